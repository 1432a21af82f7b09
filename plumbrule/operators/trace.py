"""Follow records through one rule: what the table holds, what the rule makes of it, what was reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.constants import COMPLETENESS_VALUE, NULL_TEXT, UNKNOWN_TEXT
from plumbrule.functions.columns import clean_text, column, missing_flag
from plumbrule.plans.options import RuleOptions
from plumbrule.plans.rules import Rule

TRACE_COLUMNS = ("record_id", "stage", "position", "field", "value", "normalized", "missing")


def _entry(stage: str, position: int, field: str, value: Column, normalized: Column, missing: Column) -> Column:
    return F.struct(
        F.lit(stage).alias("stage"),
        F.lit(position).alias("position"),
        F.lit(field).alias("field"),
        value.cast("string").alias("value"),
        normalized.alias("normalized"),
        missing.alias("missing"),
    )


def _seen(stage: str, position: int, name: str, df: DataFrame, options: RuleOptions) -> Column:
    """A column as the stage sees it. A column the stage does not have counts as missing."""
    if name.lower() not in {present.lower() for present in df.columns}:
        return _entry(stage, position, name, F.lit(None), F.lit(NULL_TEXT), F.lit(True))
    shown = F.coalesce(clean_text(name), F.lit(NULL_TEXT))
    return _entry(stage, position, name, column(name), shown, missing_flag(name, options.sentinels))


def _rows(df: DataFrame, stage: str, rule: Rule, record_id: str | None, options: RuleOptions) -> DataFrame:
    """Phase, the columns the rule reads in that phase, and which of them it finds missing.

    One scan: all rows of a record come out of one explode. Without a phase column, as a SQL rule may return rows, the phase
    is UNKNOWN, for which no rule lists gates.
    """
    available = {name.lower() for name in df.columns}
    phase = clean_text(options.phase_column) if options.phase_column.lower() in available else F.lit(UNKNOWN_TEXT)
    by_phase = [(phase == name, gates) for name, gates in rule.phase_gates]
    cases = by_phase or [(F.lit(True), rule.used_columns())]
    entries = [_seen(stage, 0, options.phase_column, df, options)]
    for applies, names in cases:
        for position, name in enumerate(names, start=1):
            entries.append(F.when(applies, _seen(stage, position, name, df, options)))
            missing = missing_flag(name, options.sentinels) if name.lower() in available else F.lit(True)
            found = _entry(
                f"{stage}_missing",
                position,
                options.label(name),
                F.lit(None),
                F.lit(COMPLETENESS_VALUE),
                F.lit(True),
            )
            entries.append(F.when(applies & missing, found))
    key = clean_text(options.id_column)
    wanted = df if record_id is None else df.where(key == record_id)
    exploded = wanted.select(
        F.coalesce(key, F.lit(UNKNOWN_TEXT)).alias("record_id"), F.explode(F.array(*entries)).alias("e")
    )
    return exploded.where(F.col("e").isNotNull()).select("record_id", "e.*")


def trace_record(
    df: DataFrame,
    rule: Rule,
    record_id: str | None = None,
    report: DataFrame | None = None,
    returned: DataFrame | None = None,
    options: RuleOptions = RuleOptions(),
) -> DataFrame:
    """Trace of one record, or of every record if none is named, as one tidy frame.

    Stages: `source` (phase and checked columns in the table), `source_missing` (labels of
    those the rule finds missing), `result` / `result_missing` (the same for the rows a
    SQL rule returned) and `report` (reported field and value, with the explanation
    as normalized text).
    """
    trace = _rows(df, "source", rule, record_id, options)
    if returned is not None:
        trace = trace.unionByName(_rows(returned, "result", rule, record_id, options))
    if report is not None:
        reported = report.where(F.col("rule_id") == rule.rule_id)
        key = F.trim("record_id")
        if record_id is not None:
            reported = reported.where(key == record_id)
        explanation = F.col("explanation") if "explanation" in report.columns else F.lit(None).cast("string")
        trace = trace.unionByName(
            reported.select(
                key.alias("record_id"),
                F.lit("report").alias("stage"),
                F.lit(0).alias("position"),
                F.col("failed_field").alias("field"),
                F.col("failed_value").alias("value"),
                explanation.alias("normalized"),
                F.lit(None).cast("boolean").alias("missing"),
            )
        )
    return trace.select(*TRACE_COLUMNS)
