"""Rules a user writes as a SELECT that returns the violating rows.

The query runs as it is. The run date is the named parameter `:run_date`, tolerant date
parsing is the SQL function `dq_to_date`, and a query that reads `IDENTIFIER(:subject)`
can be tried on a few rows first.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbrule.constants import (
    DEFAULT_DIMENSION,
    DEFAULT_SEVERITY,
    NULL_TEXT,
    TRIAL_ROWS,
    UNKNOWN_TEXT,
)
from plumbrule.functions.columns import column
from plumbrule.functions.sql import register_sql_functions
from plumbrule.operators.row_rules import shown_columns
from plumbrule.plans.options import RuleOptions

SUBJECT_PARAMETER = ":subject"


@dataclass(frozen=True)
class SqlRule:
    """A rule given as SQL, with the text to report for the rows it returns."""

    rule_id: str
    name: str
    sql: str
    failed_field: str = "unknown"
    explanation: str = ""
    severity: str = DEFAULT_SEVERITY
    dimension: str = DEFAULT_DIMENSION
    check_type: str = "sql"


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns with the same name, compared without case."""
    first: dict[str, int] = {}
    for position, name in enumerate(df.columns):
        first.setdefault(name.lower(), position)
    if len(first) == len(df.columns):
        return df
    numbered = df.toDF(*(f"c{position}" for position in range(len(df.columns))))
    return numbered.select(*(F.col(f"c{i}").alias(df.columns[i]) for i in first.values()))


def run_sql_rule(
    spark: SparkSession,
    rule: SqlRule,
    options: RuleOptions = RuleOptions(),
    subject: str | None = None,
) -> DataFrame:
    """Rows the rule's query returns, lazily. Only a query is accepted: the text is nested
    into another SELECT, where a command does not parse."""
    register_sql_functions(spark)
    query = rule.sql.strip().rstrip(";")
    arguments = {"run_date": options.today()}
    if subject is not None:
        arguments["subject"] = subject
    return dedupe_columns(spark.sql(f"SELECT * FROM (\n{query}\n) AS returned", args=arguments))


def sql_rule_check(
    spark: SparkSession,
    rule: SqlRule,
    options: RuleOptions = RuleOptions(),
    subject: str | None = None,
    trial_rows: int = TRIAL_ROWS,
) -> str | None:
    """Why the rule cannot be used, or None if it can.

    The query has to analyze (no job is needed for that) and return the id and phase
    columns first. With `subject`, the name of a table or view, it is then run on
    `trial_rows` rows of it under a name of its own, leaving the full view in place.
    """
    try:
        returned = run_sql_rule(spark, rule, options, subject).columns
        expected = [options.id_column.lower(), options.phase_column.lower()]
        if [name.lower() for name in returned[:2]] != expected:
            return f"must return {options.id_column} and {options.phase_column} first"
        if subject is not None and SUBJECT_PARAMETER in rule.sql:
            trial_view = f"{subject.replace('.', '_').replace('`', '')}__trial"
            spark.table(subject).limit(trial_rows).createOrReplaceTempView(trial_view)
            try:
                run_sql_rule(spark, rule, options, trial_view).write.format("noop").mode("overwrite").save()
            finally:
                spark.catalog.dropTempView(trial_view)
    except Exception as error:  # whatever the query does wrong is its author's to read
        return f"{type(error).__name__}: {error}"
    return None


def sql_rule_violations(returned: DataFrame, rule: SqlRule, options: RuleOptions = RuleOptions()) -> DataFrame:
    """Violations for the rows of a SQL rule: the rule's field and text, and the first
    column that does not identify the record as value."""
    present = {name.lower() for name in returned.columns}
    identifying = (options.id_column.lower(), options.phase_column.lower())
    others = [name for name in returned.columns if name.lower() not in identifying]

    def text_or(name: str | None, default: str):
        if name is None or name.lower() not in present:
            return F.lit(default)
        return F.coalesce(column(name).cast("string"), F.lit(default))

    result = returned.select(
        F.lit(rule.rule_id).alias("rule_id"),
        text_or(options.id_column, UNKNOWN_TEXT).alias("record_id"),
        text_or(options.phase_column, UNKNOWN_TEXT).alias("phase"),
        F.lit(rule.failed_field).alias("failed_field"),
        text_or(others[0] if others else None, NULL_TEXT).alias("failed_value"),
        F.lit(rule.explanation).alias("explanation"),
    )
    return result.select(*shown_columns(options))


def sql_violations(
    spark: SparkSession,
    rules: Sequence[SqlRule],
    options: RuleOptions = RuleOptions(),
    subject: str | None = None,
) -> DataFrame:
    """Violations of several SQL rules; `rules` must not be empty."""
    parts: Iterable[DataFrame] = (
        sql_rule_violations(run_sql_rule(spark, rule, options, subject), rule, options) for rule in rules
    )
    return reduce(DataFrame.unionByName, parts)
