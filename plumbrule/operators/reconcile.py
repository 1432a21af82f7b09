"""Differential check of two violation reports, and of a saved summary.

Both reports are brought to one row per (rule, record) with the number of rows on either side: a union and one aggregation, so
a record that occurs very often is counted partially before the shuffle and no join can be skewed. That balance is written to the
shared folder once; every result is read from it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.constants import COMPARED_COLUMNS, MISMATCH_SAMPLE_ROWS
from plumbrule.plans.rules import Rule, rules_table
from plumbrule.workspace import scratch_path

KEY = ("rule_id", "record_id")
TRUTH_COUNTS = ("gt_fail_report_count", "gt_distinct_records")
ACTUAL_COUNTS = ("actual_fail_report_count", "actual_distinct_records")
MISMATCH_COUNTS = ("false_negative_records", "false_positive_records")
SUMMARY_COUNT = "dq_summary_count"


def compared(report: DataFrame) -> DataFrame:
    """The compared columns of a report, as text."""
    return report.select(*(F.col(name).cast("string").alias(name) for name in COMPARED_COLUMNS))


def record_balance(truth: DataFrame, actual: DataFrame, saved_summary: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """Per (rule, record): rows in the truth, rows in the report under test, and what a saved summary counts.

    Written to `path`, or to the shared folder, and read from there. A saved summary knows no records; its count stands at the
    rule's NULL record, and is NULL for rules it does not list.
    """

    def side(report: DataFrame, record: Column, truth_rows: int, actual_rows: int, counted: Column) -> DataFrame:
        numbers = (F.lit(truth_rows).alias("t"), F.lit(actual_rows).alias("a"), counted.cast("long").alias("s"))
        return report.select(F.col("rule_id").cast("string").alias("rule_id"), record.cast("string").alias("record_id"), *numbers)

    nothing = F.lit(None)
    sides = side(truth, F.col("record_id"), 1, 0, nothing).unionByName(side(actual, F.col("record_id"), 0, 1, nothing))
    if saved_summary is not None:
        sides = sides.unionByName(side(saved_summary, nothing, 0, 0, F.col("violation_count")))
    balance = sides.groupBy(*KEY).agg(F.sum("t").alias("truth_rows"), F.sum("a").alias("actual_rows"), F.sum("s").alias("summary_rows"))
    path = path or scratch_path(truth.sparkSession, "balance")
    balance.write.mode("overwrite").parquet(path)
    return truth.sparkSession.read.schema(balance.schema).parquet(path)


def _only_in(rows: str, other: str) -> Column:
    """Present on one side only. A key with a NULL part equals no other key."""
    incomplete = F.col("rule_id").isNull() | F.col("record_id").isNull()
    return (F.col(rows) > 0) & ((F.col(other) == 0) | incomplete)


def _is_missed() -> Column:
    return _only_in("truth_rows", "actual_rows")


def _is_invented() -> Column:
    return _only_in("actual_rows", "truth_rows")


def reconcile(balance: DataFrame) -> DataFrame:
    """All counts per rule, in one aggregation of the balance."""
    known = F.col("record_id").isNotNull()
    return balance.groupBy("rule_id").agg(
        F.sum("truth_rows").alias("gt_fail_report_count"),
        F.count_if((F.col("truth_rows") > 0) & known).alias("gt_distinct_records"),
        F.sum("actual_rows").alias("actual_fail_report_count"),
        F.count_if((F.col("actual_rows") > 0) & known).alias("actual_distinct_records"),
        F.count_if(_is_missed()).alias("false_negative_records"),
        F.count_if(_is_invented()).alias("false_positive_records"),
        F.sum("summary_rows").alias(SUMMARY_COUNT),
    )


def truth_summary(balance: DataFrame) -> DataFrame:
    """Rows and distinct records per rule of the true violations."""
    return reconcile(balance).where(F.col(TRUTH_COUNTS[0]) > 0).select("rule_id", *TRUTH_COUNTS)


def actual_summary(balance: DataFrame) -> DataFrame:
    """Rows and distinct records per rule of the report under test."""
    return reconcile(balance).where(F.col(ACTUAL_COUNTS[0]) > 0).select("rule_id", *ACTUAL_COUNTS)


def _agree(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


def _per_rule(balance: DataFrame, rules: Iterable[Rule], **shown: Column) -> DataFrame:
    """Every rule of the rules file with columns made of its counts, which are 0 where it has none."""
    listed = rules_table(balance.sparkSession, rules).select("rule_id", "rule_name", "check_type")
    counted = listed.join(reconcile(balance), "rule_id", "left").fillna(0, [*TRUTH_COUNTS, *ACTUAL_COUNTS, *MISMATCH_COUNTS])
    return counted.select(*listed.columns, *(made.alias(name) for name, made in shown.items())).orderBy("rule_id")


def _comparison() -> dict[str, Column]:
    (truth_rows, truth_records), (actual_rows, actual_records) = TRUTH_COUNTS, ACTUAL_COUNTS
    return {name: F.col(name) for name in TRUTH_COUNTS + ACTUAL_COUNTS} | {
        "count_delta": F.col(actual_rows) - F.col(truth_rows),
        "record_delta": F.col(actual_records) - F.col(truth_records),
        "count_match": _agree(actual_rows, truth_rows),
    }


def compare_counts(balance: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Every rule with the counts of both reports, their differences and whether they agree."""
    return _per_rule(balance, rules, **_comparison())


def mismatch_summary(balance: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Every rule with the number of records missed and of records invented."""
    return _per_rule(balance, rules, **{name: F.col(name) for name in MISMATCH_COUNTS})


def summary_check(balance: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """`compare_counts`, and does the saved summary agree with the truth and with the report? NULL for rules it does not list."""
    verdicts = {
        SUMMARY_COUNT: F.col(SUMMARY_COUNT),
        "dq_summary_matches_ground_truth": _agree(SUMMARY_COUNT, TRUTH_COUNTS[0]),
        "dq_summary_matches_generated_report": _agree(SUMMARY_COUNT, ACTUAL_COUNTS[0]),
    }
    return _per_rule(balance, rules, **_comparison(), **verdicts)


def false_negatives(balance: DataFrame) -> DataFrame:
    """Distinct (rule, record) of the truth that the report lacks."""
    return balance.where(_is_missed()).select(*KEY)


def false_positives(balance: DataFrame) -> DataFrame:
    """Distinct (rule, record) of the report that are not true."""
    return balance.where(_is_invented()).select(*KEY)


def mismatch_sample(mismatches: DataFrame, rows: int = MISMATCH_SAMPLE_ROWS) -> DataFrame:
    """The first mismatches in key order, to look at. Taken per task, then merged."""
    return mismatches.orderBy(*KEY).limit(rows)
