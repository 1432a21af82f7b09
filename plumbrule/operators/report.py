"""From violations to the report people read, and its summary."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrule.constants import REPORT_COLUMNS, REPORT_ORDER, SUMMARY_KEYS, UNIQUE
from plumbrule.operators.ordering import ordered
from plumbrule.operators.row_rules import check_rule, row_violations
from plumbrule.operators.sql_rules import SqlRule, sql_violations
from plumbrule.operators.unique_rules import unique_violations
from plumbrule.plans.options import RuleOptions
from plumbrule.plans.rules import Rule, rules_table


def all_violations(
    df: DataFrame,
    rules: Sequence[Rule],
    options: RuleOptions = RuleOptions(),
    sql_rules: Sequence[SqlRule] = (),
    subject: str | None = None,
) -> DataFrame:
    """Violations of all rules.

    Row-level rules share one scan, uniqueness rules share their key counts, and each
    SQL rule is its own query.
    """
    usable = [rule for rule in rules if check_rule(rule, df.columns, options)]
    result = row_violations(df, [rule for rule in usable if rule.check_type != UNIQUE], options)
    repeated = [rule for rule in usable if rule.check_type == UNIQUE]
    if repeated:
        result = result.unionByName(unique_violations(df, repeated, options))
    if sql_rules:
        result = result.unionByName(sql_violations(df.sparkSession, sql_rules, options, subject))
    return result


def violation_report(
    violations: DataFrame,
    rules: Iterable[Rule | SqlRule],
    run_id: str,
    timestamp: str,
) -> DataFrame:
    """The report: violations with run and rule data, eleven text columns.

    The rules come from a file on the driver, so the broadcast side has its size.
    """
    rules = list(rules)
    if len({rule.rule_id for rule in rules}) < len(rules):
        raise ValueError("two rules have the same id")
    described = rules_table(violations.sparkSession, rules).drop("check_type")
    joined = violations.join(F.broadcast(described), "rule_id", "left")
    stamped = joined.withColumns({"run_id": F.lit(run_id), "timestamp": F.lit(timestamp)})
    return stamped.select(*REPORT_COLUMNS)


def report_sorted(report: DataFrame) -> DataFrame:
    """The report in its reading order."""
    return ordered(report, *REPORT_ORDER)


def rule_summary(report: DataFrame) -> DataFrame:
    """Violations per rule, in rule order. Rules without any are absent."""
    counts = report.groupBy(*SUMMARY_KEYS).agg(F.count("record_id").alias("violation_count"))
    return counts.orderBy("rule_id")


def full_rule_summary(report: DataFrame, rules: Iterable[Rule | SqlRule]) -> DataFrame:
    """`rule_summary` with a zero for every rule that found nothing."""
    counts = report.groupBy("rule_id").agg(F.count("record_id").alias("violation_count"))
    listed = rules_table(report.sparkSession, rules).select(*SUMMARY_KEYS)
    return listed.join(counts, "rule_id", "left").fillna(0, ["violation_count"]).orderBy("rule_id")


def violation_total(summary: DataFrame) -> DataFrame:
    """Grand total of a rule summary, zero if it is empty."""
    return summary.agg(F.coalesce(F.sum("violation_count"), F.lit(0)).alias("violation_total"))
