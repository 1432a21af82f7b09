"""Rules run unit by unit: what a unit has committed counts, and a failing unit stops no other.

A unit is the declared rules together (one pass over the table) or, if that fails, each declared rule by itself; and every SQL
rule. A unit appends its part of the report, one folder per rule, in a job of its own, so a unit is either in the
report or not. The rows of a SQL rule are saved in their own columns first; its violations are read from there, so its
query runs once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbrule.constants import TRIAL_ROWS
from plumbrule.operators.report import all_violations, violation_report
from plumbrule.operators.row_rules import check_rule
from plumbrule.operators.sql_rules import SqlRule, run_sql_rule, sql_rule_check, sql_rule_violations
from plumbrule.plans.options import RuleOptions
from plumbrule.plans.rules import Rule
from plumbrule.sources.sinks import read_rule_rows, write_results, write_rule_rows
from plumbrule.workspace import scratch_path

OK, ERROR, SKIPPED = "OK", "ERROR", "SKIPPED"


@dataclass(frozen=True)
class Execution:
    """What a run has committed: the report, and a row per rule with status, rows and error."""

    report: DataFrame
    log: DataFrame


class Units:
    """The units of one run and where they write."""

    def __init__(self, df: DataFrame, options: RuleOptions, path: str, rows_path: str, run_id: str, timestamp: str):
        self.df, self.options, self.path, self.rows_path = df, options, path, rows_path
        self.run_id, self.timestamp = run_id, timestamp
        self.status: dict[str, tuple[str, str | None]] = {}

    def commit(self, violations: DataFrame, rules: Sequence[Rule | SqlRule]) -> DataFrame:
        """Append the violations of `rules` to the report."""
        if "explanation" not in violations.columns:
            violations = violations.withColumn("explanation", F.lit(None).cast("string"))
        described = violation_report(violations, rules, self.run_id, self.timestamp)
        write_results(described, self.path, mode="append")
        return described

    def declared(self, rules: Sequence[Rule]) -> None:
        """All rules in one pass, or each by itself if one of them is faulty."""
        usable = []
        for rule in rules:
            try:
                if check_rule(rule, self.df.columns, self.options):
                    usable.append(rule)
                else:
                    self.status[rule.rule_id] = (SKIPPED, f"unknown check type '{rule.check_type}'")
            except ValueError as error:
                self.status[rule.rule_id] = (ERROR, str(error))
        if self.attempt(usable) or len(usable) == 1:
            return
        for rule in usable:
            self.attempt([rule])

    def attempt(self, rules: Sequence[Rule]) -> bool:
        try:
            if rules:
                self.commit(all_violations(self.df, rules, self.options), rules)
        except Exception as error:  # the table's data may fail a rule in any way
            self.status |= {rule.rule_id: (ERROR, f"{type(error).__name__}: {error}") for rule in rules}
            return False
        self.status |= {rule.rule_id: (OK, None) for rule in rules}
        return True

    def query(self, rule: SqlRule, subject: str | None, trial_rows: int | None) -> None:
        """A SQL rule: accepted by its check (unless there are no `trial_rows`), saved as it returns, then reported."""
        spark = self.df.sparkSession
        try:
            problem = sql_rule_check(spark, rule, self.options, subject, trial_rows) if trial_rows else None
            if problem is None:
                write_rule_rows(run_sql_rule(spark, rule, self.options, subject), self.rows_path, rule.rule_id)
                returned = read_rule_rows(spark, self.rows_path, rule.rule_id)
                self.commit(sql_rule_violations(returned, rule, self.options), [rule])
            self.status[rule.rule_id] = (OK, None) if problem is None else (ERROR, problem)
        except Exception as error:  # a user's query may fail in any way
            self.status[rule.rule_id] = (ERROR, f"{type(error).__name__}: {error}")


def execute_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    path: str,
    rows_path: str,
    options: RuleOptions = RuleOptions(),
    sql_rules: Sequence[SqlRule] = (),
    subject: str | None = None,
    run_id: str = "",
    timestamp: str = "",
    trial_rows: int | None = TRIAL_ROWS,
) -> Execution:
    """Run all rules; the report goes to `path`, rows of SQL rules to folders below `rows_path`. Both must be new.

    `row_count` of the log is the number of report rows of a rule, NULL if it is not `OK`. Only counts come back to the driver. Two
    rules with one id are an error.
    """
    spark = df.sparkSession
    ids = [rule.rule_id for rule in (*rules, *sql_rules)]
    if len(set(ids)) < len(ids):
        raise ValueError("two rules have the same id")
    units = Units(df, options, path, rows_path, run_id, timestamp)
    empty = units.commit(all_violations(df.limit(0), [], options), [])  # so that a run without any violation has a report
    units.declared(rules)
    for rule in sql_rules:
        units.query(rule, subject, trial_rows)
    report = spark.read.schema(empty.schema).parquet(path).select(*empty.columns)
    counts = {row["rule_id"]: row["count"] for row in report.groupBy("rule_id").count().collect()}
    rows = []
    for rule_id in ids:
        status, error = units.status[rule_id]
        rows.append((rule_id, status, counts.get(rule_id, 0) if status == OK else None, error))
    return Execution(report, log_frame(spark, rows))


def rule_execution_log(
    df: DataFrame,
    rules: Sequence[Rule],
    options: RuleOptions = RuleOptions(),
    sql_rules: Sequence[SqlRule] = (),
    subject: str | None = None,
) -> DataFrame:
    """Status, number of reported rows and error of each rule, without keeping the report: it goes to the shared folder."""
    spark = df.sparkSession
    return execute_rules(df, rules, scratch_path(spark, "report"), scratch_path(spark, "rule_rows"), options, sql_rules, subject, trial_rows=None).log


def log_frame(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    rows = list(rows)
    types = (("rule_id", pa.string()), ("status", pa.string()), ("row_count", pa.int64()), ("error", pa.string()))
    columns = [pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(types)]
    return spark.createDataFrame(pa.table(columns, names=[name for name, _ in types]))
