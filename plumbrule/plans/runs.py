"""Whole runs: check a table and save the report; audit a saved report."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from plumbrule.operators.execution import execute_rules
from plumbrule.operators.reconcile import (
    compare_counts,
    compared,
    false_negatives,
    false_positives,
    mismatch_summary,
    record_balance,
    summary_check,
)
from plumbrule.operators.report import all_violations, report_sorted, rule_summary
from plumbrule.operators.sql_rules import SqlRule
from plumbrule.plans.options import RuleOptions
from plumbrule.plans.rules import Rule
from plumbrule.sources.sinks import RunManifest, write_report_csv, write_run_manifest
from plumbrule.workspace import scratch_path


@dataclass(frozen=True)
class CheckRun:
    """What a run left behind."""

    manifest: RunManifest
    report: DataFrame
    summary: DataFrame
    log: DataFrame


def run_checks(
    table: DataFrame,
    rules: Sequence[Rule],
    output_path: str,
    options: RuleOptions = RuleOptions(),
    sql_rules: Sequence[SqlRule] = (),
    subject: str | None = None,
    run_id: str | None = None,
    started: datetime | None = None,
) -> CheckRun:
    """Evaluate all rules and save report, summary, rows of SQL rules, log and manifest.

    A rule that cannot run, or a SQL rule that its check rejects, is logged with its error and stops no other. The table is read for
    the report only. Summary and CSV come from the saved report, the CSV in reading order over numbered files. The folders
    of a run end in its `run_ts` and `run_id`; the run counts as done once it stands in `runs`, which is written last.
    """
    spark = table.sparkSession
    started = started or datetime.now(timezone.utc).replace(tzinfo=None)
    base = output_path.rstrip("/")
    manifest = RunManifest(
        run_ts=started.strftime("%Y%m%d_%H%M%S"),
        run_id=run_id or str(uuid.uuid4()),
        timestamp=started.isoformat(),
        run_date=options.today().isoformat(),
        output_path=base,
    )
    done = execute_rules(
        table,
        rules,
        manifest.place("violations"),
        manifest.place("rule_rows"),
        options,
        sql_rules,
        subject,
        manifest.run_id,
        manifest.timestamp,
    )
    summary = rule_summary(done.report)
    write_report_csv(report_sorted(done.report), manifest.place("fail_report"))
    write_report_csv(summary, manifest.place("rule_summary") + ".csv", single_file=True)
    write_run_manifest(spark, base, manifest, rules, sql_rules, done.log)
    return CheckRun(manifest, done.report, summary, done.log)


@dataclass(frozen=True)
class Audit:
    """How a report compares with freshly computed violations."""

    truth: DataFrame
    comparison: DataFrame
    mismatches: DataFrame
    summary: DataFrame | None
    missed: DataFrame
    invented: DataFrame


def audit_report(
    table: DataFrame,
    rules: Sequence[Rule],
    report: DataFrame,
    options: RuleOptions,
    saved_summary: DataFrame | None = None,
    truth_path: str | None = None,
) -> Audit:
    """Recompute the violations of `table` and reconcile `report` with them.

    The truth is written once (to the shared folder unless a path is given), and so is its balance with the report, which
    every comparison reads.
    """
    spark = table.sparkSession
    truth_path = truth_path or scratch_path(spark, "truth")
    expected = all_violations(table, rules, replace(options, explain=False))
    compared(expected).write.mode("overwrite").parquet(truth_path)
    truth = spark.read.parquet(truth_path)
    balance = record_balance(truth, compared(report), saved_summary)
    return Audit(
        truth=truth,
        comparison=compare_counts(balance, rules),
        mismatches=mismatch_summary(balance, rules),
        summary=None if saved_summary is None else summary_check(balance, rules),
        missed=false_negatives(balance),
        invented=false_positives(balance),
    )
