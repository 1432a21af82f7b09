"""Writing reports, results and the record of a run."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbrule.functions.columns import column
from plumbrule.operators.sql_rules import SqlRule
from plumbrule.plans.rules import Rule
from plumbrule.sources.tables import REPORT_CSV

WRITE_OPTIONS = {key: value for key, value in REPORT_CSV.items() if key != "multiLine"}


def write_report_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write as CSV that reads back unchanged (but for empty text, which reads as NULL).

    By default a folder with one file per task, whose numbers follow the order of a sorted frame. `single_file` makes one file at
    exactly `path`, which one task writes row by row, in the frame's order: it is written next to it and moved into place, so a
    reader sees the old file or the new one.
    """
    if not single_file:
        df.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
        return
    spark = df.sparkSession
    work = f"{path}.tmp-{uuid.uuid4().hex}"
    df.coalesce(1).write.options(**WRITE_OPTIONS).csv(work)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, folder = hadoop.Path(path), hadoop.Path(work)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("part-"))
    if files.exists(target):
        files.delete(target, True)
    files.rename(part, target)
    files.delete(folder, True)


def write_results(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The report as Parquet, one folder per rule.

    The rebalance hint spreads a rule with many violations over several files and gathers
    small ones, so the number of files follows the data and not tasks times rules.
    """
    report.hint("rebalance", "rule_id").write.mode(mode).partitionBy("rule_id").parquet(path)


def rule_folder(path: str, rule_id: str) -> str:
    return f"{path}/{quote(rule_id, safe='')}"


def write_rule_rows(rows: DataFrame, path: str, rule_id: str) -> None:
    """The rows a SQL rule returned, in their own columns, in the rule's folder. Columns without a type become text."""
    untyped = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.NullType)}
    typed = rows.select(*(F.lit(None).cast("string").alias(name) if name in untyped else column(name) for name in rows.columns))
    typed.write.mode("overwrite").parquet(rule_folder(path, rule_id))


def read_rule_rows(spark: SparkSession, path: str, rule_id: str) -> DataFrame:
    """The saved rows of a SQL rule."""
    return spark.read.parquet(rule_folder(path, rule_id))


@dataclass(frozen=True)
class RunManifest:
    """What identifies a run."""

    run_ts: str
    run_id: str
    timestamp: str
    run_date: str
    output_path: str

    def place(self, name: str) -> str:
        """Path of a file or folder of this run."""
        return f"{self.output_path}/{name}_{self.run_ts}_{quote(self.run_id, safe='')}"


def write_run_manifest(
    spark: SparkSession,
    path: str,
    manifest: RunManifest,
    rules: Sequence[Rule] = (),
    sql_rules: Sequence[SqlRule] = (),
    log: DataFrame | None = None,
) -> None:
    """Append a run: the rules it used, with their definition or SQL, to `run_rules`, the log of its rules to `run_log`, and last
    the run itself to `runs`. A run counts once it stands there; what an interrupted run left in the other tables is not read."""
    used = [
        {
            "run_id": manifest.run_id,
            "rule_id": rule.rule_id,
            "rule_name": rule.name,
            "check_type": rule.check_type,
            "failed_field": getattr(rule, "failed_field", None),
            "sql": getattr(rule, "sql", None),
            "explanation": getattr(rule, "explanation", None),
            "definition": json.dumps(rule.source, sort_keys=True) if isinstance(rule, Rule) else None,
        }
        for rule in (*rules, *sql_rules)
    ]
    if used:
        _append(spark, f"{path}/run_rules", used)
    if log is not None:
        log.withColumn("run_id", F.lit(manifest.run_id)).coalesce(1).write.mode("append").parquet(f"{path}/run_log")
    _append(spark, f"{path}/runs", [vars(manifest)])


def _append(spark: SparkSession, path: str, rows: Sequence[Mapping[str, str | None]]) -> None:
    columns = {name: pa.array([row[name] for row in rows], pa.string()) for name in rows[0]}
    spark.createDataFrame(pa.table(columns)).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All recorded runs."""
    return spark.read.parquet(f"{path}/runs")


def read_run_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rules of all recorded runs."""
    return _of_recorded_runs(spark, path, "run_rules")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Status, rows and error of the rules of all recorded runs."""
    return _of_recorded_runs(spark, path, "run_log")


def _of_recorded_runs(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}").join(read_runs(spark, path).select("run_id"), "run_id", "left_semi")


def latest_run(spark: SparkSession, path: str) -> DataFrame:
    """The most recent run."""
    return read_runs(spark, path).orderBy(F.desc("run_ts"), F.desc("run_id")).limit(1)
