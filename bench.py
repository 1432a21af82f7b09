"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the cores (default 8). Each
query runs into a sink that discards the rows, after one small query to warm up the session.
"""

from __future__ import annotations

import json
import os
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from catalog import fixtures as fx
from catalog.queries import OPTIONS, QUERIES, RULES
from plumbrule import all_violations
from plumbrule.operators.profile import date_columns, date_profile

HEADLINE = (
    "rule_not_null",
    "rule_unique",
    "rule_gate_overdue",
    "rule_date_sequence",
    "all_violations",
    "violation_report",
    "report_sorted",
    "rule_summary",
    "date_profile",
    "date_format_histogram",
    "semantic_schema",
    "sql_rule",
    "compare_counts",
    "false_negatives",
    "mismatch_summary",
    "trace_all_records",
    "batch_split",
    "scale_values",
    "binary_metrics",
    "score_batch",
)


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def violations_rule_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Yardstick: one scan per rule instead of one for all."""
    table = fx.projects(spark, sf)
    return reduce(DataFrame.unionByName, (all_violations(table, [rule], OPTIONS) for rule in RULES))


def profile_column_by_column(spark: SparkSession, sf: str) -> DataFrame:
    """Yardstick: one aggregate per date column."""
    table = fx.projects(spark, sf)
    return reduce(DataFrame.unionByName, (date_profile(table, [name]) for name in date_columns(table)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    discard(QUERIES["table_shape"](spark, sf_dir))
    runs = {name: QUERIES[name] for name in HEADLINE}
    runs["yardstick_violations_rule_by_rule"] = violations_rule_by_rule
    runs["yardstick_profile_column_by_column"] = profile_column_by_column
    seconds = {}
    for name, query in runs.items():
        started = time.perf_counter()
        discard(query(spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    total = sum(value for name, value in seconds.items() if not name.startswith("yardstick"))
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_queries_wall_time", "value": round(total, 3), "unit": "sec", "queries": seconds, "sf": scale}
        )
    )


if __name__ == "__main__":
    main()
