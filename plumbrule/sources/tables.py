"""Reading the subject table, rules, saved reports and image folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbrule.constants import REPORT_COLUMNS
from plumbrule.operators.reconcile import compared
from plumbrule.plans.rules import Rule, parse_rules

# How text tables are read and written. Quotes are doubled inside quotes, and a value
# may span lines.
CSV_READ = {
    "header": "true",
    "encoding": "UTF-8",
    "inferSchema": "false",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "PERMISSIVE",
    "nullValue": "",
    "emptyValue": "",
}
REPORT_CSV = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
BYTE_ORDER_MARK = "﻿"

REPORT_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in REPORT_COLUMNS])


def clean_header(df: DataFrame) -> DataFrame:
    """Column names without a leading byte order mark."""
    names = [name.lstrip(BYTE_ORDER_MARK) for name in df.columns]
    return df if names == df.columns else df.toDF(*names)


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    view: str | None = None,
    stage_to: str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """The subject table from CSV, every column text.

    A file with values that span lines is read by one task, so large tables should come as
    many files; `multiline=False` lets files be split where no value has a line break.
    `stage_to` writes the table to Parquet once and reads it from there, which a run
    of many rules or columns gains from. `view` also registers it for SQL.
    """
    options = {**CSV_READ, "multiLine": str(multiline).lower()}
    table = clean_header(spark.read.format("csv").options(**options).load(path))
    if stage_to is not None:
        table.write.mode("overwrite").parquet(stage_to)
        table = spark.read.parquet(stage_to)
    if view is not None:
        table.createOrReplaceTempView(view)
    return table


def scan_report(spark: SparkSession, path: str) -> DataFrame:
    """The compared columns of a saved violation report. NULL and empty text both read as NULL."""
    return compared(scan_full_report(spark, path))


def scan_full_report(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a saved violation report, by the names in its header."""
    return spark.read.options(**REPORT_CSV).csv(path)


def scan_summary(spark: SparkSession, path: str) -> DataFrame | None:
    """A saved rule summary, or None if there is none at the path. Other errors are raised."""
    try:
        return spark.read.options(**REPORT_CSV).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Rules from a rules file at any path Spark can read."""
    content = spark.read.text(path, wholetext=True).first()
    if content is None:
        raise ValueError(f"no rules in {path}")
    return parse_rules(content["value"])


def scan_images(spark: SparkSession, path: str) -> DataFrame:
    """Image files with their bytes; the class is the name of the parent folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.withColumn("class", parent_folder("path"))


def scan_decoded_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images (`image`, BGR bytes) with path and class; files that do not decode are left out."""
    reader = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "true")
    images = reader.load(path).withColumn("path", F.col("image.origin"))
    return images.withColumn("class", parent_folder("path"))


def parent_folder(path: str) -> Column:
    return F.element_at(F.split(F.col(path), "/"), -2)
