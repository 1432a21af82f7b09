"""Profiling of wide text tables in one scan, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrule.constants import (
    DATE_NAME_PARTS,
    DATE_SHAPES,
    OTHER_SHAPE,
    PROFILE_FORMATS,
    PROFILE_SENTINEL,
    SENTINELS,
)
from plumbrule.functions.columns import clean_text, column


def date_columns(df: DataFrame, parts: Sequence[str] = DATE_NAME_PARTS) -> list[str]:
    """Columns whose name says that they hold dates."""
    return [name for name in df.columns if any(part in name.lower() for part in parts)]


def long_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The trimmed values of the columns, one per row: `column_name`, `v`."""
    texts = df.select(*(clean_text(name).alias(name) for name in columns))
    return texts.unpivot([], [column(name) for name in columns], "column_name", "v")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, trimmed value): `column_name`, `v`, `n`.

    The columns are unpivoted in the scan stage and counted partially there. A value is
    then looked at once, not once per row, which is what makes parsing it affordable.
    """
    return long_texts(df, columns).groupBy("column_name", "v").agg(F.count("*").alias("n"))


def date_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per date column: how many values are absent, readable in each layout, or neither."""
    columns = date_columns(df) if columns is None else list(columns)
    v, n = F.col("v"), F.col("n")

    def rows_where(condition):
        return F.sum(F.when(condition, n).otherwise(0))

    formats = {alias: rows_where(F.try_to_date(v, layout).isNotNull()) for layout, alias in PROFILE_FORMATS}
    profile = value_counts(df, columns).groupBy("column_name").agg(
        F.sum("n").alias("total_rows"),
        rows_where(v.isNull()).alias("null_count"),
        rows_where(v == "").alias("blank_count"),
        rows_where(v == PROFILE_SENTINEL).alias("sentinel_count"),
        rows_where(v.isin(*SENTINELS)).alias("sentinel_any_count"),
        *(counted.alias(alias) for alias, counted in formats.items()),
        F.count("v").alias("distinct_values"),
    )
    accounted = sum((F.col(name) for name in formats), F.col("null_count") + F.col("blank_count"))
    return profile.withColumn("unparsed_nonblank_count", F.col("total_rows") - accounted).orderBy("column_name")


def date_format_histogram(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per date column: rows per shape of the text, blanks left out.

    The shape is told in the scan stage, before anything is counted, so a task shuffles a row per column and shape at most.
    """
    columns = date_columns(df) if columns is None else list(columns)
    (first, pattern), *others = DATE_SHAPES
    shape = F.when(F.col("v").rlike(pattern), first)
    for name, pattern in others:
        shape = shape.when(F.col("v").rlike(pattern), name)
    present = long_texts(df, columns).where(F.col("v") != "")
    shaped = present.select("column_name", shape.otherwise(OTHER_SHAPE).alias("detected_format"))
    return shaped.groupBy("column_name", "detected_format").agg(F.count("*").alias("count")).orderBy("column_name", "detected_format")


def semantic_schema(df: DataFrame) -> DataFrame:
    """Per column: DATE by its name, NUMERIC if every value is all digits, else STRING.

    One aggregation over all values of all columns at once; only its single row is unpivoted.
    """
    all_digits = [
        F.coalesce(F.bool_and(column(name).cast("string").rlike("^[0-9]+$")), F.lit(False)).alias(name)
        for name in df.columns
    ]
    totals = df.agg(F.count("*").alias("__rows"), *all_digits)
    columns = totals.unpivot("__rows", [column(name) for name in df.columns], "column_name", "digits")
    kind = (
        F.when(F.lower("column_name").contains("date"), "DATE").when(F.col("digits"), "NUMERIC").otherwise("STRING")
    )
    return columns.select("column_name", kind.alias("semantic_type"), F.col("__rows").alias("row_count"))


def table_shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))
