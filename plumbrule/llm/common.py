"""What several operators share: words, staged tables, ranks and running sums without a hot task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbrule.workspace import scratch_path

# A word is what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Rows that one window partition of a running sum holds on average: 2 to this power.
FAN_BITS = 12
# Bits of the keys made by `spread_key`.
KEY_BITS = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage, survives lost executors. `paths` gets where it lies."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove staged tables that no plan still to be run reads."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    paths.clear()


def spread_key(*parts: Column | str) -> Column:
    """A uniform key of 60 bits from md5, the same in every engine; NULL counts as an empty text."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) if isinstance(part, Column) else F.lit(part) for part in parts]
    return hex_number(F.md5(F.concat_ws(":", *texts)), KEY_BITS // 4)


def hex_number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def running_sums(
    rows: DataFrame, group: Sequence[str], key: str, key_bits: int, amount: str, out: str, ties: Sequence[str] = ()
) -> DataFrame:
    """`rows` and the sum of `amount` over the rows before each one in its group, by (`key`, `ties`).

    `key` is a long below 2 ** `key_bits`, spread evenly or dense from 0, so that its leading bits cut
    every group into cells of about 4,096 rows at most. Cells are summed, their running sums found in
    the same way, and added to the sums within a cell: no window holds a whole group. Each level has
    fewer key bits than the one above, however many groups there are, and its own helper columns. `group`
    columns hold no NULL. `rows` is read more than once and should be staged.
    """
    found = rows.count()
    cell_bits = max(0, min(key_bits, math.ceil(math.log2(max(found, 1)))) - FAN_BITS)
    cell, start, part = f"__cell_{key_bits}", f"__start_{key_bits}", f"__amount_{key_bits}"
    before = Window.partitionBy(*group, cell).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    celled = rows.withColumn(cell, F.shiftright(F.col(key), key_bits - cell_bits))
    within = celled.withColumn(out, F.coalesce(F.sum(amount).over(before), F.lit(0).cast("long")))
    if cell_bits == 0:
        return within.drop(cell)
    totals = celled.groupBy(*group, cell).agg(F.sum(amount).alias(part))
    starts = running_sums(stage(totals, "cells"), group, cell, cell_bits, part, start)
    return within.join(starts.drop(part), [*group, cell]).withColumn(out, F.col(out) + F.col(start)).drop(start, cell)


def numbered(values: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct `column` values numbered from 0 in ascending order, NULL last; a range shuffle, then a table of
    one row per partition."""
    order = F.col(column).asc_nulls_last()
    ranged = values.select(column).distinct().repartitionByRange(order)
    parts = stage(ranged.withColumn("__part", F.spark_partition_id()), "ranged")
    counts = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    offsets = counts.select(
        "__part",
        F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__at"),
    )
    row = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return parts.withColumn("__row", row).join(offsets, "__part").select(column, (F.col("__at") + F.col("__row") - 1).alias(out))
