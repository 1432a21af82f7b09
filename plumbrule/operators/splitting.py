"""Reproducible contiguous splits over batches, without a single-task sort.

Only the key columns are sorted. They are range partitioned, numbered inside each
partition and checkpointed; the partition sizes give the offsets. Wide rows are never
moved: a subset is the range between two boundary keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.constants import BATCH_SIZE, SPLIT_SHARES
from plumbrule.functions.columns import column
from plumbrule.workspace import cut_lineage

# monotonically_increasing_id puts the partition above the row number in it, at this bit.
PARTITION_SHIFT = 33
PLACE, PART = "__place", "__part"


@dataclass(frozen=True)
class Positions:
    """Key columns with `row_index`, the place of the row in key order, and the row count."""

    frame: DataFrame
    rows: int


def row_positions(df: DataFrame, *keys: str) -> Positions:
    """Place of every row in the order of `keys`, which have to identify the row."""
    by_key = df.select(*(column(key) for key in keys)).orderBy(*(column(key) for key in keys))
    placed = cut_lineage(by_key.withColumn(PLACE, F.monotonically_increasing_id()))
    part = F.shiftright(PLACE, PARTITION_SHIFT)
    in_part = F.col(PLACE) - F.shiftleft(part, PARTITION_SHIFT)
    # One row per sort partition comes back, whatever the size of the data.
    sizes = placed.groupBy(part.alias(PART)).agg((F.max(in_part) + 1).alias("rows")).orderBy(PART).collect()
    ends = list(accumulate(row["rows"] for row in sizes))
    starts = [0, *ends][: len(sizes)]
    offsets = df.sparkSession.createDataFrame(
        pa.table({PART: pa.array([row[PART] for row in sizes], pa.int64()), "__start": pa.array(starts, pa.int64())})
    )
    numbered = placed.withColumn(PART, part).join(F.broadcast(offsets), PART)
    frame = numbered.select(*(column(key) for key in keys), (F.col("__start") + in_part).alias("row_index"))
    return Positions(frame, ends[-1] if ends else 0)


def subset_ends(rows: int, batch_size: int = BATCH_SIZE) -> list[tuple[str, int]]:
    """(subset, number of batches up to its end) in order, for a number of rows."""
    batches = -(-rows // batch_size)
    ends, taken = [], 0
    for name, share, extra in SPLIT_SHARES:
        taken = min(batches, taken + int(batches * share) + extra)
        ends.append((name, taken))
    return ends


def batch_numbers(df: DataFrame, *keys: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Key columns with `row_index`, `batch` and `subset` (NULL if in no subset)."""
    positions = row_positions(df, *keys)
    batch = F.expr(f"row_index div {int(batch_size)}")
    subset = _labels(F.col("batch"), [(name, F.lit(end)) for name, end in subset_ends(positions.rows, batch_size)])
    return positions.frame.withColumn("batch", batch).withColumn("subset", subset)


def batch_split(df: DataFrame, *keys: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """`df` with its `subset`, each a contiguous run of batches in key order.

    The rows keep their place; each compares its key with the first keys of the subsets.
    """
    positions = row_positions(df, *keys)
    ends = subset_ends(positions.rows, batch_size)
    ends_at = {end * batch_size for _, end in ends if end * batch_size < positions.rows}
    first_keys = _keys_at(positions, keys, ends_at)
    key = F.struct(*(column(name) for name in keys))
    subset: Column = F.lit(None).cast("string")
    for name, end in reversed(ends):
        if end * batch_size >= positions.rows:
            subset = F.lit(name)
            continue
        limit = F.struct(*(F.lit(value).alias(part) for part, value in zip(keys, first_keys[end * batch_size])))
        subset = F.when(key < limit, name).otherwise(subset)
    return df.withColumn("subset", subset)


def _labels(value: Column, ends: Sequence[tuple[str, Column]]) -> Column:
    (name, end), *others = ends
    label = F.when(value < end, name)
    for name, end in others:
        label = label.when(value < end, name)
    return label


def _keys_at(positions: Positions, keys: Sequence[str], places: set[int]) -> dict[int, tuple]:
    """Keys of the rows at the given places: the two boundaries of a split at most."""
    if not places:
        return {}
    wanted = places | {place - 1 for place in places if place > 0}
    rows = positions.frame.where(F.col("row_index").isin(*wanted)).collect()
    found = {row["row_index"]: tuple(row[key] for key in keys) for row in rows}
    for place in places:
        if found[place] == found.get(place - 1):
            raise ValueError(f"{', '.join(keys)} does not identify a row; name more key columns")
    return {place: found[place] for place in places}


def sample_rows(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """The first rows in key order. Taken per task, then merged."""
    return df.orderBy(*(column(key) for key in keys)).limit(rows)
