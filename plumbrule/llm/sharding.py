"""Sharding by weighted rendezvous hashing.

Each record key draws an exponential variable per shard, -ln(u) / weight with u from a
hash of (key, shard), and goes to the shard with the smallest. The draws of the old
shards do not change when a shard is added, so it only takes records into itself. Slots number the
records of a shard in the order of another hash of the key, by running sums over cells of that
hash: no task gets a whole shard. Only (id, size, crc) is shuffled, never text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.llm.common import KEY_BITS, hex_number, running_sums, spread_key, stage

SHARDS = 16
DIGITS = 13  # 52 bits, exact in a double


def draw(key: Column, shard: int, weight: float) -> Column:
    """-ln(u) / weight for u strictly between 0 and 1; the smallest draw wins."""
    u = (hex_number(F.md5(F.concat_ws(":", key, F.lit(str(shard)))), DIGITS) + 0.5) / float(1 << (4 * DIGITS))
    return -F.log(u) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """struct(draw, shard) of the winning shard; equal draws go to the smaller number."""
    return F.array_min(F.array(*(F.struct(draw(key, s, w).alias("draw"), F.lit(s).alias("shard")) for s, w in enumerate(weights))))


def with_shard(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS) -> DataFrame:
    """`docs` and the column `shard` of each row, without a shuffle; a NULL doc_id is one key of its own."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return docs.withColumn("shard", rendezvous(key, weights)["shard"])


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown_weight: float = 1.0) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `docs` needs doc_id and text; further columns are ignored. A NULL text counts as empty, a NULL doc_id as one key of
    its own. Rows with the same doc_id share a shard. Rows alike in every returned column follow each other in the slots.
    """
    if not weights or min(*weights, grown_weight) <= 0:
        raise ValueError("weights must be positive, and at least one")
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    alike = narrow.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    best = alike.withColumn("best", rendezvous(key, weights)).withColumn("grown", draw(key, len(weights), grown_weight))
    placed = stage(
        best.select(
            "doc_id",
            "size",
            "text_crc32",
            "copies",
            F.col("best.shard").alias("shard"),
            F.when(F.col("grown") < F.col("best.draw"), len(weights)).otherwise(F.col("best.shard")).alias("grown_shard"),
            spread_key(F.col("doc_id"), "slot").alias("key"),
        ),
        "sharded",
    )
    starts = running_sums(placed, ["shard"], "key", KEY_BITS, "copies", "start", ["doc_id", "size", "text_crc32"])
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return starts.withColumn("copy", copy).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("start") + F.col("copy")).alias("slot"),
        "grown_shard",
    )
