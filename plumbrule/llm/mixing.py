"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule is the point i * phi mod 1, phi the golden ratio. The unit interval is cut
among the sources in proportion to the slots each needs, so every stretch of the
schedule holds the sources in about these shares. Slots are ranked per source. The
words of a source, in shuffled order of its documents, form blocks of equal length, and slot r of a
source takes its block r modulo the number of blocks: a source is used up before anything of it is
repeated, and its last slot takes just what is missing to its target.

Scale: only (id, size, source) is shuffled, never text. Running sums use
`running_sums`, so a source with a third of all rows is spread over many tasks. Slots meet sources
through cells of the unit interval, an equi-join, and blocks meet slots by (source, block).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrule.llm.common import KEY_BITS, WORD, numbered, running_sums, same, spread_key, stage
from plumbrule.workspace import broadcast_if_small

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
BLOCK_WORDS = 4096
SEED = "mix"

# Points are multiples of 2 ** -40; STEP is the odd number nearest to the golden ratio's fraction of 2 ** 40.
POINT_BITS = 40
POINTS = 1 << POINT_BITS
STEP = int((math.sqrt(5) - 1) / 2 * POINTS) | 1
HALF = 1 << (POINT_BITS // 2)


def golden_point(slot: F.Column) -> F.Column:
    """slot * STEP modulo 2 ** 40, in parts that stay below 2 ** 63; distinct for the first 2 ** 40 slots."""
    low, high = slot % HALF, F.floor(slot / HALF).cast("long")
    return (low * STEP + (high * STEP) % HALF * HALF) % POINTS


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """One row per source: source, source_no, source_size, target.

    Sources are numbered by code point, NULL last, and weigh `weights` in turn. A target above `limit` times
    its source's size stops there and the rest is shared again by weight. Only sums reach the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = numbered(sizes, "source", "source_no")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = (
        totals.join(order.withColumnRenamed("source", "__s"), same(F.col("source"), F.col("__s")))
        .drop("__s")
        .withColumn("weight", weight)
    )
    rows = stage(rows, "sources")
    most = (F.col("source_size") * limit).cast("double")
    whole = rows.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    above = F.lit(False)
    while True:
        found = rows.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if found[0] == capped or not found[2]:
            break
        capped = found[0]
        level = (share * whole - (found[1] or 0.0)) / found[2]
        above = F.col("weight") * F.lit(level) > most
    return rows.withColumn("target", F.when(above, most).otherwise(F.col("weight") * F.lit(level)))


def slot_needs(sources: DataFrame, block: int) -> DataFrame:
    """Words each source gives in all (`quota`), its blocks and the slots it needs."""
    size, quota = F.col("source_size"), F.col("quota")
    up = lambda x: F.floor((x + (block - 1)) / block).cast("long")
    passes = F.when(size > 0, F.floor(quota / size)).otherwise(0).cast("long")
    return (
        sources.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
        .withColumn("blocks", up(size))
        .withColumn("needed", passes * F.col("blocks") + up(quota - passes * size))
    )


def schedule(needs: DataFrame) -> DataFrame:
    """The slots that are used: slot, source_no, rank (from 0 within the source)."""
    spark = needs.sparkSession
    n, total = needs.agg(F.count("*"), F.sum("needed")).first()
    bits = max(1, math.ceil(math.log2(max(n, 2))))
    placed = stage(running_sums(needs.withColumn("__all", F.lit(0)), ["__all"], "source_no", bits, "needed", "__before"), "shares")
    edge = lambda x: F.floor(x.cast("decimal(38,0)") * F.lit(POINTS) / F.lit(max(total or 0, 1))).cast("long")
    cell_bits = bits + 4
    cell = lambda x: F.shiftright(x, POINT_BITS - cell_bits)
    spans = placed.filter("needed > 0").select(
        "source_no", "needed", edge(F.col("__before")).alias("lo"), edge(F.col("__before") + F.col("needed")).alias("hi")
    )
    celled = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))))
    length = (total or 0) + (total or 0) // 8 + 64
    while True:
        points = spark.range(length).select(F.col("id").alias("slot"), golden_point(F.col("id")).alias("point"))
        hit = (F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi"))
        slots = stage(
            points.withColumn("cell", cell(F.col("point"))).join(celled, "cell").filter(hit).select("slot", "source_no", "needed"), "slots"
        )
        short = spans.join(slots.groupBy("source_no").agg(F.count("*").alias("n")), "source_no", "left").filter(
            F.coalesce(F.col("n"), F.lit(0)) < F.col("needed")
        )
        if not short.head(1):
            break
        length *= 2
    slot_bits = max(1, math.ceil(math.log2(length)))
    ranked = running_sums(slots.withColumn("__one", F.lit(1).cast("long")), ["source_no"], "slot", slot_bits, "__one", "rank")
    return ranked.filter(F.col("rank") < F.col("needed")).select("slot", "source_no", "rank")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, block: int = BLOCK_WORDS, seed: str = SEED) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source, source_size, target, taken, first_slot, last_slot.

    The slots are those of the schedule in which the mix reads the document first and last, NULL if it never does.

    `docs` needs doc_id, text and source; further columns are ignored. NULL and empty texts have size 0 and nothing
    is taken of them. NULL is a source of its own, ordered last. Rows alike in doc_id, size and source share one place in
    the shuffled order and follow each other there. An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    narrow = docs.select("doc_id", "source", size.alias("size"))
    alike = stage(narrow.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")), "sizes")
    words = alike.select("source", (F.col("size") * F.col("copies")).alias("size"))
    sources = stage(slot_needs(source_targets(words, weights, share, limit), block), "targets")
    named = broadcast_if_small(sources.withColumnRenamed("source", "__s"))
    keyed = stage(
        alike.join(named, same(F.col("source"), F.col("__s")))
        .drop("__s")
        .withColumn("key", spread_key(F.col("doc_id"), seed))
        .withColumn("amount", F.col("size") * F.col("copies")),
        "keyed",
    )
    placed = running_sums(keyed, ["source_no"], "key", KEY_BITS, "amount", "start", ["doc_id", "size"])
    one_each = placed.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    placed = stage(
        one_each.select(
            "doc_id", "source", "size", "source_no", "source_size", "target", (F.col("start") + F.col("__copy") * F.col("size")).alias("start")
        ),
        "placed",
    )
    slots = schedule(sources).join(broadcast_if_small(sources.select("source_no", "source_size", "quota", "blocks")), "source_no")
    at = (F.col("rank") % F.col("blocks")) * block
    before = F.floor(F.col("rank") / F.col("blocks")).cast("long") * F.col("source_size") + at
    length = F.least(F.lit(block).cast("long"), F.col("source_size") - at, F.col("quota") - before)
    used = slots.groupBy("source_no", (F.col("rank") % F.col("blocks")).alias("block"), length.alias("length"))
    used = used.agg(F.count("*").alias("times"), F.min("slot").alias("first"), F.max("slot").alias("last"))
    full = placed.filter("size > 0")
    number = lambda x: F.floor(x / block).cast("long")
    pieces = full.select(
        "source_no", "start", "size", F.explode(F.sequence(number(F.col("start")), number(F.col("start") + F.col("size") - 1))).alias("block")
    )
    overlap = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("length")) - F.greatest(
        F.col("start"), F.col("block") * block
    )
    taken = (
        pieces.join(used, ["source_no", "block"])
        .groupBy("source_no", "start")
        .agg(
            F.sum(F.greatest(F.lit(0).cast("long"), overlap) * F.col("times")).alias("taken"),
            F.min(F.when(overlap > 0, F.col("first"))).alias("first_slot"),
            F.max(F.when(overlap > 0, F.col("last"))).alias("last_slot"),
        )
    )
    found = full.join(taken, ["source_no", "start"], "left").unionByName(placed.filter("size = 0"), allowMissingColumns=True)
    return found.select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "source", "first_slot", "last_slot"
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of `docs` as many times as the mix begins to read them (not at all, once or twice), in the order of the schedule.

    Texts stay whole and all columns are kept. Rows alike in id, source and size share what the mix takes of them. Helper columns begin
    with two underscores.
    """
    taken = mix(docs).filter("taken > 0").groupBy("doc_id", "source", "size")
    taken = taken.agg(F.sum("taken").alias("__taken"), F.count("*").alias("__n"), F.min("first_slot").alias("__first"), F.max("last_slot").alias("__last"))
    times = F.ceil(F.col("__taken") / (F.col("__n") * F.col("size"))).cast("int")
    named = (F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"))
    taken = broadcast_if_small(stage(taken.select(*named, times.alias("__times"), "__first", "__last"), "taken"))
    sized = docs.withColumn("__words", F.regexp_count("text", F.lit(WORD)).cast("long"))
    alike = sized["doc_id"].eqNullSafe(taken["__id"]) & sized["source"].eqNullSafe(taken["__source"]) & (F.col("__words") == F.col("__size"))
    rows = sized.join(taken, alike).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    slot = F.when(F.col("__copy") == 1, F.col("__first")).otherwise(F.col("__last"))
    # Rows of one slot, and copies of one row, are told apart so that no task gets them all.
    rows = rows.withColumns({"__slot": slot, "__spread": F.xxhash64("__id", "__copy")}).orderBy("__slot", "__spread")
    return rows.select(*(docs[name] for name in docs.columns))
