"""Secret scans: three patterns, and long strings that look random to a pair of character Markov models.

The patterns give the base spans. The method adds every other run of secret-like characters whose
log-likelihood ratio between a first-order Markov model of random strings and one of ordinary
identifiers exceeds the log odds of an ordinary string (`log_odds`). Both models are trained
from labelled samples: random are the values the patterns find and strings drawn from
digests; ordinary are the words and identifiers left when the base spans are blanked out. Texts come from a
sample of about `sample_rows` rows (the documented bound), every text is scanned whole.

One pass over the documents in JVM expressions, nothing is shuffled but the bigram counts of the
sample; what the driver gets is one number per pair of characters.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.llm.common import KEY_BITS, spread_key

# The base patterns and what they need in length.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX_RUN = r"(?<![0-9a-f])[0-9a-f]{24,}+"  # maximal runs, so that those of 24 or more are found alone
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
IN_ALPHABET = "[A-Za-z0-9+/_=-]"
MIN_LENGTH = 16
CANDIDATE = rf"(?<!{IN_ALPHABET}){IN_ALPHABET}{{{MIN_LENGTH},}}+"
TRAINING_WORD = rf"(?<!{IN_ALPHABET}){IN_ALPHABET}{{6,}}+"
SAMPLE_ROWS = 2_000
LOG_ODDS = math.log(10_000)
SMOOTHING = 0.5

SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def matches(text: Column, pattern: str, kind: str, value_group: int = 0, least: int = 0) -> Column:
    """Array of spans of the leftmost non-overlapping matches whose `value_group` has `least` characters or more.

    Positions are running sums over the pieces between the matches.
    """
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"),
    )
    rank = KINDS.index(kind)

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["all"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
        kept = F.coalesce(F.length(x["value"]) >= max(least, 1), F.lit(False))
        return F.struct(end.alias("at"), F.when(kept, F.array_append(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    none = F.expr(f"CAST(array() AS array<{SPAN}>)")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(found, start, step, lambda done: done["spans"])).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": matches(text, ASSIGN, "assign", 2, ASSIGN_VALUE),
        "access": matches(text, ACCESS, "access", 0, ACCESS_LENGTH),
        "hex": matches(text, HEX_RUN, "hex"),
    }


def labelled_samples(docs: DataFrame, sample_rows: int) -> DataFrame:
    """(text, random): strings to train from."""
    spark = docs.sparkSession
    share = min(1.0, sample_rows / max(docs.count(), 1))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(text.alias("text")).filter(spread_key(F.col("text"), "train") <= int(share * (1 << KEY_BITS)))
    values = F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX_RUN), F.lit(0)),
    )
    blanked = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX_RUN):
        blanked = F.regexp_replace(blanked, pattern, " ")
    found = rows.select(F.explode(values).alias("text")).filter(F.length("text") >= ASSIGN_VALUE)
    ordinary = rows.select(F.explode(F.regexp_extract_all(blanked, F.lit(TRAINING_WORD), F.lit(0))).alias("text"))
    drawn = spark.range(SAMPLE_ROWS).select(
        F.explode(F.array(*(F.substring(F.base64(F.unhex(F.sha2(F.concat(F.lit(s), F.col("id")), 256))), 1, 40) for s in "ab"))).alias("text")
    )
    return (
        found.withColumn("random", F.lit(True))
        .unionAll(drawn.withColumn("random", F.lit(True)))
        .unionAll(ordinary.withColumn("random", F.lit(False)))
    )


def train(samples: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratio of random to ordinary for each ordered pair of characters, row by row."""
    size = len(ALPHABET)
    pair = lambda i: F.substring("text", i, 2)
    ends = F.sequence(F.lit(1), F.length("text") - 1)
    pairs = samples.filter(F.length("text") > 1).select("random", F.explode(F.transform(ends, pair)).alias("pair"))
    counts = {(row[0], row[1]): row[2] for row in pairs.groupBy("random", "pair").count().collect()}

    def log_rows(random: bool) -> list[list[float]]:
        table = [[counts.get((random, a + b), 0) + smoothing for b in ALPHABET] for a in ALPHABET]
        return [[math.log(x / sum(row)) for x in row] for row in table]

    ratio = zip(log_rows(True), log_rows(False), strict=True)
    return [round(r - o, 6) for random, ordinary in ratio for r, o in zip(random, ordinary, strict=True)] if size else []


def log_ratio(text: Column, model: Sequence[float]) -> Column:
    """Sum of the model over the pairs of characters of a string over ALPHABET."""
    table = F.expr(f"array({', '.join(f'{x}D' for x in model)})")
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(done: Column, char: Column) -> Column:
        here = F.instr(F.lit(ALPHABET), char) - 1
        more = F.when(done["last"] >= 0, F.element_at(table, done["last"] * len(ALPHABET) + here + 1)).otherwise(0.0)
        return F.struct(here.alias("last"), (done["sum"] + more).alias("sum"))

    return F.aggregate(F.split(text, ""), start, step, lambda done: done["sum"])


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, log_odds: float = LOG_ODDS) -> DataFrame:
    """One row per row of `docs`: doc_id, base (array of spans), added (array of spans).

    `docs` needs doc_id and text; further columns are ignored. NULL texts count as empty. Positions are code points, ends exclusive.
    """
    model = train(labelled_samples(docs, sample_rows))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumns(base_spans(F.col("text")))
    base = F.concat("assign", "access", "hex")
    runs = matches(F.col("text"), CANDIDATE, "markov")
    rows = rows.withColumn("base", base).withColumn("runs", runs)
    free = lambda run: ~F.exists("base", lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    random = lambda run: log_ratio(F.substring("text", run["start"] + 1, run["end"] - run["start"]), model) > log_odds
    return rows.select("doc_id", "base", F.filter("runs", lambda run: free(run) & random(run)).alias("added"))


def secret_report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts per kind, a digest of the base spans and all spans as text, one row per row of `docs`."""
    found = find_secrets(docs, sample_rows)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_markov"),
    )
