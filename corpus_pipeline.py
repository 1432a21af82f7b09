"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Toxic documents go, one document of each near-duplicate group stays, documents that hold benchmark items go, sources are mixed
to their targets, and every record gets its shard. All stages but the last return the columns of `documents`, further columns
included; columns of helpers begin with two underscores. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbrule.llm.common import stage, table
from plumbrule.llm.decontaminate import without_contaminated
from plumbrule.llm.mixing import mixed
from plumbrule.llm.near_dups import without_near_duplicates
from plumbrule.llm.sharding import with_shard
from plumbrule.llm.toxicity import THRESHOLD, toxicity_scorer

SIMILAR = 80  # percent of word shingles that near copies share in a corpus; op2 has its own contract

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; NULL and empty texts score 0 and stay."""
    score = toxicity_scorer(docs, table(spark, sf_dir, "labels"))(F.col("text"))["score"]
    return docs.withColumn("__score", score).filter(F.col("__score") < THRESHOLD).drop("__score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return without_near_duplicates(docs, SIMILAR)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document as many times as the mix begins to read it: not at all, once or twice."""
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every record with the number of its shard."""
    return with_shard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Fitted weights and minwise tokens have no SQL; the tests hold the stages against brute force on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return docs
