"""Every operator of this subpackage as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbrule.llm.common import table
from plumbrule.llm.cover_tree import near_vectors
from plumbrule.llm.decontaminate import decontamination_report
from plumbrule.llm.hard_negatives import hard_negatives
from plumbrule.llm.licenses import license_report
from plumbrule.llm.line_dedup import remove_lines
from plumbrule.llm.main_text import extract_main_text
from plumbrule.llm.mixing import mix
from plumbrule.llm.near_dups import near_duplicates
from plumbrule.llm.neighbours import nearest_neighbours
from plumbrule.llm.secrets import secret_report
from plumbrule.llm.sharding import shard_documents
from plumbrule.llm.toxicity import score_documents
from plumbrule.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_lines(table(spark, sf_dir, "documents"))


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_near_dups": op2_near_dups,
    "op3_mix_sources": op3_mix_sources,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_decontaminate": op6_decontaminate,
    "op7_nearest": op7_nearest,
    "op8_main_text": op8_main_text,
    "op9_licenses": op9_licenses,
    "op10_shard": op10_shard,
    "op11_whiten": op11_whiten,
    "op12_near_vectors": op12_near_vectors,
    "op13_hard_negatives": op13_hard_negatives,
}
