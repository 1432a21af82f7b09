"""Each stage of the corpus pipeline on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from plumbrule.llm.mixing import mix
from plumbrule.llm.near_dups import near_duplicates, trees_for
from plumbrule.llm.sharding import shard_documents
from plumbrule.llm.toxicity import score_documents

SF = "/root/testdata/sf0.001"
STEPS = dict(corpus_pipeline.STAGES)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_keep_the_columns_and_take_effect(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r.doc_id for r in score_documents(docs, labels).collect() if r.predicted}
    left = STEPS["toxicity"](spark, docs, SF)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - toxic
    twice = docs.unionByName(docs.limit(3))
    once = STEPS["near_duplicates"](spark, twice, SF)
    kept = {r.doc_id for r in near_duplicates(docs, percent=80).collect() if r.kept}
    assert once.columns == docs.columns and sorted(r.doc_id for r in once.collect()) == sorted(kept)
    taken = {r.doc_id: -(-r.taken // r["size"]) for r in mix(docs).collect() if r.taken}
    mixed = STEPS["mixing"](spark, docs, SF)
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == taken
    shards = {r.doc_id: r.shard for r in shard_documents(docs).collect()}
    assert {r.doc_id: r.shard for r in STEPS["sharding"](spark, docs, SF).collect()} == shards


def test_empty_documents_pass_through(spark):
    docs = documents(spark).limit(0)
    for step in STEPS.values():
        docs = step(spark, docs, SF)
    assert docs.count() == 0 and "shard" in docs.columns


def test_near_copies_of_four_fifths_are_one_group(spark):
    words = [f"w{i}" for i in range(104)]
    # 100 shingles; the copy loses 10 at its end and gets 10 others: 90 of 110, 0.818
    copy = words[:-10] + [f"v{i}" for i in range(10)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(copy))], "doc_id long, text string")
    assert [r.doc_id for r in STEPS["near_duplicates"](spark, docs, SF).collect()] == [1]
    assert sum(r.kept for r in near_duplicates(docs).collect()) == 2
    assert (trees_for(85), trees_for(80)) == (4, 5)


def test_rows_of_a_duplicate_go_by_id_and_text(spark):
    a, b, c, d = (" ".join(f"{name}{i}" for i in range(30)) for name in "abcd")
    rows = [(1, a), (None, a), (None, b), (2, a), (2, c), (3, d), (3, f"{d} more"), (None, None), (4, c), (None, b.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in STEPS["near_duplicates"](spark, docs, SF).collect())
    # One text of a and b's, c's and d's groups each; a NULL id and a repeated one keep their other texts.
    assert sum(got.values()) == 5 and got[1, a] == got[2, c] == got[None, None] == 1
    assert got[None, b] + got[None, b.upper()] == 1 and got[3, d] + got[3, f"{d} more"] == 1
