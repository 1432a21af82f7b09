"""Toxicity by multiple-instance learning.

Labels say whether a document is toxic, not which sentence is. Each sentence gets a logistic score p from its
words and their beginnings, and the document the noisy-or 1 - prod(1 - p) of its sentences. The weights are found from
document labels by gradient descent on the likelihood of that noisy-or; sentences are then scored by the same
weights to locate the offending ones.

The classifier is fitted on at most about `sample_rows` distinct labelled texts (the documented bound), chosen by a hash of
the text; scoring reads every text whole, in one pass without a shuffle. The weights sent to
the tasks are bounded by that sample's vocabulary.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.llm.common import KEY_BITS, spread_key

SAMPLE_ROWS = 5_000
FOLDS = 5
MIN_TEXTS = 6  # texts of the sample in which a feature must occur
ROUNDS = 200
RATE = 0.1
DECAY = 1e-2
THRESHOLD = 0.5
SENTENCE = re.compile(r"[^.!?\n。！？]+")
TOKEN = re.compile(r"\w+")
STEMS = (4, 5, 6)  # lengths of the word beginnings that are features too


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a NULL id counts as an empty text and is thus held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def features(words: list[str]) -> set[str]:
    """The distinct words of a sentence and, marked by a caret, their beginnings: endings vary, stems do not."""
    distinct = set(words)
    return distinct.union(*({f"^{w[:n]}" for w in distinct if len(w) >= n} for n in STEMS))


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, words) of each sentence with words; positions are code points."""
    for found in SENTENCE.finditer(text):
        words = TOKEN.findall(found.group().lower())
        if words:
            yield found.start(), found.end(), words


def training_sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> pd.DataFrame:
    """(text, toxic) of distinct labelled texts outside the held-out fold. A text labelled both ways is toxic."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.filter("text IS NOT NULL AND text <> ''").select("doc_id", "text")
    rows = texts.filter(fold(F.col("doc_id")) != 0).join(known, "doc_id").select("text", "toxic")
    share = min(1.0, sample_rows / max(rows.count(), 1))
    chosen = rows.filter(spread_key(F.col("text"), "toxicity") <= int(share * (1 << KEY_BITS)))
    sample = chosen.groupBy("text").agg(F.max("toxic").alias("toxic")).toPandas()
    return sample.sort_values("text", ignore_index=True)


def fit(sample: pd.DataFrame, rounds: int = ROUNDS, rate: float = RATE, decay: float = DECAY) -> tuple[float, dict[str, float]]:
    """Bias and word weights, by Adam on the whole sample; the same for the same sample."""
    known: dict[str, int] = {}
    seen, last = array("i"), array("i")
    word, owner, doc_of = array("i"), array("i"), array("i")
    for d, text in enumerate(sample["text"]):
        for _, _, words in sentences(text):
            for w in sorted(features(words)):
                i = known.setdefault(w, len(known))
                if i == len(seen):
                    seen.append(0)
                    last.append(-1)
                if last[i] != d:
                    seen[i], last[i] = seen[i] + 1, d
                word.append(i)
                owner.append(len(doc_of))
            doc_of.append(d)
    often = np.frombuffer(seen, np.int32) >= MIN_TEXTS if seen else np.zeros(0, bool)
    place = np.cumsum(often) - 1
    vocabulary = {w: int(place[i]) for w, i in known.items() if often[i]}
    word, owner, doc_of = (np.array(x, np.int32) for x in (word, owner, doc_of))
    kept = often[word] if len(word) else np.zeros(0, bool)
    word, owner = place[word[kept]], owner[kept]
    toxic = sample["toxic"].to_numpy() > 0
    if not len(doc_of):
        return -np.inf, {}  # nothing is known of toxic sentences: texts of any length score 0
    docs, size = len(sample), len(vocabulary)
    weights, bias = np.zeros(size), -5.0
    moments = np.zeros((2, size + 1))
    for step in range(1, rounds + 1):
        z = bias + np.bincount(owner, weights[word], len(doc_of))
        p = 1 / (1 + np.exp(-z))
        nothing = np.bincount(doc_of, np.logaddexp(0, z), docs)  # -log of the chance of no offending sentence
        pull = np.where(toxic, -1 / np.expm1(np.maximum(nothing, 1e-9)), 1.0)[doc_of] * p
        slope = np.append(np.bincount(word, pull[owner], size), pull.sum()) / docs
        slope[:-1] += decay * weights / 100
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * decay, 0)
    return float(bias), {w: float(weights[i]) for w, i in vocabulary.items() if abs(weights[i]) > 1e-3}


def score_text(text: str, bias: float, weights: dict[str, float]) -> tuple[float, list[tuple[int, int, float]]]:
    """Document score and the sentences whose own score reaches THRESHOLD."""
    clean, offending = 1.0, []
    for start, end, words in sentences(text):
        z = bias + sum(weights.get(feature, 0.0) for feature in sorted(features(words)))
        p = 1 / (1 + np.exp(-max(min(z, 50.0), -50.0)))
        clean *= 1 - p
        if p >= THRESHOLD:
            offending.append((start, end, round(float(p), 6)))
    return float(1 - clean), offending


SCORES = "struct<score:double,sentences:array<struct<start:int,end:int,score:double>>>"


def toxicity_scorer(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """A column function text -> struct(score, offending sentences), trained on `docs` and `labels`."""
    bias, weights = fit(training_sample(docs, labels, sample_rows))
    model = docs.sparkSession.sparkContext.broadcast((bias, weights))

    @F.pandas_udf(SCORES)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own_bias, own_weights = model.value
        for texts in batches:
            found = [score_text(text or "", own_bias, own_weights) for text in texts]
            yield pd.DataFrame({"score": [s for s, _ in found], "sentences": [spans for _, spans in found]})

    return score


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted, offending (array of sentences with start, end, score).

    `docs` needs doc_id and text, `labels` doc_id and toxic; further columns are ignored and none but the text is an input
    of a score. NULL and empty texts have no sentence and score 0. Without labelled texts outside the held-out fold every score is 0.
    """
    scored = docs.select("doc_id", "text").withColumn("found", toxicity_scorer(docs, labels, sample_rows)("text"))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("found.sentences").alias("offending"),
    )
