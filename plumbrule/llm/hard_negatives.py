"""Hard negatives of embeddings, found through bounds along a spanning tree of the anchors.

Anchors are taken in chunks of about `CHUNK` (neighbours along one random direction, so that near anchors share a chunk; where many
anchors fall on one place, a hash deals them out). The driver spans the anchors of a chunk by a least spanning tree and sends it
to the tasks, a bounded broadcast; every task reads its candidates once per pass. The root is scored against each candidate. From a
parent's score, or bounds of it, follow the child's: |child . x - parent . x| <= |child - parent| |x|. Only candidates whose bounds
still meet what the child looks for are scored themselves, exactly; the others carry their bounds on to the child's children.

First pass: rows of the anchor's label that may reach its best positives so far. Second pass: rows of other labels whose bounds meet the
window of a positive, above the worst of that window's best so far. Each task returns the best of its own rows, so
what is shuffled is anchors times tasks times a constant, and no task ever holds more than `ROWS` candidates against one chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbrule.llm.common import stage
from plumbrule.llm.vectors import finite, matrix, of_common_length

SCALE = 256
ANCHORS = 100  # ids divisible by it are anchors
FLIPPED, LABELS = 7, 10  # ids divisible by it get the next of so many labels
POSITIVES = NEGATIVES = 5
LEAST_PERCENT = 80
CHUNK = 4096
ROWS = 1024
LARGEST = float(1 << 52)  # scaled entries are clipped here
SCORE_LIMIT = 1 << 62  # and scores here
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Anchors:
    """The anchors of a chunk, parents first."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    parents: np.ndarray  # -1 for the root
    edges: np.ndarray  # distance to the parent

    @classmethod
    def spanned(cls, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> Anchors:
        """In the order in which a least spanning tree takes them in."""
        points = x.astype(np.float64)
        count = len(points)
        order, parents, edges = np.zeros(count, np.int64), np.full(count, -1), np.zeros(count)
        place = np.zeros(count, np.int64)
        nearest, by = np.full(count, np.inf), np.zeros(count, np.int64)
        waiting = np.ones(count, bool)
        here = 0
        for step in range(count):
            order[step], place[here], waiting[here] = here, step, False
            if step:
                parents[step], edges[step] = place[by[here]], nearest[here]
            apart = np.sqrt(((points - points[here]) ** 2).sum(1))
            closer = apart < nearest
            nearest[closer], by[closer] = apart[closer], here
            here = int(np.where(waiting, nearest, np.inf).argmin())
            if not waiting[here]:  # only infinite distances are left
                here = int(waiting.argmax())
        return cls(ids[order], labels[order], x[order], parents, edges)


def products(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond `SCORE_LIMIT` they are that."""
    longest = math.sqrt(float((rows.astype(np.float64) ** 2).sum(1).max(initial=0)) * float((anchor.astype(np.float64) ** 2).sum()))
    if longest < LARGEST:  # no partial sum is rounded
        return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    exact = (int(np.dot(row, anchor)) for row in rows.astype(object))
    return np.array([max(-SCORE_LIMIT, min(SCORE_LIMIT, score)) for score in exact], np.int64)


class Best:
    """The best (score, id) so far, best first."""

    def __init__(self, most: int):
        self.most = most
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """What a score must reach to matter."""
        return int(self.scores[-1]) if len(self.scores) == self.most else -SCORE_LIMIT

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            scores, ids = np.r_[self.scores, scores], np.r_[self.ids, ids]
            order = np.lexsort((ids, -scores))[: self.most]
            self.scores, self.ids = scores[order], ids[order]


def windows_of(score: int) -> tuple[int, int]:
    """Least and greatest score of a positive's negatives."""
    return -(-LEAST_PERCENT * score // 100), score


class Search:
    """One pass of one task: what its candidates offer the anchors of a chunk. `windows` holds those of each anchor's positives."""

    def __init__(self, anchors: Anchors, windows: list[list[tuple[int, int]]] | None):
        self.anchors, self.windows = anchors, windows
        if windows is None:
            self.best = [[Best(POSITIVES)] for _ in anchors.ids]
        else:
            self.best = [[Best(NEGATIVES) for _ in own] for own in windows]
        self.scored = 0

    def sought(self, k: int) -> list[tuple[int, int]]:
        """Ranges of scores that matter to anchor `k`."""
        if self.windows is None:
            return [(self.best[k][0].least(), SCORE_LIMIT)]
        return [(max(low, best.least()), high) for (low, high), best in zip(self.windows[k], self.best[k], strict=True)]

    def add(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        anchors = self.anchors
        floats = x.astype(np.float64)
        sizes = np.sqrt((floats**2).sum(1)) * (1 + 1e-9)
        low, high = np.zeros((len(anchors.ids), len(ids))), np.zeros((len(anchors.ids), len(ids)))
        for k, parent in enumerate(anchors.parents):
            right = (labels == anchors.labels[k]) == (self.windows is None)
            right &= ids != anchors.ids[k]
            ranges = self.sought(k)
            if parent < 0:
                need = np.ones(len(ids), bool)
            else:
                spread = anchors.edges[k] * (1 + 1e-9) * sizes
                low[k] = low[parent] - spread - 1e-9 * np.abs(low[parent]) - 0.5
                high[k] = high[parent] + spread + 1e-9 * np.abs(high[parent]) + 0.5
                need = np.zeros(len(ids), bool)
                for best, (least, most) in zip(self.best[k], ranges, strict=True):
                    # Candidates surely inside, as many as are looked for, rule out what cannot reach the worst of them.
                    sure = low[k][right & (low[k] >= least) & (high[k] <= most)]
                    if len(sure) >= best.most:
                        least = max(least, np.partition(sure, -best.most)[-best.most])
                    need |= (high[k] >= least) & (low[k] <= most)
                need &= right
            at = np.flatnonzero(need)
            if not len(at):
                continue
            self.scored += len(at)
            scores = products(x if len(at) == len(ids) else x[at], anchors.x[k])
            low[k, at] = high[k, at] = scores
            own = right[at]
            scores, at = scores[own], at[own]
            for best, (least, most) in zip(self.best[k], ranges, strict=True):
                inside = (scores >= least) & (scores <= most)
                best.add(scores[inside], ids[at[inside]])

    def found(self) -> pd.DataFrame:
        rows = [(k, j, score, who) for k, lists in enumerate(self.best) for j, best in enumerate(lists) for score, who in zip(best.scores, best.ids, strict=True)]
        return pd.DataFrame(rows, columns=["anchor", "place", "score", "vec_id"])


def labelled_integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x): usable rows, labels changed, entries as integers; repeated rows once."""
    v = F.col("embedding").cast("array<double>")
    x = F.transform(v, lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(c * SCALE).cast("double"))).cast("long"))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(v))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % FLIPPED == 0, (label + 1) % LABELS).otherwise(label)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), x.alias("x")).dropDuplicates()


def chunked(anchors: DataFrame, dims: int, chunk: int) -> list[DataFrame]:
    """The anchors in parts of about `chunk` rows."""
    count = anchors.count()
    if count <= chunk:
        return [anchors] if count else []
    signs = np.where(np.random.default_rng(0).random(dims) < 0.5, -1.0, 1.0).tolist()
    along = F.aggregate(F.zip_with("x", F.lit(signs), lambda c, sign: c * sign), F.lit(0.0), lambda a, b: a + b)
    placed = stage(anchors.withColumn("along", along), "along")
    parts = -(-count // chunk)
    cuts = sorted(set(placed.approxQuantile("along", [i / parts for i in range(1, parts)], 0.1 / parts)))
    cells = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="along", outputCol="cell").transform(placed)
    cells = stage(cells.withColumn("deal", F.pmod(F.xxhash64("vec_id", "x"), F.lit(1 << 20))), "cells")
    found = []
    for row in cells.groupBy("cell").count().orderBy("cell").collect():  # a row per part
        own, deals = cells.filter(F.col("cell") == row["cell"]), -(-row["count"] // chunk)
        found.extend(own.filter(F.col("deal") % deals == i) for i in range(deals))
    return found


def searched(rows: DataFrame, dims: int, anchors: Anchors, windows: list[list[tuple[int, int]]] | None, most: int) -> DataFrame:
    """(anchor, place, rank, score, vec_id): the best of all candidates per anchor and place, by position in the chunk."""
    model = rows.sparkSession.sparkContext.broadcast((anchors, windows))

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                search.add(ids, labels, matrix(part, "x", dims))
        found = search.found()
        kinds = (("anchor", pa.int32()), ("place", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(found[name].to_numpy(np.int64), pa.int64()).cast(kind) for name, kind in kinds], [name for name, _ in kinds])

    offered = rows.mapInArrow(of_task, "anchor int, place int, score long, vec_id long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id")
    ranked = offered.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("anchor", "place", "rank", "score", "vec_id")


def hard_negatives(vectors: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Per anchor and positive its negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `vectors` needs vec_id, label and embedding; further columns are ignored. Rows with a NULL id, label or vector, with NULL or non-finite
    entries, or with a vector of another length than the most frequent one take no part; rows equal in id, label and
    vector count once. A row with the anchor's id is neither positive nor negative of it. Ties go to the smaller id. Positives below zero
    have no window. Scaled entries beyond 2^52 count as 2^52 and scores beyond 2^62 as 2^62. Empty vectors take no part.
    """
    spark = vectors.sparkSession
    rows, dims = of_common_length(stage(labelled_integers(vectors), "labelled"), "x")
    found: DataFrame | None = None
    for part in chunked(rows.filter(F.col("vec_id") % ANCHORS == 0), dims, chunk) if dims else []:
        held = part.select("vec_id", "label", "x").orderBy("vec_id", "label", "x").toPandas()
        if not len(held):
            continue
        anchors = Anchors.spanned(held["vec_id"].to_numpy(), held["label"].to_numpy(), np.stack(held["x"].to_list()))
        positives: list[list[tuple[int, int]]] = [[] for _ in anchors.ids]
        for row in sorted(searched(rows, dims, anchors, None, POSITIVES).collect(), key=lambda row: row["rank"]):
            positives[row["anchor"]].append((row["vec_id"], row["score"]))
        windows = [[windows_of(score) for _, score in own] for own in positives]
        named = [(k, j, int(anchors.ids[k]), *own) for k, lists in enumerate(positives) for j, own in enumerate(lists)]
        pairs = spark.createDataFrame(named, "anchor int, place int, anchor_id long, positive_id long, positive_score long")
        near = searched(rows, dims, anchors, windows, NEGATIVES).join(F.broadcast(pairs), ["anchor", "place"])  # a few rows per anchor of the chunk
        near = near.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        near = stage(near, "negatives")
        found = near if found is None else found.unionByName(near)
    return spark.createDataFrame([], OUT) if found is None else found
