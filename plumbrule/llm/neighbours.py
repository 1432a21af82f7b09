"""Approximate nearest neighbours by a hierarchical k-means tree and best-bin-first search.

The tree is fitted on a sample of at most `SAMPLE` vectors (the documented bound), chosen by a hash of
the id; every vector is indexed: it descends to the leaf of the nearest centre at each level. A query visits leaves through
a priority queue over the nodes seen so far, best bound first. How many leaves is
calibrated on `PROBES` sample queries against exact search in the sample: visits widen until the
recall reaches `RECALL`. The bound of a node for the inner product is q . centre + |q| * radius * SLACK.

(query, leaf) pairs meet the vectors of a leaf in blocks of at most `BLOCK` rows, so that a leaf that
holds a third of all vectors is many tasks' work. Each block returns its nearest per query; these
are merged by rank. The result has the exact inner products, each added up in the order of the components. A query whose leaves hold
fewer than `nearest` others visits further ones.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbrule.llm.common import KEY_BITS, spread_key, stage

SAMPLE = 20_000
BRANCHES = 8
LEAF_SAMPLE = 100  # a node of the sample below this is a leaf
ROUNDS = 12
PROBES = 200
RECALL = 0.97
SLACK = 0.3
BLOCK = 4096
QUERIES = 512  # queries of one block's task
NEAR = 1e-9
PAIRS = 65_536  # added up at once
NEAREST = 20
EVERY = 20


class Tree:
    """Nodes as arrays: centre, radius, children; leaves are numbered."""

    def __init__(self, sample: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF_SAMPLE):
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.children: list[list[int]] = []
        self.leaf_no: list[int] = []
        self.leaves = 0
        self.draw = np.random.default_rng(0)
        self.grow(sample, branches, leaf)

    def grow(self, rows: np.ndarray, branches: int, leaf: int) -> int:
        here = len(self.centres)
        centre = rows.mean(0) if len(rows) else np.zeros(rows.shape[1])
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(((rows - centre) ** 2).sum(1).mean())) if len(rows) else 0.0)
        self.children.append([])
        self.leaf_no.append(-1)
        different = np.unique(rows, axis=0) if len(rows) > leaf else rows[:1]
        if len(different) > branches:
            near = self.cluster(rows, different, branches)
            parts = [rows[near == k] for k in range(branches) if (near == k).any()]
            if len(parts) > 1:
                self.children[here] = [self.grow(part, branches, leaf) for part in parts]
                return here
        self.leaf_no[here] = self.leaves
        self.leaves += 1
        return here

    def cluster(self, rows: np.ndarray, different: np.ndarray, branches: int) -> np.ndarray:
        centres = different[self.draw.choice(len(different), branches, replace=False)]
        for _ in range(ROUNDS):
            near = nearest_centre(rows, centres)
            moved = [rows[near == k].mean(0) if (near == k).any() else centres[k] for k in range(branches)]
            centres = np.stack(moved)
        return nearest_centre(rows, centres)

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        found = np.zeros(len(rows), np.int64)
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            node, which = waiting.pop()
            if not self.children[node]:
                found[which] = self.leaf_no[node]
            elif len(which):
                below = self.children[node]
                near = nearest_centre(rows[which], np.stack([self.centres[c] for c in below]))
                waiting.extend((child, which[near == k]) for k, child in enumerate(below))
        return found

    def search(self, query: np.ndarray, visits: int, sizes: np.ndarray | None = None, enough: int = 0) -> list[int]:
        """The first `visits` leaves, best bound first; more if these do not hold `enough` of the indexed vectors."""
        reach = SLACK * float(np.linalg.norm(query))
        queue, order, held = [(0.0, 0)], [], 0
        while queue and (len(order) < visits or held < enough):
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                order.append(self.leaf_no[node])
                held += 0 if sizes is None else int(sizes[self.leaf_no[node]])
            for child in self.children[node]:
                heapq.heappush(queue, (-(float(query @ self.centres[child]) + reach * self.radii[child]), child))
        return order


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(1)


def calibrated(tree: Tree, sample: np.ndarray, nearest: int, recall: float, probes: int = PROBES) -> int:
    """Leaves to visit so that the mean share of the nearest in the visited leaves reaches `recall`."""
    if len(sample) <= 1:
        return tree.leaves
    leaf = tree.assign(sample)
    ranks = []
    for q in range(0, len(sample), max(1, len(sample) // probes)):
        score = sample @ sample[q]
        score[q] = -np.inf
        best = np.argsort(-score, kind="stable")[: min(nearest, len(sample) - 1)]
        place = {no: i + 1 for i, no in enumerate(tree.search(sample[q], tree.leaves))}
        ranks.extend(place[no] for no in leaf[best])
    return int(np.quantile(ranks, recall, method="higher"))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors of doubles without NULL or non-finite parts and not all zero."""
    v = F.col("embedding").cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(~odd).filter(F.exists(v, lambda x: x != 0))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def fit_tree(rows: DataFrame, nearest: int = NEAREST, sample: int = SAMPLE, recall: float = RECALL) -> tuple[Tree, int] | None:
    """A tree and the calibrated number of visits; None without vectors."""
    n = rows.count()
    share = min(1.0, sample / max(n, 1))
    drawn = rows.filter(spread_key(F.col("vec_id"), "tree") <= int(share * (1 << KEY_BITS))).orderBy("vec_id").toPandas()
    if not n:
        return None
    drawn = drawn if len(drawn) else rows.limit(1).toPandas()
    points = np.stack(drawn["v"].to_list())
    tree = Tree(points)
    return tree, calibrated(tree, points, nearest, recall)


def nearest_neighbours(
    vectors: DataFrame, every: int = EVERY, nearest: int = NEAREST, sample: int = SAMPLE, recall: float = RECALL
) -> DataFrame:
    """For each vector whose id is divisible by `every`, its `nearest` others: query_id, rank (from 1), vec_id, score.

    `vectors` needs vec_id and embedding, all of one length; further columns are ignored. Vectors that are NULL, zero or hold NULL
    or non-finite parts take no part, nor do NULL ids. Ties go to the smaller id; rows that repeat an id and a vector count once.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors).dropDuplicates(["vec_id", "v"]), "vectors")
    fitted = fit_tree(rows, nearest, sample, recall)
    if fitted is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    model = spark.sparkContext.broadcast(fitted)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, _ = model.value
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.assign(np.stack(batch["v"].to_list())))

    def visited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, visits = model.value
        for batch in batches:
            found = [tree.search(v, visits, held_by.value, nearest + 1) for v in batch["v"]]
            yield batch.assign(leaf=found).explode("leaf", ignore_index=True).astype({"leaf": np.int64})

    indexed = stage(rows.mapInPandas(placed, "vec_id long, v array<double>, leaf long"), "indexed")
    # Blocks by a hash of the id, as many as the leaf needs.
    sizes = indexed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sizes = stage(sizes, "leaves")  # one row per leaf of the bounded sample's tree
    small = F.broadcast(sizes)
    counts = np.zeros(fitted[0].leaves, np.int64)
    for row in indexed.groupBy("leaf").count().collect():  # a row per leaf
        counts[row["leaf"]] = row["count"]
    held_by = spark.sparkContext.broadcast(counts)
    held = indexed.join(small, "leaf").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    asked = rows.filter(F.col("vec_id") % every == 0).mapInPandas(visited, "vec_id long, v array<double>, leaf long")
    group = F.array_agg(F.struct(F.col("vec_id").alias("id"), "v"))
    parts = F.floor(F.xxhash64("vec_id") % 1_000_003)
    counted = stage(asked, "asked")
    slices = F.broadcast(counted.groupBy("leaf").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("slices")))
    queries = (
        counted.join(slices, "leaf")
        .groupBy("leaf", F.pmod(parts, F.col("slices")).alias("slice"))
        .agg(group.alias("queries"))
        .join(small, "leaf")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    blocks = held.groupBy("leaf", "block").agg(group.alias("rows"))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for asking, having in zip(batch["queries"], batch["rows"], strict=True):
                own = np.array([q["id"] for q in asking], np.int64)
                ids = np.array([r["id"] for r in having], np.int64)
                order = np.argsort(ids, kind="stable")
                ids = ids[order]
                points = np.stack([r["v"] for r in having])[order]
                asked = np.stack([q["v"] for q in asking])
                score = asked @ points.T
                score[own[:, None] == ids[None, :]] = -np.inf
                # The matrix product's last digits depend on the block; what may be among the nearest is added up again in one order.
                some = min(nearest, len(ids))
                worst = np.partition(score, -some, axis=1)[:, -some]
                row, at = np.nonzero((score >= (worst - NEAR * np.maximum(1.0, np.abs(worst)))[:, None]) & (score > -np.inf))
                parts = [slice(k, k + PAIRS) for k in range(0, len(row), PAIRS)]
                exact = np.concatenate([(points[at[part]] * asked[row[part]]).sum(1) for part in parts]) if parts else np.zeros(0)
                order = np.lexsort((ids[at], -exact, row))
                row, at, exact = row[order], at[order], exact[order]
                first = np.searchsorted(row, row)
                best = np.arange(len(row)) - first < nearest
                yield pd.DataFrame({"query_id": own[row[best]], "vec_id": ids[at[best]], "score": exact[best]})

    near = queries.join(blocks, ["leaf", "block"]).select("queries", "rows").mapInPandas(scored, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
