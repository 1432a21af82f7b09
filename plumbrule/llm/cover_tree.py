"""Exact pairs of near-equal embeddings by cover trees and dual traversal.

Equal vectors are one class each. The levels of a tree are nested nets with halving radii (`RADII`, as distances between unit
vectors): every node is a vector of the data, covers its members within the level's radius, and is its own first child. A
pair of nodes is left out when the distance of their centres, less both covering radii (as they are, not as the level allows), is
beyond the threshold; it is taken whole when that distance plus both radii is within it; else its children meet.

The upper levels are fitted on the `CENTRES` classes of least hash (the documented bound); every class goes to its nearest centre,
and the radius of a centre is that of all its classes. Neighbouring centres are packed into blocks of about `BLOCK` classes;
a centre that holds more is dealt over several blocks. The driver traverses the pairs of centres (at most `CENTRES` squared)
and names the pairs of packs that may hold links; Spark spells them out as pairs of blocks. Each block grows its
lower levels once, and each pair of blocks is one group: a dual traversal that returns per class the number of its links and
a spanning forest of them, never the pairs. So what is shuffled grows with classes times the blocks each block may meet, not with
links; in data without any structure every block meets every other one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbrule.llm.common import stage
from plumbrule.llm.near_dups import components
from plumbrule.llm.vectors import finite, of_common_length
from plumbrule.workspace import broadcast_if_small

SIMILAR = 0.9
CENTRES = 1024
BLOCK = 8192
RADII = (0.5, 0.25, 0.125)  # below the root; with a radius of 1 no pair of nodes is far enough apart to be left out
UPPER = (1.0, 0.5)  # levels that the packing of blocks goes by
CHUNK = 256  # rows of one matrix product
PAIRS = 16_384  # pairs of nodes that are met in one list
ROUGH = 1e-5  # of cosines in single precision, which only rule pairs out
SLACK = 1e-6  # of distances, which are roots of what is rounded
NEAR = 1e-9  # cosines this close to the threshold are computed again, without intermediate rounding
FOUND = "class long, links long, other long"


def units(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision, whatever the size of their entries."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    return math.sumprod(a, b) / math.sqrt(math.sumprod(a, a) * math.sumprod(b, b))


def distance(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosines))


def net(points: np.ndarray, radius: float) -> np.ndarray:
    """For each point its centre, one of the points within `radius`; centres are further apart. The first point is one."""
    points, least = points.astype(np.float32), 1 - radius * radius / 2
    owner = np.full(len(points), -1)
    centres: list[int] = []
    for start in range(0, len(points), CHUNK):
        part = points[start : start + CHUNK]
        own = owner[start : start + CHUNK]
        if centres:
            near = part @ points[centres].T
            best = near.argmax(1)
            covered = near[np.arange(len(part)), best] >= least
            own[covered] = np.array(centres)[best[covered]]
        among = part @ part.T >= least
        for i in np.flatnonzero(own < 0):
            if own[i] < 0:
                centres.append(start + int(i))
                own[among[i] & (own < 0)] = start + i
                own[i] = start + i
    return owner


def nested(points: np.ndarray, radii: tuple[float, ...]) -> np.ndarray:
    """Per point its centre on every level."""
    levels = np.zeros((len(points), len(radii)), np.int64)
    above = np.zeros(len(points), np.int64)
    for level, radius in enumerate(radii):
        order = np.argsort(above, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(above[order]) != 0])
        below = np.arange(len(points))
        for members in np.split(order, starts[1:]):
            if len(members) > 1:
                centre = above[members[0]]
                members = np.r_[centre, members[members != centre]]
                below[members] = members[net(points[members], radius)]
        levels[:, level] = above = below
    return levels


class Tree:
    """The nodes of a block, level by level; members of a node are neighbouring rows. The last level are the rows themselves."""

    def __init__(self, raw: np.ndarray, levels: np.ndarray, copies: np.ndarray, names: np.ndarray):
        order = np.lexsort(levels.T[::-1])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.raw, self.names, self.copies = raw[order], names[order], copies[order]
        self.points = units(self.raw)
        self.rough = self.points.astype(np.float32)
        self.sums = np.r_[0, np.cumsum(self.copies)]
        self.starts, self.ends, self.centres, self.radii = [], [], [], []
        new = np.zeros(len(order), bool)
        new[:1] = True
        for level in range(levels.shape[1]):
            centre = place[levels[order, level]]
            new = new | np.r_[True, np.diff(centre) != 0][: len(order)]
            starts = np.flatnonzero(new)
            self.starts.append(starts)
            self.ends.append(np.r_[starts[1:], len(order)])
            self.centres.append(centre[starts])
            apart = distance((self.points * self.points[centre]).sum(1))
            apart[centre == np.arange(len(order))] = 0
            self.radii.append(np.maximum.reduceat(apart, starts))
        rows = np.arange(len(order))
        self.starts.append(rows)
        self.ends.append(rows + 1)
        self.centres.append(rows)
        self.radii.append(np.zeros(len(order)))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) of the nodes of the next level below each node."""
        below = self.starts[level + 1]
        return np.searchsorted(below, self.starts[level][nodes]), np.searchsorted(below, self.ends[level][nodes])


class Links:
    """Number of links per row and the components they make, for the rows of two blocks (or of one, met with itself)."""

    def __init__(self, a: Tree, b: Tree):
        self.a, self.b = a, b
        self.at = 0 if a is b else len(a.names)
        self.root = np.arange(len(a.names) + (0 if a is b else len(b.names)))
        self.count = np.zeros(len(self.root), np.int64)

    def connect(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            one, two = self.root[i], self.root[j]
            differ = one != two
            if not differ.any():
                return
            i, j, one, two = i[differ], j[differ], one[differ], two[differ]
            np.minimum.at(self.root, np.maximum(one, two), np.minimum(one, two))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up

    def pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links between single rows, all different."""
        size = len(self.count)
        self.count += np.bincount(i, self.b.copies[j], size).astype(np.int64) + np.bincount(j + self.at, self.a.copies[i], size).astype(np.int64)
        self.connect(i, j + self.at)

    def whole(self, level: int, x: int, y: int, same: bool) -> None:
        """Links between all members of two nodes, or of one node."""
        a, b = self.a, self.b
        i = np.arange(a.starts[level][x], a.ends[level][x])
        j = np.arange(b.starts[level][y], b.ends[level][y])
        if same:
            self.count[i] += a.sums[i[-1] + 1] - a.sums[i[0]] - a.copies[i]
        else:
            self.count[i] += b.sums[j[-1] + 1] - b.sums[j[0]]
            self.count[j + self.at] += a.sums[i[-1] + 1] - a.sums[i[0]]
            self.connect(i[:1], j[:1] + self.at)
            self.connect(j + self.at, np.full(len(j), j[0] + self.at))
        self.connect(i, np.full(len(i), i[0]))

    def found(self) -> pd.DataFrame:
        """Rows with links; each names the first row of its own block in its component, and those of two blocks one another."""
        names = self.a.names if self.a is self.b else np.r_[self.a.names, self.b.names]
        sides = np.arange(len(names)) >= (self.at or len(names))
        has = np.flatnonzero(self.count > 0)
        _, first, which = np.unique(np.c_[self.root[has], sides[has]], axis=0, return_index=True, return_inverse=True)
        leads = has[first]
        out = pd.DataFrame({"class": names[has], "links": self.count[has], "other": names[leads[which.ravel()]]})
        across = np.flatnonzero(np.diff(self.root[leads]) == 0)
        more = pd.DataFrame({"class": names[leads[across + 1]], "links": 0, "other": names[leads[across]]})
        return pd.concat([out, more], ignore_index=True).astype({"class": "int64", "links": "int64", "other": "int64"})


def spelt(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the ranges a0..a1 and b0..b1, range pair by range pair."""
    wide = b1 - b0
    sizes = (a1 - a0) * wide
    which = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return a0[which] + at // wide[which], b0[which] + at % wide[which]


def dual(a: Tree, b: Tree, similar: float) -> Links:
    """The links between the rows of two trees, or within one.

    What waits are ranges of nodes, all of whose pairs are met by one matrix product, or lists of pairs of nodes.
    """
    links, reach, same = Links(a, b), float(distance(np.float64(similar))), a is b
    waiting: list[tuple] = [(0, 0, len(a.starts[0]), 0, len(b.starts[0]))]

    def met(level: int, i: np.ndarray, j: np.ndarray, cosines: np.ndarray) -> None:
        """Link, leave out or open pairs of nodes with these cosines of their centres."""
        own = same & (i == j)
        apart, cover = np.where(own, 0, distance(cosines)), a.radii[level][i] + b.radii[level][j]
        near = apart - cover <= reach + SLACK
        i, j, own, apart, cover, cosines = i[near], j[near], own[near], apart[near], cover[near], cosines[near]
        single = (a.ends[level][i] - a.starts[level][i] == 1) & (b.ends[level][j] - b.starts[level][j] == 1)
        for k in np.flatnonzero(single & (np.abs(cosines - similar) < NEAR)):
            cosines[k] = cosine(a.raw[a.starts[level][i[k]]], b.raw[b.starts[level][j[k]]])
        linked = single & ~own & (cosines >= similar)
        links.pairs(a.starts[level][i[linked]], b.starts[level][j[linked]])
        inside = ~single & (apart + cover <= reach - SLACK)
        for k in np.flatnonzero(inside):
            links.whole(level, int(i[k]), int(j[k]), bool(own[k]))
        left = ~single & ~inside
        if not left.any():
            return
        a0, a1 = a.children(level, i[left])
        b0, b1 = b.children(level, j[left])
        sizes = (a1 - a0) * (b1 - b0)
        waiting.extend((level + 1, a0[k], a1[k], b0[k], b1[k]) for k in np.flatnonzero(sizes > PAIRS))
        few = np.flatnonzero(sizes <= PAIRS)
        for part in np.split(few, np.flatnonzero(np.diff(np.cumsum(sizes[few]) // PAIRS)) + 1):
            if len(part):
                waiting.append((level + 1, *spelt(a0[part], a1[part], b0[part], b1[part])))

    def products(level: int, x: np.ndarray, y: np.ndarray, mirrored: bool) -> None:
        """Meet all pairs of these nodes that their bounds let through, by products in single precision first."""
        centres, others = a.centres[level][x], b.centres[level][y]
        cover, covers = a.radii[level][x], b.radii[level][y]
        for start in range(0, len(x), CHUNK):
            rows = slice(start, start + CHUNK)
            columns = slice(start if mirrored else 0, None)
            rough = a.rough[centres[rows]] @ b.rough[others[columns]].T
            if cover.any() or covers.any():
                widest = np.minimum(2.0, reach + cover[rows][:, None] + covers[columns][None, :])
                near = rough >= (1 - widest * widest / 2 - ROUGH).astype(np.float32)
            else:
                near = rough >= np.float32(similar - ROUGH)
            i, j = np.nonzero(near)
            if len(i) > near.size // 50:
                cosines = (a.points[centres[rows]] @ b.points[others[columns]].T)[i, j]
            else:
                cosines = np.einsum("kd,kd->k", a.points[centres[rows][i]], b.points[others[columns][j]])
            i, j = x[rows][i], y[columns][j]
            if same:
                kept = i <= j if mirrored else np.ones(len(i), bool)
                i, j, cosines = np.minimum(i, j)[kept], np.maximum(i, j)[kept], cosines[kept]
            met(level, i, j, cosines)

    while waiting:
        level, *what = waiting.pop()
        if len(what) == 2:
            i, j = what
            if same:
                i, j = i[i <= j], j[i <= j]
            met(level, i, j, np.einsum("kd,kd->k", a.points[a.centres[level][i]], b.points[b.centres[level][j]]))
            continue
        a0, a1, b0, b1 = what
        x, y = np.arange(a0, a1), np.arange(b0, b1)
        # Nodes of one row, mostly the bulk, need no bound of their own.
        x_rows, y_rows = a.radii[level][x] == 0, b.radii[level][y] == 0
        mirrored = same and a0 == b0
        products(level, x[x_rows], y[y_rows], mirrored)
        products(level, x[~x_rows], y[~y_rows], mirrored)
        products(level, x[x_rows], y[~y_rows], False)
        if not mirrored:
            products(level, x[~x_rows], y[y_rows], False)
    return links


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def grown(block: pd.DataFrame) -> pd.DataFrame:
    """A block with the centre of each row on every level, as its position in the block."""
    return block.assign(levels=list(nested(units(stacked(block["v"])), RADII)), row=np.arange(len(block)))


def tree_of(block: pd.DataFrame) -> Tree:
    block = block.sort_values("row")
    return Tree(stacked(block["v"]), np.stack(block["levels"].to_list()), block["copies"].to_numpy(), block["class"].to_numpy())


def upper_centres(sample: np.ndarray) -> np.ndarray:
    """Centres of the finest upper level, in the order of the tree."""
    points = units(sample)
    return points[np.unique(nested(points, UPPER), axis=0)[:, -1]]


def pack(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring cells in packs of at most `block` rows, larger cells alone: the pack of each cell, the blocks of each pack."""
    packs, held = [], []
    for size in sizes:
        if not held or held[-1] + size > block:
            held.append(0)
        held[-1] += int(size)
        packs.append(len(held) - 1)
    return np.array(packs, np.int64), np.array([max(1, -(-rows // block)) for rows in held], np.int64)


def block_pairs(spark: SparkSession, centres: np.ndarray, radii: np.ndarray, packs: np.ndarray, blocks: np.ndarray, similar: float) -> DataFrame:
    """(p, i, q, j): pairs of blocks, block i of pack p and block j of pack q, that may hold links."""
    near = distance(centres @ centres.T) - radii[:, None] - radii[None, :] <= float(distance(np.float64(similar))) + SLACK
    np.fill_diagonal(near, True)
    meet = np.zeros((len(blocks), len(blocks)), bool)
    one, two = np.nonzero(near)
    meet[packs[one], packs[two]] = True
    p, q = np.nonzero(np.triu(meet))
    named = pd.DataFrame({"p": p.astype(np.int32), "q": q.astype(np.int32), "m": blocks[p].astype(np.int32), "n": blocks[q].astype(np.int32)})
    spelt = spark.createDataFrame(named, "p int, q int, m int, n int").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    spelt = spelt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return spelt.filter("p < q OR i <= j").select("p", "i", "q", "j")


def link_classes(classes: DataFrame, similar: float = SIMILAR, centres: int = CENTRES, block: int = BLOCK) -> DataFrame:
    """(class, links, other) of classes with links: rows to be summed, and links that connect each component.

    `classes` holds different vectors: class, v, copies, h1. A link of a class with `copies` rows counts that often.
    """
    spark = classes.sparkSession
    sample = classes.orderBy("h1", "class").limit(centres).select("v").toPandas()
    if not len(sample):
        return spark.createDataFrame([], FOUND)
    middle = upper_centres(stacked(sample["v"]))
    model = spark.sparkContext.broadcast(middle)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                near = units(stacked(batch["v"])) @ model.value.T
                cell = near.argmax(1)
                yield batch.assign(cell=cell.astype(np.int32), far=distance(near[np.arange(len(cell)), cell]))

    kind = classes.schema["v"].dataType.simpleString()
    held = f"class long, copies long, v {kind}"
    celled = stage(classes.select("class", "copies", "v").mapInPandas(placed, f"{held}, cell int, far double"), "celled")
    sizes, radii = np.zeros(len(middle), np.int64), np.zeros(len(middle))
    for row in celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():
        sizes[row["cell"]], radii[row["cell"]] = row["n"], row["far"]
    packs, blocks = pack(sizes, block)
    cells = pd.DataFrame({"cell": np.arange(len(packs), dtype=np.int32), "pack": packs.astype(np.int32), "blocks": blocks[packs].astype(np.int32)})
    cells = F.broadcast(spark.createDataFrame(cells, "cell int, pack int, blocks int"))  # a row per centre
    dealt = celled.join(cells, "cell").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    trees = dealt.select("class", "copies", "v", "pack", "block").groupBy("pack", "block").applyInPandas(grown, f"{held}, pack int, block int, levels array<long>, row long")
    pairs = block_pairs(spark, middle, radii, packs, blocks, similar)
    ends = pairs.select(F.col("p").alias("pack"), F.col("i").alias("block"), "p", "i", "q", "j", F.lit(0).alias("side"))
    others = pairs.filter("p < q OR i < j").select(F.col("q").alias("pack"), F.col("j").alias("block"), "p", "i", "q", "j", F.lit(1).alias("side"))
    meeting = stage(trees, "trees").join(ends.unionByName(others), ["pack", "block"]).drop("pack", "block")

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if not len(left) or not (len(right) or (rows["p"].iloc[0], rows["i"].iloc[0]) == (rows["q"].iloc[0], rows["j"].iloc[0])):
            return pd.DataFrame({"class": [], "links": [], "other": []}, dtype="int64")
        a = tree_of(left)
        return dual(a, tree_of(right) if len(right) else a, similar).found()

    return meeting.groupBy("p", "i", "q", "j").applyInPandas(compared, FOUND)


def near_vectors(vectors: DataFrame, similar: float = SIMILAR, centres: int = CENTRES, block: int = BLOCK) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    `vectors` needs vec_id and embedding; further columns are ignored. Two rows are linked if the cosine of their vectors is at least
    `similar` (above 0); equal vectors always are. `n_links` counts the other rows linked directly, rows that repeat an id or a vector
    included; `component_id` is the smallest id reachable. Vectors that are NULL, zero or hold NULL or non-finite entries link with
    nothing, nor do those of another length than the most frequent one. A NULL id is never the smallest while there is
    another; a row with one is kept if no id is reachable.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    v = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    some = F.coalesce(finite(F.col("v")) & F.exists("v", lambda x: x != 0), F.lit(False))
    used, dims = of_common_length(rows.filter(some), "v")
    keyed = stage(used.select("vec_id", "v", F.xxhash64(F.lit(0), "v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")), "keyed")
    found = keyed.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    classes = stage(found.withColumn("class", F.monotonically_increasing_id()), "classes")
    links = stage(link_classes(classes, similar, centres, block), "links")
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    edges = links.filter("class <> other").select(F.col("class").cast("string").alias("a"), F.col("other").cast("string").alias("b"))
    labels = components(edges).select(F.col("class").cast("long").alias("class"), "component")
    few = classes.select("class", "h1", "h2", "least_id", "copies").join(counts, "class", "left").filter("links IS NOT NULL OR copies > 1")
    few = few.join(labels, "class", "left").withColumn("component", F.coalesce("component", F.col("class").cast("string")))
    few = stage(few, "linked")
    least = few.groupBy("component").agg(F.min("least_id").alias("component_id"))
    few = few.join(least, "component").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    joined = keyed.select("vec_id", "h1", "h2").join(broadcast_if_small(stage(few, "fates")), ["h1", "h2"], "left")
    linked = F.col("n_links").isNotNull()
    out = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(linked, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    usable = some & (F.size("v") == dims)
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
