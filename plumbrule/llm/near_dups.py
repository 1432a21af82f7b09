"""Near duplicates by a chosen-path set similarity join.

A document is the set of its distinct shingles, hashed to 64 bits; documents with equal sets are one
class from the start, known by a number. Every class has a signature of minwise tokens. A tree begins with a
node of all classes; a node picks `BRANCHES` positions of the signature by its own hash, and each class goes to
one child per position, named by the minwise token there. Nodes of up to `LEAF` classes are compared exhaustively by their
sketches. In larger ones each class is compared with `PIVOTS` of them and names its nearest. If up to `LEAF` classes are then outside the
node's largest group, these are compared with all classes of the node and it ends there: what is in one group is compared anyhow. Other
nodes branch on. A pair at the threshold t meets at the end of a tree
with a chance q = 1 - (1 - t * q) ** BRANCHES: 0.97 for t = 0.85 and two branches, 0.94 for t = 0.80. There are as many independent
trees as miss fewer than `MISSED` of the pairs at the threshold: four at 0.85, five at 0.80. Nodes that would branch on after `DEPTH` levels end in the same way, however many classes are outside.

What trees find are candidates, of which only those that bring groups together are named: what is compared exhaustively names a
spanning forest, fewer pairs than classes. A group is what candidates connect, so every pair of candidates lies in one. Links are
told within groups, on full sets made from one text of each of just the classes in groups. A group's sets are dealt into blocks of about
`BLOCK` shingles; pairs of a block are tested first, then those of two blocks that are still apart, and only pairs not connected already.

Scale: a class goes down the trees in scans of the table of classes, joined with the numbers of the nodes that branched on (about one in
`LEAF` memberships at most), so signatures are shuffled once, to find equal sets. Else only numbers and sketches of 32 bytes are
shuffled, and the sets of classes with candidates, each made once and sent to as many tasks as its group has blocks: one, unless the group has
more than `BLOCK` shingles. Work grows with the square of a group if its texts are all candidates and none are links. No task holds more than a list of
about twice `LEAF` classes at once, or two blocks. What a level needs is written to the shared folder, so a lost executor costs only a part of a level, and removed once it has been read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.llm.common import discard, stage
from plumbrule.workspace import broadcast_if_small

SHINGLE = 5
PERCENT = 85  # links: 100 * intersection >= PERCENT * union
POSITIONS = 128
MISSED = 1e-6
BRANCHES = 2
LEAF = 256
DEPTH = 12
PIVOTS = 16
SKETCH_MISSED = 1e-8  # chance that the sketches of a pair at the threshold agree too little
CACHE_WORDS = 100_000
SLICE = 128  # shingles hashed at once for all positions
BROADCAST = 2_000_000  # rows of one or two short columns up to which a side is broadcast
SIGNATURES = "doc_id long, text_key binary, class binary, n_shingles long, signature binary, sketch binary"
BLOCK = 1 << 20  # shingles of a group that are tested in one task, about; twice as many for pairs of two blocks
PAIRS = 1 << 16  # pairs that a task gathers before it passes them on, about
LIST = ["node", "block", "other"]
LIST_PAIRS = "node long, block long, other long, a long, b long"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words, made when first asked for and remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, length: int):
        self.length = length
        self.known = WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        # Of bytes, `lower` changes A to Z only, and `split` takes just the white space between words here.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        width = min(self.length, len(words))
        joined = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(words) - width + 1 + i])
        return np.unique(joined)


def class_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def minwise_seeds() -> tuple[np.ndarray, np.ndarray]:
    """What is xored to a shingle, and the odd number it is multiplied with, per position."""
    drawn = mixed(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return drawn.astype(np.uint32), (drawn >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minwise(shingles: np.ndarray, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least 32-bit hash per position, mixed; in slices that stay in the processor's cache."""
    flips, factors = seeds
    least = np.full(POSITIONS, np.iinfo(np.uint32).max, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), SLICE):
        hashes = short[at : at + SLICE, None] ^ flips
        hashes *= factors
        np.minimum(least, hashes.min(0), out=least)
    return (mixed(least.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype("<u4")


def sketch_of(tokens: np.ndarray) -> bytes:
    """Two bits of each token."""
    bits = (tokens & 3).astype(np.uint8).reshape(-1, 4)
    return (bits[:, 0] | bits[:, 1] << 2 | bits[:, 2] << 4 | bits[:, 3] << 6).tobytes()


def text_key(text: Column | str) -> Column:
    return F.unhex(F.md5(text))


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_key, class, n_shingles, signature, sketch) per row of `docs`, text_key the text's md5; texts without words have no class."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles_of, seeds = Shingler(shingle), minwise_seeds()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                own = shingles_of(text)
                if len(own):
                    tokens = minwise(own, seeds)
                    rows.append((class_of(own), len(own), tokens.tobytes(), sketch_of(tokens)))
                else:
                    rows.append((None, 0, None, None))
            out = pd.DataFrame(rows, columns=["class", "n_shingles", "signature", "sketch"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            out.insert(1, "text_key", batch["text_key"].array)
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text", text_key("text").alias("text_key")).mapInPandas(made, SIGNATURES)


def trees_for(percent: int) -> int:
    """Independent trees that together miss a pair at the threshold with a chance below MISSED."""
    met = 1.0
    for _ in range(DEPTH):
        met = 1 - (1 - percent / 100 * met) ** BRANCHES
    return 1 if met >= 1 else max(1, math.ceil(math.log(MISSED) / math.log1p(-met)))


def least_agreement(percent: int) -> int:
    """Places in which the sketches of all but SKETCH_MISSED of the pairs at the threshold agree at least."""
    same = percent / 100 + (1 - percent / 100) / 4
    below, places = 0.0, 0
    while places < POSITIONS:
        below += math.comb(POSITIONS, places) * same**places * (1 - same) ** (POSITIONS - places)
        if below > SKETCH_MISSED:
            break
        places += 1
    return places


def children(rows: DataFrame, branches: int, trees: int = 1) -> DataFrame:
    """`rows` (node, signature, ...) with a child in place of the node, a row per child; a node chooses the positions by its hash."""

    def child(tree: int, branch: int) -> Column:
        position = F.pmod(F.xxhash64("node", F.lit(tree * branches + branch)), F.lit(POSITIONS)).cast("int")
        return F.xxhash64("node", F.lit(tree), position, F.substring(F.col("signature"), position * 4 + 1, 4))

    nodes = F.array_distinct(F.array(*(child(t, b) for t in range(trees) for b in range(branches))))
    return rows.withColumn("node", F.explode(nodes))


def agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """In how many places each sketch of `left` agrees with each of `right`."""
    differ = left[:, None, :] ^ right[None, :, :]
    differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
    return POSITIONS - np.bitwise_count(differ).sum(2, dtype=np.int16)


def sketched(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)


def spanning(weight: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A spanning forest of a symmetric relation, the heaviest pairs first, and the tree of each place."""
    weight = np.asarray(weight, np.int16)
    tree, edges = np.full(len(weight), -1), []
    for root in range(len(weight)):
        if tree[root] >= 0:
            continue
        tree[root] = root
        best, source = np.where(tree < 0, weight[root], 0), np.full(len(weight), root)
        while best.any():
            here = int(best.argmax())
            edges.append((int(source[here]), here))
            tree[here], best[here] = root, 0
            closer = (weight[here] > best) & (tree < 0)
            best[closer], source[closer] = weight[here][closer], here
    return edges, tree


def listed(rows: DataFrame) -> DataFrame:
    """The rows (node, block, other, number, n_shingles, sketch, component, outer) of a list in one row."""
    return rows.groupBy(*LIST).agg(*(F.collect_list(name).alias(name) for name in ("number", "n_shingles", "sketch", "component", "outer")))


def list_pairs(lists: DataFrame, least: int, percent: int, every: bool = False) -> DataFrame:
    """(node, block, other, a, b), a < b, of candidates in a list: a spanning forest of them, or `every` one.

    The outer classes of a list meet its others, or each other if there are none. Candidates are in different components, near
    enough in size, and their sketches agree in `least` places.
    """

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[np.ndarray] = []
        for batch in batches:
            for node, block, other, numbers, sizes, sketches, known, outer in batch.itertuples(index=False, name=None):
                own = np.flatnonzero(outer)
                rest = np.flatnonzero(~np.asarray(outer, bool))
                rest = rest if len(rest) else own
                sketch = sketched(list(sketches))
                agree = agreement(sketch[own], sketch[rest])
                less, more = np.minimum(sizes[own][:, None], sizes[rest]), np.maximum(sizes[own][:, None], sizes[rest])
                near = (agree >= least) & (100 * less >= percent * more) & (known[own][:, None] != known[rest])
                if rest is own:
                    near = np.triu(near)
                if not near.any():
                    continue
                i, j = np.nonzero(near)
                ends = np.column_stack([own[i], rest[j]])
                if not every:
                    used = np.union1d(own[near.any(1)], rest[near.any(0)])
                    place = np.full(len(numbers), -1)
                    place[used] = np.arange(len(used))
                    # Connected classes are joined first, by edges that are not named.
                    weight = np.where(known[used][:, None] == known[used], POSITIONS + 1, 0)
                    weight[place[own[i]], place[rest[j]]] = weight[place[rest[j]], place[own[i]]] = agree[i, j]
                    ends = used[np.array(spanning(weight)[0], np.int64)]
                    ends = ends[known[ends[:, 0]] != known[ends[:, 1]]]
                names = np.broadcast_to(np.array([node, block, other]), (len(ends), 3))
                found.append(np.hstack([names, np.sort(numbers[ends], axis=1)]))
                if sum(map(len, found)) >= PAIRS:
                    yield pd.DataFrame(np.concatenate(found), columns=[*LIST, "a", "b"])
                    found = []
        if found:
            yield pd.DataFrame(np.concatenate(found), columns=[*LIST, "a", "b"])

    return lists.select(*LIST, "number", "n_shingles", "sketch", "component", "outer").mapInPandas(compared, LIST_PAIRS)


def pivot_pairs(rows: DataFrame, least: int, percent: int) -> DataFrame:
    """(a, b), a < b, of a row's class and the nearest of its `pivots`, if a candidate; one pair per class and batch."""

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[int, tuple[int, int]] = {}
            for number, size, sketch, known, others, sizes, sketches, components in batch.itertuples(index=False, name=None):
                agree = agreement(sketched([sketch]), sketched(list(sketches)))[0]
                for k in np.argsort(-agree, kind="stable"):
                    if agree[k] < least or number in found and agree[k] <= found[number][0]:
                        break
                    less, more = sorted((size, sizes[k]))
                    if components[k] != known and 100 * less >= percent * more:
                        found[number] = (agree[k], others[k])
                        break
            pairs = [(min(a, b), max(a, b)) for a, (_, b) in found.items()]
            yield pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    own = ("number", "n_shingles", "sketch", "component")
    # Arrays of plain values: structs would be a dict each in Python.
    return rows.select(*own, *(F.col(f"pivots.{name}").alias(f"pivot_{name}") for name in own)).mapInPandas(compared, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(class, component): the least class reachable, for every class that has a link.

    Each round every class takes the least label among its own and its partners', then the label of its label.
    """
    edges = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stage(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "class"), "labels")
    kind = labels.schema["component"].dataType
    while True:
        own = labels.select("class", "component", F.col("component").alias("before"))
        heard = edges.join(labels, edges["b"] == labels["class"]).select(F.col("a").alias("class"), "component", F.lit(None).cast(kind).alias("before"))
        nearest = own.unionByName(heard).groupBy("class").agg(F.min("component").alias("component"), F.max("before").alias("before"))
        nearest = stage(nearest, "nearest")
        if not nearest.filter("component <> before").head(1):
            return labels
        jump = nearest.select(F.col("class").alias("component"), F.col("component").alias("further"))
        labels = stage(nearest.join(jump, "component").select("class", F.col("further").alias("component")), "labels")


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """`labels` with the components that further links, given between classes of any label, bring together.

    Only the links between different labels are followed, so that a round costs what it adds.
    """
    if labels is None:
        return components(links)
    between = stage(relabelled(links, labels), "between")
    roots = components(between).select(F.col("class").alias("component"), F.col("component").alias("root"))
    ends = between.select(F.col("a").alias("class")).union(between.select(F.col("b").alias("class"))).distinct()
    every = labels.unionByName(ends.join(labels, "class", "left_anti").select("class", F.col("class").alias("component")))
    return stage(every.join(roots, "component", "left").select("class", F.coalesce("root", "component").alias("component")), "merged")


def relabelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs of labels that `pairs` join, those that are one label left out."""
    found = pairs
    for end in ("a", "b"):
        named = labels.select(F.col("class").alias(end), F.col("component").alias(f"__{end}"))
        found = found.join(named, end, "left")
    ends = found.select(F.coalesce("__a", "a").alias("a"), F.coalesce("__b", "b").alias("b"))
    return ends.filter("a <> b").distinct()


def with_component(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """`rows` and the component of `number`, itself if it is not connected."""
    if labels is None:
        return rows.withColumn("component", F.col("number"))
    named = rows.join(labels.withColumnRenamed("class", "number"), "number", "left")
    return named.withColumn("component", F.coalesce("component", "number"))


class Sets:
    """The shingle sets of classes: made from one text of each when first asked for, and kept."""

    def __init__(self, docs: DataFrame, classes: DataFrame, shingle: int):
        self.docs, self.classes, self.shingle = docs, classes, shingle
        self.known: DataFrame | None = None
        self.paths: list[str] = []

    def of(self, numbers: DataFrame) -> DataFrame:
        """(number, shingles) of at least the classes in `numbers`."""
        if self.known is not None:
            numbers = numbers.join(self.known.select("number"), "number", "left_anti")
        wanted = self.classes.select("number", F.col("text_key").alias("__key")).join(numbers, "number")
        wanted = stage(wanted, "wanted", self.paths)
        if self.known is None or wanted.head(1):
            made = stage(self.made(wanted), "sets", self.paths)
            self.known = made if self.known is None else self.known.union(made)
        return self.known

    def made(self, wanted: DataFrame) -> DataFrame:
        length = self.shingle

        def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shingles_of = Shingler(length)
            seen: set[int] = set()  # rows that repeat a text make one set in a task
            for batch in batches:
                first = [name not in seen and not seen.add(name) for name in batch["number"]]
                batch = batch[np.array(first, bool)]
                yield pd.DataFrame({"number": batch["number"], "shingles": [shingles_of(text).view(np.int64) for text in batch["text"]]})

        texts = self.docs.select("text", text_key("text").alias("text_key"))
        chosen = texts.join(broadcast_if_small(wanted, BROADCAST), texts["text_key"] == wanted["__key"]).select("number", "text")
        return chosen.mapInPandas(made, "number long, shingles array<long>").dropDuplicates(["number"])


def tested(rows: DataFrame, least: int, percent: int) -> DataFrame:
    """(a, b), a < b: links that connect what is linked on full sets in each list of `rows`, fewer than its classes.

    `rows` has (node, block, other, number, n_shingles, sketch, component, outer, shingles). The outer classes of a list meet its others, or each
    other if there are none. Pairs of one component, or connected by links found before, are not tested.
    """

    def links(own: pd.DataFrame) -> pd.DataFrame:
        numbers, outer = own["number"].to_numpy(), own["outer"].to_numpy(bool)
        lengths = own["n_shingles"].to_numpy(np.int64)
        sketch = sketched(list(own["sketch"]))
        label = np.unique(own["component"].to_numpy(), return_inverse=True)[1]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        names, places = np.unique(np.concatenate(list(own["shingles"])), return_inverse=True)
        marked = np.zeros(len(names), bool)
        rest, found = np.flatnonzero(~outer), []
        inner = not len(rest)
        for i in np.flatnonzero(outer):
            others = np.arange(i + 1, len(numbers)) if inner else rest
            size = lengths[others]
            others = others[(label[others] != label[i]) & (100 * np.minimum(size, lengths[i]) >= percent * np.maximum(size, lengths[i]))]
            others = others[agreement(sketch[i : i + 1], sketch[others])[0] >= least]
            if not len(others):
                continue
            marked[places[starts[i] : starts[i + 1]]] = True
            shared = np.array([np.count_nonzero(marked[places[starts[j] : starts[j + 1]]]) for j in others])
            marked[places[starts[i] : starts[i + 1]]] = False
            linked = others[100 * shared >= percent * (lengths[i] + lengths[others] - shared)]
            reached, first = np.unique(label[linked], return_index=True)
            found += [(numbers[i], numbers[j]) for j in linked[first]]
            label[np.isin(label, reached)] = label[i]
        return pd.DataFrame(np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1), columns=["a", "b"])

    return rows.groupBy(*LIST).applyInPandas(links, "a long, b long")


def linked_within(sets: Sets, groups: DataFrame, classes: DataFrame, least: int, percent: int, paths: list[str]) -> DataFrame | None:
    """(class, component) of what links connect within `groups` (class, component); None if there are no links."""
    own = classes.select("number", "n_shingles", "sketch").join(groups.select(F.col("class").alias("number"), F.col("component").alias("node")), "number")
    own = stage(own, "grouped", paths)
    blocks = F.ceil(F.sum(F.col("n_shingles").cast("double")) / BLOCK).cast("long")
    blocks = stage(own.groupBy("node").agg(blocks.alias("blocks")), "blocks", paths)
    own = own.join(broadcast_if_small(blocks), "node").withColumn("block", F.pmod(F.xxhash64("number"), F.col("blocks")))
    known = sets.of(own.select("number"))

    def links(rows: DataFrame) -> DataFrame:
        return stage(tested(known.join(broadcast_if_small(rows), "number"), least, percent), "links", paths)

    found = links(own.withColumn("other", F.col("block")).withColumns({"component": F.col("number"), "outer": F.lit(True)}))
    labels = components(found) if found.head(1) else None
    if not blocks.filter("blocks > 1").head(1):
        return labels
    wide = with_component(own.filter("blocks > 1"), labels)
    wide = wide.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).filter("__block <> block")
    ends = {"block": F.least("block", "__block"), "other": F.greatest("block", "__block"), "outer": F.col("block") < F.col("__block")}
    found = links(wide.withColumns(ends).drop("__block"))
    return merged(labels, found) if found.head(1) else labels


def end_lists(named: DataFrame, ends: DataFrame, leaf: int) -> DataFrame:
    """The lists in which all classes of a node meet those outside its component `main`, in blocks of about `leaf` classes of both kinds.

    `named` has (node, number, n_shingles, sketch, component), `ends` (node, size, most, main).
    """
    rows = named.join(broadcast_if_small(ends, BROADCAST), "node")
    blocks, others = F.ceil(F.col("size") / leaf), F.ceil((F.col("size") - F.col("most")) / leaf)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
    own = ("number", "n_shingles", "sketch", "component")
    block, other = F.pmod(F.xxhash64("number"), blocks).alias("block"), F.pmod(F.xxhash64("number", F.lit(1)), others).alias("other")
    inner = rows.select("node", block, upto(others).alias("other"), *own, F.lit(False).alias("outer"))
    outer = rows.filter("main IS NULL OR component <> main").select("node", upto(blocks).alias("block"), other, *own, F.lit(True).alias("outer"))
    return listed(inner.unionByName(outer))


def near_groups(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, trees: int | None = None, leaf: int = LEAF, paths: list[str] | None = None
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_key, n_shingles, class, group, least_id.

    `group` is the least number of a component's classes, and `least_id` its smallest doc_id; both are NULL for texts without words. Unlike
    `least_id`, `group` tells components apart where a doc_id is repeated or NULL. `paths` gets where the tables lie that the result reads.
    """
    trees = trees_for(percent) if trees is None else trees
    least = least_agreement(percent)
    spark = docs.sparkSession
    paths = [] if paths is None else paths
    wide: list[str] = []
    kept: list[str] = []
    signed = stage(signatures(docs, shingle), "signatures", wide)
    found = signed.filter("class IS NOT NULL").groupBy("class")
    found = found.agg(*(F.min(name).alias(name) for name in ("doc_id", "text_key", "n_shingles", "signature", "sketch"))).withColumnRenamed("doc_id", "least_id")
    classes = stage(found.withColumn("number", F.monotonically_increasing_id()), "classes", kept)
    rows = stage(signed.select("doc_id", "text_key", "n_shingles", "class"), "rows", paths)
    discard(spark, wide)
    sets = Sets(docs, classes, shingle)
    labels: DataFrame | None = None  # what candidates connect
    opened: list[DataFrame] = []
    lists: list[DataFrame] = []

    def reached() -> DataFrame:
        """The classes of the nodes of the next level, found by a walk down from the root over the nodes that branched on."""
        found = classes.select(F.lit(0).cast("long").alias("node"), "signature", "number", "n_shingles", "sketch")
        found = children(found, BRANCHES, trees)
        for nodes in opened:
            found = children(found.join(nodes, "node"), BRANCHES)
        return found.drop("signature")

    def learn(pairs: DataFrame) -> None:
        nonlocal labels
        if pairs.head(1):
            labels = merged(labels, pairs)

    for depth in range(DEPTH + 1):
        level: list[str] = []
        members = stage(reached(), "members", level)
        sizes = stage(members.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), "sizes", level)
        small = members.join(sizes.filter(F.col("size") <= leaf).select("node"), "node")
        zero = F.lit(0).cast("long")
        small = small.withColumns({"block": zero, "other": zero, "component": F.col("number"), "outer": F.lit(True)})
        # What leaves hold decides nothing about larger nodes and is compared once, at the end.
        lists.append(stage(listed(small), "leaves", kept))
        big = sizes.filter(F.col("size") > leaf)
        if not big.head(1):
            discard(spark, level)
            break
        large = members.join(broadcast_if_small(big, BROADCAST), "node")
        named = stage(with_component(large.drop("size"), labels), "large", level)
        spread = F.pmod(F.xxhash64("number", "node"), F.lit(PIVOTS))
        pivot = F.struct("number", "n_shingles", "sketch", "component")
        pivots = named.groupBy("node", spread.alias("spread")).agg(F.min_by(pivot, "number").alias("pivot"))
        pivots = stage(pivots.groupBy("node").agg(F.collect_list("pivot").alias("pivots")), "pivots", level)
        before = labels
        learn(stage(pivot_pairs(named.join(pivots, "node"), least, percent).distinct(), "pairs", kept))
        if labels is not before:
            named = stage(with_component(named.drop("component"), labels), "named", level)
        # The largest component of a node, among those of several classes.
        shares = named
        if labels is not None:
            shares = named.join(labels.select("component").distinct(), "component", "left_semi")
        else:
            shares = named.limit(0)
        shares = shares.groupBy("node", "component").agg(F.count("*").alias("n"))
        shares = shares.groupBy("node").agg(F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("main"))
        shares = big.join(shares, "node", "left").withColumn("most", F.coalesce("most", F.lit(0).cast("long")))
        shares = stage(shares.filter("most < size"), "shares", level)
        ends = F.lit(depth == DEPTH) | (F.col("size") - F.col("most") <= leaf)
        lists.append(stage(end_lists(named, shares.filter(ends), leaf), "ended", kept))
        further = stage(shares.filter(~ends).select("node"), "opened", kept)
        discard(spark, level)
        if not further.head(1):
            break
        opened.append(broadcast_if_small(further, BROADCAST))

    every = reduce(DataFrame.union, lists)
    learn(stage(list_pairs(every, least, percent).select("a", "b").distinct(), "near", kept))
    if labels is not None:
        labels = linked_within(sets, labels, classes, least, percent, kept)

    groups = with_component(classes.select("class", "number", "least_id"), labels).withColumnRenamed("component", "group")
    groups = stage(groups, "groups", paths)
    smallest = groups.groupBy("group").agg(F.min("least_id").alias("least_id"))
    named = groups.select("class", "group").join(smallest, "group").select("class", "group", "least_id")
    discard(spark, kept + sets.paths)
    return rows.join(named, "class", "left").select("doc_id", "text_key", "n_shingles", "class", "group", "least_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, trees: int | None = None, leaf: int = LEAF) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept, class.

    `docs` needs doc_id and text; further columns are ignored. NULL and empty texts and those without words have no
    class and are linked with nothing. `component_id` is the smallest doc_id reachable; rows that repeat a doc_id share
    `kept`. Without `trees`, the threshold decides how many there are. NULL ids never are the smallest while there is another, and a row with one is kept if alone in its component.
    """
    out = near_groups(docs, shingle, percent, trees, leaf)
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least_id"))
    out = out.withColumn("component_id", component)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), F.lower(F.hex("class")).alias("class"))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with all its columns: the smallest id, NULL last, of rows with that id the least md5.

    Rows go by id and text: other texts of an id that is repeated or NULL are none of a group's business. Of rows that repeat the id and text
    that stay, the one with the least hash of all columns is kept. Texts without words all stay. Helper columns begin with two underscores.
    """
    spent: list[str] = []
    found = near_groups(docs, percent=percent, paths=spent).filter("class IS NOT NULL")
    rows = found.groupBy("group", "doc_id", "text_key").agg(F.count("*").alias("__n"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    rows = stage(rows.withColumn("__rank", rank), "group_rows", spent)
    rows = rows.join(rows.groupBy("group").agg(F.min("__rank").alias("__first")), "group")
    rows = rows.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__n", (F.col("__rank") == F.col("__first")).alias("__kept"))
    rows = stage(rows, "fates")
    discard(docs.sparkSession, spent)
    keyed = docs.withColumn("__text", text_key("text"))

    def those(frame: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
        return frame.join(chosen, (F.col("__text") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id")), how)

    left = those(keyed, broadcast_if_small(rows.filter("NOT __kept").select("__id", "__key"), BROADCAST), "left_anti")
    again = rows.filter("__n > 1 AND __kept").select("__id", "__key")
    if not again.head(1):
        return left.drop("__text")
    again = broadcast_if_small(again, BROADCAST)
    columns = [F.col(f"`{name}`") for name in docs.columns]
    first = F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("__row")
    one_each = those(left, again, "left_semi").groupBy("doc_id", "__text").agg(first).select("__row.*")
    return those(left, again, "left_anti").drop("__text").unionByName(one_each)
