"""Line dedup by pairwise alignment.

A line ends at a line end or behind a sentence mark. Lines of `ANCHOR_WORDS` words or more are hashed; documents that
share one become a pair. A rare line (up to `RARE` holders) pairs all its holders, a more frequent one pairs each holder with the
earliest, so links grow with the rows. Besides, the shortest runs of lines from each line on
and up to each line that reach `BLOCK_WORDS` words are hashed and pair each holder with the run's earliest holder: each line of a shared block is in
such a run within the block, so every line of it meets an earlier document, lines too short to be anchors included. Each pair is aligned by patience diff on
line hashes, and aligned blocks of `BLOCK_WORDS` words or more are deleted from the later document. Of copies of one text
the first stays as it is; it stands for all of them in the pairs, and the others are one aligned block each.

Scale: exact copies are collapsed first. Distinct texts are numbered in the order of their first documents; what is shuffled is
hashes of lines and runs with these numbers, 16 bytes each, and texts once at the end where the list of deletions is beyond
`BROADCAST_BYTES`. Frequent lines and hub documents meet in sort-merge joins that adaptive execution splits. The alignment of two segments without
unique lines takes a bit per pair of lines that have a partner. Blocks that two documents hold in another order are aligned in one
order only, as in any diff: what stands against it stays in the later document.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrule.llm.common import WORD, stage

ANCHOR_WORDS = 5
BLOCK_WORDS = 20
RARE = 4
BROADCAST_BYTES = 32 << 20
END = re.compile(r"[.!?]+(?=\s)|\n")
SPLIT = re.compile(WORD)


def text_lines(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the lines that hold a word; code points."""
    text = text or ""
    ends = [match.end() for match in END.finditer(text)]
    return [(start, end) for start, end in pairwise([0, *ends, len(text)]) if end > start and not text[start:end].isspace()]


def line_hashes(text: str | None) -> tuple[list[int], list[int]]:
    """Hash and number of words per line; white space and ASCII case do not count."""
    # Bytes split at ASCII white space only, as words do.
    words = [text[a:b].lower().encode("utf-8", "surrogatepass").split() for a, b in text_lines(text)]
    hashes = [xxhash.xxh3_64_intdigest(b" ".join(w)) - (1 << 63) for w in words]
    return hashes, [len(w) for w in words]


def run_hashes(hashes: Sequence[int], words: Sequence[int], least: int) -> list[int]:
    """Hashes of the runs of neighbouring lines that reach `least` words: the shortest from each line on and the shortest up to each line."""
    packed = np.asarray(hashes, np.int64)
    until = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    places = np.arange(len(packed))
    ends = np.searchsorted(until, until[:-1] + least)  # from each line on
    starts = np.searchsorted(until, until[1:] - least, "right") - 1  # up to each line
    runs = {*zip(places.tolist(), ends.tolist(), strict=True)} | {*zip(starts.tolist(), (places + 1).tolist(), strict=True)}
    held = {xxhash.xxh3_64_intdigest(packed[a:b].tobytes()) - (1 << 63) for a, b in runs if a >= 0 and b <= len(packed)}
    return sorted(held)


def longest_rise(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of `pairs` (ordered by the first place) whose second places rise."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[k], piles[k] = b, i
    chain, i = [], piles[-1] if piles else -1
    while i >= 0:
        chain.append(pairs[i])
        i = back[i]
    return chain[::-1]


def common_subsequence(left: Sequence[int], right: Sequence[int]) -> list[tuple[int, int]]:
    """(place in left, place in right) of a longest common subsequence; the table has a bit for each pair of lines with a partner."""
    ours, theirs = set(left), set(right)
    rows = [i for i, h in enumerate(left) if h in theirs]
    columns = [j for j, h in enumerate(right) if h in ours]
    places: dict[int, int] = {}
    for k, j in enumerate(columns):
        places[right[j]] = places.get(right[j], 0) | 1 << k
    full = (1 << len(columns)) - 1
    state, states = full, [full]  # a 0 where the length rises by one
    for i in rows:
        hit = state & places[left[i]]
        state = ((state + hit) | (state - hit)) & full
        states.append(state)
    found, x, y = [], len(rows), len(columns)
    while x and y:
        mask = (1 << y) - 1
        here = y - (states[x] & mask).bit_count()
        if y - (states[x - 1] & mask).bit_count() == here:
            x -= 1
        elif y - 1 - (states[x] & (mask >> 1)).bit_count() == here:
            y -= 1
        else:
            found.append((rows[x - 1], columns[y - 1]))
            x, y = x - 1, y - 1
    return found[::-1]


def aligned(left: Sequence[int], right: Sequence[int]) -> list[tuple[int, int]]:
    """(place in left, place in right) of the lines that patience diff aligns, in order; without unique lines, a longest common subsequence."""
    found: list[tuple[int, int]] = []
    waiting = [(0, len(left), 0, len(right))]
    while waiting:
        a, a_end, b, b_end = waiting.pop()
        while a < a_end and b < b_end and left[a] == right[b]:
            found.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and left[a_end - 1] == right[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            found.append((a_end, b_end))
        if a >= a_end or b >= b_end:
            continue
        ours: dict[int, int] = {}
        for i in range(a, a_end):
            ours[left[i]] = -1 if left[i] in ours else i
        theirs: dict[int, int] = {}
        for j in range(b, b_end):
            theirs[right[j]] = -1 if right[j] in theirs else j
        unique = [(i, theirs[h]) for h, i in ours.items() if i >= 0 and theirs.get(h, -1) >= 0]
        last_a, last_b = a, b
        chain = longest_rise(sorted(unique))
        for i, j in chain:
            waiting.append((last_a, i, last_b, j))
            found.append((i, j))
            last_a, last_b = i + 1, j + 1
        if chain:
            waiting.append((last_a, a_end, last_b, b_end))
        else:
            found.extend((a + i, b + j) for i, j in common_subsequence(left[a:a_end], right[b:b_end]))
    return sorted(found)


def common_blocks(left: Sequence[int], right: Sequence[int], words: Sequence[int], least: int) -> list[tuple[int, int]]:
    """[start, end) of lines of `right` in aligned blocks of `least` words or more."""
    blocks, run = [], []
    for a, b in [*aligned(left, right), (-2, -2)]:
        if run and (a, b) != (run[-1][0] + 1, run[-1][1] + 1):
            if sum(words[j] for _, j in run) >= least:
                blocks.append((run[0][1], run[-1][1] + 1))
            run = []
        run.append((a, b))
    return blocks


def line_pairs(anchors: DataFrame, runs: DataFrame, rare: int = RARE) -> DataFrame:
    """(a, b): numbers of texts with a shared line or run, the earlier one first; both tables have (hash, number)."""
    rows = anchors.distinct()
    counts = rows.groupBy("hash").agg(F.count("*").alias("n"), F.min("number").alias("first")).filter("n > 1")
    held = stage(rows.join(counts, "hash"), "held_lines")
    star = held.filter(F.col("first") < F.col("number")).select(F.col("first").alias("a"), F.col("number").alias("b"))
    few = held.filter(F.col("n") <= rare)
    both = few.select("hash", F.col("number").alias("a")).join(few.select("hash", F.col("number").alias("b")), "hash").filter("a < b")
    earliest = runs.groupBy("hash").agg(F.count("*").alias("n"), F.min("number").alias("a")).filter("n > 1").select("hash", "a")
    passed = runs.join(earliest, "hash").select("a", F.col("number").alias("b")).filter("a < b")
    return star.union(both.select("a", "b")).union(passed).distinct()


def removed_blocks(texts: DataFrame, least: int) -> DataFrame:
    """(text_key, earlier, blocks) of the texts that lose lines; `texts` has (number, text_key, first_id, hashes, words)."""

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, ids, starts, ends = [], [], [], []
            for key, other, left, right, words in zip(batch["b"], batch["a"], batch["left"], batch["right"], batch["words"], strict=True):
                for start, end in common_blocks(left.tolist(), right.tolist(), words.tolist(), least):
                    keys.append(key)
                    ids.append(other)
                    starts.append(start)
                    ends.append(end)
            out = pd.DataFrame({"b": keys, "a": ids, "start": starts, "end": ends})
            yield out.astype({"b": np.int64, "a": np.int64, "start": np.int32, "end": np.int32})

    def begun(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs = [run_hashes(h, w, least) for h, w in zip(batch["hashes"], batch["words"], strict=True)]
            numbers = np.repeat(batch["number"].to_numpy(), [len(own) for own in runs])
            yield pd.DataFrame({"hash": np.array([h for own in runs for h in own], np.int64), "number": numbers})

    lines = texts.select("number", F.explode(F.arrays_zip("hashes", "words")).alias("line"))
    anchors = lines.filter(F.col("line.words") >= ANCHOR_WORDS).select(F.col("line.hashes").alias("hash"), "number")
    runs = texts.select("number", "hashes", "words").mapInPandas(begun, "hash long, number long")
    pairs = stage(line_pairs(anchors, stage(runs, "runs")), "line_pairs")
    left = texts.select(F.col("number").alias("a"), F.col("hashes").alias("left"))
    right = texts.select(F.col("number").alias("b"), F.col("hashes").alias("right"), "words")
    both = pairs.join(right.hint("shuffle_merge"), "b").join(left.hint("shuffle_merge"), "a").select("a", "b", "left", "right", "words")
    found = stage(both.mapInPandas(compared, "b long, a long, start int, end int"), "found")
    named = found.join(texts.select(F.col("number").alias("a"), "first_id"), "a")
    named = named.groupBy("b").agg(F.collect_set("first_id").alias("earlier"), F.collect_set(F.struct("start", "end")).alias("blocks"))
    return named.join(texts.select(F.col("number").alias("b"), "text_key"), "b").select("text_key", "earlier", "blocks")


def remove_lines(docs: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_lines, n_removed, removed (spans start:end of code points), earlier (ids), text.

    `docs` needs doc_id and text; further columns are ignored. The earlier document is the one with the smaller doc_id, NULL
    first; rows that repeat id and text are one document and have the same result. NULL and empty texts have no lines and an empty text. Documents
    with the same id and different texts go by the order of their texts' md5. An empty table gives an empty result.
    """

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[str] = set()  # a task reads copies of a text once
        for batch in batches:
            first = [key not in seen and not seen.add(key) for key in batch["text_key"]]
            batch = batch[np.array(first, bool)]
            rows = [line_hashes(text) for text in batch["text"]]
            yield pd.DataFrame({"text_key": batch["text_key"], "hashes": [r[0] for r in rows], "words": [r[1] for r in rows]})

    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.md5("text"))
    # NULL ids come first: NULL sorts before all numbers in a struct's minimum too.
    firsts = keyed.groupBy("text_key").agg(F.min(F.struct("doc_id")).alias("first"), F.count_distinct(F.struct("doc_id")).alias("copies"))
    firsts = firsts.select("text_key", F.col("first.doc_id").alias("first_id"), "copies").orderBy(F.col("first_id").asc_nulls_first(), "text_key")
    firsts = stage(firsts.withColumn("number", F.monotonically_increasing_id()), "firsts")  # numbers rise in this order
    lines = keyed.select("text", "text_key").mapInPandas(hashed, "text_key string, hashes array<long>, words array<int>")
    lines = stage(lines, "lines").groupBy("text_key").agg(F.min("hashes").alias("hashes"), F.min("words").alias("words"))
    texts = stage(lines.join(firsts, "text_key").select("number", "text_key", "first_id", "hashes", "words"), "texts")
    blocks = stage(removed_blocks(texts, least), "blocks")
    fate = firsts.join(blocks, "text_key", "left").filter("copies > 1 OR blocks IS NOT NULL")
    fate = stage(fate.select("text_key", F.lit(True).alias("fated"), "first_id", "earlier", "blocks"), "fate")
    listed = F.coalesce(F.size("earlier"), F.lit(0)) + F.coalesce(F.size("blocks"), F.lit(0))
    held = fate.agg(F.coalesce(F.sum(listed * 16 + 64), F.lit(0))).first()[0]
    fate = F.broadcast(fate) if held <= BROADCAST_BYTES else fate
    rows = keyed.join(fate, "text_key", "left")
    copy = F.col("fated").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    rows = rows.withColumn("copy", copy).select("doc_id", "text", "copy", "first_id", "earlier", "blocks")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, copied, blocks in zip(batch["doc_id"], batch["text"], batch["copy"], batch["blocks"], strict=True):
                spans = text_lines(text)
                gone: set[int] = set()
                if copied and len(SPLIT.findall(text)) >= least:
                    gone.update(range(len(spans)))
                elif blocks is not None:
                    for block in blocks:
                        gone.update(range(block["start"], block["end"]))
                cuts: list[list[int]] = []
                for i in sorted(gone):
                    start, end = spans[i]
                    if cuts and i - 1 in gone:
                        cuts[-1][1] = end
                    else:
                        cuts.append([start, end])
                kept, at = [], 0
                for start, end in cuts:
                    kept.append(text[at:start])
                    at = end
                kept.append(text[at:])
                out.append((len(spans), len(gone), ",".join(f"{a}:{b}" for a, b in cuts), "".join(kept)))
            made = pd.DataFrame(out, columns=["n_lines", "n_removed", "removed", "text"])
            made["doc_id"] = batch["doc_id"].array
            made["earlier"] = batch["earlier"].array
            yield made

    partners = F.when(F.col("copy"), F.array("first_id")).otherwise(F.coalesce("earlier", F.expr("CAST(array() AS array<long>)")))
    rows = rows.withColumn("earlier", F.array_sort(partners))
    return rows.mapInPandas(cut, "doc_id long, n_lines long, n_removed long, removed string, earlier array<long>, text string")
