"""Benchmark decontamination by template canonicalisation.

A text is read twice. In the strict reading, words lose case and punctuation, and numbers and units after numbers become typed
placeholders. In the loose one names do so as well, those that begin a sentence included, and each run of name or number words is one
placeholder, however many words it has. Windows of `WINDOW` template words are hashed and joined with those of the benchmark
items, reading by reading. An item whose template is shorter is one window, looked for at every place of the texts.

Hits belong together if their diagonals (document position minus item position) lie within `SPREAD` of one another, so words may come in
or drop out between them. A slot value of the item takes the value that most of these hits give it, and hits that say otherwise do not
count. A document holds an item if half of its windows are hit, or `RUN` words of it in a row are there with their own slot values. An item
of one short window with fewer than `PLAIN_WORDS` words outside slots must be there with its own values.

The window hashes are made per text in Arrow batches. A benchmark of up to `LOOKUP_ROWS` windows is looked up there, so that only hits
leave Python; a larger one is joined. A word that is no slot and stands in no item ends every window, so of each text only
stretches of at least a window without such words are read at first, and the whole text once one of their windows is looked up
successfully. Decisions depend on the text alone and are made once per text and item with a hit. Items of fewer than `LEAST_WORDS` words are
held by nothing: they stand in too many clean texts.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrule.llm.common import WORD, stage
from plumbrule.workspace import broadcast_if_small

WINDOW = 8
COVERAGE = 0.5  # share of the windows of an item
RUN = 13  # words in a row that are enough of any item
SPREAD = 8  # words that may come in or drop out within an item
PLAIN_WORDS = 4
LOOKUP_ROWS = 1_000_000
FRAME_ROWS = 50_000
CACHE_WORDS = 50_000
FLAG_WORDS = 200_000
LEAST_WORDS = 4
UNITS = frozenset(
    "mm cm m km g kg mg t l ml s sec min h hr hour hours minute minutes second seconds day days week weeks month months year years "
    "meter meters metre metres mile miles inch inches foot feet yard yards pound pounds ounce ounces dollar dollars euro euros "
    "cent cents percent liter liters litre litres gallon gallons gram grams kilogram kilograms kilometer kilometers".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
# Words that begin sentences and are no names.
STARTERS = frozenset(
    "a after all although an and any are as at because before both but by can could did do does during each every few find for from give given "
    "had has have he her here his how i if in is it its let many may most my no not of on once one only or our out over she should since so "
    "some suppose than that the their them then there these they this those though to under until was we were what when where which while "
    "who whose why will with would you your".split()
)
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
EDGE = re.compile(r"^\W+|\W+$")
MARKS = ".,;:!?\"'()"  # the commonest of what EDGE takes off
SPLIT = re.compile(WORD)
PLAIN, NUM, CAP, UNIT = range(4)
KINDS = ("word", "number", "name", "unit")
WINDOWS = "text_key string, reading int, width int, n int, at int, hash long, slots string"


UNKNOWN, KNOWN, NO_WORD = range(3)


class Words(dict):
    """Whether a word can stand in a window of the benchmark: it is in its vocabulary, or may be a slot."""

    def __init__(self, templates: Templates, vocabulary: frozenset[str]):
        self.templates, self.vocabulary = templates, vocabulary | UNITS | NUMBER_WORDS

    def __missing__(self, raw: str) -> int:
        bare = raw.strip(MARKS)
        if not bare.isalnum():
            bare = EDGE.sub("", raw)
        lower = bare.lower()
        if lower in self.vocabulary:
            found = KNOWN
        elif bare.isalpha() and bare[0].islower():
            found = UNKNOWN
        elif not bare:
            found = NO_WORD
        elif bare[0].isupper() or NUMBER.fullmatch(bare) or all(part in NUMBER_WORDS for part in lower.split("-")):
            found = KNOWN
        else:
            found = UNKNOWN
        if len(self) >= FLAG_WORDS:
            self.clear()
        self[raw] = found
        return found

    def stretches(self, text: str, least: int) -> Iterator[tuple[list[str], bool]]:
        """Longest runs of at least `least` known words, and whether a sentence begins with them."""
        words = SPLIT.findall(text)
        flags = np.frombuffer(bytes(map(self.__getitem__, words)), np.uint8)
        at = np.flatnonzero(flags != NO_WORD)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], flags[at] == KNOWN, [0]]).astype(np.int8)))
        for start, end in zip(edges[::2], edges[1::2], strict=True):
            if end - start >= least:
                yield [words[i] for i in at[start:end]], start == 0 or self.templates.word(words[at[start - 1]])[2]


class Templates:
    """Texts to their two readings, and these to window hashes."""

    def __init__(self):
        self.known: dict[str, tuple[int, int, bool, bool, str, int]] = {}

    def word(self, raw: str) -> tuple[int, int, bool, bool, str, int]:
        """(hash, kind, ends a sentence, ends a phrase, bare word, kind in the loose reading)."""
        got = self.known.get(raw)
        if got is None:
            bare = EDGE.sub("", raw)
            kind = PLAIN
            if NUMBER.fullmatch(bare):
                kind = NUM
            elif bare.lower() in UNITS:
                kind = UNIT
            elif bare[:1].isupper():
                kind = CAP
            last = raw.rstrip("\"')]”’»")[-1:]
            bare = bare.lower()
            free = NUM if all(part in NUMBER_WORDS for part in bare.split("-")) else PLAIN if bare == "i" else kind
            got = (xxhash.xxh3_64_intdigest(bare.encode("utf-8", "surrogatepass")), kind, last in tuple(".!?:"), last in tuple(".!?:,;"), bare, free)
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[raw] = got
        return got

    def __call__(self, text: str | None) -> list[tuple[np.ndarray, np.ndarray, list[str]]]:
        """(tokens, kinds, words) of the strict and, if it has slots, of the loose reading."""
        return self.readings(SPLIT.findall(text or ""))

    def readings(self, raw: list[str], start: bool = True) -> list[tuple[np.ndarray, np.ndarray, list[str]]]:
        """The readings of these words; `start` says whether a sentence begins with them."""
        words = [w for w in map(self.word, raw) if w[4]]
        if not words:
            return []
        hashes = np.fromiter((w[0] for w in words), np.uint64, len(words))
        strict = np.zeros(len(words), np.uint64)
        loose: list[int] = []
        after_number, after_loose = False, False
        for i, (_, kind, ends, _, bare, free) in enumerate(words):
            if kind == NUM or (kind == UNIT and after_number):
                strict[i] = kind
            if (free == UNIT and not after_loose) or (free == CAP and start and bare in STARTERS):
                free = PLAIN
            loose.append(free)
            start, after_number, after_loose = ends, kind == NUM, free == NUM
        readings = [(np.where(strict > 0, strict, hashes), strict, [w[4] for w in words])]
        if any(loose):
            tokens, kinds, values = [], [], []
            joins = PLAIN
            for (own, _, _, breaks, bare, _), kind in zip(words, loose, strict=True):
                if kind == joins != PLAIN:
                    values[-1] += f" {bare}"
                else:
                    tokens.append(kind or own)
                    kinds.append(kind)
                    values.append(bare)
                joins = PLAIN if breaks or kind == UNIT else kind
            readings.append((np.array(tokens, np.uint64), np.array(kinds, np.uint64), values))
        return readings

    def windows(self, tokens: np.ndarray, width: int, reading: int) -> np.ndarray:
        n = len(tokens) - width + 1
        out = np.full(n, 2 * width + reading, np.uint64)
        for i in range(width):
            out = (out ^ tokens[i : n + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return out.view(np.int64)


def slot_values(kinds: np.ndarray, values: list[str], at: int, width: int) -> str | None:
    """The slots of a window: place, kind and value of each."""
    found = [f"{i}={KINDS[int(kinds[at + i])]}={values[at + i]}" for i in np.flatnonzero(kinds[at : at + width])]
    return "\x1f".join(found) if found else None


def template_windows(
    texts: DataFrame, width: int, shorter: Sequence[int] | None = None, wanted: np.ndarray | None = None, vocabulary: frozenset[str] | None = None
) -> DataFrame:
    """(text_key, reading, width, n, at, hash, slots): the windows of each text's readings; `n` of them, `at` counts from 0.

    A template below `width` is one window of its own length. With `shorter`, windows of just these lengths, and of `width`, are
    made at all places instead. With `wanted` (sorted hashes) and `vocabulary`, windows with other hashes are left out.
    """
    sought = None if wanted is None else texts.sparkSession.sparkContext.broadcast((wanted, vocabulary))
    widths = [*(shorter or ()), width]

    def framed(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["text_key", "reading", "width", "n", "at", "hash", "slots"])
        return out.astype({"reading": np.int32, "width": np.int32, "n": np.int32, "at": np.int32, "hash": np.int64})

    def places(hashes: np.ndarray) -> np.ndarray:
        """Where windows are that are looked up successfully."""
        known = sought.value[0]
        return np.flatnonzero(known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes)

    def may_hold(templates: Templates, words: Words, texts: Sequence[str]) -> set[int]:
        """Places of the texts some window of which is wanted, told from the stretches that can hold one, all hashed together.

        Windows across two stretches mean nothing; where one is wanted, its texts are read for nothing.
        """
        found: set[int] = set()
        read: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for place, text in enumerate(texts):
            for stretch, start in words.stretches(text, widths[0]):
                for reading, (tokens, _, _) in enumerate(templates.readings(stretch, start)):
                    read[reading].append((place, tokens))
        for reading, parts in read.items():
            tokens = np.concatenate([own for _, own in parts])
            of_text = np.repeat([place for place, _ in parts], [len(own) for _, own in parts])
            for w in widths:
                if w <= len(tokens):
                    hit = places(templates.windows(tokens, w, reading))
                    found.update(of_text[hit].tolist())
                    found.update(of_text[hit + w - 1].tolist())
        return found

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates = Templates()
        words = None if sought is None else Words(templates, sought.value[1])
        rows: list[tuple] = []
        for batch in batches:
            if words is not None:
                held = may_hold(templates, words, batch["text"])
                batch = batch[[place in held for place in range(len(batch))]]
            for key, text in zip(batch["text_key"], batch["text"], strict=True):
                for reading, (tokens, kinds, values) in enumerate(templates(text)):
                    for w in [min(width, len(tokens))] if shorter is None else [w for w in widths if w <= len(tokens)]:
                        hashes = templates.windows(tokens, w, reading)
                        chosen = np.arange(len(hashes)) if sought is None else places(hashes)
                        rows.extend((key, reading, w, len(hashes), int(at), int(hashes[at]), slot_values(kinds, values, at, w)) for at in chosen)
                if len(rows) >= FRAME_ROWS:
                    yield framed(rows)
                    rows = []
        yield framed(rows)

    keyed = texts.filter("text IS NOT NULL").select(F.md5("text").alias("text_key"), "text")
    return keyed.mapInPandas(made, WINDOWS)


def vocabulary_of(texts: DataFrame) -> frozenset[str]:
    """The words that stand in a reading of a text outside slots."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates = Templates()
        for batch in batches:
            found = {value for text in batch["text"] for _, kinds, values in templates(text) for kind, value in zip(kinds, values, strict=True) if kind == PLAIN}
            yield pd.DataFrame({"word": sorted(found)}, dtype=object)

    return frozenset(texts.select("text").mapInPandas(made, "word string").distinct().toPandas()["word"])


def alike(left: str, right: str) -> bool:
    """Equal values, or names that share a word."""
    return left == right or bool(set(left.split()) & set(right.split()))


def counted(hits: list[tuple[int, int, str | None, str | None]]) -> list[tuple[int, int, str | None, str | None]]:
    """The hits whose slots agree with what most hits say of the item's slot values."""
    pairs = [list(zip((theirs or "").split("\x1f"), (ours or "").split("\x1f"), strict=False)) if theirs else [] for _, _, theirs, ours in hits]
    bare = [[(t.partition("=")[2], o.partition("=")[2]) for t, o in row] for row in pairs]
    votes: dict[str, Counter] = defaultdict(Counter)
    for row in bare:
        for theirs, ours in row:
            votes[theirs][ours] += 1
    chosen = {theirs: min(said, key=lambda ours: (-said[ours], ours)) for theirs, said in votes.items()}
    return [hit for hit, row in zip(hits, bare, strict=True) if all(alike(chosen[theirs], ours) for theirs, ours in row)]


def holds(hits: list[tuple[int, int, str | None, str | None]], n: int, width: int, full: int, coverage: float) -> bool:
    """Whether hits (item place, diagonal, item slots, own slots) of one reading are enough of an item of `n` windows."""
    if width < full:
        return any(theirs == ours or width - len((theirs or "").split("\x1f")) >= PLAIN_WORDS for _, _, theirs, ours in hits)
    same = sorted({(diagonal, place) for place, diagonal, theirs, ours in hits if theirs == ours})
    length, before = 0, None
    for diagonal, place in same:
        length = length + 1 if before == (diagonal, place - 1) else 1
        if length + width - 1 >= RUN:
            return True
        before = (diagonal, place)
    least = max(1, int(np.ceil(n * coverage)))
    hits = sorted(hits, key=lambda hit: hit[1])
    start = 0
    for end in range(1, len(hits) + 1):
        while hits[end - 1][1] - hits[start][1] > SPREAD:
            start += 1
        if end < len(hits) and hits[end][1] - hits[start][1] <= SPREAD:
            continue
        near = hits[start:end]
        if len({hit[0] for hit in near}) >= least and len({hit[0] for hit in counted(near)}) >= least:
            return True
    return False


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """(text_key, item_ids): the items that each distinct text of `docs` holds, by md5 of the text."""
    benchmark = benchmark.filter(F.regexp_count("text", F.lit(WORD)) >= LEAST_WORDS)
    items = benchmark.select(F.col("item_id").cast("long"), F.md5("text").alias("text_key")).distinct()
    asked = template_windows(benchmark.select("text").distinct(), width).join(items, "text_key")
    asked = asked.select("item_id", "hash", "width", F.col("n").alias("item_n"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    asked = stage(asked, "item_windows")
    shorter = sorted(r.width for r in asked.filter(F.col("width") < width).select("width").distinct().collect())
    windows = asked.limit(LOOKUP_ROWS + 1).count()
    wanted = vocabulary = None
    if 0 < windows <= LOOKUP_ROWS:
        wanted = np.sort(asked.select("hash").distinct().toPandas()["hash"].to_numpy())
        vocabulary = vocabulary_of(benchmark)
    found = template_windows(docs, width, shorter, wanted, vocabulary).select("text_key", "reading", "at", "hash", "slots")
    hit = F.struct("item_at", (F.col("at") - F.col("item_at")).alias("diagonal"), "item_slots", "slots")
    hits = found.join(broadcast_if_small(asked), "hash").groupBy("text_key", "item_id", "reading", "width", "item_n").agg(F.collect_set(hit).alias("hits"))

    def enough(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [
                holds([(h["item_at"], h["diagonal"], h["item_slots"], h["slots"]) for h in own], n, w, width, coverage)
                for own, n, w in zip(batch["hits"], batch["item_n"], batch["width"], strict=True)
            ]
            yield batch.loc[np.array(kept, bool), ["text_key", "item_id"]]

    held = hits.mapInPandas(enough, "text_key string, item_id long")
    return held.groupBy("text_key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


def decontamination_report(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """One row per row of `docs`: doc_id, contaminated, item_ids (sorted list, empty if none).

    `docs` needs doc_id and text, `benchmark` item_id and text; further columns are ignored. NULL and empty texts hold
    nothing and are held by nothing, as are items below `LEAST_WORDS` words. Items shorter than a window count as one window, found at
    any place of a text. Rows that repeat a text have the same items; repeated items count once, and all ids of an item's text are listed. Empty
    tables give no rows or no items.
    """
    found = broadcast_if_small(stage(contamination(docs, benchmark, width, coverage), "contaminated"))
    keyed = docs.select("doc_id", F.md5("text").alias("text_key")).join(found, "text_key", "left")
    return keyed.select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("item_ids", F.expr("CAST(array() AS array<long>)")).alias("item_ids")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with all their columns; repeated rows stay or go together."""
    found = stage(contamination(docs, benchmark, width, coverage), "contaminated")
    found = broadcast_if_small(found.select(F.col("text_key").alias("__key")))
    return docs.join(found, F.md5(docs["text"]) == found["__key"], "left_anti")
