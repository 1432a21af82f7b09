"""The operators against brute force on small tables, and their edge cases."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from plumbrule.llm.decontaminate import decontamination_report
from plumbrule.llm.licenses import DIGESTS, LICENSES, license_report
from plumbrule.llm.line_dedup import aligned, common_subsequence, remove_lines, run_hashes
from plumbrule.llm.main_text import main_text
from plumbrule.llm.mixing import mix
from plumbrule.llm.near_dups import near_duplicates
from plumbrule.llm.neighbours import nearest_neighbours
from plumbrule.llm.secrets import secret_report
from plumbrule.llm.toxicity import score_documents

DOCS = "doc_id long, text string, lang string, source string, n_chars long, class string, key string"


@pytest.fixture(scope="module")
def words():
    draw = random.Random(1)
    return ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(400)]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None, "x", "y") for i, t in texts], DOCS)


def shingles(text):
    split = (text or "").lower().split()
    return {tuple(split[i : i + 5]) for i in range(len(split) - 4)} if len(split) >= 5 else ({tuple(split)} if split else set())


def test_near_duplicates_equal_brute_force(spark, words):
    draw = random.Random(2)
    texts = []
    for group in range(12):
        base = [draw.choice(words) for _ in range(120)]
        for _ in range(draw.randint(1, 8)):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append((len(texts), " ".join(copy)))
    texts += [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE two"), (904, "ONE two")]
    got = {r.doc_id: r for r in near_duplicates(docs_of(spark, texts), leaf=4).collect()}
    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 85 * len(sets[a] | sets[b]) and root[b] > root[a]:
                    root[b], changed = root[a], True
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(s), root[i], root[i] == i) for i, s in sets.items()}


def brute_components(texts, percent):
    sets = [shingles(text) for text in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return {frozenset(j for j in range(len(texts)) if find(j) == find(i)) for i in range(len(texts)) if sets[i]}


def test_near_copies_around_the_threshold_equal_brute_force(spark, words):
    """Copies of one text, of all degrees of likeness around the threshold, in leaves and in larger nodes."""
    draw = random.Random(12)
    texts = []
    for group in range(4):
        base = [draw.choice(words) for _ in range(150)]
        for copy in range(30):
            changed = list(base)
            for _ in range(draw.randint(0, 6)):
                changed[draw.randrange(len(changed))] = draw.choice(words)
            texts.append(" ".join(changed))
    expected = brute_components(texts, 85)
    for leaf in (8, 256):
        rows = near_duplicates(docs_of(spark, list(enumerate(texts))), leaf=leaf).collect()
        got = {}
        for r in rows:
            got.setdefault(r.component_id, set()).add(r.doc_id)
        assert set(map(frozenset, got.values())) == expected


def test_copies_and_null_ids_make_one_set_per_class(spark, words, monkeypatch):
    from plumbrule.llm import near_dups

    base = words[:60]
    near = [*base[:-1], words[70]]
    rows = [(None if i % 3 == 0 else i, " ".join(base)) for i in range(300)] + [(None if i % 3 == 0 else 1000 + i, " ".join(near)) for i in range(300)]
    rows += [(None, " ".join(words[100 + i : 130 + i])) for i in range(0, 120, 40)]
    seen = []
    stage = near_dups.stage

    def counted(df, name, *more):
        out = stage(df, name, *more)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(near_dups, "stage", counted)
    got = near_duplicates(docs_of(spark, rows)).collect()
    assert {r.component_id for r in got if r["class"] in {g["class"] for g in got if g.doc_id in (1, 1001)}} == {1}
    assert max(n for name, n in seen if name in ("sets", "links", "wanted")) <= 2


def test_spanning_forest_of_a_leaf():
    import numpy as np

    from plumbrule.llm.near_dups import spanning

    strong = np.zeros((6, 6), bool)
    for i, j in ((0, 1), (1, 2), (0, 2), (3, 4)):
        strong[i, j] = strong[j, i] = True
    edges, tree = spanning(strong)
    assert len(edges) == 3 and tree.tolist() == [0, 0, 0, 3, 3, 5]


def test_items_of_few_words_are_held_by_nothing(spark):
    bench = spark.createDataFrame([(1, "the"), (2, "of the"), (3, "one two three"), (4, "a b c d")], "item_id long, text string")
    texts = [(1, "of the one two three and the a b c d e"), (2, "the")]
    got = {r.doc_id: r.item_ids for r in decontamination_report(docs_of(spark, texts), bench).collect()}
    assert got == {1: [4], 2: []}


def brute_holds(item, text, width=8):
    """Share of the item's word windows that stand in the text."""
    windows = lambda t: {tuple(t[i : i + width]) for i in range(len(t) - width + 1)}
    return len(windows(item) & windows(text)) / max(1, len(windows(item)))


def test_decontamination_of_plain_items_equals_brute_force(spark, words):
    draw = random.Random(13)
    items = [[draw.choice(words) for _ in range(draw.randint(20, 50))] for _ in range(12)]
    texts = []
    for i in range(80):
        text = [draw.choice(words[:300]) for _ in range(draw.randint(20, 200))]
        if i % 2:
            item, at = draw.choice(items), draw.randrange(len(text))
            first = draw.randrange(len(item) // 2)
            text[at:at] = item[first : first + draw.randint(5, len(item))]
        texts.append((i, " ".join(text)))
    bench = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontamination_report(docs_of(spark, texts), bench).collect()}

    def longest(item, text):
        return max((n for n in range(len(item) + 1) for i in range(len(item) - n + 1) if " ".join(item[i : i + n]) in text), default=0)

    for i, text in texts:
        want = [k for k, item in enumerate(items) if brute_holds(item, text.split()) >= 0.5 or longest(item, text) >= 13]
        assert got[i] == want


def test_decontamination_finds_passages_and_changed_slots(spark):
    item = "In the year 1990 a farmer named Anna had 12 kg of apples and gave Anna half of the 12 kg away again"
    changed = item.replace("12", "35").replace("Anna", "Maria")
    torn = item.replace("Anna", "Maria", 1)
    texts = [(1, f"Before. {item} After."), (2, changed), (3, "a clean text about nothing that was ever asked"), (4, torn.lower()), (5, None), (6, "")]
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontamination_report(docs_of(spark, texts), bench).collect()}
    assert got[1] == [7] and got[2] == [7]
    assert got[3] == got[5] == got[6] == []
    assert decontamination_report(docs_of(spark, []), bench).count() == 0


def test_decontamination_finds_shifted_partial_and_short_items(spark, words):
    item = words[:40]
    story = "John Smith buys 3 kg of pears at noon. John Smith sells 2 pears to a friend of the shop and John Smith goes home with what is left of it"
    bench = [(1, " ".join(item)), (2, story), (3, "who wrote the old green book"), (4, "add 2 and 3")]
    texts = [
        (1, " ".join([*words[200:210], *item[:20], "extra", *item[20:], *words[210:220]])),
        (2, " ".join([*item[:20], *item[21:]])),
        (3, " ".join([*words[200:230], *item[10:30], *words[230:260]])),
        (4, story.replace("John Smith", "Maria").replace("3 kg", "1 200 kg")),
        (5, "They asked: who wrote the old green book, and nobody knew"),
        (6, "now add 2 and 3 to it"),
        (7, "now add 5 and 9 to it"),
        (8, " ".join([*words[200:230], *item[10:19], *words[230:260]])),
        (9, story.replace("John Smith", "Mary Ann Lee").replace("3 kg", "twenty five kg")),
    ]
    table = spark.createDataFrame(bench, "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontamination_report(docs_of(spark, texts), table).collect()}
    assert got == {1: [1], 2: [1], 3: [1], 4: [2], 5: [3], 6: [4], 7: [], 8: [], 9: [2]}
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.item_ids == [] for r in decontamination_report(docs_of(spark, texts), none).collect())


def test_line_dedup_removes_the_shared_block_from_the_later_document(spark, words):
    draw = random.Random(3)
    sentence = lambda: " ".join(draw.choice(words) for _ in range(9)) + "."
    block = "\n".join(sentence() for _ in range(4))
    first, second = f"{sentence()}\n{block}\n{sentence()}", f"{sentence()}\n{block}\n{sentence()}"
    texts = [(1, first), (2, second), (3, first), (4, sentence()), (5, None), (6, "")]
    got = {r.doc_id: r for r in remove_lines(docs_of(spark, texts)).collect()}
    assert got[1].text == first and got[1].n_removed == 0
    assert got[2].n_removed == 4 and block not in got[2].text and got[2].earlier == [1]
    assert got[3].text == "" and got[3].earlier == [1]
    assert got[4].n_removed == got[5].n_removed == got[6].n_lines == 0


def test_line_dedup_finds_passages_of_frequent_and_of_short_lines(spark, words):
    draw = random.Random(6)
    sentence = lambda n: " ".join(draw.choice(words) for _ in range(n)) + "."
    lines = [sentence(17) for _ in range(3)]
    passage, verse = "\n".join(lines), "\n".join(sentence(3) for _ in range(9))
    texts = [(i, f"{sentence(8)}\n{line}\n{sentence(9)}") for i, line in enumerate(lines)]
    texts += [(10 + i, f"{sentence(8)}\n{passage}\n{sentence(9)}") for i in range(5)]
    texts += [(20 + i, f"{sentence(8)}\n{verse}\n{sentence(9)}") for i in range(2)]
    got = {r.doc_id: r for r in remove_lines(docs_of(spark, texts)).collect()}
    assert {i: r.n_removed for i, r in got.items() if r.n_removed} == {11: 3, 12: 3, 13: 3, 14: 3, 21: 9}
    assert all(got[i].earlier == [10] for i in range(11, 15)) and got[21].earlier == [20]


def test_line_dedup_equals_brute_force(spark, words):
    """All pairs of documents, aligned one by one."""
    from plumbrule.llm.line_dedup import common_blocks, line_hashes, text_lines

    draw = random.Random(21)
    lines = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 14))) + draw.choice([".", "\n", "?", " ..."]) for _ in range(60)]
    passages = [[draw.choice(lines) for _ in range(draw.randint(2, 8))] for _ in range(8)]
    texts = []
    for i in range(60):
        parts = [line for _ in range(draw.randint(0, 4)) for line in draw.choice([passages[draw.randrange(8)], [draw.choice(lines)], [" ".join(draw.sample(words, 9)) + "."]])]
        texts.append((i // 2 if i > 50 else i + 100, " ".join(parts)))
    texts += [(7, None), (None, texts[3][1]), (8, "")]
    got = [(r.doc_id, r.n_lines, r.n_removed, tuple(r.earlier)) for r in remove_lines(docs_of(spark, texts).repartition(3)).collect()]
    firsts = {}
    for i, text in texts:
        text = text or ""
        key = (i is not None, i or 0)
        firsts[text] = min(firsts.get(text, key), key)
    md5 = lambda text: __import__("hashlib").md5(text.encode()).hexdigest()
    order = sorted(firsts, key=lambda text: (firsts[text], md5(text)))
    hashed = {text: line_hashes(text) for text in order}
    expected = []
    for i, text in texts:
        text = text or ""
        first = firsts[text][1] if firsts[text][0] else None
        n = len(text_lines(text))
        if i != first:
            expected.append((i, n, n if len(text.split()) >= 20 else 0, (first,)))
            continue
        gone, earlier = set(), set()
        for other in order[: order.index(text)]:
            for start, end in common_blocks(hashed[other][0], *hashed[text], 20):
                gone |= set(range(start, end))
                earlier.add(firsts[other][1] if firsts[other][0] else None)
        expected.append((i, n, len(gone), tuple(sorted(e for e in earlier if e is not None))))
    # Each removed line is in an earlier document; not all documents that hold it are named.
    assert sorted((r[:3] for r in got), key=str) == sorted((r[:3] for r in expected), key=str) and sum(r[2] for r in got) > 50
    named = {r[0]: set(r[3]) for r in expected if r[0] is not None and r[0] >= 100}
    assert all(set(r[3]) <= named[r[0]] for r in got if r[0] in named)


def test_lines_end_at_line_ends_and_behind_sentence_marks():
    from plumbrule.llm.line_dedup import text_lines

    cut = lambda text: [text[a:b] for a, b in text_lines(text)]
    assert cut("One. Two?! Three\n\n four v1.2 is. out...") == ["One.", " Two?!", " Three\n", " four v1.2 is.", " out..."]
    assert cut("") == cut(None) == cut(" \n\t ") == [] and cut("a\n") == ["a\n"]


def test_every_line_of_a_block_is_in_a_run_of_it():
    draw = random.Random(8)
    for _ in range(200):
        sizes = [draw.randrange(1, 15) for _ in range(draw.randrange(1, 10))]
        lines = list(range(len(sizes)))
        runs = set(run_hashes(lines, sizes, 20))
        inside = [range(a, b) for a in lines for b in range(a + 1, len(lines) + 1) if runs & set(run_hashes(lines[a:b], sizes[a:b], sum(sizes[a:b])))]
        assert all(sum(sizes[k] for k in run) >= 20 for run in inside)
        assert sum(sizes) < 20 or {k for run in inside for k in run} == set(lines)


def test_alignment_without_unique_lines():
    assert aligned([9, 1, 2, 1, 2, 8], [7, 1, 2, 1, 2, 6]) == [(1, 1), (2, 2), (3, 3), (4, 4)]
    draw = random.Random(7)
    for _ in range(200):
        left, right = ([draw.randrange(4) for _ in range(draw.randrange(12))] for _ in range(2))
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                best[i + 1][j + 1] = best[i][j] + 1 if a == b else max(best[i][j + 1], best[i + 1][j])
        found = common_subsequence(left, right)
        assert len(found) == best[-1][-1] and found == sorted(found) and all(left[i] == right[j] for i, j in found)


def test_patience_alignment_keeps_order():
    assert aligned([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1), (2, 2)]
    assert aligned([1, 2], [2, 1]) in ([(0, 1)], [(1, 0)])
    assert aligned([], [1]) == []


def test_neighbours_are_exact_where_all_leaves_are_visited(spark):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 1) for _ in range(4)], i) for i in range(60)]
    rows += [(100, None, 0), (120, [0.0] * 4, 0), (140, [float("nan")] * 4, 0), (160, [1.0, None, 1.0, 1.0], 0), (61, rows[1][1], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, leaf int")
    got = nearest_neighbours(table, nearest=5).collect()
    vectors = {r.vec_id: r.embedding for r in table.collect() if r.vec_id < 100}
    for query in (0, 20, 40):
        score = lambda i, q=query: sum(a * b for a, b in zip(vectors[q], vectors[i], strict=True))
        best = sorted((i for i in vectors if i != query), key=lambda i: (-score(i), i))[:5]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == query), key=lambda r: r["rank"])] == best
    assert nearest_neighbours(table.filter("vec_id < 0")).count() == 0


def test_neighbours_of_equal_vectors_have_equal_scores_and_all_are_found(spark):
    """Copies in many blocks and leaves score alike, ties go to the smaller id, and small leaves are no reason to return fewer."""
    draw = random.Random(14)
    base = [[draw.gauss(0, 1) for _ in range(16)] for _ in range(30)]
    rows = [(i, base[i % 30]) for i in range(600)] + [(1000 + 20 * i, [draw.gauss(0, 5) for _ in range(16)]) for i in range(3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = nearest_neighbours(table, sample=40, recall=0.01).collect()
    vectors = dict(rows)
    for query in (i for i in vectors if i % 20 == 0):
        mine = sorted((r for r in got if r.query_id == query), key=lambda r: r["rank"])
        assert len(mine) == 20
        assert [(r.score, -r.vec_id) for r in mine] == sorted(((r.score, -r.vec_id) for r in mine), reverse=True)
    scores = {}
    for r in got:
        scores.setdefault((r.query_id, tuple(vectors[r.vec_id])), set()).add(r.score)
    assert all(len(found) == 1 for found in scores.values())


def test_main_text_leaves_out_what_is_not_the_article():
    page = (
        "<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><a href=x>Menu</a></nav><div class='ad'>Buy this now</div>"
        "<article><h1>Head</h1><p><b>A first paragraph &amp; more  text<br>here.<p>Short.</p><div class=comments>nice</div></article><footer>&copy; me</footer>"
    )
    assert main_text(page) == "Head\nA first paragraph & more text here.\nShort."
    assert main_text(None) == main_text("") == main_text("<nav>only</nav>") == ""
    assert main_text("<p>a plain paragraph of a page without any frame</p>") == "a plain paragraph of a page without any frame"


def test_main_text_keeps_regions_with_layout_classes():
    text = "A long paragraph of the article that says what there is to say about the matter."
    body = f"<p>{text}</p><p>{text}</p>"
    want = f"{text}\n{text}"
    for start, end in (
        ("<main class='has-sidebar'>", "</main>"),
        ("<div id='wrap' class='layout-sidebar-right'><article>", "</article></div>"),
        ("<div class='sidebar'><article>", "</article></div>"),
        ("<article class='post category-legal'>", "</article>"),
        ("<article class='legal'>", "</article>"),
        ("<div class='social-science'>", "</div>"),
        ("<div class='widget'>", "</div>"),
    ):
        page = f"<html><body><div class='ad'>Buy</div>{start}{body}<div class='share-buttons'>Send it</div>{end}<div class='related-posts'>More</div></body></html>"
        assert main_text(page) == want, start
    replies = f"<div class='comments-area'><article class='comment-body'>{body}{body}</article></div>"
    teasers = f"<div class='related-posts'><article>{body}</article></div>"
    assert main_text(f"<html><body><article>{body}</article>{replies}{teasers}</body></html>") == want


def test_secrets_of_known_texts(spark):
    key = "AKIA" + "A1B2C3D4E5F6G7H8"
    texts = [(1, f"é password: hunter22 and {key} or {'0f' * 14}."), (2, None), (3, "")]
    got = {r.doc_id: r for r in secret_report(docs_of(spark, texts)).collect()}
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex) == (1, 1, 1)
    assert got[1].spans.startswith("assign:2:20,access:25:45,hex:49:77")
    assert got[2].spans == got[3].spans == ""


def test_licenses_by_canonical_digest(spark):
    text = LICENSES["MIT"].upper().replace("COPYRIGHT (C) <YEAR>", "Copyright (c) 2020 someone")
    got = {r.doc_id: r.license_id for r in license_report(docs_of(spark, [(1, text), (2, "none"), (3, None)])).collect()}
    assert got == {1: "MIT", 2: None, 3: None}


def test_licenses_of_long_texts_and_of_sentences(spark):
    apache = Path("/usr/share/common-licenses/Apache-2.0")
    mit = LICENSES["MIT"].removeprefix("MIT License")
    texts = [
        (1, LICENSES["BSD-3-Clause"]),
        (2, "BSD 3-Clause License\n" + LICENSES["BSD-3-Clause"].replace("1.", "*").replace("2.", "*").replace("3.", "*")),
        (3, mit),
        (4, "Some words. Released under the MIT License. More words follow."),
        (5, "This project is distributed under the terms of the GNU Lesser General Public License, version 2.1. Have fun"),
        (6, "We spoke of the MIT License at length."),
    ]
    if apache.exists():
        texts.append((7, apache.read_text()))
    got = {r.doc_id: (r.license_id, r.notices) for r in license_report(docs_of(spark, texts)).collect()}
    assert got.pop(7, ("Apache-2.0", ""))[0] == "Apache-2.0"
    assert got == {1: ("BSD-3-Clause", ""), 2: ("BSD-3-Clause", ""), 3: ("MIT", ""), 4: (None, "MIT"), 5: (None, "LGPL-2.1"), 6: (None, "")}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense"} <= set(DIGESTS.values())


def test_toxicity_learns_the_marked_word(spark, words):
    draw = random.Random(5)
    texts, labels = [], []
    for i in range(300):
        line = [draw.choice(words) for _ in range(20)]
        if i % 3 == 0:
            line[draw.randrange(20)] = "zzqqrr"
        texts.append((i, " ".join(line) + "."))
        labels.append((i, None, int(i % 3 == 0)))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = score_documents(docs_of(spark, [*texts, (999, None), (998, "")]), known).collect()
    held = [r for r in got if r.held_out and r.doc_id < 900]
    right = sum(r.predicted == int(r.doc_id % 3 == 0) for r in held)
    assert right >= 0.9 * len(held)
    assert all(r.score == 0 for r in got if r.doc_id >= 998)


def test_toxicity_without_labels_marks_nothing(spark, words):
    long = " ".join(f"{words[i]} {words[i + 1]}." for i in range(300))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.score, r.predicted, r.offending) for r in score_documents(docs_of(spark, [(1, long)]), none).collect()] == [(0.0, 0, [])]


def mix_table(spark, rows):
    return spark.createDataFrame([(i, text, "en", source, None, "x", "y") for i, text, source in rows], DOCS)


def test_schedule_keeps_every_prefix_near_the_shares(spark):
    """Each stretch from the start of the schedule holds every source within a few slots of its share."""
    from plumbrule.llm.mixing import schedule

    needed = [700, 90, 333, 1]
    needs = spark.createDataFrame(list(enumerate(needed)), "source_no long, needed long")
    slots = sorted((r.slot, r.source_no) for r in schedule(needs).collect())
    assert len(slots) == sum(needed)
    seen = [0] * len(needed)
    # The share of a source is that of the interval; the end of the schedule fills up what is missing.
    for slot, source in slots[: int(0.9 * len(slots))]:
        seen[source] += 1
        for number, count in enumerate(seen):
            assert abs(count - (slot + 1) * needed[number] / sum(needed)) <= 4


def test_mix_reads_by_the_schedule(spark, words):
    draw = random.Random(15)
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(1, 900))), draw.choice(["a", "b", None])) for i in range(120)]
    rows += [(500, None, "a"), (501, "", "b"), (502, " ", None), *rows[:3]]
    docs = mix_table(spark, rows)
    got = mix(docs, block=64).collect()
    assert len(got) == len(rows) and [tuple(r) for r in sorted(got)] == [tuple(r) for r in sorted(mix(docs.repartition(7), block=64).collect())]
    for r in got:
        assert (r.first_slot is None) == (r.last_slot is None) == (r.taken == 0) and r.taken <= 2 * r["size"]
        assert r.taken == 0 or r.first_slot <= r.last_slot
    for source in ("a", "b", None):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 1 and mine[0].source_size == sum(r["size"] for r in mine)
    assert mix(docs.limit(0)).count() == 0


def test_mixed_rows_come_in_the_order_of_the_schedule(spark, words):
    from plumbrule.llm.mixing import mixed

    draw = random.Random(16)
    rows = [(i, " ".join(draw.choices(words, k=300)), draw.choice(["a", "b", "c"])) for i in range(200)]
    docs = mix_table(spark, rows)
    first = {r.doc_id: (r.first_slot, r.last_slot) for r in mix(docs).collect()}
    seen, slots = set(), []
    for r in mixed(docs).collect():
        slots.append(first[r.doc_id][1 if r.doc_id in seen else 0])
        seen.add(r.doc_id)
    assert slots == sorted(slots) and len(slots) > 200


def test_running_sums_over_many_levels_and_groups(spark, monkeypatch):
    """Sums of cells are summed in cells again, and more groups than a cell has rows end too."""
    from plumbrule.llm import common

    monkeypatch.setattr(common, "FAN_BITS", 2)
    draw = random.Random(30)
    rows = [(g, key, draw.randint(0, 9)) for g, n in [(0, 700), *((g, 3) for g in range(1, 40))] for key in draw.sample(range(1 << 10), n)]
    table = spark.createDataFrame(rows, "g long, key long, amount long")
    got = {(r.g, r.key): r.before for r in common.running_sums(table, ["g"], "key", 10, "amount", "before").collect()}
    assert got == {(g, key): sum(a for h, other, a in rows if h == g and other < key) for g, key, _ in rows}


def test_mix_of_tables_with_many_cells(spark, words, monkeypatch):
    """As with one cell; above 4,096 cells sums take three levels, whose helper columns clashed."""
    from plumbrule.llm import common

    draw = random.Random(31)
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(1, 60))), draw.choice(["a", "b", None])) for i in range(150)]
    docs = mix_table(spark, rows)
    once = sorted(map(tuple, mix(docs, block=64).collect()), key=repr)
    monkeypatch.setattr(common, "FAN_BITS", 3)
    assert sorted(map(tuple, mix(docs, block=64).collect()), key=repr) == once


def test_slots_of_tables_with_many_cells(spark, monkeypatch):
    """Slots number the records of a shard from 0, and do not depend on how many cells the shards are cut into."""
    from plumbrule.llm import common
    from plumbrule.llm.sharding import shard_documents

    docs = docs_of(spark, [(i, f"text {i % 7}") for i in [*range(600), 5, 5, 6]])
    once = sorted(map(tuple, shard_documents(docs).collect()))
    monkeypatch.setattr(common, "FAN_BITS", 5)
    got = shard_documents(docs).collect()
    assert sorted(map(tuple, got)) == once
    slots = sorted((r.shard, r.slot) for r in got)
    assert slots == [(s, n) for s in range(16) for n in range(sum(r.shard == s for r in got))]


def test_candidates_of_a_list_are_fewer_than_its_classes(spark, words):
    """A group of near copies names a spanning forest, and one pair per class with pivots, however large it is."""
    from pyspark.sql import functions as F

    from plumbrule.llm import near_dups

    draw = random.Random(21)
    base = [draw.choice(words) for _ in range(400)]
    texts = []
    for i in range(60):
        changed = list(base)
        changed[draw.randrange(len(changed))] = f"new{i}"
        texts.append(" ".join(changed))
    shingler, seeds = near_dups.Shingler(5), near_dups.minwise_seeds()
    sets = [shingler(text) for text in texts]
    sketches = [bytearray(near_dups.sketch_of(near_dups.minwise(own, seeds))) for own in sets]
    rows = [(0, 0, 0, i, len(own), sketch, i, True) for i, (own, sketch) in enumerate(zip(sets, sketches, strict=True))]
    schema = "node long, block long, other long, number long, n_shingles int, sketch binary, component long, outer boolean"
    flat = spark.createDataFrame(rows, schema)
    lists, least = near_dups.listed(flat), near_dups.least_agreement(85)
    forest = near_dups.list_pairs(lists, least, 85).collect()
    assert len(forest) == 59 and near_dups.list_pairs(lists, least, 85, every=True).count() == 60 * 59 // 2
    pivots = [(0, [(i, len(sets[i]), sketches[i], i) for i in range(16)])]
    pivots = spark.createDataFrame(pivots, "node long, pivots array<struct<number: long, n_shingles: int, sketch: binary, component: long>>")
    assert near_dups.pivot_pairs(flat.join(pivots, "node"), least, 85).count() <= 60
    # Connected classes name nothing; the outer ones of an ended node meet the others in one forest.
    known = near_dups.listed(flat.withColumn("component", F.lit(0).cast("long")))
    assert near_dups.list_pairs(known, least, 85).count() == 0
    two = flat.withColumn("outer", F.col("number") < 5).withColumn("component", F.when(F.col("number") < 5, F.col("number")).otherwise(5))
    assert near_dups.list_pairs(near_dups.listed(two), least, 85).count() == 5


def test_near_copies_that_are_no_links_name_few_pairs(spark, words, monkeypatch):
    """A group whose texts are all candidates is told apart on its sets, in one block or many; pairs are never listed one by one."""
    from plumbrule.llm import near_dups

    draw = random.Random(32)
    texts = []
    for group in range(2):
        base = [draw.choice(words) for _ in range(200)]
        for copy in range(40):
            changed = list(base)
            for _ in range(draw.choice([1, 3, 4, 5])):
                changed[draw.randrange(len(changed))] = draw.choice(words)
            texts.append(" ".join(changed))
    expected = brute_components(texts, 90)
    assert 10 < len(expected) < 70
    seen = []
    stage = near_dups.stage

    def counted(df, name, *more):
        out = stage(df, name, *more)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(near_dups, "stage", counted)
    for block in (near_dups.BLOCK, 1000):
        monkeypatch.setattr(near_dups, "BLOCK", block)
        got = {}
        for r in near_duplicates(docs_of(spark, list(enumerate(texts))), percent=90).collect():
            got.setdefault(r.component_id, set()).add(r.doc_id)
        assert set(map(frozenset, got.values())) == expected
    # A forest a list at most; the candidates that are no links are 1,085 pairs.
    assert max(n for name, n in seen if name in ("near", "pairs", "firsts", "rest", "links")) < 5 * len(texts)
