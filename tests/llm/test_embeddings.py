"""Whitening, near-dedup of vectors and hard negatives against brute force, and their edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest

from plumbrule.llm.cover_tree import RADII, Tree, cosine, dual, near_vectors, nested, units
from plumbrule.llm.hard_negatives import Anchors, Search, hard_negatives, products
from plumbrule.llm.whitening import jacobi_davidson, whiten

# Columns of the operators' own results and helpers clash on purpose.
ROWS = "vec_id long, embedding array<double>, label int, component int, x string, class string, n_links string, score double, v int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], label, 1, "x", "c", "n", 0.5, 7) for i, v, label in rows], ROWS)


def odd_rows(dims):
    """Rows that take no part anywhere."""
    plain = [1.0] * dims
    return [(9001, None, 1), (9002, [], 1), (9003, [None, *plain[1:]], 1), (9004, [math.nan, *plain[1:]], 1), (9005, [math.inf, *plain[1:]], 1)]


def clustered(seed, groups, size, dims, spread):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((groups, dims))
    return np.vstack([c + spread * draw.standard_normal((draw.integers(1, size + 1), dims)) for c in centres])


# whitening


def eigen(x):
    n, sums = len(x), x.sum(0)
    z = (n * x - sums) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    return z, (n * x - sums).astype(object), e[::-1], u[:, ::-1]


@pytest.mark.parametrize("dims", [3, 8, 24])
def test_whitening_equals_dense_eigenvectors(spark, dims):
    draw = np.random.default_rng(dims)
    points = draw.standard_normal((200, dims)) * np.linspace(3, 1, dims) + 5
    rows = [(i, p, 1) for i, p in enumerate(points)] + odd_rows(dims) + [(9100, [1.0], 1), (None, points[0], 1)]
    x = np.floor(1024 * np.vstack([points, points[:1]])).astype(np.int64) + 100_000
    z, apart, values, axes = eigen(x)
    k = min(8, dims)
    expected = z @ axes[:, :k] / np.sqrt(values[:k])
    got = whiten(vectors_of(spark, rows).repartition(3)).toPandas()
    assert len(got) == len(x) * k and set(got["n"]) == {len(x)}
    table = got[got["vec_id"].notna()].pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((table * expected[:-1]).sum(0))
    assert np.abs(table * signs - expected[:-1]).max() < 1e-10
    alone = got[got["vec_id"].isna()].sort_values("component")["whitened"].to_numpy()
    assert np.abs(alone * signs - expected[-1]).max() < 1e-10
    one = got[got["vec_id"] == 0].sort_values("component")
    assert np.allclose(one["explained"], values[:k] / values.sum(), rtol=1e-12)
    assert set(one["deviation"]) == {sum(int(c) ** 2 for c in apart[0])}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-12


def test_whitening_of_little(spark):
    assert whiten(vectors_of(spark, [])).count() == 0
    assert whiten(vectors_of(spark, odd_rows(4))).count() == 0
    same = whiten(vectors_of(spark, [(1, [1.0, 2.0, 3.0], 1), (1, [1.0, 2.0, 3.0], 1)])).collect()
    assert len(same) == 6 and {(r.whitened, r.explained, r.deviation, r.identity_error) for r in same} == {(0.0, 0.0, 0, 0.0)}
    line = whiten(vectors_of(spark, [(i, [float(i), 2.0 * i, 1.0], 1) for i in range(20)])).collect()
    assert {r.component for r in line if r.whitened} == {1}
    assert all(abs(r.explained - 1) < 1e-12 for r in line if r.component == 1)
    huge = whiten(vectors_of(spark, [(i, [1e300 * (-1) ** i, float(i)], 1) for i in range(4)])).collect()
    assert len(huge) == 8 and {r.deviation for r in huge} == {None}


def test_jacobi_davidson_restarts_and_meets_close_eigenvalues():
    draw = np.random.default_rng(1)
    values = np.r_[[5, 5 - 1e-6, 4, 4, 3.5, 3.4, 3.39, 3.38], np.linspace(3, 0.1, 192)]
    turn = np.linalg.qr(draw.standard_normal((200, 200)))[0]
    dense = turn * values @ turn.T
    dense = (dense + dense.T) / 2
    got, axes = jacobi_davidson(lambda w: dense @ w, 200, 8, width=40, kept=16)
    assert np.abs(got - values[:8]).max() < 1e-12
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-12
    assert np.linalg.norm(dense @ axes - axes * got, axis=0).max() < 1e-12


# near-dedup


def brute_links(ids, points, similar=0.9):
    linked = units(points) @ units(points).T >= similar
    np.fill_diagonal(linked, False)
    root = np.arange(len(ids))
    while True:
        best = np.array([min([root[i], *root[linked[i]]]) for i in range(len(ids))])
        if (best == root).all():
            break
        root = best
    least = {r: min(i for i, own in zip(ids, root, strict=True) if own == r) for r in set(root)}
    return {i: (int(n), least[r]) for i, n, r in zip(ids, linked.sum(1), root, strict=True)}


@pytest.mark.parametrize("block", [16, 8192])
def test_near_vectors_equal_brute_force(spark, block):
    points = np.vstack([clustered(s, 12, 14, 6, spread) for s, spread in enumerate((0.02, 0.15, 0.4))])
    points = np.vstack([points, points[:9], 3.5 * points[5:9], 1e-200 * points[:2]])
    ids = [1000 - 3 * i for i in range(len(points))]
    zero = [(9200, [0.0] * 6, 1), (9201, [0.0] * 6, 1), (9300, [1.0, 2.0], 1)]
    rows = list(zip(ids, points, [1] * len(ids), strict=True)) + odd_rows(6) + zero
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(vectors_of(spark, rows).repartition(4), centres=20, block=block).collect()}
    expected = {i: (n, c, i == c) for i, (n, c) in brute_links(ids, points).items()}
    expected |= {i: (0, i, True) for i, *_ in odd_rows(6) + zero}
    assert got == expected


def test_near_vectors_with_repeated_and_null_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.01], 1), (None, [-1.0, 0.0], 1), (7, [0.0, 1.0], 1), (7, [0.0, 1.0], 1)]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in near_vectors(vectors_of(spark, rows)).collect())
    assert got == [("5", 2, "5", True), ("5", 2, "5", True), ("7", 1, "7", True), ("7", 1, "7", True), ("None", 0, "None", True), ("None", 2, "5", False)]
    assert near_vectors(vectors_of(spark, [])).count() == 0
    assert near_vectors(vectors_of(spark, [(1, None, 1)])).collect()[0].kept


def test_many_copies_make_no_pairs(spark):
    """A group of copies is one class, and a tight cluster is linked as a whole."""
    draw = np.random.default_rng(3)
    tight = np.array([1.0, 2.0, 3.0, 4.0]) + 0.001 * draw.standard_normal((400, 4))
    tree = Tree(tight, nested(units(tight), RADII), np.ones(400, np.int64), np.arange(400))
    links = dual(tree, tree, 0.9)
    assert (links.count == 399).all() and len(links.found()) == 400
    rows = [(i, [1.0, 2.0], 1) for i in range(3000)]
    got = near_vectors(vectors_of(spark, rows)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(2999, 0)} and sum(r.kept for r in got) == 1


def test_cosines_at_the_threshold():
    a, b = np.array([1.0, 0.0]), np.array([0.9, math.sqrt(1 - 0.81)])
    raw = np.vstack([a, b])
    tree = Tree(raw, nested(units(raw), RADII), np.ones(2, np.int64), np.arange(2))
    assert bool(dual(tree, tree, 0.9).count.any()) == (cosine(a, b) >= 0.9)


# hard negatives


def brute_negatives(rows):
    held = sorted({(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * c) for c in v)) for i, v, label in rows})
    out = []
    for anchor, label, x in (row for row in held if row[0] % 100 == 0):
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, other) for i, other, y in held if i != anchor)
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(anchor, positive, rank + 1, s[1], -p, -s[0]) for rank, s in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("chunk", [3, 4096])
def test_hard_negatives_equal_brute_force(spark, chunk):
    points = np.vstack([clustered(s, 30, 20, 5, spread) for s, spread in enumerate((0.05, 0.5))])
    ids = [20 * i for i in range(len(points))]
    rows = [(i, p.tolist(), i // 20 % 3) for i, p in zip(ids, points, strict=True)]
    rows += rows[:7]  # repeated rows
    rows += [(1_000_000 + i, rows[i][1], rows[i][2]) for i in range(40)]  # ties
    more = odd_rows(5) + [(500, None, 1), (600, points[0].tolist(), None), (9100, [1.0], 1)]
    got = hard_negatives(vectors_of(spark, [(i, v, label) for i, v, label in rows] + more).repartition(5), chunk=chunk).collect()
    assert sorted(tuple(r) for r in got) == brute_negatives(rows)


def test_hard_negatives_of_little(spark):
    assert hard_negatives(vectors_of(spark, [])).count() == 0
    assert hard_negatives(vectors_of(spark, [(100, [1.0, 1.0], 1)])).count() == 0
    assert hard_negatives(vectors_of(spark, [(101, [1.0, 1.0], 1), (102, [1.0, 1.0], 2)])).count() == 0
    opposed = [(200, [1.0, 0.0], 1), (201, [-1.0, 0.0], 1), (202, [-0.9, 0.0], 2)]
    assert hard_negatives(vectors_of(spark, opposed)).count() == 0


def test_bounds_spare_candidates_of_near_anchors():
    """Near anchors share scores: only the root and what may matter is scored."""
    draw = np.random.default_rng(5)
    x = np.vstack([np.full(8, 3000) + draw.integers(-3, 4, (20, 8)), draw.integers(-3000, 3000, (2000, 8))])
    ids, labels = np.arange(len(x)), np.zeros(len(x), np.int64)
    search = Search(Anchors.spanned(ids[:20], labels[:20], x[:20]), None)
    search.add(ids, labels, x)
    assert search.scored < 0.1 * 20 * len(x)
    for k, anchor in enumerate(search.anchors.ids):
        score = x @ x[anchor]
        score[anchor] = score.min() - 1
        best = np.lexsort((ids, -score))[:5]
        assert search.best[k][0].ids.tolist() == best.tolist()


def test_products_stay_exact():
    huge = np.array([[1 << 52, 3], [1 << 30, 1]])
    assert products(huge[1:], huge[1]).tolist() == [(1 << 60) + 1]
    assert products(huge, huge[0]).tolist() == [1 << 62, 1 << 62]
