"""Whitening of embeddings on their leading principal components, found by Jacobi-Davidson.

The covariance is never formed. What the iteration knows of it are products with a few columns, each one distributed pass over
the fit list: rows are centred first, multiplied with the columns, and summed per task; the sums of the tasks are added in `FAN`
groups before the driver adds those. The driver holds matrices of dims x `WIDTH` at most, whatever the number of rows.

Outer loop: Rayleigh-Ritz on the search space; leading pairs whose residuals have reached rounding size are locked and projected
out from then on. Inner loop: for each open pair, `INNER` steps of MINRES on the correction equation
(I - QQ')(V - theta I)(I - QQ') t = -r, Q the locked vectors and the pair's own; the pairs step together, so a step is one pass.
The corrections extend the search space, which is cut back to its best vectors beyond `WIDTH`.

Entries become integers first, so sums and `deviation` are exact, and a row minus the mean is right to its last digit.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrule.llm.common import stage
from plumbrule.llm.vectors import finite, matrix, of_common_length

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
GUARD = 8  # further vectors of the first search space
INNER = 4  # steps of MINRES for a correction
WIDTH = 96  # columns of the search space at most
KEPT = 24  # of these after cutting back
ROUNDS = 400
STALLED = 6  # rounds without a smaller residual after which rounding is taken to be reached
FAN = 64
LARGEST = float(1 << 52)  # scaled entries are clipped here
INT64 = 1 << 62
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class FitList:
    """The rows that the covariance is over, and sums over them, one distributed pass each."""

    def __init__(self, rows: DataFrame, dims: int):
        self.rows, self.dims = rows, dims
        self.parts = rows.rdd.getNumPartitions()
        self.n, *sums = self.total(counted)
        self.sums = np.array(sums, object)
        # A row minus the mean, S/n = quotient + remainder / n, without rounding before the last step.
        self.quotient = np.array([int(s) // int(self.n) for s in sums], np.int64)
        self.remainder = np.array([int(s) % int(self.n) / int(self.n) for s in sums])

    def total(self, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of part(matrix of some rows) over all rows."""
        dims = self.dims

        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for batch in batches:
                if batch.num_rows:
                    more = part(matrix(batch, "x", dims))
                    found = more if found is None else found + more
            if found is not None:
                task = pa.array([TaskContext.get().partitionId()], pa.int32())
                yield pa.RecordBatch.from_arrays([task, pa.array([pickle.dumps(found)], pa.binary())], ["task", "sums"])

        def added(tasks: pd.DataFrame) -> pd.DataFrame:
            ordered = tasks.sort_values("task")
            return pd.DataFrame({"task": ordered["task"][:1], "sums": [pickle.dumps(sum(map(pickle.loads, ordered["sums"])))]})

        found = self.rows.select("x").mapInArrow(of_task, "task int, sums binary")
        if self.parts > FAN:
            found = found.groupBy(F.col("task") % FAN).applyInPandas(added, "task int, sums binary")
        return sum(pickle.loads(row["sums"]) for row in sorted(found.collect(), key=lambda row: row["task"]))

    def centring(self) -> Callable[[np.ndarray], np.ndarray]:
        quotient, remainder = self.quotient, self.remainder
        return lambda x: (x - quotient) - remainder

    def product(self, columns: np.ndarray) -> np.ndarray:
        """Covariance times `columns`."""
        centred = self.centring()

        def part(x: np.ndarray) -> np.ndarray:
            z = centred(x)
            return z.T @ (z @ columns)

        return self.total(part) / self.n

    def deviations(self) -> Callable[[np.ndarray], np.ndarray]:
        """Per row the exact sum of (n x - S)^2, as integers of any size."""
        n, sums = int(self.n), self.sums
        least, most = min(sums, default=0), max(sums, default=0)

        def per_row(x: np.ndarray) -> np.ndarray:
            bound = n * int(np.abs(x).max(initial=0)) + max(abs(least), abs(most))
            kind = np.int64 if bound < INT64 and x.shape[1] * bound * bound < INT64 else object
            apart = x.astype(kind) * n - sums.astype(kind)
            if kind is object:
                # The bound above is of sums before they cancel; what is left is mostly small.
                far = max(abs(int(apart.max())), abs(int(apart.min())))
                if x.shape[1] * far * far < INT64:
                    apart = apart.astype(np.int64)
            return (apart * apart).sum(1)

        return per_row

    def trace(self) -> float:
        """Trace of the covariance, from exact integers."""
        per_row = self.deviations()
        found = self.total(lambda x: np.array([sum(per_row(x).tolist())], object))[0]
        return int(found) / int(self.n) ** 3


def counted(x: np.ndarray) -> np.ndarray:
    """Number of rows and the sum of each column, as integers of any size."""
    safe = len(x) * int(np.abs(x).max(initial=0)) < INT64
    return np.array([len(x), *(x if safe else x.astype(object)).sum(0).tolist()], object)


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of a symmetric system per column of `right`; the columns share each product."""

    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(np.broadcast_shapes(a.shape, b.shape)), where=np.abs(b) > 0)

    x = before = turn = turn_before = np.zeros_like(right)
    size = np.linalg.norm(right, axis=0)
    v, left = over(right, size), size
    cos = cos_before = np.ones_like(size)
    sin = sin_before = link = np.zeros_like(size)
    for _ in range(steps):
        image = apply(v)
        diagonal = (v * image).sum(0)
        following = image - diagonal * v - link * before
        further = np.linalg.norm(following, axis=0)
        rotated = cos * diagonal - cos_before * sin * link
        length = np.hypot(rotated, further)
        first, second = sin * diagonal + cos_before * cos * link, sin_before * link
        turn_before, turn = turn, over(v - second * turn_before - first * turn, length)
        cos_before, sin_before = cos, sin
        cos, sin = over(rotated, length), over(further, length)
        x = x + cos * left * turn
        left = -sin * left
        before, v, link = v, over(following, further), further
    return x


def orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """`columns` made orthonormal and orthogonal to `against`; what depends on the others is left out."""
    kept = against
    for column in columns.T:
        size = np.linalg.norm(column)
        if size == 0 or kept.shape[1] == len(column):
            continue
        column = column / size
        for _ in range(3):
            column = column - kept @ (kept.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            kept = np.column_stack([kept, column])
    return kept[:, against.shape[1] :]


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, inner: int = INNER, width: int = WIDTH, kept: int = KEPT
) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` greatest eigenvalues, falling, and unit eigenvectors (columns) of the symmetric matrix behind `product`.

    A pair is locked once its residual is below 32 * sqrt(dims) roundings of the greatest eigenvalue. If rounding in the products keeps
    the residuals above that for `STALLED` rounds although the search space is renewed, what has been reached is taken.
    """
    wanted = min(wanted, dims)
    draw = np.random.default_rng(0)
    locked, values = np.zeros((dims, 0)), []
    space = orthonormal(draw.standard_normal((dims, min(dims, wanted + GUARD))), locked)
    images = product(space)
    least, stalled = np.inf, 0
    for _ in range(ROUNDS):
        small = space.T @ images
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        turn = turn[:, ::-1]
        theta, space, images = theta[::-1], space @ turn, images @ turn
        residual = images - space * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        bound = 32 * np.sqrt(dims) * np.finfo(float).eps * max([*values, abs(theta[0])])
        open_pairs = wanted - len(values)
        worst = size[:open_pairs].max()
        stalled = 0 if worst < 0.5 * least else stalled + 1
        least = min(least, worst)
        done = open_pairs if stalled > STALLED and least < 1e-9 * max([*values, theta[0]]) else 0
        while done < open_pairs and size[done] <= bound:
            done += 1
        locked, values = np.column_stack([locked, space[:, :done]]), [*values, *theta[:done]]
        if len(values) == wanted:
            break
        if done:
            least, stalled = np.inf, 0
        theta, space, images, residual, size = theta[done:], space[:, done:], images[:, done:], residual[:, done:], size[done:]
        if space.shape[1] > width:
            space, images = space[:, :kept], images[:, :kept]
        at = np.flatnonzero(size[: wanted - len(values)] > bound)
        pairs, shifts = space[:, at], theta[at]

        def projected(t: np.ndarray, pairs: np.ndarray = pairs, locked: np.ndarray = locked) -> np.ndarray:
            t = t - locked @ (locked.T @ t)
            return t - pairs * (pairs * t).sum(0)

        def corrected(t: np.ndarray, shifts: np.ndarray = shifts) -> np.ndarray:
            t = projected(t)
            return projected(product(t) - t * shifts)

        more = minres(corrected, -projected(residual[:, at]), inner) if space.shape[1] + locked.shape[1] < dims else residual[:, :0]
        more = orthonormal(more, np.column_stack([locked, space]))
        if more.shape[1]:
            space, images = np.column_stack([space, more]), np.column_stack([images, product(more)])
        else:
            space = orthonormal(space, locked)
            images = product(space)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order]


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): usable rows with entries as integers."""
    v = F.col("embedding").cast("array<double>")
    scaled = F.transform(v, lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(c * SCALE).cast("double"))).cast("long") + SHIFT)
    return vectors.filter(finite(v)).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x"))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    `vectors` needs vec_id and embedding; further columns are ignored. Rows whose vector is NULL, empty or holds NULL or non-finite
    entries take no part, nor do those of another length than the most frequent one. Repeated rows and NULL ids count
    as rows of their own. With fewer dimensions than `components` there are as many components as dimensions. Components without
    variance (all rows equal in it, up to rounding) have `whitened` 0 and, without any variance at all, `explained` 0; `identity_error`
    is that of the components with variance. `deviation` is NULL beyond the range of a long. Scaled entries beyond 2^52 count as 2^52.
    """
    spark = vectors.sparkSession
    rows, dims = of_common_length(stage(integer_vectors(vectors), "integers"), "x")
    if not dims:
        return spark.createDataFrame([], OUT)
    fit = FitList(rows, dims)
    values, axes = jacobi_davidson(fit.product, dims, components)
    signs = np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    axes = axes * signs
    trace = fit.trace()
    varied = values > dims * np.finfo(float).eps * max(trace, np.finfo(float).tiny)
    scales = np.zeros_like(values)
    scales[varied] = 1 / np.sqrt(values[varied])
    centred, per_row, n = fit.centring(), fit.deviations(), int(fit.n)
    turn = axes * scales

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ turn
        return np.vstack([w.T @ w, w.sum(0)])

    found = fit.total(moments) / n
    mean = found[-1]
    apart = np.abs(found[:-1] - np.outer(mean, mean) - np.eye(len(values)))[np.ix_(varied, varied)]
    error = float(apart.max(initial=0.0))
    explained = [float(e) / trace if trace else 0.0 for e in values]

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, "x", dims)
                w = centred(x) @ turn
                m, k = w.shape
                far = [d if d < 1 << 63 else None for d in per_row(x).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        pa.array(far, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(w.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(written, OUT)
