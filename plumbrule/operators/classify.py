"""Fitting, scoring and judging a binary classifier on feature arrays.

A sigmoid head with binary cross-entropy is fitted pass by pass: each pass is one job over training and validation rows, which
returns the loss and accuracy of both with the weights so far, and the gradient of the training rows. Tasks multiply Arrow batches
with the weight vector and return sums; the driver holds one number per feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbrule.functions.columns import ColumnOrName, column
from plumbrule.operators.totals import total

PASSES = 2
MOMENTUM = 0.9
TRAIN, VALIDATION = "train", "val"
HISTORY = "pass int, subset string, row_count long, loss double, accuracy double"
MODEL = f"weights array<double>, intercept double, history array<struct<{HISTORY}>>"


@dataclass(frozen=True)
class BinaryModel:
    """Weights of a sigmoid head, and what each pass of its fit found: (pass, subset, rows, loss, accuracy)."""

    weights: tuple[float, ...]
    intercept: float
    history: tuple[tuple[int, str, int, float, float], ...] = ()


def rows_and_margins(values: pa.Array, weights: np.ndarray, intercept: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the usable arrays of a batch (as many numbers as there are weights, none missing), these as a matrix, their margins."""
    lengths = values.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == len(weights))
    x = values.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), len(weights))
    whole = np.isfinite(x).all(1)
    at, x = at[whole], x[whole]
    return at, x, x @ weights + intercept


def fit_binary(df: DataFrame, values: str, label: str, subset: str | None = None, passes: int = PASSES, momentum: float = MOMENTUM) -> BinaryModel:
    """A model fitted to the rows whose `subset` is `train` (all rows if there is no such column), validated on those that are `val`.

    Gradient steps with momentum from zero weights and the log odds of the training labels, so the loss before the first step is
    the entropy of their shares. The step is four over the mean squared length of the features, one for the intercept
    included, which bounds the curvature. Rows without label, with missing or non-finite features or of another length
    than most take no part. Without training rows of both classes the model is constant. Labels are 0 and 1.
    """
    of_subset = F.lit(TRAIN) if subset is None else column(subset)
    features = column(values).cast("array<double>")
    rows = df.select(features.alias("x"), column(label).cast("double").alias("y"), (of_subset == TRAIN).alias("fitted"), of_subset.alias("subset"))
    rows = rows.where(F.col("y").isNotNull() & F.col("x").isNotNull() & F.col("subset").isin(TRAIN, VALIDATION)).drop("subset")
    common = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    dims = common["length"] if common else 0

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        """Rows, labels and squared lengths of the training rows."""
        at, x, _ = rows_and_margins(batch.column(0), np.zeros(dims), 0.0)
        fitted = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)[at]
        y = batch.column(1).to_numpy()[at]
        return np.array([fitted.sum(), y[fitted].sum(), (x[fitted] ** 2).sum()])

    count, ones, squares = total(rows, moments, 3)
    share = ones / count if count else 0.5
    share = min(max(share, 1e-12), 1 - 1e-12)
    weights, intercept = np.zeros(dims), float(np.log(share / (1 - share)))
    step = 4 / (squares / count + 1) if 0 < ones < count else 0.0
    moved = np.zeros(dims + 1)
    history = []
    for number in range(passes + 1):
        shared = df.sparkSession.sparkContext.broadcast((weights, intercept))

        def losses_and_gradient(batch: pa.RecordBatch, shared=shared) -> np.ndarray:
            """Per subset rows, loss and right guesses, then the gradient of the training loss."""
            at, x, margin = rows_and_margins(batch.column(0), *shared.value)
            y = batch.column(1).to_numpy()[at]
            fitted = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)[at]
            loss = np.log1p(np.exp(-np.abs(margin))) + np.maximum(margin, 0) - y * margin
            right = (margin > 0) == (y == 1)
            counts = [number for chosen in (fitted, ~fitted) for number in (chosen.sum(), loss[chosen].sum(), right[chosen].sum())]
            apart = 1 / (1 + np.exp(-margin[fitted])) - y[fitted]
            return np.concatenate([counts, apart @ x[fitted], [apart.sum()]])

        sums = total(rows, losses_and_gradient, 7 + dims)
        for name, (n, loss, right) in zip((TRAIN, VALIDATION), (sums[:3], sums[3:6]), strict=True):
            if n:
                history.append((number, name, int(n), float(loss / n), float(right / n)))
        if number < passes and step:
            moved = momentum * moved - step * sums[6:] / count
            weights, intercept = weights + moved[:-1], intercept + float(moved[-1])
    return BinaryModel(tuple(weights.tolist()), intercept, tuple(history))


def loss_history(spark: SparkSession, model: BinaryModel) -> DataFrame:
    """Loss and accuracy of both subsets before the first pass and after each: pass, subset, row_count, loss, accuracy."""
    return spark.createDataFrame(list(model.history), HISTORY)


def rounded_class(probability: ColumnOrName) -> Column:
    """Class of a probability: rounded, an exact half to the even class 0."""
    return F.bround(column(probability)).cast("int")


def score_batch(df: DataFrame, model: BinaryModel, values: str) -> DataFrame:
    """`df` with the `probability` of class 1 and the `prediction` it rounds to.

    Arrow batches are multiplied with the weight vector. Arrays that are NULL, of another length than the weights or with missing or
    non-finite numbers have neither.
    """
    shared = df.sparkSession.sparkContext.broadcast((np.array(model.weights), model.intercept))
    place = df.columns.index(values)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, _, margin = rows_and_margins(batch.column(place), *shared.value)
            probability = np.full(batch.num_rows, np.nan)
            probability[at] = 1 / (1 + np.exp(-margin))
            known = pa.array(probability, mask=np.isnan(probability))
            guess = pa.array((probability > 0.5).astype(np.int32), mask=np.isnan(probability))
            yield pa.RecordBatch.from_arrays([*batch.columns, known, guess], names=[*batch.schema.names, "probability", "prediction"])

    added = [T.StructField("probability", T.DoubleType()), T.StructField("prediction", T.IntegerType())]
    return df.mapInArrow(scored, T.StructType([*df.schema.fields, *added]))


def binary_metrics(scored: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Accuracy, precision and recall over all rows, with the counts behind them; 0 where undefined."""
    truth, guess = column(label) == 1, rounded_class(probability) == 1
    counts = scored.agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
    )


def save_model(spark: SparkSession, model: BinaryModel, path: str) -> None:
    """Write the model, replacing an older one. Keep `path` apart from the data."""
    row = (list(model.weights), model.intercept, list(model.history))
    spark.createDataFrame([row], MODEL).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> BinaryModel:
    """A model saved by `save_model`."""
    row = spark.read.schema(MODEL).parquet(path).first()
    return BinaryModel(tuple(row["weights"]), row["intercept"], tuple(tuple(entry) for entry in row["history"]))
