"""Fitting, scoring, saving and judging a binary classifier."""

from __future__ import annotations

import math

import numpy as np
import pytest

from plumbrule.operators import classify

ROWS = "id long, v array<double>, label int, subset string, probability_of string"


def separable(spark, count=600):
    draw = np.random.default_rng(0)
    rows = []
    for i in range(count):
        label = int(draw.random() < 0.3)
        v = (draw.standard_normal(5) + 1.5 * label).tolist()
        rows.append((i, v, label, ("train", "train", "val", "test")[i % 4], "x"))
    odd = [(None, "train", 1), ([1.0], "train", 0), ([math.nan] * 5, "train", 1), ([None] * 5, "val", 0)]
    rows += [(count + i, v, label, subset, "x") for i, (v, subset, label) in enumerate(odd)] + [(None, [0.0] * 5, None, "train", "x"), (1, [9.0] * 5, 0, None, "x")]
    return spark.createDataFrame(rows, ROWS).repartition(3)


def test_fit_learns_and_reports_every_pass(spark):
    rows = separable(spark)
    model = classify.fit_binary(rows, "v", "label", "subset", passes=40)
    history = {(p, subset): (n, loss, accuracy) for p, subset, n, loss, accuracy in model.history}
    assert len(history) == 2 * 41 and history[0, "train"][0] == 300 and history[0, "val"][0] == 150
    share = rows.where("subset = 'train' AND size(v) = 5 AND NOT isnan(v[0]) AND label IS NOT NULL").agg({"label": "avg"}).first()[0]
    assert history[0, "train"][1] == pytest.approx(-share * math.log(share) - (1 - share) * math.log(1 - share), abs=1e-12)
    assert history[40, "train"][1] < 0.4 * history[0, "train"][1] and history[40, "val"][2] > 0.9
    scored = classify.score_batch(rows.where("subset = 'test'"), model, "v")
    assert classify.binary_metrics(scored).first()["accuracy"] > 0.9


def test_scores_of_odd_arrays_are_null(spark):
    model = classify.BinaryModel((1.0, -1.0), 0.0)
    values = [[2.0, 1.0], [1.0, 1.0], None, [], [1.0], [None, 1.0], [math.inf, 1.0]]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v array<double>")
    got = [(row["probability"], row["prediction"]) for row in classify.score_batch(frame, model, "v").orderBy("id").collect()]
    assert got[0] == (pytest.approx(1 / (1 + math.exp(-1))), 1) and got[1] == (0.5, 0) and got[2:] == [(None, None)] * 5
    assert classify.score_batch(frame.limit(0), model, "v").columns == ["id", "v", "probability", "prediction"]


def test_fit_without_two_classes(spark):
    rows = separable(spark)
    for only in ("label = 1", "FALSE"):
        model = classify.fit_binary(rows.where(only), "v", "label", "subset")
        assert set(model.weights) <= {0.0}


def test_model_survives_saving(spark, tmp_path):
    model = classify.fit_binary(separable(spark), "v", "label", "subset")
    for _ in range(2):
        classify.save_model(spark, model, str(tmp_path / "model"))
    assert classify.load_model(spark, str(tmp_path / "model")) == model
    assert classify.loss_history(spark, model).count() == 6


def test_metrics(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.7), (0, 0.1)]
    frame = spark.createDataFrame(rows, "label int, probability double")
    metrics = classify.binary_metrics(frame).first()
    assert (metrics["tp"], metrics["fp"], metrics["fn"], metrics["tn"]) == (1, 1, 1, 1)
    assert (metrics["accuracy"], metrics["precision"], metrics["recall"]) == (0.5, 0.5, 0.5)
    nothing = classify.binary_metrics(frame.limit(0)).first()
    assert (nothing["accuracy"], nothing["precision"], nothing["recall"]) == (0.0, 0.0, 0.0)
