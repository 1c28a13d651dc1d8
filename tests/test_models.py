"""Classifiers: coefficients against a direct solve, train-only learning, scores by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.operators import models

COLUMNS = ("a", "b", "noise", "flat")


def table(spark, rows=600, classes=2):
    rng = np.random.default_rng(7)
    made = []
    for n in range(rows):
        kind = int(rng.integers(classes)) if classes > 2 else int(rng.random() < 0.3)
        a, b = rng.normal(kind, 1.0), rng.normal(-1.5 * kind, 2.0)
        split = "train" if n < rows * 0.6 else "validation" if n < rows * 0.8 else "test"
        made.append((n, split, "xyz"[kind], float(a) if n % 17 else None, float(b), float(rng.normal()), 1.0))
    made += [(rows, "train", None, 1e9, 1e9, 1e9, 1.0), (rows + 1, None, "x", 0.0, 0.0, 0.0, 1.0)]
    return spark.createDataFrame(made, "n int, split string, label string, a double, b double, noise double, flat double").repartition(3)


def solve(x, y, w, penalty):
    """Weighted logistic regression by Newton steps over [1, x]."""
    deviation = np.sqrt((w[:, None] * (x - np.average(x, axis=0, weights=w)) ** 2).sum(0) / (w.sum() - (w**2).sum() / w.sum()))
    ridge = np.diag([0.0, *(penalty * deviation**2)])
    design, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (w * (p - y)) / w.sum() + ridge @ beta
        beta -= np.linalg.solve(design.T @ (design * (w * p * (1 - p))[:, None]) / w.sum() + ridge, gradient)
    return beta


def test_weights_give_every_class_the_same_share(spark):
    got = models.class_weights(table(spark), "label").collect()
    assert {r["label"] for r in got} == {"x", "y"} and sum(r["rows"] for r in got) == 360
    assert [r["rows"] * r["weight"] for r in got] == pytest.approx([180, 180])


def test_coefficients_equal_a_direct_solve(spark):
    rows = table(spark)
    fitted = models.fit_candidate(rows, COLUMNS, "label", models.CANDIDATES[0])
    assert set(fitted.columns) == {"a", "b", "noise"} and fitted.classes == ("x", "y")
    train = [r for r in rows.where("split = 'train' AND label IS NOT NULL").collect()]
    x = np.array([[(fitted.parameters[c][0] if r[c] is None else r[c]) for c in fitted.columns] for r in train])
    x = (x - x.mean(0)) / x.std(0, ddof=1)
    y = np.array([r["label"] == "y" for r in train], dtype=float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta = solve(x, y, w, 0.08)
    model = fitted.models[0]
    assert [model.intercept, *model.coefficients.toArray()] == pytest.approx(list(beta), abs=2e-4)


def test_only_train_rows_teach_and_missing_values_are_predicted(spark):
    rows = table(spark)
    other = rows.withColumns({c: F.when(F.col("split") == "train", F.col(c)).otherwise(F.lit(None).cast("double")) for c in ("a", "b", "noise")})
    first, second = (models.fit_candidate(t, COLUMNS, "label", models.CANDIDATES[0]) for t in (rows, other))
    assert all(first.parameters[c] == pytest.approx(second.parameters[c]) for c in first.columns)
    assert first.models[0].coefficients.toArray() == pytest.approx(second.models[0].coefficients.toArray())
    done = first.predict(other)
    assert done.columns == [*rows.columns, "probabilities", "predicted", "confidence"]
    assert done.count() == 602 and done.where("predicted IS NULL OR isnan(confidence)").isEmpty()


def test_scores_by_hand(spark):
    fitted = models.Fitted("m", (), ("x", "y"), {}, ())
    rows = [("test", "x", [0.8, 0.2], "x"), ("test", "x", [0.4, 0.6], "y"), ("test", "y", [0.1, 0.9], "y"), ("test", "new", [1.0, 0.0], "x"), ("test", None, [1.0, 0.0], "x")]
    made = spark.createDataFrame(rows, "split string, label string, probabilities array<double>, predicted string")
    got = models.scores(made, fitted, "label").collect()
    loss = -(math.log(0.8) + math.log(0.4) + math.log(0.9) + math.log(1e-15)) / 4
    assert len(got) == 1 and got[0]["rows"] == 4
    assert [got[0][c] for c in ("accuracy", "base_accuracy", "log_loss", "balanced_accuracy")] == pytest.approx([0.5, 0.5, loss, 0.5])
    assert models.scores(made.limit(0), fitted, "label").isEmpty()


def test_candidates_beat_the_commonest_class_and_validation_chooses(spark):
    rows = table(spark, 1500, classes=3)
    report = models.compare_candidates(rows, COLUMNS, "label").collect()
    assert len(report) == 9 and {r["model"] for r in report if r["chosen"]} == {min((r for r in report if r["split"] == "validation"), key=lambda r: r["log_loss"])["model"]}
    assert all(r["accuracy"] > r["base_accuracy"] and r["log_loss"] < math.log(3) for r in report if r["split"] != "train")


def test_what_cannot_be_learned_is_refused(spark):
    rows = table(spark)
    with pytest.raises(ValueError, match="1 classes"):
        models.fit_candidate(rows.where("label = 'x'"), COLUMNS, "label", models.CANDIDATES[0])
    with pytest.raises(ValueError, match="0 classes"):
        models.fit_candidate(rows.limit(0), COLUMNS, "label", models.CANDIDATES[0])
    with pytest.raises(ValueError, match="no column"):
        models.fit_candidate(rows, ("flat",), "label", models.CANDIDATES[0])
