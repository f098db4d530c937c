"""Logistic models fitted together against separate fits and the conditions of an optimum."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake import config as C
from farelake.operators import linear
from farelake.operators import models as M

NUMERIC = ["x", "z", "flat"]
SPECS = [linear.Spec(f"{r}-{v}", r, v) for r in (0.0, 0.5, 1.0) for v in (0.001, 1.0, 30.0, 3000.0)]


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(11)
    rows = []
    for i in range(500):
        x, z = rng.gauss(3, 20), rng.gauss(0, 0.01)
        y = int(rng.random() < 1 / (1 + math.exp(-(x - 3) / 15 - 60 * z + 0.5)))
        rows.append((f"P{i}", x, z, 7.0, rng.choice(["a", "b", None]), y, i % 5))
    return spark.createDataFrame(rows, "unidad_id string, x double, z double, flat double, perfil string, etiqueta int, fold int").cache()


@pytest.fixture(scope="module")
def fits(training):
    return linear.fit(training.repartition(7), NUMERIC, SPECS, "etiqueta", "perfil", "fold", range(5))


def design(training, k):
    rows = [r for r in training.collect() if r.fold != k]
    x = np.array([[r.x, r.z, r.flat] for r in rows])
    std = x.std(axis=0, ddof=1)
    scaled = (x - x.mean(axis=0)) * np.where(std > 0, 1 / np.where(std > 0, std, 1), 0)
    hot = np.array([[r.perfil == "a", r.perfil == "b"] for r in rows], float)
    return np.concatenate([np.ones((len(rows), 1)), scaled, hot], axis=1), np.array([r.etiqueta for r in rows], float)


def test_every_model_is_at_its_optimum(training, fits):
    assert len(fits.models) == 5 * len(SPECS) and fits.features == [*NUMERIC, "perfil_a", "perfil_b"]
    for m in fits.models:
        x, y = design(training, m.fold)
        p = 1 / (1 + np.exp(-x @ m.scaled))
        slope, l1, l2 = x.T @ (p - y), m.spec.lam * m.spec.l1_ratio, m.spec.lam * (1 - m.spec.l1_ratio)
        assert m.rows == len(y) and abs(slope[0]) < 1e-3
        for w, g in zip(m.scaled[1:], slope[1:]):
            g += l2 * w
            assert abs(g + l1 * np.sign(w)) < 1e-3 if w else abs(g) <= l1 + 1e-3


def test_objective_is_not_above_that_of_single_fits(training, fits):
    for m in fits.models:
        if m.fold != 2 or m.spec.lam not in (1.0, 30.0):
            continue
        rows = training.filter("fold <> 2")
        single = M.logistic_pipeline(NUMERIC, m.spec.l1_ratio, m.spec.lam, rows.count()).fit(rows).stages[-1]
        x, y = design(training, 2)
        w = np.concatenate([[single.intercept], single.coefficients.toArray()[:5]])
        z = x @ w
        value = (np.logaddexp(0, z) - y * z).sum() + m.spec.lam * (
            m.spec.l1_ratio * np.abs(w[1:]).sum() + (1 - m.spec.l1_ratio) / 2 * (w[1:] ** 2).sum()
        )
        assert m.objective <= value + 1e-6 * abs(value)


def test_few_passes(fits):
    assert max(m.passes for m in fits.models) <= 14


def test_scores_of_all_models(training, fits):
    got = fits.scores(training, "fold", "unidad_id").cache()
    assert got.count() == 500 * len(fits.models) and got.filter("split = 'val'").count() == 500 * len(SPECS)
    by_id = {r.unidad_id: r for r in training.collect()}
    model = next(m for m in fits.models if m.fold == 1 and m.spec == SPECS[1])
    for r in got.filter((F.col("modelo") == SPECS[1].name) & (F.col("fold") == 1)).collect():
        t = by_id[r.unidad_id]
        z = model.plain @ [1, t.x, t.z, t.flat, t.perfil == "a", t.perfil == "b"]
        assert abs(r.puntaje - 1 / (1 + math.exp(-z))) < 1e-9 and r.split == ("val" if t.fold == 1 else "train")
    only = fits.scores(training, "fold", "unidad_id", val_only=True)
    assert only.count() == 500 * len(SPECS) and only.filter("split <> 'val'").count() == 0


def test_fit_on_all_rows_and_perfectly_separated_labels(training):
    split = training.withColumn("etiqueta", (F.col("x") > 3).cast("int"))
    model = linear.fit(split, ["x", "z"], [linear.Spec("m", 0.0, 0.01)], "etiqueta", "perfil").models[0]
    assert model.fold is None and model.rows == 500 and model.scaled[1] > 5 and np.isfinite(model.objective)


def test_one_class_and_null_features(training):
    ones = training.withColumn("etiqueta", F.lit(1))
    model = linear.fit(ones, ["x"], [linear.Spec("m", 0.5, 1.0)], "etiqueta", "perfil").models[0]
    assert np.isfinite(model.scaled).all() and model.scaled[0] > 5
    with pytest.raises(ValueError, match="null"):
        linear.fit(training.withColumn("x", F.when(F.col("fold") > 0, F.col("x"))), ["x"], SPECS[:1], "etiqueta", "perfil")


def test_sweep_runs_few_jobs(spark, training):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sweep", "sweep")
    linear.fit(training, NUMERIC, [linear.Spec(n, r, float(v)) for n, r in C.ModelGrid().penalties.items() for v in C.ModelGrid().lambdas],
               "etiqueta", "perfil", "fold", range(5))
    jobs = len(tracker.getJobIdsForGroup("sweep"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs < 30
