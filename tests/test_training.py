"""The training entry point: everything is chosen before the only look at the test cut."""

import random
from datetime import date, datetime

import lake_fixture as fx
import pytest
from pyspark.sql import functions as F

from farelake import config as C
from farelake.operators import models
from farelake.plans import cut_features as CF
from farelake.plans import lakehouse, training

GRID = C.ModelGrid(lambdas=(0.1, 10.0), penalties={"L2": 0.0}, gbt_rounds=2, gbt_min_leaf=10, rf_trees=3, rf_depth=3)


def frame(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        x, z = rng.gauss(0, 1), rng.gauss(0, 1)
        y = int(rng.random() < 1 / (1 + 2.718 ** -(2 * x - 1)))
        rows.append((f"P{i}", x, z, rng.choice(["a", "b"]), y, abs(z), rng.randint(3, 30)))
    kind = "unidad_id string, x double, z double, perfil string, etiqueta int, dias_desde_ultimo_viaje double, viajes_28d long"
    return spark.createDataFrame(rows, kind)


def test_training_run(spark, tmp_path):
    train, test, out = frame(spark, 1), frame(spark, 2), str(tmp_path / "run")
    got = training.train_on(train, test, ["x", "z"], out, "v1", C.CutWindows(), GRID)
    names = ["logistica L2", "boosting", "bosque", *training.BASELINES]
    assert got.out_of_fold.columns == ["unidad_id", "fold", "etiqueta", *names] and got.out_of_fold.count() == 300
    assert {r.modelo for r in got.comparison.collect()} == set(names)
    assert got.out_of_fold.filter(F.col(got.model).isNull()).count() == 0
    # the threshold is that of largest gain on the out-of-fold scores
    scores = [(r[got.model], r.etiqueta) for r in got.out_of_fold.collect()]
    costs = C.CostScenario()
    gain = lambda u: sum(costs.gain_tp if y else costs.gain_fp for p, y in scores if p >= u)
    grid = [i / 1000 for i in range(10, 991, 5)]
    assert gain(got.threshold) == max(map(gain, grid)) and got.threshold == min(u for u in grid if gain(u) == gain(got.threshold))
    assert got.test.filter("modelo = 'modelo'").first().umbral == got.threshold
    _, meta = models.load_package(spark, got.package)
    assert (meta.version, meta.tipo, meta.umbral) == ("v1", got.model, got.threshold)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        training.train_on(train, test, ["x", "z"], out, "v2", C.CutWindows(), GRID)


def test_prediction_from_raw_files(spark, tmp_path):
    raw = str(tmp_path / "raw")
    fx.write(raw)
    lake = lakehouse.Lake(spark, str(tmp_path / "lake"))
    w, numeric = C.CutWindows(), CF.feature_columns(C.CutWindows(), C.OPERATOR_CODES)
    lakehouse.full_load(lake, raw, fx.SETTINGS, datetime(2026, 9, 1), date(2026, 9, 1), cuts={"A": C.CUTS["A"]})
    feats = lake.read("feat_cortes")
    model = models.logistic_pipeline(numeric, 0.0, 1.0, feats.count()).fit(feats)
    models.save_package(model, str(tmp_path / "model"), "v1", "logistica", 0.3, "corte A", numeric)
    fresh = lakehouse.Lake(spark, str(tmp_path / "fresh"))
    got = training.predict_from_raw(
        fresh, raw, fx.SETTINGS, datetime(2026, 9, 1), date(2026, 9, 1), str(tmp_path / "model"), C.CUTS["A"], str(tmp_path / "out"), w
    )
    assert got.columns == ["unidad_id", "tarjetas", "puntaje", "contactar"] and got.count() == feats.count()
