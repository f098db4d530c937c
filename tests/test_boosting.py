"""Boosting against a plain one that splits one leaf at a time."""

import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake import config as C
from farelake.operators import boosting, evaluate, forest, models

GRID = C.ModelGrid(gbt_rounds=23, gbt_min_leaf=12, gbt_leaves=7)
NUMERIC = ["x", "z", "flat"]


@pytest.fixture(scope="module")
def units(spark):
    rng, rows = random.Random(5), []
    for i in range(500):
        x, z = rng.gauss(0, 1), rng.choice([None, 1.0, 2.0])
        level = rng.choice(["a", "b", None])
        y = int(rng.random() < (0.9 if x > 0.3 or level == "b" else 0.1))
        rows.append((f"P{i}", x, z, 7.0, level, y if i else None, i % 5))
    schema = "unidad_id string, x double, z double, flat double, perfil string, etiqueta int, fold int"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


def plain(x, y, grid):
    """Raw scores after all rounds, every leaf searched by brute force."""
    rate = y.mean()
    raw = np.full(len(y), np.log(rate / (1 - rate)))
    for _ in range(grid.gbt_rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        worth = lambda m: g[m].sum() ** 2 / (h[m].sum() + grid.gbt_l2)  # noqa: E731,B023
        leaves = [np.ones(len(y), bool)]

        def best(m):
            out = (0, None)
            for f in range(x.shape[1]):
                for b in np.unique(x[m, f])[:-1]:
                    left, right = m & (x[:, f] <= b), m & (x[:, f] > b)
                    if min(left.sum(), right.sum()) >= grid.gbt_min_leaf:
                        gain = worth(left) + worth(right) - worth(m)  # noqa: B023
                        if gain > out[0] + 1e-9:
                            out = (gain, (left, right))
            return out

        options = [best(leaves[0])]
        while len(leaves) < grid.gbt_leaves and max(o[0] for o in options) > 1e-12:
            i = int(np.argmax([o[0] for o in options]))
            parts = options[i][1]
            leaves[i : i + 1], options[i : i + 1] = parts, [best(m) for m in parts]
        for m in leaves:
            raw[m] -= grid.gbt_step * g[m].sum() / (h[m].sum() + grid.gbt_l2)
    return raw


def test_against_one_leaf_at_a_time(units):
    fitted = boosting.fit(units, NUMERIC, "etiqueta", "unidad_id", "perfil", [-1, 2], GRID)
    rows = forest.points(units, fitted.bins, "etiqueta", "unidad_id").filter("y is not null").collect()
    got = {r.unidad_id: r.puntajes for r in fitted.scores(units).collect()}
    for k, fold in enumerate([-1, 2]):
        own = [r for r in rows if r.fold != fold]
        x = np.array([list(r.x) for r in own], np.uint8)
        raw = plain(x, np.array([r.y for r in own], float), GRID)
        assert np.allclose([got[r.id][k] for r in own], 1 / (1 + np.exp(-raw)), atol=1e-9)
    assert fitted.passes < 23 * 7 and all(len(t) == 23 for t in fitted.trees)
    assert max((t.feature >= 0).sum() for t in fitted.trees[0]) == 6


def test_cross_validation(units):
    scored = boosting.cross_validate(units, NUMERIC, "boosting", "etiqueta", "unidad_id", "perfil", grid=GRID).cache()
    assert scored.count() == 500 * 5 and scored.filter("split = 'val'").count() == 500
    val = scored.filter("split = 'val' and etiqueta is not null")
    assert evaluate.ranking_metrics(val, ["modelo"], "puntaje").first()["pr_auc"] > 0.85
    other = units.withColumn("etiqueta", F.when(F.col("fold") == 2, 1 - F.col("etiqueta")).otherwise(F.col("etiqueta")))
    moved = boosting.cross_validate(other, NUMERIC, "boosting", "etiqueta", "unidad_id", "perfil", grid=GRID)
    near = scored.filter("fold = 2").join(moved.filter("fold = 2").select("unidad_id", F.col("puntaje").alias("p")), "unidad_id")
    assert near.count() == 500 and near.filter("abs(puntaje - p) > 1e-9").isEmpty()


def test_no_units(units):
    none = units.filter("false")
    assert boosting.cross_validate(none, NUMERIC, "boosting", "etiqueta", "unidad_id", "perfil", grid=GRID).count() == 0


def test_importance_of_the_signal(units):
    found = models.boosting_importance(units.filter("etiqueta is not null"), NUMERIC, C.ModelGrid(gbt_rounds=10, gbt_min_leaf=12, gbt_leaves=7))
    by = {r.feature: r.importancia_media for r in found.collect()}
    assert set(by) == {*NUMERIC, "perfil"} and by["x"] == max(by.values()) > 0.1
    assert abs(by["flat"]) < 1e-12 and by["perfil"] > 0.02 > abs(by["z"])


def test_parts_meet_on_the_executors(units, monkeypatch):
    """The driver gets the best split of a node, not its sums by bin, and parts give the models of a single part."""
    whole = boosting.fit(units, NUMERIC, "etiqueta", "unidad_id", "perfil", [-1, 2], GRID)
    sizes, learn = [], boosting._Growing.learn

    def spy(self, found):
        sizes.append(len(pickle.dumps(found)) / len(self.wanted))
        learn(self, found)

    monkeypatch.setattr(boosting, "PART_ROWS", 90)
    monkeypatch.setattr(boosting._Growing, "learn", spy)
    fitted = boosting.fit(units.repartition(7), NUMERIC, "etiqueta", "unidad_id", "perfil", [-1, 2], GRID)
    assert max(sizes) < 2000 and fitted.passes == whole.passes
    for own, other in zip(fitted.trees, whole.trees):
        assert all((a.feature == b.feature).all() and np.allclose(a.value, b.value, atol=1e-9) for a, b in zip(own, other))


def test_importance_scores_all_folds_in_one_job(units, monkeypatch):
    """Copies are bytes of bins and are scored as columns of values were, without a job for each fold."""
    grid = C.ModelGrid(gbt_rounds=5, gbt_min_leaf=12, gbt_leaves=7, permutation_repeats=2)
    known = units.filter("etiqueta is not null")
    fitted = boosting.fit(known, NUMERIC, "etiqueta", "unidad_id", "perfil", range(C.FOLDS), grid)

    def by_fold(k):
        return lambda rows: fitted.scores(rows).withColumn("puntaje", F.col("puntajes")[k])

    expected = models.importances(known, NUMERIC, by_fold, 2).collect()
    monkeypatch.setattr(models, "run_all", None)
    found = models.boosting_importance(known, NUMERIC, grid).collect()
    assert [r.feature for r in found] == [r.feature for r in expected]
    assert np.allclose([r[1:] for r in found], [r[1:] for r in expected], atol=1e-12)


def test_a_model_of_few_rows_is_grown_in_one_job(units):
    """All rounds are made where the rows are, not by a job a pass."""
    sc = units.sparkSession.sparkContext
    sc.setJobGroup("whole", "whole")
    try:
        boosting.fit(units, NUMERIC, "etiqueta", "unidad_id", "perfil", range(C.FOLDS), GRID)
        assert len(sc.statusTracker().getJobIdsForGroup("whole")) < GRID.gbt_rounds
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_own_scores_are_those_of_the_fold_left_out(units):
    args = (NUMERIC, "boosting", "etiqueta", "unidad_id", "perfil")
    every = boosting.cross_validate(units, *args, grid=GRID).filter("split = 'val'")
    own = boosting.cross_validate(units, *args, grid=GRID, val_only=True)
    assert own.columns == every.columns and own.count() == 500
    both = own.join(every.withColumnRenamed("puntaje", "p"), ["modelo", "fold", "split", "unidad_id"])
    assert both.count() == 500 and both.filter("abs(puntaje - p) > 1e-12").isEmpty()
    assert boosting.cross_validate(units.filter("false"), *args, grid=GRID, val_only=True).isEmpty()


def test_leaves_by_bits_are_those_of_a_walk():
    rng = np.random.default_rng(3)
    x = np.asfortranarray(rng.integers(0, 256, (3000, 4), dtype=np.uint8))
    for leaves in (1, 2, 31, 64, 65, 90):
        feature, bin, left, right = [-1], [0], [0], [0]
        for _ in range(leaves - 1):
            node = rng.choice([i for i, f in enumerate(feature) if f < 0])
            feature[node], bin[node], left[node], right[node] = rng.integers(4), rng.integers(255), len(feature), len(feature) + 1
            for column, value in ((feature, -1), (bin, 0), (left, 0), (right, 0)):
                column += [value, value]
        tree = boosting.Tree(feature, bin, left, right, rng.normal(size=len(feature)))
        assert (tree.leaf(x) == tree._walked(x)).all() and (pickle.loads(pickle.dumps(tree))(x) == tree(x)).all()
        assert (tree.leaf(x[:0]) == tree._walked(x[:0])).all()
