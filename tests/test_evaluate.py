"""Evaluation operators against direct Python formulas, ties included."""

import random

import pytest
from pyspark.sql import functions as F

from farelake import config as C
from farelake.operators import evaluate as E
from farelake.operators import models as M


def average_precision(pairs):
    """Step sum over distinct scores, highest first."""
    total = sum(y for y, _ in pairs)
    tp = n = 0
    ap = 0.0
    for s in sorted({p for _, p in pairs}, reverse=True):
        here = [y for y, p in pairs if p == s]
        tp, n = tp + sum(here), n + len(here)
        ap += sum(here) / total * tp / n
    return ap


def roc_auc(pairs):
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    data = [
        (g, i, int(rng.random() < 0.3), round(rng.random(), 1 if g == "ties" else 4))
        for g in ("ties", "fine")
        for i in range(150)
    ]
    return data, spark.createDataFrame(data, "g string, unidad_id long, etiqueta int, puntaje double")


def test_ranking_metrics(scored):
    data, df = scored
    got = {r.g: r for r in E.ranking_metrics(df, ["g"], "puntaje").collect()}
    for g in ("ties", "fine"):
        pairs = [(y, p) for gg, _, y, p in data if gg == g]
        assert abs(got[g].pr_auc - average_precision(pairs)) < 1e-12
        assert abs(got[g].roc_auc - roc_auc(pairs)) < 1e-12


def test_known_value_is_the_step_sum(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "etiqueta int, p double")
    assert abs(E.ranking_metrics(df, [], "p").first().pr_auc - 0.8333333333) < 1e-9


def test_threshold_curve_and_choices(scored):
    data, df = scored
    pairs = [(y, p) for g, _, y, p in data if g == "fine"]
    curve = E.threshold_curve(df.filter("g = 'fine'"), "puntaje").orderBy("umbral").collect()
    assert len(curve) == 197 and (curve[0].umbral, curve[-1].umbral) == (0.01, 0.99)
    for r in curve:
        vp = sum(y for y, p in pairs if p >= r.umbral)
        fp = sum(1 - y for y, p in pairs if p >= r.umbral)
        assert (r.vp, r.fp, r.fn) == (vp, fp, sum(y for y, _ in pairs) - vp)
        assert r.ganancia_q == 10 * vp - 5 * fp
    best = max(curve, key=lambda r: (r.ganancia_q, -r.umbral))
    choices = {r.regla: r for r in E.threshold_choices(df.filter("g = 'fine'"), "puntaje").collect()}
    assert choices["elegido"].umbral == best.umbral
    assert abs(choices["teorico"].umbral - 1 / 3) < 1e-12
    assert choices["todos"].contactados == 150


def test_scores_on_a_threshold_count_as_reached(spark):
    exact = [(1, k / 1000) for k in range(10, 991, 5)]
    df = spark.createDataFrame(exact, "etiqueta int, p double")
    for r in E.threshold_curve(df, "p").collect():
        assert r.vp == sum(1 for _, p in exact if p >= r.umbral)


def test_folds_are_balanced_and_stable(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("P"), "id").alias("unidad_id"), (F.col("id") % 7 == 0).cast("int").alias("etiqueta")
    )
    folds = E.stratified_folds(df)
    sizes = {(r.etiqueta, r.fold): r["count"] for r in folds.groupBy("etiqueta", "fold").count().collect()}
    assert len(sizes) == 10
    for label in (0, 1):
        n = [sizes[label, k] for k in range(5)]
        assert max(n) - min(n) <= 1
    again = {r.unidad_id: r.fold for r in E.stratified_folds(df.repartition(7)).collect()}
    assert again == {r.unidad_id: r.fold for r in folds.collect()}
    assert E.attach_folds(df, folds).count() == 1000
    with pytest.raises(Exception, match="no fold for unit"):
        E.attach_folds(df, folds.filter("unidad_id <> 'P3'")).select("fold").collect()


def test_grouped_medians(spark):
    rng = random.Random(4)
    data = [("hot", float(rng.randint(0, 9)), rng.random()) for _ in range(501)]
    data += [("even", float(i), None if i == 0 else float(i)) for i in range(4)]
    df = spark.createDataFrame(data, "g string, a double, b double")
    got = {r.g: r for r in E.grouped_medians(df, ["g"], ["a", "b"]).collect()}
    want = {r.g: r for r in df.groupBy("g").agg(F.median("a").alias("a"), F.median("b").alias("b")).collect()}
    for g in want:
        assert (got[g].a, got[g].b) == (want[g].a, want[g].b)


def test_summary_over_folds(spark):
    data = [("m", k, s, v, v) for k, v in enumerate([0.1, 0.2, 0.4]) for s in ("train", "val")]
    df = spark.createDataFrame(data, "modelo string, fold int, split string, pr_auc double, roc_auc double")
    r = E.fold_summary(df).first()
    assert abs(r.pr_auc_val_media - 0.7 / 3) < 1e-12 and abs(r.pr_auc_val_std - 0.15275252316519464) < 1e-12
    assert r.brecha_train_val == 0


# ---- models ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        x, z = rng.gauss(0, 1), rng.gauss(0, 1)
        y = int(rng.random() < 1 / (1 + 2.718 ** -(2 * x - 1)))
        rows.append((f"P{i}", x, z, rng.choice(["a", "b"]), y, i % 5))
    return spark.createDataFrame(
        rows, "unidad_id string, x double, z double, perfil string, etiqueta int, fold int"
    ).cache()


def test_cross_validation_and_oof(training):
    scored = M.cross_validate(training, "lr", lambda n: M.logistic_pipeline(["x", "z"], 0.0, 1.0, n))
    assert scored.filter("split = 'val'").count() == 400
    oof = M.out_of_fold(scored, ["lr"])
    assert oof.columns == ["unidad_id", "fold", "etiqueta", "lr"] and oof.count() == 400
    m = E.fold_summary(E.ranking_metrics(scored, ["modelo", "fold", "split"], "puntaje")).first()
    assert m.roc_auc_val_media > 0.75


def test_lambda_curve_scores_like_the_models(training):
    grid = C.ModelGrid(lambdas=(1.0,), penalties={"L2": 0.0})
    curve = M.lambda_curve(training, ["x", "z"], grid).first()
    scored = M.cross_validate(training, "lr", lambda n: M.logistic_pipeline(["x", "z"], 0.0, 1.0, n))
    direct = E.fold_summary(E.ranking_metrics(scored, ["modelo", "fold", "split"], "puntaje")).first()
    assert abs(curve.pr_auc_media - direct.pr_auc_val_media) < 1e-6
    assert M.best_lambda(M.lambda_curve(training, ["x", "z"], grid)).first()["lambda"] == 1.0


def test_permutation_finds_the_signal(training):
    imp = M.permutation_importance(
        training, ["x", "z"], lambda n: M.logistic_pipeline(["x", "z"], 0.0, 1.0, n), repeats=2
    )
    got = {r.feature: r.importancia_media for r in imp.collect()}
    assert set(got) == {"x", "z", "perfil"} and got["x"] > 0.1 > abs(got["z"])


def test_permuted_copies_shuffle_one_column(training):
    copies = M.permuted_copies(training, ["x", "z"], 1).cache()
    assert copies.count() == 3 * 400
    x = copies.filter("feature = 'x'").join(training.select("unidad_id", F.col("x").alias("x0"), F.col("z").alias("z0")), "unidad_id")
    assert x.filter("z <> z0").count() == 0 and x.filter("x <> x0").count() > 350
    assert abs(x.agg(F.sum("x") - F.sum("x0")).first()[0]) < 1e-9  # a permutation, nothing lost


def test_unknown_profile_scores_as_all_zeros(training):
    model = M.logistic_pipeline(["x", "z"], 0.0, 1.0, 400).fit(training)
    new = training.limit(1).withColumn("perfil", F.lit("never seen"))
    hot = model.transform(new).select("_hot").first()[0]
    assert hot.numNonzeros() == 0
    table = M.coefficient_table(model, ["x", "z"], training.sparkSession).collect()
    assert table[0].feature == "x" and {r.feature for r in table} == {"x", "z", "perfil_a", "perfil_b"}


def test_segments(training):
    points = M.scaled(training, ["x", "z"]).cache()
    sweep = M.kmeans_sweep(points, C.ModelGrid(kmeans_k=(2, 3), kmeans_restarts=2)).collect()
    assert [r.k for r in sweep] == [2, 3] and sweep[0].inercia > sweep[1].inercia
    out, share = M.with_components(M.with_segments(points, 2, 2))
    assert abs(sum(share) - 1) < 1e-9 and {"pc1", "pc2", "segmento"} <= set(out.columns)
    profile = E.segment_profile(out, "segmento", ["x", "z"])
    assert profile.agg(F.sum("tamano")).first()[0] == 400


def test_trees_fit(training):
    grid = C.ModelGrid(gbt_rounds=3, gbt_min_leaf=10, rf_trees=5, rf_depth=4)
    for clf in (M.boosting(grid), M.forest(grid)):
        model = M.tree_pipeline(["x", "z"], clf).fit(training)
        assert E.ranking_metrics(M.score(model, training), [], "puntaje").first().roc_auc > 0.7


def test_models_score_after_the_session_ran_an_observation(training):
    from pyspark.sql import Observation

    training.observe(Observation("rows"), F.count(F.lit(1)).alias("n")).count()
    for make in (M.logistic_pipeline(["x", "z"], 0.0, 1.0, 400), M.tree_pipeline(["x", "z"], M.forest(C.ModelGrid(rf_trees=2, rf_depth=2)))):
        assert M.score(make.fit(training), training).filter("puntaje is null").count() == 0
    assert M.with_segments(M.scaled(training, ["x", "z"]), 2, 1).count() == 400


def test_final_test_has_baselines(training):
    df = training.withColumn("dias_desde_ultimo_viaje", F.col("x"))
    model, result = M.final_test(df, df, M.logistic_pipeline(["x", "z"], 0.0, 1.0, 400), 1 / 3, C.CutWindows())
    got = {r.modelo: r for r in result.collect()}
    assert set(got) == {"modelo", "tasa", "dias_desde_ultimo_viaje"}
    m = got["modelo"]
    assert m.vp + m.fp + m.fn + m.vn == 400 and abs(got["tasa"].roc_auc - 0.5) < 1e-12


def test_a_null_group_is_a_group(spark):
    rows = [(g, i % 2, i / 10) for g in ("m", None) for i in range(8)]
    df = spark.createDataFrame(rows, "modelo string, etiqueta int, puntaje double")
    got = {r.modelo: r for r in E.ranking_metrics(df, ["modelo"], "puntaje").collect()}
    assert set(got) == {"m", None} and got[None].pr_auc == got["m"].pr_auc and got[None].n == 8
    profile = {r.modelo: r for r in E.segment_profile(df, "modelo", ["puntaje"]).collect()}
    assert profile[None].puntaje == profile["m"].puntaje == 0.35
