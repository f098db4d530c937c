"""Model and streaming operators on the benchmark tables.

Fits use the labelled orders cut. All penalties, λ, clusterings, trees and rounds are those of
:class:`farelake.config.ModelGrid`.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from farelake import config as C
from farelake.operators import boosting, cdc, evaluate, forest, linear, models
from farelake.operators.quality import Rule
from farelake.plans import cut_features as CF
from farelake.plans import tables as Q
from farelake.session import materialise, run_dir
from farelake.streaming import jobs, updates

NUMERIC = CF.feature_columns(Q.WINDOWS, Q.STATUSES)
GRID = C.ModelGrid()


def _training(spark, sf):
    feats = materialise(Q.cut_features(spark, sf, {"A": Q.CUTS["A"]}))
    return materialise(evaluate.attach_folds(feats, evaluate.stratified_folds(feats)))


def _points(spark, sf):
    return models.scaled(materialise(Q.cut_features(spark, sf, {"A": Q.CUTS["A"]})), NUMERIC)


def _l2(n):
    return models.logistic_pipeline(NUMERIC, 0.0, 100.0, n, GRID)


L2 = linear.Spec("logistica_l2", 0.0, 100.0)


def lr_cv(spark, sf):
    scored = models.cross_validate_logistic(_training(spark, sf), NUMERIC, [L2])
    return evaluate.fold_summary(evaluate.ranking_metrics(scored, ["modelo", "fold", "split"], "puntaje"))


def lr_lambda_curve(spark, sf):
    return models.lambda_curve(_training(spark, sf), NUMERIC, GRID)


def lr_coefficients(spark, sf):
    feats = _training(spark, sf)
    return models.coefficient_table(_l2(feats.count()).fit(feats), NUMERIC, spark)


def gbt_oof(spark, sf):
    """300 rounds a fold, at most 31 leaves a tree."""
    scored = boosting.cross_validate(
        _training(spark, sf), NUMERIC, "boosting", models.LABEL, models.UNIT, models.PROFILE, val_only=True
    )
    return models.out_of_fold(scored, ["boosting"])


def rf_oof(spark, sf):
    """300 trees a fold, without a limit of depth."""
    scored = forest.cross_validate(
        _training(spark, sf), NUMERIC, "bosque", models.LABEL, models.UNIT, models.PROFILE, val_only=True
    )
    return models.out_of_fold(scored, ["bosque"])


def permutation_importance(spark, sf):
    return models.boosting_importance(_training(spark, sf), NUMERIC, GRID)


def kmeans_k(spark, sf):
    return models.kmeans_sweep(materialise(_points(spark, sf)), GRID)


def pca_segments(spark, sf):
    points = materialise(_points(spark, sf))
    out, share = models.with_components(models.with_segments(points, 3, GRID.kmeans_restarts))
    return out.select(
        "unidad_id", "segmento", "pc1", "pc2", F.lit(sum(share)).alias("varianza_explicada")
    )


def _threshold(train):
    """The threshold of largest gain on out-of-fold scores."""
    val = models.cross_validate_logistic(train, NUMERIC, [L2]).filter("split = 'val'")
    return float(evaluate.best_threshold(evaluate.threshold_curve(val, "puntaje")).first()["umbral"])


def score_cut(spark, sf):
    """Fit on cut A, score cut B's population."""
    train = _training(spark, sf)
    model = _l2(train.count()).fit(train)
    later = Q.cut_features(spark, sf, {"B": Q.CUTS["B"]}, labels="none")
    return models.score_population(later, model, _threshold(train))


def final_test(spark, sf):
    train = _training(spark, sf)
    test = materialise(Q.cut_features(spark, sf, {"B": Q.CUTS["B"]}))
    _, result = models.final_test(train, test, _l2(train.count()), _threshold(train), Q.WINDOWS)
    return result


# ---- streaming ------------------------------------------------------------------------------------


def _stream(spark, sf, name):
    return jobs.read_files(spark, sf, Q.SCHEMAS[name], "parquet", f"{name}.parquet")


def stream_land(spark, sf):
    out = run_dir(spark, "land")
    jobs.land(
        _stream(spark, sf, "events"), "events", f"{out}/bronze", f"{out}/cp",
        datetime(2024, 2, 1), date(2024, 2, 1),
    )
    return spark.read.parquet(f"{out}/bronze")


ARRIVALS = 3


def _arriving_lines(spark, sf, job):
    """``lineitem`` arrives in parts, in the order in which the reads were made; the job runs after each and goes on."""
    folder = run_dir(spark, "lines")
    lines = Q.table(spark, sf, "lineitem")
    shares = [i / ARRIVALS for i in range(1, ARRIVALS)]
    bounds = lines.select(F.percentile_approx("l_shipdate", shares).alias("b")).first().b or []
    # reads without a time come first, so that none is left out
    part = sum((F.coalesce(F.col("l_shipdate") > F.lit(b), F.lit(False)).cast("int") for b in bounds), F.lit(0))
    for i in range(ARRIVALS):
        lines.filter(part == i).write.mode("append").parquet(folder)
        job(jobs.read_files(spark, folder, Q.SCHEMAS["lineitem"], "parquet", "*.parquet"))


def stream_dedup(spark, sf):
    """Keys of the reads that survive the streaming duplicate filter, over several runs of the job."""
    out = run_dir(spark, "dedup")

    def job(lines):
        timely = jobs.not_future(lines, "l_shipdate", Q.AS_OF)
        jobs.first_arrivals(timely, out, f"{out}/cp", Q.LINE_KEY, Q.LINE_ORDER)

    _arriving_lines(spark, sf, job)
    return spark.read.parquet(f"{out}/primeras").select(*Q.LINE_KEY)


def stream_quarantine(spark, sf):
    """Streaming form of the valid/quarantine split; returns both sides, told apart by the reason."""
    out = run_dir(spark, "clean")

    def job(lines):
        jobs.clean(
            lines, out, f"{out}/cp", "lineitem", Q.LINE_KEY, Q.LINE_ORDER, "l_shipdate",
            Q._line_id(), Q.line_rules(), Rule(C.REASON_DUPLICATE, F.lit(True), "lectura repetida"), "month",
        )

    _arriving_lines(spark, sf, job)
    valid = spark.read.parquet(f"{out}/validos").select(
        Q._line_id().alias("id_registro"), F.lit("valido").alias("motivo"),
        F.col("l_shipdate").alias("fecha_hora_evento"),
    )
    bad = spark.read.parquet(f"{out}/cuarentena").select("id_registro", "motivo", "fecha_hora_evento")
    return valid.unionByName(bad)


def stream_hourly(spark, sf):
    out = run_dir(spark, "hourly")
    jobs.hourly_demand(
        _stream(spark, sf, "events"), "ts", "value", ["event_type"], "2 hours", f"{out}/data", f"{out}/cp"
    )
    return updates.newest(spark, f"{out}/data", ["hora_ts", "event_type"])


def stream_registry(spark, sf):
    out = run_dir(spark, "registry")
    jobs.registry(
        Q.registry_log(_stream(spark, sf, "events")), "tarjeta", Q.BODY, f"{out}/data", f"{out}/cp"
    )
    return updates.newest(spark, f"{out}/data", ["tarjeta"])


def stream_profile(spark, sf):
    """Purchases arriving as a stream, each with the profile its user had at that time."""
    out = run_dir(spark, "profile")
    others = Q.table(spark, sf, "events").filter(F.col("event_type") != "purchase")
    history = cdc.versions(Q.registry_log(others), "tarjeta", Q.BODY)
    points = _stream(spark, sf, "events").filter(F.col("event_type") == "purchase").select(
        "event_id", F.col("user_id").alias("tarjeta"), "ts", "value"
    )
    jobs.profile_at_event(points, history, "tarjeta", "ts", [*Q.BODY, "estado"], f"{out}/data", f"{out}/cp")
    return spark.read.parquet(f"{out}/data").drop(updates.BATCH)


QUERIES = {
    f.__name__: f
    for f in [
        lr_cv, lr_lambda_curve, lr_coefficients, gbt_oof, rf_oof, permutation_importance, kmeans_k,
        pca_segments, score_cut, final_test,
        stream_land, stream_dedup, stream_quarantine, stream_hourly, stream_registry, stream_profile,
    ]
}
