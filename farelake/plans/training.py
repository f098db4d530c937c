"""From cut features to a stored model: choose, set the threshold, test once, package; and from raw files to scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import config as C
from farelake.operators import evaluate, linear, models
from farelake.operators.quality import union_all
from farelake.plans.lakehouse import Lake, cuts_table, full_load, predict
from farelake.session import materialise
from farelake.sources import sinks

BASELINES = ("tasa", "dias_desde_ultimo_viaje", "menos_viajes")


@dataclass(frozen=True)
class Trained:
    """What a training run decided, and where its tables are."""

    model: str
    threshold: float
    out_of_fold: DataFrame
    comparison: DataFrame
    test: DataFrame
    package: str


def candidates(feats: DataFrame, numeric: Sequence[str], grid: C.ModelGrid) -> tuple[dict, list[linear.Spec]]:
    """Pipelines by name: each penalty with its best λ, boosting and forest; and the logistic ones as one sweep."""
    curve = materialise(models.lambda_curve(feats, numeric, grid))
    best = {r["castigo"]: r["lambda"] for r in models.best_lambda(curve).collect()}  # one row per penalty
    specs = [linear.Spec(f"logistica {name}", ratio, best[name]) for name, ratio in grid.penalties.items()]
    out = {s.name: lambda n, s=s: models.logistic_pipeline(numeric, s.l1_ratio, s.lam, n, grid) for s in specs}
    out["boosting"] = lambda n: models.tree_pipeline(numeric, models.boosting(grid))
    out["bosque"] = lambda n: models.tree_pipeline(numeric, models.forest(grid))
    return out, specs


def cross_validated(feats: DataFrame, numeric: Sequence[str], make: dict, specs: Sequence[linear.Spec], w: C.CutWindows) -> DataFrame:
    """Scores of all candidates and baselines, each written by itself."""
    swept = {s.name for s in specs}
    parts = [materialise(models.cross_validate_logistic(feats, numeric, specs))]
    parts += [models.cross_validate(feats, name, pipeline) for name, pipeline in make.items() if name not in swept]
    parts.append(materialise(baseline_folds(feats, w)))
    return union_all(parts)


def baseline_folds(feats: DataFrame, w: C.CutWindows) -> DataFrame:
    """The scores that need no training, as if they had been fitted for each fold."""
    scores = evaluate.baseline_scores(feats, w).withColumnRenamed("fold", "_own")
    folds = F.explode(F.sequence(F.lit(0), F.lit(C.FOLDS - 1))).alias("fold")
    split = F.when(F.col("_own") == F.col("fold"), "val").otherwise("train").alias("split")
    return scores.select("*", folds).select(
        "modelo", F.col("fold").cast("int").alias("fold"), split, models.UNIT, models.LABEL, "puntaje"
    )


def train_on(
    train: DataFrame, test: DataFrame, numeric: Sequence[str], out: str, version: str, w: C.CutWindows,
    grid: C.ModelGrid = C.ModelGrid(), costs: C.CostScenario = C.CostScenario(),
) -> Trained:
    """Cross-validate all candidates on ``train``, take the best by validation AP and the threshold of largest gain on
    its out-of-fold scores, then test once on ``test``. A second run into the same folder fails before it sees ``test``.
    """
    spark = train.sparkSession
    sinks.write_once(spark.createDataFrame([(version,)], "version string"), f"{out}/prueba_unica")
    feats = materialise(evaluate.attach_folds(train, evaluate.stratified_folds(train)))
    make, specs = candidates(feats, numeric, grid)
    scored = cross_validated(feats, numeric, make, specs, w)
    models.out_of_fold(scored, [*make, *BASELINES]).write.mode("overwrite").parquet(f"{out}/fuera_de_pliegue")
    summary = evaluate.fold_summary(evaluate.ranking_metrics(scored, ["modelo", "fold", "split"], "puntaje"))
    summary.write.mode("overwrite").parquet(f"{out}/comparacion")
    comparison = sinks.read_table(spark, f"{out}/comparacion").orderBy(F.desc("pr_auc_val_media"), "modelo")
    name = comparison.filter(F.col("modelo").isin(list(make))).first()["modelo"]
    own = scored.filter((F.col("modelo") == name) & (F.col("split") == "val"))
    threshold = float(evaluate.best_threshold(evaluate.threshold_curve(own, "puntaje", costs)).first()["umbral"])
    model, result = models.final_test(feats, test, make[name](feats.count()), threshold, w, costs)
    sinks.write_once(result, f"{out}/prueba_final")
    models.save_package(model, f"{out}/paquete", version, name, threshold, "entrenamiento", numeric)
    return Trained(
        name, threshold, sinks.read_table(spark, f"{out}/fuera_de_pliegue"), comparison,
        sinks.read_table(spark, f"{out}/prueba_final"), f"{out}/paquete",
    )


def train(
    lake: Lake, train_cut: date, test_cut: date, numeric: Sequence[str], out: str, version: str,
    w: C.CutWindows = C.CutWindows(), grid: C.ModelGrid = C.ModelGrid(),
) -> Trained:
    """:func:`train_on` for two cuts of a loaded lake."""
    feats = materialise(cuts_table(lake, {"train": train_cut, "test": test_cut}, w))
    one = lambda c: feats.filter(F.col("corte") == c)
    return train_on(one("train"), one("test"), numeric, out, version, w, grid)


def predict_from_raw(
    lake: Lake, raw: str, s: C.Settings, loaded_at: datetime, load_date: date, package: str, cut: date, out: str,
    w: C.CutWindows = C.CutWindows(),
) -> DataFrame:
    """Load the raw files and score the population of ``cut`` with a stored model."""
    full_load(lake, raw, s, loaded_at, load_date, w=w)
    return predict(lake, package, cut, out, w)
