"""Evaluation of scores in relational form: folds, ranking metrics, thresholds, summaries.

Scored rows are long: group columns (model, fold, split…), ``etiqueta`` 0/1 and a score. All groups
are evaluated in one pass, so five folds of three models cost one job, not fifteen.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake import config as C
from farelake.functions import columns as X
from farelake.operators.ordered import (

    hash_prefix_blocks,
    range_blocks,
    row_numbers,
    running_sums,
)

LABEL = "etiqueta"


# ---- folds -------------------------------------------------------------------------------


def stratified_folds(
    df: DataFrame, unit: str = "unidad_id", label: str = LABEL, folds: int = C.FOLDS, seed: int = C.SEED
) -> DataFrame:
    """(unit, label, fold): exactly balanced inside each label (or its absence), the same on every run.

    Units are dealt out in the order of a digest of their id, so no unit's fold depends on how the
    data are partitioned. The digest's first digits cut each label into even blocks.
    """
    keyed = df.select(
        unit, label, F.coalesce(label, F.lit(-1)).alias("_stratum"), F.sha2(F.concat(F.col(unit).cast("string"), F.lit(f":{seed}")), 256).alias("_h")
    )
    dealt = row_numbers(hash_prefix_blocks(keyed, "_h"), ["_stratum"], ["_h", unit], "_rn")
    return dealt.select(unit, label, F.pmod(F.col("_rn") - 1, folds).cast("int").alias("fold"))


def attach_folds(df: DataFrame, folds: DataFrame, unit: str = "unidad_id") -> DataFrame:
    """Use a stored assignment; a unit without one is an error raised by the job itself."""
    joined = df.join(folds.select(unit, F.col("fold").alias("_fold")), unit, "left")
    missing = F.raise_error(F.concat(F.lit("no fold for unit "), F.col(unit).cast("string")))
    return joined.withColumn("fold", F.coalesce("_fold", missing.cast("int"))).drop("_fold")


# ---- ranking metrics ------------------------------------------------------------------------


def ranking_metrics(
    scored: DataFrame, groups: Sequence[str], score: str, label: str = LABEL
) -> DataFrame:
    """Average precision (step sum) and ROC-AUC (ties count half) per group.

    Rows are first reduced to one per distinct score; the cumulative counts then run over those in
    range blocks, so neither a large group nor a single global window ends in one task.
    """
    y = F.col(label)
    points = scored.groupBy(*groups, score).agg(
        F.sum(y.cast("long")).alias("_pos"), F.sum((1 - y).cast("long")).alias("_neg")
    )
    order = [*[F.col(g) for g in groups], F.col(score).desc()]
    blocks = range_blocks(points, order)
    run = running_sums(blocks, list(groups), [F.col(score).desc()], {"_tp": "_pos", "_fp": "_neg"}, null_keys=True)
    tp, fp, pos, neg = (F.col(c) for c in ("_tp", "_fp", "_pos", "_neg"))
    sums = run.groupBy(*groups).agg(
        F.sum(pos).alias("_p"),
        F.sum(neg).alias("_n"),
        F.sum(pos * tp / (tp + fp)).alias("_ap"),
        F.sum(neg * (tp - pos / F.lit(2.0))).alias("_auc"),
    )
    return sums.select(
        *groups,
        (F.col("_p") + F.col("_n")).alias("n"),
        F.col("_p").alias("positivos"),
        F.try_divide("_ap", "_p").alias("pr_auc"),
        F.try_divide("_auc", F.col("_p") * F.col("_n")).alias("roc_auc"),
    )


def fold_summary(per_fold: DataFrame, model: str = "modelo") -> DataFrame:
    """Mean and sample deviation over folds, and the train–validation gap.

    ``per_fold`` has model, fold, split (``train``/``val``), pr_auc, roc_auc.
    """
    val, train = F.col("split") == "val", F.col("split") == "train"
    pr, roc = F.col("pr_auc"), F.col("roc_auc")
    return (
        per_fold.groupBy(model)
        .agg(
            F.avg(F.when(val, pr)).alias("pr_auc_val_media"),
            F.stddev_samp(F.when(val, pr)).alias("pr_auc_val_std"),
            F.avg(F.when(train, pr)).alias("pr_auc_train_media"),
            F.avg(F.when(val, roc)).alias("roc_auc_val_media"),
            F.stddev_samp(F.when(val, roc)).alias("roc_auc_val_std"),
        )
        .withColumn("brecha_train_val", F.col("pr_auc_train_media") - F.col("pr_auc_val_media"))
    )


# ---- thresholds --------------------------------------------------------------------------------


def confusion(
    scored: DataFrame,
    score: str,
    threshold: float | Column,
    costs: C.CostScenario = C.CostScenario(),
    label: str = LABEL,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts, precision, recall and gain of contacting ``score >= threshold``."""
    u = F.lit(threshold) if not isinstance(threshold, Column) else threshold
    y, hit = F.col(label) == 1, F.col(score) >= u
    counts = scored.groupBy(*groups).agg(
        F.count_if(y & hit).alias("vp"),
        F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"),
        F.count_if(~y & ~hit).alias("vn"),
    )
    return counts.select(*groups, u.cast("double").alias("umbral"), "vp", "fp", "fn", "vn", *_rates(costs))


def _rates(costs: C.CostScenario) -> list[Column]:
    vp, fp, fn = F.col("vp"), F.col("fp"), F.col("fn")

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    return [
        (vp + fp).alias("contactados"),
        ratio(vp, vp + fp).alias("precision"),
        ratio(vp, vp + fn).alias("recall"),
        (vp * F.lit(costs.gain_tp) + fp * F.lit(costs.gain_fp)).alias("ganancia_q"),
    ]


GRID_FIRST, GRID_LAST, GRID_STEP = 10, 990, 5  # thousandths


def threshold_curve(
    scored: DataFrame, score: str, costs: C.CostScenario = C.CostScenario(), label: str = LABEL
) -> DataFrame:
    """Counts and gain for thresholds 0.010, 0.015 … 0.990.

    Each score falls into the slot of the largest threshold it reaches; one aggregate over the rows
    leaves at most 198 slots, over which the suffix sums run.
    """
    steps = (GRID_LAST - GRID_FIRST) // GRID_STEP
    slots_all = scored.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("slot"))
    at = lambda k: (k * GRID_STEP + GRID_FIRST) / F.lit(1000.0)
    guess = F.floor((F.col(score) * 1000 - GRID_FIRST) / GRID_STEP).cast("int")
    # floating point may misplace a score that equals a threshold by one slot
    slot = (
        F.when(F.col(score) >= at(guess + 1), guess + 1)
        .when(F.col(score) < at(guess), guess - 1)
        .otherwise(guess)
    )
    counted = scored.groupBy(F.greatest(F.lit(-1), F.least(F.lit(steps), slot)).alias("slot")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")
    )
    full = slots_all.join(counted, "slot", "left").na.fill(0, ["_p", "_n"])
    down = Window.orderBy(F.desc("slot"))  # over the 199 slots
    everything = Window.partitionBy()
    counts = full.select(
        "slot",
        at(F.col("slot")).alias("umbral"),
        F.sum("_p").over(down).alias("vp"),
        F.sum("_n").over(down).alias("fp"),
        (F.sum("_p").over(everything) - F.sum("_p").over(down)).alias("fn"),
    )
    return counts.filter(F.col("slot") >= 0).select("umbral", "vp", "fp", "fn", *_rates(costs))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row of largest gain; the smallest threshold wins a tie."""
    best = F.max_by(F.struct(*curve.columns), F.struct(F.col("ganancia_q"), -F.col("umbral")))
    return curve.agg(best.alias("_b")).select("_b.*")


def threshold_choices(
    scored: DataFrame, score: str, costs: C.CostScenario = C.CostScenario(), label: str = LABEL
) -> DataFrame:
    """Chosen, theoretical and contact-everyone thresholds side by side."""
    cols = ["umbral", "vp", "fp", "fn", "contactados", "precision", "recall", "ganancia_q"]
    chosen = best_threshold(threshold_curve(scored, score, costs, label)).select(
        F.lit("elegido").alias("regla"), *cols
    )
    theory = confusion(scored, score, costs.theoretical_threshold, costs, label).select(
        F.lit("teorico").alias("regla"), *cols
    )
    everyone = confusion(scored, score, 0.0, costs, label).select(F.lit("todos").alias("regla"), *cols)
    return chosen.unionByName(theory).unionByName(everyone)


# ---- baselines, ties, segments --------------------------------------------------------------------


def baseline_scores(feats: DataFrame, w: C.CutWindows, label: str = LABEL) -> DataFrame:
    """Long rows for three scores that need no training: constant rate, recency, few trips."""
    rate = feats.agg(F.avg(F.col(label).cast("double"))).scalar()
    named = [
        ("tasa", F.col("_rate")),
        ("dias_desde_ultimo_viaje", F.col("dias_desde_ultimo_viaje")),
        ("menos_viajes", -F.col(f"viajes_{w.window}d").cast("double")),
    ]
    pairs = F.array(
        *[F.struct(F.lit(name).alias("modelo"), s.cast("double").alias("puntaje")) for name, s in named]
    )
    keep = [c for c in ("unidad_id", "fold", label) if c in feats.columns]
    return feats.withColumn("_rate", rate).select(*keep, F.explode(pairs).alias("_s")).select(*keep, "_s.*")


def grouped_medians(df: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact medians of several columns per group, for groups of any size.

    Values become (group, column, value, count) rows; cumulative counts over range blocks then show
    which one or two values sit in the middle. No group is ever gathered in one task.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in columns]
    )
    values = (
        df.select(*groups, F.explode(pairs).alias("_e"))
        .select(*groups, "_e.*")
        .filter(F.col("_v").isNotNull())
        .groupBy(*groups, "_col", "_v")
        .agg(F.count(F.lit(1)).alias("_k"))
    )
    keys = [*groups, "_col"]
    run = running_sums(range_blocks(values, [*keys, "_v"]), keys, ["_v"], {"_upto": "_k"}, null_keys=True)
    sizes = values.groupBy(*keys).agg(F.sum("_k").alias("_n"))
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    after = F.col("_upto") - F.col("_k")
    holds = lambda rank: (after < rank) & (rank <= F.col("_upto"))
    middle = _same_group(run, sizes, keys).groupBy(*keys).agg(
        ((F.max(F.when(holds(low), F.col("_v"))) + F.max(F.when(holds(high), F.col("_v")))) / 2).alias("_m")
    )
    return middle.groupBy(*groups).pivot("_col", list(columns)).agg(F.max("_m"))


def _same_group(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group columns in which a null is a group like any other."""
    renamed = right.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_g_{k}" for k in keys])


def segment_profile(
    df: DataFrame, segment: str, medians: Sequence[str], label: str = LABEL
) -> DataFrame:
    """Size, positive rate and medians per segment."""
    sizes = df.groupBy(segment).agg(
        F.count(F.lit(1)).alias("tamano"), X.share(F.sum(label), F.count(label)).alias("tasa_abandono")
    )
    return _same_group(sizes, grouped_medians(df, [segment], medians), [segment], "left")
