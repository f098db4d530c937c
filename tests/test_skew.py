"""A third of all rows on one key, value or copy: results stay whole and no group is gathered."""

import pytest
from pyspark.sql import functions as F

from farelake.operators import evaluate as E
from farelake.operators import ordered
from farelake.operators.dedup import content_ids, first_reads, repeat_reads
from farelake.plans import cut_features as CF
from farelake.plans import marts

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """Key 0 holds a third of the rows, half of those identical."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 0).otherwise(i).alias("k")
    return spark.range(N).select(key, F.when((i % 3 == 0) & (i % 2 == 0), 0).otherwise(i).alias("v"))


def test_duplicates_are_all_accounted_for(hot):
    first, rest = first_reads(hot, ["k"], ["v"]), repeat_reads(hot, ["k"], ["v"])
    assert first.count() == hot.select("k").distinct().count()
    assert rest.count() == N - first.count()
    assert rest.agg(F.sum("v")).first()[0] + first.agg(F.sum("v")).first()[0] == hot.agg(F.sum("v")).first()[0]


def test_ids_of_a_hot_copy_are_distinct(hot):
    ids = content_ids(hot, "id")
    assert ids.count() == ids.select("id").distinct().count() == N


def test_numbering_spreads_a_hot_key(hot):
    got = ordered.number_all(hot, ["k", "v"], "rn", parts=8)
    assert got.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first() == (1, N, N)


def test_range_blocks_split_a_hot_key(hot):
    rows = hot.withColumn("u", F.monotonically_increasing_id())
    sizes = ordered.range_blocks(rows, ["k", "v", "u"], 8).groupBy(ordered.BLOCK).count()
    assert sizes.agg(F.max("count")).first()[0] < N / 3


def test_metrics_with_one_dominant_score(spark):
    df = spark.range(N).select(
        (F.col("id") % 5 == 0).cast("int").alias("etiqueta"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / N).alias("p"),
    )
    r = E.ranking_metrics(df, [], "p").first()
    assert r.n == N and 0 < r.pr_auc < 1 and abs(r.roc_auc - 0.5) < 0.05


def test_hot_person_in_features_and_combinations(spark):
    i = F.col("id")
    unit = F.when(i % 3 == 0, F.lit("P0")).otherwise(F.concat(F.lit("P"), i % 1000 + 1)).alias("unidad_id")
    ev = spark.range(N).select(
        unit,
        F.concat(unit, F.lit("-"), i % 2).alias("tarjeta"),
        F.element_at(F.array(F.lit("X"), F.lit("Y")), (i % 2 + 1).cast("int")).alias("operador"),
        (F.lit("2026-06-25").cast("timestamp_ntz") + F.make_dt_interval(secs=i)).alias("fecha_hora"),
        F.lit(1.1).alias("monto_gtq"),
        (i % 7).cast("string").alias("zona"),
    )
    from datetime import date

    f = CF.build(ev, None, {"A": date(2026, 7, 1)}, operators=["X", "Y"])
    top = f.orderBy(F.desc("viajes_28d")).first()
    assert (top.unidad_id, top.viajes_28d, top.n_operadores, top.n_zonas) == ("P0", N // 3, 2, 7)
    assert top.tarjetas == "P0-0;P0-1" and abs(top.gasto_28d - 1.1 * (N // 3)) < 1e-6
    assert f.agg(F.sum("viajes_28d")).first()[0] == N
    owners = ev.select("tarjeta", "unidad_id").distinct()
    combos = marts.multi_operator(ev, owners, "tarjeta", "unidad_id", "operador")
    assert combos.agg(F.sum("personas")).first()[0] == f.count()
