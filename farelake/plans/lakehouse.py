"""The three entry points: full load, one layer at a time, and prediction for a cut date.

The order of the layers is the order of the statements; each layer is written once and read back,
so no job recomputes the one before it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import config as C
from farelake.operators import models, quality
from farelake.plans import cut_features, gold, marts, person_features, silver, staging
from farelake.session import run_all
from farelake.sources import sinks
from farelake.sources.bronze import ingest, latest_sources
from farelake.sources.schemas import BI_EXPORTS, CONTRACTS, KEY_CHECKS
from farelake.sources.truncate import truncate_all

# Event-time column by which a table is laid out in day folders.
BY_DAY = {
    "silver_tm_validaciones": "fecha_hora",
    "silver_tu_transacciones": "fecha_hora",
    "silver_mr_viajes": "ts_entrada",
    "silver_am_boardings": "fecha_hora",
    "fact_abordaje": "fecha_hora",
    "fact_viaje_metroriel": "ts_entrada",
}


@dataclass(frozen=True)
class Lake:
    """Where the layers of one lake live; ``root`` is on storage all executors share."""

    spark: SparkSession
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    def path(self, table: str) -> str:
        layer = table.split("_")[0]
        layer = {"dim": "gold", "fact": "gold", "mart": "gold", "feat": "features", "stg": "staging"}.get(
            layer, layer
        )
        return f"{self.root}/{layer}/{table}"

    def read(self, table: str) -> DataFrame:
        return sinks.read_table(self.spark, self.path(table))

    def publish(self, table: str, df: DataFrame) -> DataFrame:
        sinks.publish(df, self.path(table), CONTRACTS.get(table), BY_DAY.get(table))
        return self.read(table)

    def publish_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Tables of one layer that do not read each other, written side by side."""
        written = run_all([lambda n=n, df=df: self.publish(n, df) for n, df in tables.items()])
        return dict(zip(tables, written))


def build_silver(lake: Lake, frames: dict[str, DataFrame], s: C.Settings, tu_ids: str = "content"):
    """Staging stays lazy, except the bus transactions: their ids cost a shuffle and three readers
    need them, so they are written once."""
    stg = staging.build(frames, tu_ids)
    stg["stg_tu_transacciones"] = lake.publish("stg_tu_transacciones", stg["stg_tu_transacciones"])
    for name, df in stg.items():
        df.createOrReplaceTempView(name)
    return stg, lake.publish_all(silver.build(stg, s))


def build_gold(lake: Lake, stg, silver_tables, s: C.Settings) -> dict[str, DataFrame]:
    dims = lake.publish_all(gold.build_dimensions(lake.spark, stg, silver_tables, s))
    facts = lake.publish_all(gold.build_facts(silver_tables, dims, s))
    cube = lake.publish("mart_demanda", marts.demand(facts["fact_abordaje"], dims))
    rest = lake.publish_all(marts.build(lake.spark, dims, facts, cube))
    return {**dims, **facts, "mart_demanda": cube, **rest}


def full_load(
    lake: Lake,
    raw: str,
    s: C.Settings,
    loaded_at: datetime,
    load_date: date,
    cuts: dict[str, date] | None = None,
    w: C.CutWindows = C.CutWindows(),
    tu_ids: str = "content",
    expected: dict[str, int] | None = None,
) -> dict:
    """Ingest, transform, test, export, features. Returns tables, counts, the test report, the seconds of each stage and,
    where the ``expected`` rows of the sources are given, their comparison with what was loaded. It reports and does not
    stop the load."""
    started, seconds = time.monotonic(), {}

    def done(stage: str) -> None:
        seconds[stage] = round(time.monotonic() - started - sum(seconds.values()), 3)

    counts = ingest(lake.spark, raw, lake.bronze, loaded_at, load_date)
    checked = reconciliation(lake.spark, expected, counts) if expected is not None else None
    done("ingesta")
    frames = latest_sources(lake.spark, lake.bronze)
    stg, silver_tables = build_silver(lake, frames, s, tu_ids)
    gold_tables = build_gold(lake, stg, silver_tables, s)
    persons = person_features.build(person_features.events(silver_tables, s.salt))
    feat = lake.publish("feat_usuario", persons)
    tables = {**silver_tables, **gold_tables, "feat_usuario": feat}
    done("transformacion")
    report = quality.check_report(tables, KEY_CHECKS)
    done("pruebas")
    for name in BI_EXPORTS:
        sinks.export_csv(tables[name], f"{lake.root}/export/{name}")
    done("exportacion")
    if cuts:
        sinks.write_features(cuts_table(lake, cuts, w), lake.path("feat_cortes"))
        tables["feat_cortes"] = lake.read("feat_cortes")
        done("features")
    return {"tables": tables, "counts": counts, "checks": report, "reconciliation": checked, "seconds": seconds}


def reconciliation(spark: SparkSession, expected: dict[str, int], counts: dict[str, int]) -> DataFrame:
    """Expected and loaded rows of each expected source; one that was not loaded has a null count."""
    wanted = spark.createDataFrame(list(expected.items()), "tabla string, filas_esperadas long")
    return quality.reconcile(wanted, spark.createDataFrame(list(counts.items()), "tabla string, filas long"))


def cuts_table(lake: Lake, cuts: dict[str, date], w: C.CutWindows, labels: str = "auto", until=None):
    """Features of the given cuts from the published silver tables."""
    silver_tables = {n: lake.read(n) for n in [*BY_DAY, "silver_cdc_padron"] if n.startswith("silver")}
    log = cut_features.until(cut_features.registry(silver_tables["silver_cdc_padron"]), "commit_ts", until)
    first_day = min(cuts.values()) - timedelta(days=w.window)
    every = cut_features.until(cut_features.events(silver_tables), "fecha_hora", until)
    end = max(cuts.values()) + timedelta(days=w.horizon)
    recent = cut_features.until(cut_features.events(silver_tables, first_day, end), "fecha_hora", until)
    recent = recent.filter(F.col("fecha_hora") < F.lit(end).cast("timestamp_ntz"))
    last_event = every.agg(F.max("fecha_hora").alias("ultimo"))
    cards = cut_features.card_rollup(every)
    return cut_features.features(recent, cards, log, cuts, w, C.OPERATOR_CODES, last_event, labels)


def features_from_raw(
    frames: dict[str, DataFrame], s: C.Settings, cuts: dict[str, date], w: C.CutWindows,
    until=None,
) -> DataFrame:
    """Cut features straight from bronze frames, truncated at ``until`` before any layer is built.

    The strict leak audit compares this with the features of the full data: it would also catch a
    leak in the layers, not only in the features.
    """
    if until is not None:
        frames = truncate_all(frames, until)
    tables = silver.build(staging.build(frames), s)
    return cut_features.build(
        cut_features.events(tables), cut_features.registry(tables["silver_cdc_padron"]), cuts, w, labels="none"
    )


def leak_report(full: DataFrame, known: DataFrame) -> DataFrame:
    return quality.table_diff(full.drop("etiqueta"), known.drop("etiqueta"), ["unidad_id", "corte"])


def predict(lake: Lake, package: str, cut: date, out: str, w: C.CutWindows = C.CutWindows(), until=None) -> DataFrame:
    """Score the population of a cut with a stored model and write the sorted CSV."""
    pipeline, meta = models.load_package(lake.spark, package)
    feats = cuts_table(lake, {"pred": cut}, w, labels="none", until=until)
    scored = models.score_population(feats, pipeline, meta["umbral"])
    sinks.export_sorted_csv(scored, out, ["unidad_id"])
    return lake.spark.read.option("header", True).schema(scored.schema).csv(out)


def invariance_report(short: DataFrame, long: DataFrame) -> DataFrame:
    return quality.table_diff(short, long, ["unidad_id"])


def lake_fingerprint(tables: dict[str, DataFrame]) -> DataFrame:
    """Counts and content digests of all tables; two runs over the same data must agree."""
    return quality.union_all([quality.fingerprint(df, name) for name, df in sorted(tables.items())])
