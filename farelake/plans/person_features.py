"""Person features as of the day after the last event: 7/30/90-day windows over all history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import config as C
from farelake.functions import columns as X
from farelake.operators.quality import union_all


def events(silver: dict[str, DataFrame], salt: str) -> DataFrame:
    """Valid boardings with the person key: persona_key, operador, fecha_hora, monto_gtq, zona.

    Cards that name no person are left out.
    """

    def part(view, operator, card, ts, zone):
        op = F.lit(operator)
        return silver[view].select(
            op.alias("operador"),
            X.person_key(salt, op, F.col(card)).alias("persona_key"),
            F.col(ts).alias("fecha_hora"),
            "monto_gtq",
            F.col(zone).alias("zona"),
        )

    return union_all(
        [
            part("silver_tm_validaciones", C.TRANSMETRO, "tarjeta_tm", "fecha_hora", "zona_canonica"),
            part("silver_tu_transacciones", C.TRANSURBANO, "tarjeta_tu", "fecha_hora", "zona_canonica"),
            part("silver_mr_viajes", C.METRORIEL, "tarjeta_mr", "ts_entrada", "zona_entrada"),
            part("silver_am_boardings", C.AEROMETRO, "tarjeta_am", "fecha_hora", "zona_canonica"),
        ]
    ).filter(F.col("persona_key").isNotNull())


def build(ev: DataFrame, person: str = "persona_key", windows: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """One row per person. A single shuffle: every measure is one aggregate with map-side partials.

    Day, mode and zone sets stay small (days of history, operators, zones), so a person with a third
    of all events still reduces to one short row per task. Mode ties go to the smallest value.
    """
    cut = ev.agg(F.date_add(F.max("fecha_hora").cast("date"), 1)).scalar()
    rows = ev.withColumn("fecha_corte", cut).filter(F.col("fecha_hora") < F.col("fecha_corte"))
    ts = F.col("fecha_hora")

    def trips_since(days):
        since = F.date_sub("fecha_corte", days).cast("timestamp_ntz")
        return F.count_if(ts >= since).alias(f"viajes_{days}d")

    n = F.count(F.lit(1))
    spent = F.sum(X.cents(F.col("monto_gtq")))
    return rows.groupBy(person, "fecha_corte").agg(
        *[trips_since(d) for d in windows],
        n.alias("viajes_total"),
        F.datediff(F.first("fecha_corte"), F.max(ts).cast("date")).alias("dias_desde_ultimo_viaje"),
        F.size(F.collect_set(ts.cast("date"))).cast("long").alias("dias_activos"),
        F.size(F.collect_set("operador")).cast("long").alias("n_modos_distintos"),
        F.mode("operador", deterministic=True).alias("modo_mas_usado"),
        X.share(F.count_if(X.peak_hour(ts)), n).alias("prop_hora_pico"),
        X.share(F.count_if(X.weekend(ts)), n).alias("prop_fin_de_semana"),
        F.mode("zona", deterministic=True).alias("zona_origen_mas_frecuente"),
        X.from_cents(spent).alias("gasto_total_gtq"),
        (X.from_cents(spent) / F.count("monto_gtq")).alias("gasto_promedio_gtq"),
    )
