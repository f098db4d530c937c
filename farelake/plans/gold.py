"""Conformed dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake import config as C
from farelake.functions import columns as X
from farelake.operators.ordered import number_all
from farelake.operators.quality import union_all

# ---- small dimensions -----------------------------------------------------------------


def distinct_zones(frames: list[DataFrame], zone: str = "zona_canonica") -> DataFrame:
    return union_all([f.select(zone) for f in frames]).filter(F.col(zone).isNotNull()).distinct()


def zone_dimension(zones: DataFrame, zone: str = "zona_canonica") -> DataFrame:
    """Keys by name. The input is the list of zones, whose number the geography bounds."""
    return zones.select(
        F.row_number().over(Window.orderBy(zone)).cast("long").alias("zona_key"),
        F.col(zone).alias("zona_nombre"),
        X.zone_kind(F.col(zone)).alias("zona_tipo"),
    )


def inline(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A constant relation as one projection: the optimizer sees its size and broadcasts it."""
    literals = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*literals)))


def operator_dimension(spark: SparkSession) -> DataFrame:
    return inline(spark, C.OPERATORS, ["operador", "nombre", "modo", "unidades_infra"])


def _catalogue(df, operator, code, name, lat=None, lon=None):
    none = F.lit(None).cast("double")
    return df.select(
        F.lit(operator).alias("operador"),
        F.col(code).cast("string").alias("codigo_nativo"),
        F.col(name).alias("nombre"),
        "zona_canonica",
        (F.col(lat) if lat else none).alias("lat"),
        (F.col(lon) if lon else none).alias("lon"),
    )


def station_dimension(stations: DataFrame, zones: DataFrame, small: bool = True) -> DataFrame:
    """Keys by (operator, native code).

    A transit catalogue has hundreds of rows and is numbered in one window; ``small=False`` numbers
    catalogues of any size over range partitions.
    """
    order = ["operador", "codigo_nativo"]
    if small:
        keyed = stations.withColumn("estacion_key", F.row_number().over(Window.orderBy(*order)).cast("long"))
    else:
        keyed = number_all(stations, order, "estacion_key")
    named = zones.select("zona_key", F.col("zona_nombre").alias("zona_canonica"))
    return keyed.join(named, "zona_canonica", "left").select(
        "estacion_key", "operador", "codigo_nativo", "nombre", "zona_key", "lat", "lon"
    )


def hour_dimension(span: DataFrame) -> DataFrame:
    """One row per hour from ``min_ts`` to ``max_ts`` of a one-row input."""
    hours = span.select(
        F.explode(
            F.sequence(
                X.hour_start(F.col("min_ts")), X.hour_start(F.col("max_ts")), F.expr("interval 1 hour")
            )
        ).alias("h")
    )
    h = F.col("h")
    return hours.select(
        X.hour_key(h).alias("tiempo_key"),
        h.cast("date").alias("fecha"),
        F.hour(h).cast("long").alias("hora_del_dia"),
        X.working_day(h).alias("dia_habil"),
        X.peak_hour(h).alias("hora_pico"),
    )


def user_dimension(cards: DataFrame, salt: str) -> DataFrame:
    """``cards``: operador, llave_nativa, perfil, zona_residencia, estado_padron, one row per card."""
    op, card = F.col("operador"), F.col("llave_nativa")
    return cards.select(
        X.pseudonym(salt, op, card).alias("usuario_key"),
        "operador",
        "perfil",
        "zona_residencia",
        "estado_padron",
        X.person_key(salt, op, card).alias("persona_key"),
        F.when(op.isin(C.LINKED_OPERATORS), "NUMERO_TARJETA")
        .otherwise("SIN_VINCULO")
        .alias("vinculo_persona"),
    )


def known_cards(stg: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """BRT cards seen in valid readings with their registry state; other cards as delivered."""
    none = F.lit(None).cast("string")
    seen = silver["silver_tm_validaciones"].select("tarjeta_tm").distinct()
    registry = silver["silver_padron_transmetro_vigente"].select(
        "tarjeta_tm", "perfil", "zona_residencia", "estado_vigente"
    )
    parts = [
        seen.join(registry, "tarjeta_tm", "left").select(
            F.lit(C.TRANSMETRO).alias("operador"),
            F.col("tarjeta_tm").alias("llave_nativa"),
            "perfil",
            "zona_residencia",
            F.coalesce("estado_vigente", F.lit("SIN_PADRON")).alias("estado_padron"),
        )
    ]
    for operator, view, card in [
        (C.TRANSURBANO, "stg_tu_transacciones", "tarjeta_tu"),
        (C.METRORIEL, "stg_mr_viajes", "tarjeta_mr"),
        (C.AEROMETRO, "stg_am_boardings", "tarjeta_am"),
    ]:
        cards = stg[view].select(card).filter(F.col(card).isNotNull()).distinct()
        parts.append(
            cards.select(
                F.lit(operator).alias("operador"),
                F.col(card).alias("llave_nativa"),
                none.alias("perfil"),
                none.alias("zona_residencia"),
                none.alias("estado_padron"),
            )
        )
    return union_all(parts)


# ---- facts --------------------------------------------------------------------------------


def boardings(silver: dict[str, DataFrame]) -> DataFrame:
    """Accepted boardings of the four operators in one shape; rail contributes its entry."""

    def part(view, operator, row_id, card, station, ts, transfer=None):
        return silver[view].select(
            F.lit(operator).alias("operador"),
            F.col(row_id).cast("string").alias("id_origen"),
            F.col(card).alias("tarjeta"),
            F.col(station).cast("string").alias("codigo_estacion"),
            F.col(ts).alias("fecha_hora"),
            "monto_gtq",
            (F.col(transfer) if transfer else F.lit(False)).alias("es_transbordo"),
        )

    return union_all(
        [
            part("silver_tm_validaciones", C.TRANSMETRO, "validacion_id", "tarjeta_tm", "estacion_id",
                 "fecha_hora", "es_transbordo"),
            part("silver_tu_transacciones", C.TRANSURBANO, "transaccion_id", "tarjeta_tu", "cod_parada",
                 "fecha_hora"),
            part("silver_mr_viajes", C.METRORIEL, "viaje_id", "tarjeta_mr", "estacion_entrada", "ts_entrada"),
            part("silver_am_boardings", C.AEROMETRO, "boarding_id", "tarjeta_am", "station_code",
                 "fecha_hora"),
        ]
    )


def boarding_fact(events: DataFrame, stations: DataFrame, salt: str) -> DataFrame:
    """``events`` as from :func:`boardings`; the card leaves the lake here, only pseudonyms stay."""
    codes = stations.select("operador", F.col("codigo_nativo").alias("codigo_estacion"), "estacion_key")
    return events.join(codes, ["operador", "codigo_estacion"], "left").select(
        F.concat("operador", F.lit(":"), "id_origen").alias("abordaje_key"),
        "operador",
        X.pseudonym(salt, F.col("operador"), F.col("tarjeta")).alias("usuario_key"),
        "estacion_key",
        X.hour_key(F.col("fecha_hora")).alias("tiempo_key"),
        "fecha_hora",
        "monto_gtq",
        "es_transbordo",
    )


def rail_trip_fact(
    trips: DataFrame, stations: DataFrame, salt: str, operator: str = C.METRORIEL
) -> DataFrame:
    """Closed trips; the station dimension plays origin and destination."""
    rail = stations.filter(F.col("operador") == operator)
    origin = rail.select(
        F.col("codigo_nativo").alias("_o"), F.col("estacion_key").alias("estacion_origen_key")
    )
    target = rail.select(
        F.col("codigo_nativo").alias("_d"), F.col("estacion_key").alias("estacion_destino_key")
    )
    return (
        trips.join(origin, F.col("estacion_entrada").cast("string") == F.col("_o"), "left")
        .join(target, F.col("estacion_salida").cast("string") == F.col("_d"), "left")
        .select(
            "viaje_id",
            X.pseudonym(salt, F.lit(operator), F.col("tarjeta_mr")).alias("usuario_key"),
            "estacion_origen_key",
            "estacion_destino_key",
            X.hour_key(F.col("ts_entrada")).alias("tiempo_key_entrada"),
            "ts_entrada",
            "ts_salida",
            "duracion_s",
            "monto_gtq",
        )
    )


# ---- the layer ---------------------------------------------------------------------------------


def event_span(events: DataFrame, ts: str = "fecha_hora") -> DataFrame:
    return events.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def station_catalogue(stg: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            _catalogue(stg["stg_tm_estaciones"], C.TRANSMETRO, "estacion_id", "nombre", "lat", "lon"),
            _catalogue(silver["silver_tu_paradas"], C.TRANSURBANO, "cod_parada", "descripcion"),
            _catalogue(stg["stg_mr_estaciones"], C.METRORIEL, "id_estacion", "nombre_estacion"),
            _catalogue(stg["stg_am_estaciones"], C.AEROMETRO, "station_code", "station_name"),
        ]
    )


def build_dimensions(
    spark: SparkSession, stg: dict[str, DataFrame], silver: dict[str, DataFrame], s: C.Settings
) -> dict[str, DataFrame]:
    catalogue = station_catalogue(stg, silver)
    zones = zone_dimension(distinct_zones([catalogue]))
    return {
        "dim_zona": zones,
        "dim_operador": operator_dimension(spark),
        "dim_estacion": station_dimension(catalogue, zones),
        "dim_tiempo": hour_dimension(event_span(boardings(silver))),
        "dim_usuario": user_dimension(known_cards(stg, silver), s.salt),
    }


def build_facts(
    silver: dict[str, DataFrame], dims: dict[str, DataFrame], s: C.Settings
) -> dict[str, DataFrame]:
    return {
        "fact_abordaje": boarding_fact(boardings(silver), dims["dim_estacion"], s.salt),
        "fact_viaje_metroriel": rail_trip_fact(silver["silver_mr_viajes"], dims["dim_estacion"], s.salt),
    }
