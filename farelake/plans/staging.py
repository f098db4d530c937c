"""Typed, renamed views of the newest bronze loads. Lazy: they fuse into the silver jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions import columns as X
from farelake.operators.dedup import content_ids, ranked_ids

TU_COLUMNS = ["fecha", "hora", "num_tarjeta", "cod_parada", "ruta", "monto_centavos", "cod_estado"]


def _num(name: str, kind: str):
    return F.col(name).try_cast(kind)


def tm_stations(df: DataFrame) -> DataFrame:
    return df.select(
        "estacion_id",
        "nombre",
        "linea",
        F.col("zona").alias("zona_canonica"),
        _num("lat", "double").alias("lat"),
        _num("lon", "double").alias("lon"),
    )


def tu_stops(df: DataFrame) -> DataFrame:
    return df.select(
        "cod_parada",
        "descripcion",
        "ruta",
        F.col("sector").alias("sector_crudo"),
        F.col("sector").rlike("^Z[0-9]+$").alias("es_zona_numerada"),
    )


def mr_stations(df: DataFrame) -> DataFrame:
    return df.select(
        _num("id_estacion", "int").alias("id_estacion"),
        "nombre_estacion",
        F.col("zona_nombre").alias("zona_canonica"),
        _num("km", "double").alias("km"),
    )


def am_stations(df: DataFrame) -> DataFrame:
    return df.select("station_code", "station_name", "axis", F.col("district").alias("zona_canonica"))


def tm_validations(df: DataFrame) -> DataFrame:
    return df.select(
        _num("validacion_id", "bigint").alias("validacion_id"),
        F.col("tarjeta").alias("tarjeta_tm"),
        "estacion_id",
        "linea",
        X.parse_ts(F.col("fecha_hora"), "yyyy-MM-dd HH:mm:ss").alias("fecha_hora"),
        _num("tarifa", "double").alias("monto_gtq"),
        "tipo",
        "ts_ingesta",
    )


def tu_transactions(df: DataFrame, ids: str = "content") -> DataFrame:
    """``ids="content"`` gives stable ids; ``"rank"`` numbers all rows in text order.

    The rank renumbers everything when a row arrives and costs a global sort; it exists for parity.
    """
    raw = df.select(*TU_COLUMNS)
    if ids == "rank":
        keyed = ranked_ids(raw, [F.col(c).asc_nulls_last() for c in TU_COLUMNS], "transaccion_id")
    else:
        keyed = content_ids(raw, "transaccion_id")
    code = _num("cod_estado", "int")
    return keyed.select(
        "transaccion_id",
        F.col("num_tarjeta").alias("tarjeta_tu"),
        X.blank_to_null(F.col("cod_parada")).alias("cod_parada"),
        "ruta",
        X.parse_ts(F.concat("fecha", F.lit(" "), "hora"), "dd/MM/yyyy HH:mm:ss").alias("fecha_hora"),
        X.from_cents(_num("monto_centavos", "double")).alias("monto_gtq"),
        code.alias("cod_estado"),
        X.status_label(code).alias("estado_desc"),
    )


def mr_trips(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("trip_id").alias("viaje_id"),
        F.col("card").alias("tarjeta_mr"),
        F.col("entry.station").cast("int").alias("estacion_entrada"),
        F.col("entry.ts").try_cast("timestamp_ntz").alias("ts_entrada"),
        F.col("exit.station").cast("int").alias("estacion_salida"),
        F.col("exit.ts").try_cast("timestamp_ntz").alias("ts_salida"),
        F.col("fare_gtq").alias("monto_gtq"),
        F.col("duration_s").cast("int").alias("duracion_s"),
        F.col("exit").isNull().alias("sin_salida"),
        F.col("_corrupt_record").alias("linea_ilegible"),
    )


def am_boardings(df: DataFrame) -> DataFrame:
    utc = X.parse_ts(F.col("timestamp_utc"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return df.select(
        _num("boarding_id", "bigint").alias("boarding_id"),
        F.col("user_hash").alias("tarjeta_am"),
        "station_code",
        "axis",
        utc.alias("ts_utc"),
        X.local_from_utc(utc).alias("fecha_hora_local"),
        _num("cabin_number", "int").alias("cabin_number"),
        _num("fare", "double").alias("monto_gtq"),
    )


def registry_log(df: DataFrame) -> DataFrame:
    """The change log, typed, with the operator its key format points to."""
    return df.select(
        _num("seq", "bigint").alias("seq"),
        F.col("commit_ts").try_cast("timestamp_ntz").alias("commit_ts"),
        "op",
        "tarjeta",
        X.blank_to_null(F.col("perfil")).alias("perfil"),
        X.blank_to_null(F.col("zona_residencia")).alias("zona_residencia"),
        X.blank_to_null(F.col("estado")).alias("estado"),
        X.card_operator(F.col("tarjeta")).alias("operador_detectado"),
    )


def build(frames: dict[str, DataFrame], tu_ids: str = "content") -> dict[str, DataFrame]:
    return {
        "stg_tm_estaciones": tm_stations(frames["tm_estaciones"]),
        "stg_tu_paradas": tu_stops(frames["tu_paradas"]),
        "stg_mr_estaciones": mr_stations(frames["mr_estaciones"]),
        "stg_am_estaciones": am_stations(frames["am_estaciones"]),
        "stg_tm_validaciones": tm_validations(frames["tm_validaciones"]),
        "stg_tu_transacciones": tu_transactions(frames["tu_transacciones"], tu_ids),
        "stg_mr_viajes": mr_trips(frames["mr_viajes"]),
        "stg_am_boardings": am_boardings(frames["am_boardings"]),
        "stg_cdc_padron_raw": registry_log(frames["cdc_padron_usuarios"]),
    }
