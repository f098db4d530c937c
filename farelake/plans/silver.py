"""Validated and conformed tables. Silver and quarantine come from one set of rules per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import config as C
from farelake.functions import columns as X
from farelake.operators import cdc, quality
from farelake.operators.dedup import first_reads, repeat_reads
from farelake.operators.quality import Rule

BODY = ["perfil", "zona_residencia"]
_BAD_FORMAT = "identificador o fecha ilegible"


def _malformed(*required: str) -> Rule:
    broken = F.lit(False)
    for c in required:
        broken = broken | F.col(c).isNull()
    return Rule(C.REASON_MALFORMED, broken, _BAD_FORMAT)


# ---- rules per source ----------------------------------------------------------------


def tm_rules(s: C.Settings) -> list[Rule]:
    return [
        _malformed("validacion_id", "fecha_hora"),
        Rule(
            C.REASON_FUTURE,
            F.col("fecha_hora") > F.lit(s.as_of).cast("timestamp_ntz"),
            "fecha_hora posterior al momento de la carga",
        ),
    ]


def tu_rules(s: C.Settings) -> list[Rule]:
    return [
        _malformed("fecha_hora"),
        Rule(
            C.REASON_NO_STOP,
            F.col("cod_parada").isNull(),
            "cod_parada vacio: no se puede atribuir a una zona",
        ),
        Rule(
            C.REASON_FUTURE,
            F.col("fecha_hora") > F.lit(s.as_of).cast("timestamp_ntz"),
            "fecha posterior al momento de la carga (reloj de unidad desconfigurado)",
        ),
        Rule(
            C.REASON_REJECTED,
            F.col("estado_desc") != "OK",
            F.concat(
                F.lit("estado "), "estado_desc", F.lit(": intento de abordaje rechazado por el validador")
            ),
            fallback=True,
        ),
    ]


def mr_rules(s: C.Settings) -> list[Rule]:
    return [
        Rule(C.REASON_MALFORMED, F.col("linea_ilegible").isNotNull() | F.col("viaje_id").isNull()
             | F.col("ts_entrada").isNull(), _BAD_FORMAT),
        Rule(
            C.REASON_NO_EXIT,
            F.col("sin_salida") & F.col("linea_ilegible").isNull(),
            "el pasajero no valido salida: viaje no se puede cerrar",
        ),
    ]


def am_rules(s: C.Settings) -> list[Rule]:
    return [
        _malformed("boarding_id", "fecha_hora_local"),
        Rule(
            C.REASON_FUTURE,
            F.col("fecha_hora_local") > F.lit(s.as_of).cast("timestamp_ntz"),
            "fecha posterior al momento de la carga",
        ),
    ]


def registry_rules() -> list[Rule]:
    """Changes without a place in the log or a time; the log itself keeps every row."""
    return [_malformed("seq", "commit_ts", "tarjeta")]


# ---- silver ----------------------------------------------------------------------------


def _tm_readings(stg: dict[str, DataFrame]) -> DataFrame:
    return stg["stg_tm_validaciones"].drop("ts_ingesta")


def tm_validations(stg: dict[str, DataFrame], s: C.Settings) -> DataFrame:
    first = first_reads(_tm_readings(stg), ["validacion_id"], ["fecha_hora"])
    valid = quality.accepted(quality.with_reasons(first, tm_rules(s)))
    zones = stg["stg_tm_estaciones"].select("estacion_id", "zona_canonica")
    return valid.join(zones, "estacion_id", "left").select(
        "validacion_id",
        "tarjeta_tm",
        "estacion_id",
        "linea",
        "fecha_hora",
        "monto_gtq",
        "tipo",
        (F.col("tipo") == "TRANSBORDO").alias("es_transbordo"),
        "zona_canonica",
    )


def tu_stops(stg: dict[str, DataFrame]) -> DataFrame:
    return stg["stg_tu_paradas"].select(
        "cod_parada", "descripcion", "ruta", X.canonical_zone(F.col("sector_crudo")).alias("zona_canonica")
    )


def tu_transactions(stg: dict[str, DataFrame], s: C.Settings) -> DataFrame:
    valid = quality.accepted(quality.with_reasons(stg["stg_tu_transacciones"], tu_rules(s)))
    zones = tu_stops(stg).select("cod_parada", "zona_canonica")
    return valid.join(zones, "cod_parada", "left").select(
        "transaccion_id",
        "tarjeta_tu",
        "cod_parada",
        "ruta",
        "fecha_hora",
        "monto_gtq",
        "estado_desc",
        "zona_canonica",
    )


def mr_trips(stg: dict[str, DataFrame], s: C.Settings) -> DataFrame:
    valid = quality.accepted(quality.with_reasons(stg["stg_mr_viajes"], mr_rules(s)))
    zones = stg["stg_mr_estaciones"].select("id_estacion", "zona_canonica")
    entry = zones.toDF("estacion_entrada", "zona_entrada")
    leave = zones.toDF("estacion_salida", "zona_salida")
    return (
        valid.join(entry, "estacion_entrada", "left")
        .join(leave, "estacion_salida", "left")
        .select(
            "viaje_id",
            "tarjeta_mr",
            "estacion_entrada",
            "ts_entrada",
            "estacion_salida",
            "ts_salida",
            "monto_gtq",
            "duracion_s",
            "zona_entrada",
            "zona_salida",
        )
    )


def am_boardings(stg: dict[str, DataFrame], s: C.Settings) -> DataFrame:
    valid = quality.accepted(quality.with_reasons(stg["stg_am_boardings"], am_rules(s)))
    zones = stg["stg_am_estaciones"].select("station_code", "zona_canonica")
    return valid.join(zones, "station_code", "left").select(
        "boarding_id",
        "tarjeta_am",
        "station_code",
        "axis",
        F.col("fecha_hora_local").alias("fecha_hora"),
        "monto_gtq",
        "zona_canonica",
    )


def registry_events(stg: dict[str, DataFrame]) -> DataFrame:
    """All registry changes with the person number their card carries."""
    linked = F.col("operador_detectado").isin(C.LINKED_OPERATORS)
    return stg["stg_cdc_padron_raw"].select(
        "seq",
        "commit_ts",
        "op",
        "tarjeta",
        "operador_detectado",
        F.when(linked, X.card_number(F.col("tarjeta"))).alias("numero"),
        "perfil",
        "zona_residencia",
        "estado",
    )


def _tm_log(stg: dict[str, DataFrame]) -> DataFrame:
    return stg["stg_cdc_padron_raw"].filter(F.col("operador_detectado") == C.TRANSMETRO)


def current_registry(stg: dict[str, DataFrame]) -> DataFrame:
    state = cdc.current_state(_tm_log(stg), "tarjeta", BODY)
    return state.select(
        F.col("tarjeta").alias("tarjeta_tm"),
        *BODY,
        cdc.registry_status(F.col("ultima_operacion")).alias("estado_vigente"),
        F.col("commit_ts").alias("ultimo_cambio_ts"),
        "ultima_operacion",
        "ultimo_seq",
    )


def registry_history(stg: dict[str, DataFrame]) -> DataFrame:
    return cdc.versions(_tm_log(stg), "tarjeta", BODY).withColumnRenamed("tarjeta", "tarjeta_tm")


# ---- quarantine ---------------------------------------------------------------------------


def quarantine(stg: dict[str, DataFrame], s: C.Settings) -> DataFrame:
    readings = _tm_readings(stg)
    again = repeat_reads(readings, ["validacion_id"], ["fecha_hora"])
    duplicate = Rule(
        C.REASON_DUPLICATE, F.lit(True), "validacion_id repetido en la misma lectura de torniquete"
    )

    def bad(df, rules, source, row_id, event_ts):
        return quality.rejected(quality.with_reasons(df, rules), source, F.col(row_id), F.col(event_ts))

    return quality.union_all(
        [
            bad(again, [duplicate], C.TRANSMETRO, "validacion_id", "fecha_hora"),
            bad(readings, tm_rules(s), C.TRANSMETRO, "validacion_id", "fecha_hora"),
            bad(stg["stg_tu_transacciones"], tu_rules(s), C.TRANSURBANO, "transaccion_id", "fecha_hora"),
            bad(stg["stg_mr_viajes"], mr_rules(s), C.METRORIEL, "viaje_id", "ts_entrada"),
            bad(stg["stg_am_boardings"], am_rules(s), C.AEROMETRO, "boarding_id", "fecha_hora_local"),
            bad(stg["stg_cdc_padron_raw"], registry_rules(), "PADRON", "seq", "commit_ts"),
        ]
    )


def build(stg: dict[str, DataFrame], s: C.Settings) -> dict[str, DataFrame]:
    return {
        "silver_tm_validaciones": tm_validations(stg, s),
        "silver_tu_paradas": tu_stops(stg),
        "silver_tu_transacciones": tu_transactions(stg, s),
        "silver_mr_viajes": mr_trips(stg, s),
        "silver_am_boardings": am_boardings(stg, s),
        "silver_cdc_padron": registry_events(stg),
        "silver_padron_transmetro_vigente": current_registry(stg),
        "silver_padron_transmetro_scd2": registry_history(stg),
        "silver_cuarentena": quarantine(stg, s),
    }
