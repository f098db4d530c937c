"""Schemas of the raw files, the published tables and the feature columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
DATE, NTZ = T.DateType(), T.TimestampNTZType()


def text_schema(*names: str) -> T.StructType:
    """All-string schema: leading zeros of card numbers must survive the load."""
    return T.StructType([T.StructField(n, S) for n in names])


def table(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols.items()])


_READING = T.StructType([T.StructField("station", L), T.StructField("ts", S)])


@dataclass(frozen=True)
class Source:
    """One raw file: where it is, how it is read, by which route it arrives."""

    name: str
    file: str
    schema: T.StructType
    fmt: str = "csv"
    route: str = "batch"  # batch | stream | cdc


SOURCES = {
    s.name: s
    for s in [
        Source(
            "tm_estaciones",
            "tm_estaciones.csv",
            text_schema("estacion_id", "nombre", "linea", "zona", "lat", "lon"),
        ),
        Source(
            "tu_paradas", "tu_paradas.csv", text_schema("cod_parada", "descripcion", "ruta", "sector")
        ),
        Source(
            "mr_estaciones",
            "mr_estaciones.csv",
            text_schema("id_estacion", "nombre_estacion", "zona_nombre", "km"),
        ),
        Source(
            "am_estaciones",
            "am_estaciones.csv",
            text_schema("station_code", "station_name", "axis", "district"),
        ),
        Source(
            "mr_viajes",
            "metroriel_viajes.jsonl",
            table(
                trip_id=L,
                card=S,
                entry=_READING,
                exit=_READING,
                fare_gtq=D,
                duration_s=L,
                _corrupt_record=S,
            ),
            fmt="json",
        ),
        Source(
            "tm_validaciones",
            "transmetro_validaciones.csv",
            text_schema("validacion_id", "tarjeta", "estacion_id", "linea", "fecha_hora", "tarifa", "tipo"),
            route="stream",
        ),
        Source(
            "am_boardings",
            "aerometro_boardings.csv",
            text_schema(
                "boarding_id", "user_hash", "station_code", "axis", "timestamp_utc", "cabin_number", "fare"
            ),
            route="stream",
        ),
        Source(
            "tu_transacciones",
            "transurbano_transacciones.csv",
            text_schema(
                "fecha", "hora", "num_tarjeta", "cod_parada", "ruta", "monto_centavos", "cod_estado"
            ),
        ),
        Source(
            "cdc_padron_usuarios",
            "cdc_padron_usuarios.csv",
            text_schema("seq", "commit_ts", "op", "tarjeta", "perfil", "zona_residencia", "estado"),
            route="cdc",
        ),
    ]
}

# Published tables: column order and types are the contract with their readers.
CONTRACTS = {
    "silver_cuarentena": table(fuente=S, id_registro=S, motivo=S, detalle=S, fecha_hora_evento=NTZ),
    "dim_zona": table(zona_key=L, zona_nombre=S, zona_tipo=S),
    "dim_operador": table(operador=S, nombre=S, modo=S, unidades_infra=I),
    "dim_estacion": table(
        estacion_key=L, operador=S, codigo_nativo=S, nombre=S, zona_key=L, lat=D, lon=D
    ),
    "dim_tiempo": table(tiempo_key=L, fecha=DATE, hora_del_dia=L, dia_habil=B, hora_pico=B),
    "dim_usuario": table(
        usuario_key=S,
        operador=S,
        perfil=S,
        zona_residencia=S,
        estado_padron=S,
        persona_key=S,
        vinculo_persona=S,
    ),
    "fact_abordaje": table(
        abordaje_key=S,
        operador=S,
        usuario_key=S,
        estacion_key=L,
        tiempo_key=L,
        fecha_hora=NTZ,
        monto_gtq=D,
        es_transbordo=B,
    ),
    "fact_viaje_metroriel": table(
        viaje_id=L,
        usuario_key=S,
        estacion_origen_key=L,
        estacion_destino_key=L,
        tiempo_key_entrada=L,
        ts_entrada=NTZ,
        ts_salida=NTZ,
        duracion_s=I,
        monto_gtq=D,
    ),
    "mart_demanda": table(
        fecha=DATE,
        hora_del_dia=L,
        dia_habil=B,
        hora_pico=B,
        operador=S,
        operador_nombre=S,
        modo=S,
        zona_nombre=S,
        zona_tipo=S,
        abordajes=L,
        recaudo_gtq=D,
    ),
    "mart_cobertura_zona": table(
        zona_nombre=S,
        zona_tipo=S,
        estaciones_transmetro=L,
        paradas_transurbano=L,
        estaciones_metroriel=L,
        estaciones_aerometro=L,
        n_modos_con_servicio=I,
        abordajes_total=L,
    ),
    "mart_transbordo": table(n_operadores=L, combinacion=S, personas=L),
    "mart_metroriel_zona": table(
        zona_nombre=S,
        zona_tipo=S,
        estaciones_metroriel=L,
        en_trazado_metroriel=B,
        abordajes_otros_modos=L,
        abordajes_metroriel=L,
        ranking_demanda_otros_modos=L,
    ),
    "mart_metroriel_od": table(
        estacion_origen=S, zona_origen=S, estacion_destino=S, zona_destino=S, viajes=L, duracion_promedio_s=D
    ),
}

# Declarative key tests on the published tables.
KEY_CHECKS = {
    "dim_zona": {"unique": ["zona_key"], "not_null": ["zona_key"]},
    "dim_estacion": {"unique": ["estacion_key"], "not_null": ["estacion_key"]},
    "dim_usuario": {"unique": ["usuario_key"], "not_null": ["usuario_key"]},
    "dim_tiempo": {"unique": ["tiempo_key"], "not_null": ["tiempo_key"]},
    "fact_abordaje": {"unique": ["abordaje_key"], "not_null": ["abordaje_key", "estacion_key"]},
    "fact_viaje_metroriel": {"unique": ["viaje_id"], "not_null": ["viaje_id"]},
    "mart_cobertura_zona": {"unique": ["zona_nombre"], "not_null": ["zona_nombre"]},
    "mart_metroriel_zona": {"unique": ["zona_nombre"], "not_null": ["zona_nombre"]},
    "feat_usuario": {"unique": ["persona_key"], "not_null": ["persona_key"]},
}

BI_EXPORTS = [
    "mart_demanda",
    "mart_cobertura_zona",
    "mart_transbordo",
    "mart_metroriel_zona",
    "mart_metroriel_od",
]
