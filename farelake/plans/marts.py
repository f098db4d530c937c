"""Marts and the report queries answered on top of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake import config as C
from farelake.functions import columns as X

# ---- marts ---------------------------------------------------------------------------


def demand(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Boardings and revenue per date, hour, operator and zone.

    The fact is reduced to (operator, station, hour) before any dimension is joined: the reduced
    rows number at most stations x hours, so the star joins and the second sum are small.
    """
    cube = fact.groupBy("operador", "estacion_key", "tiempo_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(X.cents(F.col("monto_gtq"))).alias("c")
    )
    stations = dims["dim_estacion"].select("estacion_key", "zona_key")
    operators = dims["dim_operador"].select("operador", F.col("nombre").alias("operador_nombre"), "modo")
    return (
        cube.join(stations, "estacion_key")
        .join(dims["dim_zona"], "zona_key")
        .join(dims["dim_tiempo"], "tiempo_key")
        .join(operators, "operador")
        .groupBy(
            "fecha",
            "hora_del_dia",
            "dia_habil",
            "hora_pico",
            "operador",
            "operador_nombre",
            "modo",
            "zona_nombre",
            "zona_tipo",
        )
        .agg(F.sum("n").alias("abordajes"), X.from_cents(F.sum("c")).alias("recaudo_gtq"))
    )


def zone_universe(spark: SparkSession, zones: DataFrame) -> DataFrame:
    """The numbered city zones plus every municipality some catalogue names."""
    city = spark.range(1, C.CITY_ZONES + 1).select(
        F.concat(F.lit("Zona "), F.col("id").cast("string")).alias("zona_nombre"),
        F.lit("ZONA_GUATEMALA").alias("zona_tipo"),
    )
    towns = zones.filter(F.col("zona_tipo") == "MUNICIPIO").select("zona_nombre", "zona_tipo")
    return city.unionByName(towns).distinct()


def coverage(
    universe: DataFrame,
    stations_with_zone: DataFrame,
    demand_by_zone: DataFrame,
    counters: dict[str, Column],
    zone: str = "zona_nombre",
) -> DataFrame:
    """Per zone of ``universe``: one station count per mode, modes present, demand; zeros if none.

    ``stations_with_zone`` has the zone name; ``counters`` maps an output column to the predicate of
    the stations it counts; ``demand_by_zone`` has ``abordajes_total``.
    """
    per_zone = stations_with_zone.groupBy(zone).agg(
        *[F.count_if(cond).alias(name) for name, cond in counters.items()]
    )
    joined = universe.join(per_zone, zone, "left").join(demand_by_zone, zone, "left")
    counts = {name: F.coalesce(F.col(name), F.lit(0)) for name in counters}
    modes = sum(((c > 0).cast("int") for c in counts.values()), F.lit(0))
    return joined.select(
        *universe.columns,
        *[c.alias(name) for name, c in counts.items()],
        modes.cast("int").alias("n_modos_con_servicio"),
        F.coalesce("abordajes_total", F.lit(0)).cast("long").alias("abordajes_total"),
    )


COVERAGE_COUNTERS = {
    "estaciones_transmetro": C.TRANSMETRO,
    "paradas_transurbano": C.TRANSURBANO,
    "estaciones_metroriel": C.METRORIEL,
    "estaciones_aerometro": C.AEROMETRO,
}


def zone_coverage(spark: SparkSession, dims: dict[str, DataFrame], mart_demand: DataFrame) -> DataFrame:
    stations = dims["dim_estacion"].join(dims["dim_zona"], "zona_key").select("zona_nombre", "operador")
    by_zone = mart_demand.groupBy("zona_nombre").agg(F.sum("abordajes").alias("abordajes_total"))
    counters = {name: F.col("operador") == op for name, op in COVERAGE_COUNTERS.items()}
    return coverage(zone_universe(spark, dims["dim_zona"]), stations, by_zone, counters)


def multi_operator(pairs: DataFrame, owners: DataFrame, card: str, person: str, mode: str) -> DataFrame:
    """Persons by the combination of modes they use.

    ``pairs`` (card, mode) is made distinct before the large join, which turns a hot card into at
    most one row per mode; the join then needs no care for skew.
    """
    used = pairs.select(card, mode).distinct().join(owners.select(card, person), card)
    per_person = used.groupBy(person).agg(F.array_sort(F.collect_set(mode)).alias("_modes"))
    return (
        per_person.groupBy(
            F.size("_modes").cast("long").alias("n_operadores"),
            F.array_join("_modes", " + ").alias("combinacion"),
        )
        .agg(F.count(F.lit(1)).alias("personas"))
    )


def served_demand(
    cov: DataFrame, mart_demand: DataFrame, own: str, served_col: str, zone: str = "zona_nombre"
) -> DataFrame:
    """Demand of the other modes against one mode's own, per zone, ranked.

    Both sums come from one pass over the demand. The rank is over zones, a bounded list.
    """
    is_own = F.col("operador") == own
    sums = mart_demand.groupBy(zone).agg(
        F.sum(F.when(~is_own, F.col("abordajes"))).alias("_others"),
        F.sum(F.when(is_own, F.col("abordajes"))).alias("_own"),
    )
    others = F.coalesce("_others", F.lit(0)).cast("long")
    return cov.join(sums, zone, "left").select(
        zone,
        "zona_tipo",
        served_col,
        (F.col(served_col) > 0).alias("en_trazado_metroriel"),
        others.alias("abordajes_otros_modos"),
        F.coalesce("_own", F.lit(0)).cast("long").alias("abordajes_metroriel"),
        F.rank().over(Window.orderBy(others.desc())).cast("long").alias("ranking_demanda_otros_modos"),
    )


def origin_destination(trips: DataFrame, stations: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips and mean duration per pair of stations. Trips are summed by key before the joins."""
    pairs = trips.groupBy("estacion_origen_key", "estacion_destino_key").agg(
        F.count(F.lit(1)).alias("viajes"), F.avg("duracion_s").alias("duracion_promedio_s")
    )
    named = stations.join(zones, "zona_key").select("estacion_key", "codigo_nativo", "zona_nombre")
    origin = named.toDF("estacion_origen_key", "estacion_origen", "zona_origen")
    target = named.toDF("estacion_destino_key", "estacion_destino", "zona_destino")
    # native codes are unique per operator, so a pair of keys is a pair of codes
    return (
        pairs.join(origin, "estacion_origen_key")
        .join(target, "estacion_destino_key")
        .select(
            "estacion_origen", "zona_origen", "estacion_destino", "zona_destino", "viajes",
            "duracion_promedio_s",
        )
    )


def build(
    spark: SparkSession, dims: dict[str, DataFrame], facts: dict[str, DataFrame], mart_demand: DataFrame
) -> dict[str, DataFrame]:
    """All marts but the demand cube, which the caller has published and passes in."""
    cov = zone_coverage(spark, dims, mart_demand)
    return {
        "mart_cobertura_zona": cov,
        "mart_transbordo": multi_operator(
            facts["fact_abordaje"], dims["dim_usuario"], "usuario_key", "persona_key", "operador"
        ),
        "mart_metroriel_zona": served_demand(cov, mart_demand, C.METRORIEL, "estaciones_metroriel"),
        "mart_metroriel_od": origin_destination(
            facts["fact_viaje_metroriel"], dims["dim_estacion"], dims["dim_zona"]
        ),
    }


# ---- reports ------------------------------------------------------------------------------


def by_hour_and_mode(mart_demand: DataFrame) -> DataFrame:
    return mart_demand.groupBy("hora_del_dia", "operador").agg(F.sum("abordajes").alias("abordajes"))


def by_zone_and_mode(mart_demand: DataFrame) -> DataFrame:
    return mart_demand.groupBy("zona_nombre", "operador").agg(F.sum("abordajes").alias("abordajes"))


def peak_share(mart_demand: DataFrame) -> DataFrame:
    total = F.sum("abordajes")
    peak = F.coalesce(F.sum(F.when(F.col("hora_pico"), F.col("abordajes"))), F.lit(0))
    return mart_demand.agg(
        total.alias("abordajes"), peak.alias("abordajes_pico"), F.round(X.share(peak, total), 6).alias("parte_pico")
    )


def weekday_mean(mart_demand: DataFrame) -> DataFrame:
    """Mean boardings per day, working days against weekends."""
    per_day = mart_demand.groupBy("fecha", "dia_habil").agg(F.sum("abordajes").alias("n"))
    return per_day.groupBy("dia_habil").agg(
        F.count(F.lit(1)).alias("dias"),
        F.sum("n").alias("abordajes"),
        F.round(X.share(F.sum("n"), F.count(F.lit(1))), 6).alias("media_por_dia"),
    )


def trips_in(fact: DataFrame, ts: str, start, end) -> DataFrame:
    """The official count of trips in ``[start, end)``."""
    t = F.col(ts)
    return fact.filter((t >= X.midnight(start)) & (t < X.midnight(end))).agg(
        F.count(F.lit(1)).alias("viajes")
    )


def active_users(person_features: DataFrame, trips_col: str = "viajes_30d") -> DataFrame:
    return person_features.agg(
        F.count_if(F.col(trips_col) > 0).alias("activos"), F.count(F.lit(1)).alias("personas")
    )


def same_zone_share(od: DataFrame) -> DataFrame:
    same = F.coalesce(
        F.sum(F.when(F.col("zona_origen") == F.col("zona_destino"), F.col("viajes"))), F.lit(0)
    )
    total = F.sum("viajes")
    return od.agg(
        total.alias("viajes"), same.alias("misma_zona"), F.round(X.share(same, total), 6).alias("parte")
    )


def zone_matrix(od: DataFrame) -> DataFrame:
    return od.groupBy("zona_origen", "zona_destino").agg(F.sum("viajes").alias("viajes"))


def per_station(mart_demand: DataFrame, stations: DataFrame) -> DataFrame:
    """Boardings per station of each operator."""
    n = stations.groupBy("operador").agg(F.count(F.lit(1)).alias("estaciones"))
    b = mart_demand.groupBy("operador").agg(F.sum("abordajes").alias("abordajes"))
    return b.join(n, "operador").select(
        "operador",
        "estaciones",
        "abordajes",
        F.round(X.share(F.col("abordajes"), F.col("estaciones")), 6).alias("por_estacion"),
    )


def top_zones(served: DataFrame, n: int, unserved_only: bool = True) -> DataFrame:
    """The ``n`` zones with most demand of other modes, by default those the mode does not reach."""
    rows = served.filter(~F.col("en_trazado_metroriel")) if unserved_only else served
    return (
        rows.select("zona_nombre", "abordajes_otros_modos")
        .orderBy(F.desc("abordajes_otros_modos"), "zona_nombre")
        .limit(n)
    )


def busiest_origins(od: DataFrame, n: int = 1) -> DataFrame:
    return (
        od.groupBy("estacion_origen", "zona_origen")
        .agg(F.sum("viajes").alias("viajes"))
        .orderBy(F.desc("viajes"), "estacion_origen")
        .limit(n)
    )
