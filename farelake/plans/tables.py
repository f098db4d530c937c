"""The lake's operators on the benchmark tables (orders, lineitem, events, customer, …).

Roles: ``events`` and ``lineitem`` are boardings of two operators, ``customer`` and ``supplier`` their
station catalogues, ``nation``/``region`` the zones, ``lineitem`` also the reads with duplicates,
``orders`` the trips behind the cut features, and ``events`` the change log of a registry. Every query
calls the library functions the transit flow itself uses.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import config as C
from farelake.functions import columns as X
from farelake.operators import cdc, dedup, evaluate, quality
from farelake.operators.quality import Rule
from farelake.plans import cut_features as CF
from farelake.plans import gold, marts, person_features
from farelake.session import materialise
from farelake.sources.bronze import newest_load

SALT = "farelake-demo"
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate"]
AS_OF = datetime(2001, 6, 1)

CUTS = {"A": date(1998, 7, 1), "B": date(1999, 7, 1), "C": date(2000, 7, 1)}
WINDOWS = C.CutWindows(window=730, short=180, half=365, horizon=365, min_trips=2)
STATUSES = ["F", "O", "P"]

EVENT_CUTS = {"E": date(2024, 1, 20)}
EVENT_WINDOWS = C.CutWindows(window=14, short=3, half=7, horizon=7, min_trips=2)
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

COSTS = C.CostScenario()


# Declared, not inferred: opening a table then costs no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def _k(props):
    return F.from_json(props, "k int")["k"]


# ---- typing, loads, counts ---------------------------------------------------------------


def stg_events_typed(spark, sf):
    e = table(spark, sf, "events").withColumn("k", _k(F.col("props")))
    code = F.pmod(F.col("k"), 10)
    ts = F.col("ts")
    return e.select(
        "event_id",
        X.cents(F.col("value")).alias("centavos"),
        F.col("k").cast("long").alias("k"),
        X.hour_key(ts).alias("tiempo_key"),
        X.hour_start(ts).alias("hora_ts"),
        X.local_from_utc(ts).alias("ts_local"),
        F.hour(ts).cast("long").alias("hora"),
        X.peak_hour(ts).alias("hora_pico"),
        X.weekend(ts).alias("fin_de_semana"),
        X.status_label(code).alias("estado_desc"),
        (F.col("event_type") == "purchase").alias("es_compra"),
        X.blank_to_null(F.regexp_replace("event_type", "^error$", "")).alias("tipo"),
    )


def latest_partition(spark, sf):
    o = table(spark, sf, "orders").withColumn("carga", F.trunc(F.col("o_orderdate").cast("date"), "month"))
    return newest_load(o, "carga")


def reconcile_counts(spark, sf):
    """Expected rows from the dense keys against loaded rows."""
    keys = {
        "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
        "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "events": "event_id",
    }
    frames = {n: table(spark, sf, n) for n in keys}
    expected = quality.union_all(
        [
            frames[n].agg((F.max(k).cast("long") + 1).alias("filas_esperadas")).withColumn("tabla", F.lit(n))
            for n, k in keys.items()
        ]
    )
    return quality.reconcile(expected, quality.table_counts(frames))


def table_fingerprints(spark, sf):
    """Amounts in cents and times in microseconds, whose text is the same everywhere."""
    money, time = {"c_acctbal", "o_totalprice", "value"}, {"o_orderdate", "ts"}

    def plain(name):
        df = table(spark, sf, name)
        whole = lambda c: F.unix_micros(F.col(c).cast("timestamp")) if c in time else F.round(F.col(c) * 100).cast("long")
        return df.select(*[whole(c).alias(c) if c in money | time else F.col(c) for c in df.columns])

    return quality.union_all([quality.fingerprint(plain(n), n) for n in ("customer", "orders", "events")])


# ---- duplicates and rules -----------------------------------------------------------------


def dedup_first(spark, sf):
    return dedup.first_reads(table(spark, sf, "lineitem"), LINE_KEY, LINE_ORDER)


def line_rules() -> list[Rule]:
    return [
        Rule(C.REASON_FUTURE, F.col("l_shipdate") > F.lit(AS_OF).cast("timestamp_ntz"), "posterior a la carga"),
        Rule(C.REASON_NO_STOP, F.col("l_tax") == 0, "sin parada"),
        Rule(
            C.REASON_REJECTED,
            F.col("l_returnflag") == "R",
            F.concat(F.lit("estado "), "l_returnflag"),
            fallback=True,
        ),
    ]


def _line_id():
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def quarantine_union(spark, sf):
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    again = Rule(C.REASON_DUPLICATE, F.lit(True), "lectura repetida")
    open_order = Rule(C.REASON_NO_EXIT, F.col("o_orderstatus") == "P", "sin cierre")
    ship = F.col("l_shipdate")
    return quality.union_all(
        [
            quality.rejected(
                quality.with_reasons(dedup.repeat_reads(lines, LINE_KEY, LINE_ORDER), [again]),
                "lineitem", _line_id(), ship,
            ),
            quality.rejected(quality.with_reasons(lines, line_rules()), "lineitem", _line_id(), ship),
            quality.rejected(
                quality.with_reasons(orders, [open_order]), "orders", F.col("o_orderkey"), F.col("o_orderdate")
            ),
        ]
    )


def valid_rows(spark, sf):
    return quality.accepted(quality.with_reasons(dedup_first(spark, sf), line_rules()))


def dq_unique_not_null(spark, sf):
    frames = {n: table(spark, sf, n) for n in ("lineitem", "orders", "customer", "events")}
    return quality.check_report(
        frames,
        {
            "lineitem": {"unique": [LINE_KEY], "not_null": ["l_orderkey", "l_shipdate"]},
            "orders": {"unique": ["o_orderkey", "o_custkey"], "not_null": ["o_orderkey"]},
            "customer": {"unique": ["c_custkey"], "not_null": ["c_custkey", "c_nationkey"]},
            "events": {"unique": ["event_id"], "not_null": ["event_id", "props"]},
        },
    )


def surrogate_fact_id(spark, sf):
    cols = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    return dedup.content_ids(table(spark, sf, "lineitem").select(*cols), "fila_id")


def surrogate_fact_rank(spark, sf):
    cols = ["l_returnflag", "l_orderkey", "l_linenumber", "l_linestatus"]
    return dedup.ranked_ids(table(spark, sf, "lineitem").select(*cols), cols, "fila_id")


# ---- cards and names -------------------------------------------------------------------------


def _cards(df: DataFrame, key: str) -> DataFrame:
    """The three card formats, the missing card and an unreadable one, dealt out by key."""
    n = F.col(key).cast("string")
    kind = F.pmod(F.col(key), 5)
    card = (
        F.when(kind == 0, F.concat(F.lit("TC-"), F.lpad(n, 8, "0")))
        .when(kind == 1, F.lpad(n, 10, "0"))
        .when(kind == 2, F.concat(F.lit("MR"), F.lpad(n, 7, "0")))
        .when(kind == 3, F.lit("SIN-TARJETA"))
        .otherwise(F.concat(F.lit("x"), n))
    )
    return df.withColumn("tarjeta", card)


def key_class(spark, sf):
    cards = _cards(table(spark, sf, "customer"), "c_custkey")
    op = X.card_operator(F.col("tarjeta"))
    return cards.select(
        "c_custkey",
        "tarjeta",
        op.alias("operador_detectado"),
        F.when(op.isin(C.LINKED_OPERATORS), X.card_number(F.col("tarjeta"))).alias("numero"),
    )


def pseudonym(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", X.pseudonym(SALT, F.lit("CLIENTE"), F.col("c_name")).alias("usuario_key")
    )


def _card_holders(spark, sf):
    c = _cards(table(spark, sf, "customer"), "c_custkey").select("tarjeta")
    s = _cards(table(spark, sf, "supplier"), "s_suppkey").select("tarjeta")
    none = F.lit(None).cast("string")
    return c.unionByName(s).distinct().select(
        X.card_operator(F.col("tarjeta")).alias("operador"),
        F.col("tarjeta").alias("llave_nativa"),
        none.alias("perfil"),
        none.alias("zona_residencia"),
        none.alias("estado_padron"),
    )


def person_key(spark, sf):
    users = gold.user_dimension(_card_holders(spark, sf), SALT)
    return users.select("usuario_key", "operador", "persona_key", "vinculo_persona")


def title_case(spark, sf):
    """Zone names of every part and customer segment, conformed."""
    parts = table(spark, sf, "part").select(
        F.upper(F.col("p_name")).alias("crudo"), F.concat(F.lit("Z"), F.col("p_size")).alias("sector")
    )
    raw = parts.select(F.explode(F.array("crudo", "sector")).alias("crudo"))
    return raw.groupBy("crudo").agg(F.count(F.lit(1)).alias("filas")).select(
        "crudo", X.canonical_zone(F.col("crudo")).alias("zona"),
        X.zone_kind(X.canonical_zone(F.col("crudo"))).alias("tipo"), "filas",
    )


# ---- change log -----------------------------------------------------------------------------------


def registry_log(events: DataFrame) -> DataFrame:
    """Events as a change log: signup inserts, error deletes without body, the rest update.

    The residence is left out of some updates so that fill-forward has something to do.
    """
    op = (
        F.when(F.col("event_type") == "signup", "INSERT")
        .when(F.col("event_type") == "error", "DELETE")
        .otherwise("UPDATE")
    )
    k = _k(F.col("props"))
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts").alias("commit_ts"),
        op.alias("op"),
        F.col("user_id").alias("tarjeta"),
        F.when(op != "DELETE", F.col("event_type")).alias("perfil"),
        F.when((op != "DELETE") & (F.pmod(k, 3) != 0), F.concat(F.lit("Zona "), k.cast("string"))).alias(
            "zona_residencia"
        ),
    )


BODY = ["perfil", "zona_residencia"]


def cdc_current(spark, sf):
    state = cdc.current_state(registry_log(table(spark, sf, "events")), "tarjeta", BODY)
    return state.withColumn("estado_vigente", cdc.registry_status(F.col("ultima_operacion")))


def cdc_scd2(spark, sf):
    return cdc.versions(registry_log(table(spark, sf, "events")), "tarjeta", BODY)


def scd2_asof_lookup(spark, sf):
    """Profile each user had when they made a purchase, from the history of their other events."""
    e = table(spark, sf, "events")
    history = cdc.versions(registry_log(e.filter(F.col("event_type") != "purchase")), "tarjeta", BODY)
    points = e.filter(F.col("event_type") == "purchase").select(
        "event_id", F.col("user_id").alias("tarjeta"), "ts", "value"
    )
    return cdc.as_of(points, history, "tarjeta", "ts", [*BODY, "estado"])


# ---- dimensions -------------------------------------------------------------------------------------


def dim_zone(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_name").alias("zona_canonica"))
    r = table(spark, sf, "region").select(F.col("r_name").alias("zona_canonica"))
    return gold.zone_dimension(gold.distinct_zones([n, r]))


def _nation_zones(spark, sf):
    return gold.zone_dimension(
        gold.distinct_zones([table(spark, sf, "nation").select(F.col("n_name").alias("zona_canonica"))])
    )


def _station_catalogue(spark, sf):
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("zona_canonica"))
    none = F.lit(None).cast("double")

    def part(name, operator, key, label, nation, lat):
        return (
            table(spark, sf, name)
            .withColumnRenamed(nation, "n_nationkey")
            .join(nations, "n_nationkey", "left")
            .select(
                F.lit(operator).alias("operador"),
                F.col(key).cast("string").alias("codigo_nativo"),
                F.col(label).alias("nombre"),
                "zona_canonica",
                (F.col(lat) if lat else none).alias("lat"),
                none.alias("lon"),
            )
        )

    return quality.union_all(
        [
            part("customer", "CUSTOMER", "c_custkey", "c_name", "c_nationkey", "c_acctbal"),
            part("supplier", "SUPPLIER", "s_suppkey", "s_name", "s_nationkey", None),
        ]
    )


def dim_station(spark, sf):
    return gold.station_dimension(_station_catalogue(spark, sf), _nation_zones(spark, sf), small=False)


def dim_hour(spark, sf):
    return gold.hour_dimension(gold.event_span(table(spark, sf, "events"), "ts"))


def dim_user(spark, sf):
    """Users seen buying, with the registry state their signups and errors leave."""
    e = table(spark, sf, "events")
    seen = e.filter(F.col("event_type") == "purchase").select(F.col("user_id").alias("tarjeta")).distinct()
    log = registry_log(e.filter(F.col("event_type").isin("signup", "error")))
    state = cdc.current_state(log, "tarjeta", BODY)
    none = F.coalesce(cdc.registry_status(F.col("ultima_operacion")), F.lit("SIN_PADRON"))
    status = F.when(F.col("ultima_operacion").isNull(), "SIN_PADRON").otherwise(none)
    cards = seen.join(state, "tarjeta", "left").select(
        F.lit(C.TRANSMETRO).alias("operador"),
        F.concat(F.lit("TC-"), F.lpad(F.col("tarjeta").cast("string"), 8, "0")).alias("llave_nativa"),
        *BODY,
        status.alias("estado_padron"),
    )
    return gold.user_dimension(cards, SALT)


def _inline_modes(spark):
    rows = [(t, t.title(), "digital" if t in ("click", "view") else "caja") for t in EVENT_TYPES]
    return gold.inline(spark, rows, ["operador", "nombre", "modo"])


def dim_inline(spark, sf):
    """The inline operator relation, joined to what it describes."""
    n = table(spark, sf, "events").groupBy(F.col("event_type").alias("operador")).agg(
        F.count(F.lit(1)).alias("eventos")
    )
    return n.join(_inline_modes(spark), "operador")


# ---- facts ----------------------------------------------------------------------------------------------


def _boardings(spark, sf):
    e = table(spark, sf, "events").select(
        F.lit("CUSTOMER").alias("operador"),
        F.col("event_id").cast("string").alias("id_origen"),
        F.col("user_id").cast("string").alias("tarjeta"),
        F.col("user_id").cast("string").alias("codigo_estacion"),
        F.col("ts").alias("fecha_hora"),
        F.col("value").alias("monto_gtq"),
        F.lit(False).alias("es_transbordo"),
    )
    line = dedup_first(spark, sf).select(
        F.lit("SUPPLIER").alias("operador"),
        _line_id().alias("id_origen"),
        F.col("l_partkey").cast("string").alias("tarjeta"),
        F.col("l_suppkey").cast("string").alias("codigo_estacion"),
        F.col("l_shipdate").alias("fecha_hora"),
        F.col("l_extendedprice").alias("monto_gtq"),
        (F.col("l_returnflag") == "R").alias("es_transbordo"),
    )
    return e.unionByName(line)


def fact_boarding(spark, sf):
    return gold.boarding_fact(_boardings(spark, sf), dim_station(spark, sf), SALT)


def _rail(spark, sf):
    """Nations as stations of one line, regions as their zones."""
    zones = gold.zone_dimension(
        gold.distinct_zones([table(spark, sf, "region").select(F.col("r_name").alias("zona_canonica"))])
    )
    regions = table(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("zona_canonica"))
    none = F.lit(None).cast("double")
    catalogue = table(spark, sf, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lit(C.METRORIEL).alias("operador"),
        F.col("n_nationkey").cast("string").alias("codigo_nativo"),
        F.col("n_name").alias("nombre"),
        "zona_canonica",
        none.alias("lat"),
        none.alias("lon"),
    )
    return zones, gold.station_dimension(catalogue, zones)


def _rail_trips(spark, sf):
    """From the supplier's nation to the customer's, from order to shipment."""
    lines = dedup_first(spark, sf)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("viaje_id"),
            F.col("o_custkey").cast("string").alias("tarjeta_mr"),
            F.col("s_nationkey").alias("estacion_entrada"),
            F.col("c_nationkey").alias("estacion_salida"),
            F.col("o_orderdate").alias("ts_entrada"),
            F.col("l_shipdate").alias("ts_salida"),
            F.datediff("l_shipdate", "o_orderdate").alias("duracion_s"),
            F.col("l_extendedprice").alias("monto_gtq"),
        )
    )


def fact_trip_roles(spark, sf):
    _, stations = _rail(spark, sf)
    return gold.rail_trip_fact(_rail_trips(spark, sf), stations, SALT)


# ---- marts -------------------------------------------------------------------------------------------------


def _operators(spark):
    rows = [("CUSTOMER", "Clientes", "digital", 1), ("SUPPLIER", "Proveedores", "carga", 2)]
    return gold.inline(spark, rows, ["operador", "nombre", "modo", "unidades_infra"])


def _demand_parts(spark, sf):
    """Dimensions, fact and demand cube over the same station keys."""
    stations = dim_station(spark, sf)
    events = _boardings(spark, sf)
    # repeated reads do not move the first and last hour, so the span needs no deduplication
    shipped = table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("ts"))
    times = table(spark, sf, "events").select("ts").unionByName(shipped).withColumnRenamed("ts", "fecha_hora")
    dims = {
        "dim_estacion": stations,
        "dim_zona": _nation_zones(spark, sf),
        "dim_tiempo": gold.hour_dimension(gold.event_span(times)),
        "dim_operador": _operators(spark),
    }
    fact = gold.boarding_fact(events, stations, SALT)
    return dims, fact, marts.demand(fact, dims)


def mart_demand(spark, sf):
    return _demand_parts(spark, sf)[2]


COVERAGE = {"estaciones_cliente": "CUSTOMER", "estaciones_metroriel": "SUPPLIER"}


def _coverage(spark, sf, dims, cube):
    zones = _nation_zones(spark, sf)
    regions = table(spark, sf, "region").select(
        F.col("r_name").alias("zona_nombre"), X.zone_kind(F.col("r_name")).alias("zona_tipo")
    )
    universe = zones.select("zona_nombre", "zona_tipo").unionByName(regions).distinct()
    stations = dims["dim_estacion"].join(zones, "zona_key").select("zona_nombre", "operador")
    by_zone = cube.groupBy("zona_nombre").agg(F.sum("abordajes").alias("abordajes_total"))
    counters = {n: F.col("operador") == op for n, op in COVERAGE.items()}
    return marts.coverage(universe, stations, by_zone, counters)


def mart_coverage(spark, sf):
    dims, _, cube = _demand_parts(spark, sf)
    return _coverage(spark, sf, dims, cube)


def mart_multi_mode(spark, sf):
    """Households (two neighbouring customers) by the combination of order priorities they use."""
    owners = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.floor(F.col("c_custkey") / 2).alias("persona")
    )
    return marts.multi_operator(table(spark, sf, "orders"), owners, "o_custkey", "persona", "o_orderpriority")


def _served(spark, sf):
    dims, _, cube = _demand_parts(spark, sf)
    return marts.served_demand(_coverage(spark, sf, dims, cube), cube, "SUPPLIER", "estaciones_metroriel")


def mart_served_rank(spark, sf):
    return _served(spark, sf)


def mart_od(spark, sf):
    zones, stations = _rail(spark, sf)
    od = marts.origin_destination(fact_trip_roles(spark, sf), stations, zones)
    return od.withColumn("duracion_promedio_s", F.round("duracion_promedio_s", 6))


# ---- reports -----------------------------------------------------------------------------------------------------


def bi_hour_mode(spark, sf):
    return marts.by_hour_and_mode(mart_demand(spark, sf))


def bi_zone_mode(spark, sf):
    return marts.by_zone_and_mode(mart_demand(spark, sf))


def bi_peak_share(spark, sf):
    return marts.peak_share(mart_demand(spark, sf))


def bi_weekday_mean(spark, sf):
    return marts.weekday_mean(mart_demand(spark, sf))


def bi_monthly_trips(spark, sf):
    return marts.trips_in(_boardings(spark, sf), "fecha_hora", date(1998, 6, 1), date(1998, 7, 1))


def bi_active_users(spark, sf):
    return marts.active_users(_person_features(spark, sf), "viajes_7d")


def bi_same_zone_share(spark, sf):
    return marts.same_zone_share(mart_od(spark, sf))


def bi_zone_matrix(spark, sf):
    return marts.zone_matrix(mart_od(spark, sf))


def bi_per_station(spark, sf):
    dims, _, cube = _demand_parts(spark, sf)
    return marts.per_station(cube, dims["dim_estacion"])


def bi_top_zones(spark, sf):
    return marts.top_zones(_served(spark, sf), 5, unserved_only=False)


def bi_busiest_origin(spark, sf):
    return marts.busiest_origins(mart_od(spark, sf), 3)


# ---- features -------------------------------------------------------------------------------------------------------


def _person_events(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("persona_key"),
        F.col("event_type").alias("operador"),
        F.col("ts").alias("fecha_hora"),
        F.col("value").alias("monto_gtq"),
        F.concat(F.lit("Zona "), F.pmod(_k(F.col("props")), F.lit(25)).cast("string")).alias("zona"),
    )


def _person_features(spark, sf):
    return person_features.build(_person_events(spark, sf))


def feat_person(spark, sf):
    f = _person_features(spark, sf)
    for c in ("prop_hora_pico", "prop_fin_de_semana", "gasto_promedio_gtq"):
        f = f.withColumn(c, F.round(c, 6))
    return f.withColumn("dias_desde_ultimo_viaje", F.col("dias_desde_ultimo_viaje").cast("long"))


def trips(spark, sf):
    """Orders as boardings: unit customer, card (customer, priority), operator status."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("unidad_id"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), F.substring("o_orderpriority", 1, 1)).alias(
            "tarjeta"
        ),
        F.col("o_orderstatus").alias("operador"),
        F.col("o_orderdate").alias("fecha_hora"),
        F.col("o_totalprice").alias("monto_gtq"),
        F.substring("o_orderpriority", 3, 20).alias("zona"),
    )


def trip_log(spark, sf):
    """A registry log out of the orders: urgent orders insert, some low ones delete, others update."""
    o = table(spark, sf, "orders")
    gone = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    op = F.when(gone, "DELETE").when(F.col("o_orderpriority") == "1-URGENT", "INSERT").otherwise("UPDATE")
    return o.select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("unidad_id"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), F.substring("o_orderpriority", 1, 1)).alias(
            "tarjeta"
        ),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderdate").alias("commit_ts"),
        op.alias("op"),
        F.when(op != "DELETE", F.col("o_orderpriority")).alias("perfil"),
    )


def cut_features(spark, sf, cuts=None, **kw):
    return CF.build(
        trips(spark, sf), trip_log(spark, sf), cuts or CUTS, WINDOWS, STATUSES, **kw
    )


def rounded(df: DataFrame) -> DataFrame:
    """Ratios to six digits, whole counts as long: the form compared with SQL."""
    form = {"double": lambda c: F.round(c, 6).alias(c), "int": lambda c: F.col(c).cast("long").alias(c)}
    return df.select(*[form.get(kind, F.col)(name) for name, kind in df.dtypes])


def feat_cut_a(spark, sf):
    return rounded(cut_features(spark, sf, {"A": CUTS["A"]}, labels="require"))


def feat_cuts_stacked(spark, sf):
    return rounded(cut_features(spark, sf))


def feat_cut_events(spark, sf):
    """The same features where the hour of day matters."""
    e = table(spark, sf, "events")
    unit = F.concat(F.lit("P"), F.col("user_id").cast("string"))
    ev = e.select(
        unit.alias("unidad_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("tarjeta"),
        F.col("event_type").alias("operador"),
        F.col("ts").alias("fecha_hora"),
        F.col("value").alias("monto_gtq"),
        F.pmod(_k(F.col("props")), F.lit(25)).cast("string").alias("zona"),
    )
    log = registry_log(e).withColumn("unidad_id", F.concat(F.lit("P"), F.col("tarjeta").cast("string")))
    return rounded(CF.build(ev, log, EVENT_CUTS, EVENT_WINDOWS, EVENT_TYPES))


def population_by_cut(spark, sf):
    return CF.population(cut_features(spark, sf))


def unit_counterfactual(spark, sf):
    return quality.union_all(
        [
            CF.card_counterfactual(trips(spark, sf), trip_log(spark, sf), CUTS[c], WINDOWS).select(
                F.lit(c).alias("corte"), "*"
            )
            for c in ("A", "B")
        ]
    )


def subpopulation_share(spark, sf):
    f = cut_features(spark, sf, {"A": CUTS["A"]})
    return CF.subpopulation(f, F.col("unidad_id").startswith("P1"))


# ---- audits ------------------------------------------------------------------------------------------------------------


def leak_audit(spark, sf):
    """Cut A from all data against cut A from data before the cut: every difference counts."""
    cut = {"A": CUTS["A"]}
    full = cut_features(spark, sf, cut, labels="none").drop("etiqueta")
    known = cut_features(spark, sf, cut, labels="none", data_until=CUTS["A"]).drop("etiqueta")
    return quality.table_diff(full, known, ["unidad_id"]).select(
        "filas_a", "filas_b", "solo_a", "solo_b", "diferencias"
    )


def _scored(feats: DataFrame) -> DataFrame:
    """A fixed recency score in [0, 1], to six digits, and who to contact."""
    score = F.round(F.least(F.lit(1.0), F.col("dias_desde_ultimo_viaje") / WINDOWS.window), 6)
    return feats.withColumn("puntaje", score).withColumn("contactar", (score >= 0.25).cast("int"))


def invariance_audit(spark, sf):
    """Scores at cut B with and without the year that follows."""
    cut = {"B": CUTS["B"]}
    cols = ["unidad_id", "tarjetas", "puntaje", "contactar"]
    short = _scored(
        cut_features(spark, sf, cut, labels="none", data_until=CUTS["B"])
    ).select(*cols)
    long = _scored(cut_features(spark, sf, cut, labels="none")).select(*cols)
    return quality.table_diff(short, long, ["unidad_id"]).select(
        "filas_a", "filas_b", "solo_a", "solo_b", "diferencias"
    )


def table_diff(spark, sf):
    """Orders of two adjacent years' customers: a comparison that does find differences."""
    o = table(spark, sf, "orders")

    def year(y):
        return o.filter(F.year("o_orderdate") == y).groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("pedidos"),
            F.min("o_orderstatus").alias("estado"),
            (F.sum(X.cents(F.col("o_totalprice"))) / 100.0).alias("total"),
        )

    return quality.table_diff(year(1997), year(1998), ["o_custkey"])


def only_one_side(spark, sf):
    """Customers who ordered in one of two years only, both directions."""
    o = table(spark, sf, "orders")
    a = o.filter(F.year("o_orderdate") == 1997).select("o_custkey").distinct()
    b = o.filter(F.year("o_orderdate") == 1998).select("o_custkey").distinct()
    return quality.only_in(a, b, ["o_custkey"]).withColumn("lado", F.lit("1997")).unionByName(
        quality.only_in(b, a, ["o_custkey"]).withColumn("lado", F.lit("1998"))
    )


# ---- evaluation --------------------------------------------------------------------------------------------------------------


def _labelled(spark, sf, cut="A"):
    return cut_features(spark, sf, {cut: CUTS[cut]})


def folds_stratified(spark, sf):
    f = evaluate.stratified_folds(_labelled(spark, sf))
    return f.withColumn("fold", F.col("fold").cast("long")).withColumn("etiqueta", F.col("etiqueta").cast("long"))


def _baselines_by_fold(spark, sf):
    feats = materialise(_labelled(spark, sf))  # read by the folds and by the scores
    folded = evaluate.attach_folds(feats, evaluate.stratified_folds(feats))
    long = evaluate.baseline_scores(folded, WINDOWS)
    both = F.array(
        *[
            F.struct(F.lit(k).alias("fold"), F.when(F.col("_f") == k, "val").otherwise("train").alias("split"))
            for k in range(C.FOLDS)
        ]
    )
    rows = long.withColumnRenamed("fold", "_f").withColumn("_e", F.explode(both)).select(
        "modelo", "_e.*", "etiqueta", "puntaje"
    )
    return evaluate.ranking_metrics(rows, ["modelo", "fold", "split"], "puntaje")


def baseline_ap_auc(spark, sf):
    rows = evaluate.baseline_scores(_labelled(spark, sf), WINDOWS)
    m = evaluate.ranking_metrics(rows, ["modelo"], "puntaje")
    return m.withColumn("pr_auc", F.round("pr_auc", 6)).withColumn("roc_auc", F.round("roc_auc", 6))


def fold_summary(spark, sf):
    return rounded(evaluate.fold_summary(_baselines_by_fold(spark, sf)))


def threshold_curve(spark, sf):
    curve = evaluate.threshold_curve(_scored(_labelled(spark, sf)), "puntaje", COSTS)
    return curve.withColumn("precision", F.round("precision", 6)).withColumn("recall", F.round("recall", 6))


def threshold_best(spark, sf):
    t = evaluate.threshold_choices(_scored(_labelled(spark, sf)), "puntaje", COSTS)
    for c in ("umbral", "precision", "recall"):
        t = t.withColumn(c, F.round(c, 6))
    return t


def confusion_at(spark, sf):
    c = evaluate.confusion(_scored(_labelled(spark, sf, "B")), "puntaje", 0.25, COSTS)
    return c.withColumn("precision", F.round("precision", 6)).withColumn("recall", F.round("recall", 6))


PROFILE = ["viajes_730d", "dias_desde_ultimo_viaje", "tendencia_365d", "tarifa_promedio"]


def segment_profile(spark, sf):
    seg = F.least(F.floor(F.col("viajes_730d") / 2), F.lit(4)).cast("long")
    feats = rounded(_labelled(spark, sf)).withColumn("segmento", seg)
    p = evaluate.segment_profile(feats, "segmento", PROFILE).withColumn(
        "tasa_abandono", F.round("tasa_abandono", 6)
    )
    for c in PROFILE:  # the middle of two six-digit values has seven digits
        p = p.withColumn(c, F.round(c, 7))
    return p


# ---- flagship --------------------------------------------------------------------------------------------------------------------


def demand_by_month_and_nation(spark, sf):
    """First reads of each line, joined to customer and nation: trips and cents per month."""
    lines = dedup_first(spark, sf).select("l_orderkey", "l_extendedprice", "l_shipdate")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    return (
        lines.join(orders, "l_orderkey")
        .groupBy("o_custkey", month.alias("mes"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(X.cents(F.col("l_extendedprice"))).alias("c"))
        .join(customers, "o_custkey")
        .join(nations, "c_nationkey")
        .groupBy("mes", "n_name")
        .agg(F.sum("n").alias("lineas"), F.sum("c").alias("centavos"))
    )


QUERIES = {
    f.__name__: f
    for f in [
        demand_by_month_and_nation,
        stg_events_typed, latest_partition, reconcile_counts, table_fingerprints,
        dedup_first, quarantine_union, valid_rows, dq_unique_not_null, surrogate_fact_id, surrogate_fact_rank,
        key_class, pseudonym, person_key, title_case,
        cdc_current, cdc_scd2, scd2_asof_lookup,
        dim_zone, dim_station, dim_hour, dim_user, dim_inline,
        fact_boarding, fact_trip_roles,
        mart_demand, mart_coverage, mart_multi_mode, mart_served_rank, mart_od,
        bi_hour_mode, bi_zone_mode, bi_peak_share, bi_weekday_mean, bi_monthly_trips, bi_active_users,
        bi_same_zone_share, bi_zone_matrix, bi_per_station, bi_top_zones, bi_busiest_origin,
        feat_person, feat_cut_a, feat_cuts_stacked, feat_cut_events, population_by_cut,
        unit_counterfactual, subpopulation_share,
        leak_audit, invariance_audit, table_diff, only_one_side,
        folds_stratified, baseline_ap_auc, fold_summary, threshold_curve, threshold_best, confusion_at,
        segment_profile,
    ]
}
