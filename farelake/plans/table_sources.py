"""Sources and sinks on the benchmark tables: written in the raw formats and read back through the library."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.plans import table_sql
from farelake.plans import tables as Q
from farelake.session import run_dir
from farelake.sources import bronze, sinks
from farelake.sources import schemas as S

ORDERS = S.Source("pedidos", "pedidos.csv", S.text_schema("pedido", "cliente", "estado", "centavos", "prioridad"))
_POINT = S.table(ts=S.S, zona=S.L)
EVENTS = S.Source(
    "eventos", "eventos.jsonl", S.table(evento=S.L, usuario=S.S, entrada=_POINT, salida=_POINT, _corrupt_record=S.S), "json"
)
LOADS = [(date(2024, 2, 1), "c_nationkey < 12"), (date(2024, 2, 2), "c_nationkey >= 3"), (date(2024, 2, 2), "c_nationkey >= 5")]


def src_csv_text(spark, sf):
    """Orders as CSV; every column comes back as text, leading zeros and empty values included."""
    folder = run_dir(spark, "csv")
    orders = Q.table(spark, sf, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("pedido"), F.col("o_custkey").alias("cliente"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("estado"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("centavos"), F.col("o_orderpriority").alias("prioridad"),
    )
    orders.write.option("header", True).csv(f"{folder}/{ORDERS.file}")
    return bronze.read_raw(spark, ORDERS, folder)


def src_ndjson_nested(spark, sf):
    """Events as JSON lines with nested, partly missing records."""
    folder = run_dir(spark, "json")
    zone = F.regexp_extract("props", "[0-9]+", 0).cast("long") % 25
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    events = Q.table(spark, sf, "events").select(
        F.col("event_id").alias("evento"), F.concat(F.lit("U-"), "user_id").alias("usuario"),
        F.struct(stamp.alias("ts"), zone.alias("zona")).alias("entrada"),
        F.when(F.col("event_type") != "view", F.struct(stamp.alias("ts"), (zone + 1).alias("zona"))).alias("salida"),
    )
    events.write.json(f"{folder}/{EVENTS.file}")
    return bronze.read_raw(spark, EVENTS, folder).select(
        "evento", "usuario", F.col("entrada.ts").alias("ts_entrada"), F.col("entrada.zona").alias("zona_entrada"),
        F.col("salida.ts").alias("ts_salida"), F.col("salida.zona").alias("zona_salida"),
    )


def _landed(spark, sf):
    root = run_dir(spark, "bronze")
    customers = Q.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    for day, part in LOADS:  # the last load replaces the second one's day
        stamped = bronze.with_provenance(customers.filter(part), "clientes", datetime(2024, 2, 2), day)
        bronze.write_bronze(stamped, root, "clientes")
    return bronze.bronze(spark, root, "clientes")


def bronze_loads(spark, sf):
    """Two load days, one of them loaded twice: rows per day and source."""
    return _landed(spark, sf).groupBy("fecha_ingesta", "fuente_archivo").agg(F.count(F.lit(1)).alias("filas"))


def bronze_newest_load(spark, sf):
    return bronze.newest_load(_landed(spark, sf)).select("c_custkey", "c_name", "c_nationkey", "fecha_ingesta")


def sink_csv_mart(spark, sf):
    """A mart exported as one CSV file, read back."""
    path = run_dir(spark, "mart")
    sinks.export_csv(Q.QUERIES["mart_multi_mode"](spark, sf), path)
    return spark.read.schema("n_operadores long, combinacion string, personas long").option("header", True).csv(path)


def sink_csv_sorted(spark, sf):
    """A totally ordered export: the place of a row follows from the name of its part and its line there."""
    path = run_dir(spark, "sorted")
    suppliers = Q.table(spark, sf, "supplier").select("s_nationkey", "s_suppkey", "s_name")
    sinks.export_sorted_csv(suppliers, path, ["s_nationkey", "s_suppkey"])
    back = spark.read.schema("s_nationkey int, s_suppkey long, s_name string").option("header", True).csv(path)
    placed = back.withColumn("_file", F.col("_metadata.file_name")).withColumn("_line", F.monotonically_increasing_id())
    counts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))  # one row per part file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_file").orderBy("_line"))
    return placed.withColumn("_i", inside).join(starts, "_file").select(
        (F.col("_start") + F.col("_i")).cast("long").alias("lugar"), "s_nationkey", "s_suppkey", "s_name"
    )


def sink_by_day(spark, sf):
    """A table laid out by event day, and the rows observed while it was written."""
    path = run_dir(spark, "days")
    n = sinks.publish(Q.table(spark, sf, "events").select("event_id", "ts"), path, day_of="ts")
    back = sinks.read_table(spark, path).filter(F.col("dia") >= F.lit(date(2024, 1, 10)))
    return back.groupBy("dia").agg(F.count(F.lit(1)).alias("eventos")).withColumn("publicados", F.lit(n).cast("long"))


QUERIES = {
    f.__name__: f
    for f in [src_csv_text, src_ndjson_nested, bronze_loads, bronze_newest_load, sink_csv_mart, sink_csv_sorted, sink_by_day]
}

_STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
_ZONE = "cast(regexp_extract(props, '[0-9]+') as bigint) % 25"
SQL = {
    "src_csv_text": """
select lpad(cast(o_orderkey as varchar), 9, '0') as pedido, cast(o_custkey as varchar) as cliente,
  nullif(o_orderstatus, 'P') as estado, cast(cast(round(o_totalprice * 100) as bigint) as varchar) as centavos,
  o_orderpriority as prioridad from orders""",
    "src_ndjson_nested": f"""
select event_id as evento, 'U-' || user_id as usuario, {_STAMP} as ts_entrada, {_ZONE} as zona_entrada,
  if(event_type <> 'view', {_STAMP}, null) as ts_salida, if(event_type <> 'view', {_ZONE} + 1, null) as zona_salida
from events""",
    "bronze_loads": """
select date '2024-02-01' as fecha_ingesta, 'clientes' as fuente_archivo, count(*) as filas from customer where c_nationkey < 12
union all select date '2024-02-02', 'clientes', count(*) from customer where c_nationkey >= 5""",
    "bronze_newest_load": """
select c_custkey, c_name, c_nationkey, date '2024-02-02' as fecha_ingesta from customer where c_nationkey >= 5""",
    "sink_csv_mart": table_sql.SQL["mart_multi_mode"],
    "sink_csv_sorted": """
select row_number() over (order by s_nationkey, s_suppkey) as lugar, s_nationkey, s_suppkey, s_name from supplier""",
    "sink_by_day": """
select cast(ts as date) as dia, count(*) as eventos, (select count(*) from events) as publicados from events
where ts >= timestamp '2024-01-10' group by 1""",
}
