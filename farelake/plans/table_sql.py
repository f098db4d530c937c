"""Plain SQL for the queries of :mod:`farelake.plans.tables`, written from the definitions of the results.

The texts are built another way than the Spark plans they check: states come from the largest struct of a group, histories
and gaps from sorted lists, absence from correlated subqueries. Nothing here runs on Spark.
"""

from __future__ import annotations

from datetime import date, timedelta

from farelake.plans import tables as Q

SALT = Q.SALT
PEAK = "(5, 6, 7, 8, 16, 17, 18, 19)"
HOUR_KEY = "cast(strftime({t}, '%Y%m%d%H') as bigint)"


def hour_key(t: str) -> str:
    return HOUR_KEY.format(t=t)


def pseudo(scope: str, key: str) -> str:
    return f"substr(sha256('{SALT}' || ':' || {scope} || ':' || {key}), 1, 16)"


LINE_COLS = [
    "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LINE_RANK = (
    "row_number() over (partition by l_orderkey, l_linenumber order by " + ", ".join(LINE_COLS[2:]) + ")"
)
FIRST = f"first_lines as (select * exclude (rn) from (select *, {LINE_RANK} as rn from lineitem) where rn = 1)"

SQL: dict[str, str] = {}

SQL["demand_by_month_and_nation"] = f"""
with {FIRST}
select cast(date_trunc('month', l_shipdate) as date) as mes, n_name, count(*) as lineas,
       cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as centavos
from first_lines join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey group by 1, 2"""

SQL["stg_events_typed"] = f"""
with e as (select *, cast(regexp_extract(props, '[0-9]+') as bigint) as kk from events)
select event_id, cast(round(value * 100) as bigint) as centavos, kk as k, {hour_key('ts')} as tiempo_key,
       date_trunc('hour', ts) as hora_ts, ts - interval 6 hour as ts_local, extract(hour from ts) as hora,
       extract(hour from ts) in {PEAK} as hora_pico, dayofweek(ts) in (0, 6) as fin_de_semana,
       case when kk % 10 in (1, 2, 3) then 'OK' when kk % 10 = 7 then 'SALDO_INSUF'
            when kk % 10 = 9 then 'TARJETA_INVALIDA' else 'DESCONOCIDO' end as estado_desc,
       event_type = 'purchase' as es_compra,
       case when event_type = 'error' then null else event_type end as tipo
from e"""

SQL["latest_partition"] = """
with o as (select *, cast(date_trunc('month', o_orderdate) as date) as carga from orders)
select * from o where carga = (select max(carga) from o)"""

_EXPECTED = [
    ("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"),
    ("part", "p_partkey"), ("orders", "o_orderkey"), ("events", "event_id"),
]
SQL["reconcile_counts"] = " union all ".join(
    f"select '{t}' as tabla, cast(max({k}) as bigint) + 1 as filas_esperadas, count(*) as filas_cargadas, "
    f"count(*) - (cast(max({k}) as bigint) + 1) as diferencia from {t}"
    for t, k in _EXPECTED
)
_MONEY, _TIME = {"c_acctbal", "o_totalprice", "value"}, {"o_orderdate", "ts"}


def _fingerprint(t: str, cols: list) -> str:
    plain = [
        f"cast(round({c} * 100) as bigint)" if c in _MONEY else f"epoch_us({c})" if c in _TIME else c for c in sorted(cols)
    ]
    text = " || ".join(f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in plain)
    words = " || ".join(
        f"printf('%08x', cast(sum(cast('0x' || substr(h, {1 + 8 * i}, 8) as bigint)) % 4294967296 as bigint))" for i in range(4)
    )
    return f"select '{t}' as tabla, count(*) as filas, {words} as huella from (select md5({text}) as h from {t})"


SQL["table_fingerprints"] = " union all ".join(_fingerprint(t, [c.split()[0] for c in Q.SCHEMAS[t].split(', ')]) for t in ("customer", "orders", "events"))

SQL["dedup_first"] = f"with {FIRST} select * from first_lines"

_LID = "l_orderkey || '-' || l_linenumber"
_FUTURE = "l_shipdate > timestamp '2001-06-01 00:00:00'"
SQL["quarantine_union"] = f"""
with r as (select *, {LINE_RANK} as rn from lineitem)
select 'lineitem' as fuente, {_LID} as id_registro, 'duplicado_torniquete' as motivo,
       'lectura repetida' as detalle, l_shipdate as fecha_hora_evento from r where rn > 1
union all
select 'lineitem', {_LID}, 'fecha_futura', 'posterior a la carga', l_shipdate from r where {_FUTURE}
union all
select 'lineitem', {_LID}, 'parada_nula', 'sin parada', l_shipdate from r where l_tax = 0
union all
select 'lineitem', {_LID}, 'transaccion_no_exitosa', 'estado R', l_shipdate from r
where l_returnflag = 'R' and l_tax <> 0 and not {_FUTURE}
union all
select 'orders', cast(o_orderkey as varchar), 'viaje_sin_salida', 'sin cierre', o_orderdate
from orders where o_orderstatus = 'P'"""

SQL["valid_rows"] = f"""
with {FIRST} select * from first_lines where l_tax <> 0 and l_returnflag <> 'R' and not {_FUTURE}"""


def _unique(t: str, cols: str) -> str:
    return (
        f"select '{t}' as tabla, 'unique' as prueba, '{cols}' as columna, count(*) as fallas from "
        f"(select {cols} from {t} group by {cols} having count(*) > 1)"
    )


def _not_null(t: str, col: str) -> str:
    return (
        f"select '{t}' as tabla, 'not_null' as prueba, '{col}' as columna, "
        f"count(*) filter (where {col} is null) as fallas from {t}"
    )


SQL["dq_unique_not_null"] = " union all ".join(
    [
        _unique("lineitem", "l_orderkey,l_linenumber"), _not_null("lineitem", "l_orderkey"),
        _not_null("lineitem", "l_shipdate"), _unique("orders", "o_orderkey"), _unique("orders", "o_custkey"),
        _not_null("orders", "o_orderkey"), _unique("customer", "c_custkey"), _not_null("customer", "c_custkey"),
        _not_null("customer", "c_nationkey"), _unique("events", "event_id"), _not_null("events", "event_id"),
        _not_null("events", "props"),
    ]
)

SQL["surrogate_fact_id"] = """
select sha256(concat_ws(chr(31), l_orderkey, l_linenumber, l_returnflag, l_linestatus)) || '-' ||
       row_number() over (partition by l_orderkey, l_linenumber, l_returnflag, l_linestatus) as fila_id,
       l_orderkey, l_linenumber, l_returnflag, l_linestatus from lineitem"""
SQL["surrogate_fact_rank"] = """
select row_number() over (order by l_returnflag, l_orderkey, l_linenumber, l_linestatus) as fila_id,
       l_returnflag, l_orderkey, l_linenumber, l_linestatus from lineitem"""


def card(key: str) -> str:
    return (
        f"case {key} % 5 when 0 then 'TC-' || lpad(cast({key} as varchar), 8, '0') "
        f"when 1 then lpad(cast({key} as varchar), 10, '0') when 2 then 'MR' || lpad(cast({key} as varchar), 7, '0') "
        f"when 3 then 'SIN-TARJETA' else 'x' || {key} end"
    )


OPERATOR_OF = """case when tarjeta like 'TC-%' then 'TRANSMETRO' when tarjeta like 'MR%' then 'METRORIEL'
 when tarjeta similar to '[0-9]{10}' then 'TRANSURBANO' when tarjeta = 'SIN-TARJETA' then 'SIN_TARJETA'
 else 'DESCONOCIDO' end"""
LINKED = "('TRANSMETRO', 'TRANSURBANO', 'METRORIEL')"
NUMBER = "cast(regexp_extract(tarjeta, '[0-9]+') as bigint)"

SQL["key_class"] = f"""
with c as (select c_custkey, {card('c_custkey')} as tarjeta from customer),
d as (select *, {OPERATOR_OF} as operador_detectado from c)
select *, case when operador_detectado in {LINKED} then {NUMBER} end as numero from d"""
SQL["pseudonym"] = f"select c_custkey, {pseudo(chr(39) + 'CLIENTE' + chr(39), 'c_name')} as usuario_key from customer"
SQL["person_key"] = f"""
with c as (select {card('c_custkey')} as tarjeta from customer union select {card('s_suppkey')} from supplier),
d as (select tarjeta, {OPERATOR_OF} as operador from c)
select {pseudo('operador', 'tarjeta')} as usuario_key, operador,
  case when operador in {LINKED} then {pseudo("'PERSONA'", f"cast({NUMBER} as varchar)")}
       else {pseudo('operador', 'tarjeta')} end as persona_key,
  case when operador in {LINKED} then 'NUMERO_TARJETA' else 'SIN_VINCULO' end as vinculo_persona
from d"""
SQL["title_case"] = """
with names as (select upper(p_name) as crudo from part union all select 'Z' || p_size from part),
counted as (select crudo, string_split(lower(crudo), ' ') as words, count(*) as filas from names group by crudo),
named as (
  select crudo, filas, case when left(crudo, 1) = 'Z' and try_cast(crudo[2:] as int) >= 0 then 'Zona ' || crudo[2:]
    else (select string_agg(upper(w[1]) || w[2:], ' ' order by i)
          from (select unnest(words) as w, generate_subscripts(words, 1) as i)) end as zona
  from counted)
select crudo, zona, case when starts_with(zona, 'Zona ') then 'ZONA_GUATEMALA' else 'MUNICIPIO' end as tipo, filas
from named"""


def registry(where: str = "true") -> str:
    return f"""(select *, case when op = 'DELETE' then null else event_type end as perfil,
  case when op <> 'DELETE' and k % 3 <> 0 then 'Zona ' || k end as zona_residencia from
  (select event_id as seq, ts as commit_ts, user_id as tarjeta, event_type,
   cast(regexp_extract(props, '[0-9]+') as bigint) as k,
   case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op
   from events where {where}))"""


def current(where: str = "true") -> str:
    """One group per card: its largest row, and its largest row with a body."""
    return f"""(select tarjeta, body.p as perfil, body.z as zona_residencia, newest.op as ultima_operacion,
  newest.ts as commit_ts, newest.seq as ultimo_seq from
  (select tarjeta, max({{'seq': seq, 'op': op, 'ts': commit_ts}}) as newest,
     max({{'seq': seq, 'p': perfil, 'z': zona_residencia}}) filter (where op <> 'DELETE') as body
   from {registry(where)} group by tarjeta))"""


def history(where: str = "true") -> str:
    """One sorted list per card; a version is a slot of it, and looks back and ahead in the list."""
    seen = "list_filter(slots[:i], lambda e: e.{c} is not null)[-1].{c}"
    return f"""(select tarjeta, {seen.format(c='p')} as perfil, {seen.format(c='z')} as zona_residencia,
  if(slots[i].op = 'DELETE', 'INACTIVO', 'ACTIVO') as estado, slots[i].op as operacion_origen, slots[i].seq as seq,
  slots[i].ts as valid_from, slots[i + 1].ts as valid_to, i = len(slots) as es_version_vigente from
  (select tarjeta, slots, unnest(range(1, len(slots) + 1)) as i from
   (select tarjeta, list({{'seq': seq, 'ts': commit_ts, 'op': op, 'p': perfil, 'z': zona_residencia}} order by seq) as slots
    from {registry(where)} group by tarjeta)))"""


SQL["cdc_current"] = (
    "select *, case when ultima_operacion = 'DELETE' then 'INACTIVO' else 'ACTIVO' end as estado_vigente "
    f"from {current()}"
)
SQL["cdc_scd2"] = f"select * from {history()}"
SQL["scd2_asof_lookup"] = f"""
select e.event_id, e.user_id as tarjeta, e.ts, e.value, h.perfil, h.zona_residencia, h.estado,
       h.seq as version_seq
from events e left join {history("event_type <> 'purchase'")} h
  on h.tarjeta = e.user_id and h.valid_from <= e.ts and (h.valid_to is null or e.ts < h.valid_to)
where e.event_type = 'purchase'"""

# ---- dimensions --------------------------------------------------------------------

_KIND = "case when {z} like 'Zona %' then 'ZONA_GUATEMALA' else 'MUNICIPIO' end"
SQL["dim_zone"] = f"""
with z as (select n_name as zona_nombre from nation union select r_name from region)
select row_number() over (order by zona_nombre) as zona_key, zona_nombre, {_KIND.format(z='zona_nombre')} as zona_tipo
from z"""
NATION_ZONES = f"""nation_zones as (select row_number() over (order by n_name) as zona_key, n_name as zona_nombre,
  {_KIND.format(z='n_name')} as zona_tipo from nation)"""
STATIONS = """stations as (select row_number() over (order by operador, codigo_nativo) as estacion_key, operador,
  codigo_nativo, nombre, z.zona_key, lat, cast(null as double) as lon from
  (select 'CUSTOMER' as operador, cast(c_custkey as varchar) as codigo_nativo, c_name as nombre, n_name,
          c_acctbal as lat from customer left join nation on c_nationkey = n_nationkey
   union all
   select 'SUPPLIER', cast(s_suppkey as varchar), s_name, n_name, cast(null as double)
   from supplier left join nation on s_nationkey = n_nationkey) t
  left join nation_zones z on z.zona_nombre = t.n_name)"""
SQL["dim_station"] = f"with {NATION_ZONES}, {STATIONS} select * from stations"


def hours(source: str, ts: str) -> str:
    return f"""hours as (select {hour_key('h')} as tiempo_key, cast(h as date) as fecha,
  extract(hour from h) as hora_del_dia, dayofweek(h) not in (0, 6) as dia_habil,
  extract(hour from h) in {PEAK} as hora_pico from
  (select unnest(generate_series(date_trunc('hour', min({ts})), date_trunc('hour', max({ts})), interval 1 hour)) as h
   from {source}))"""


SQL["dim_hour"] = f"with {hours('events', 'ts')} select * from hours"
SQL["dim_user"] = f"""
with seen as (select distinct user_id as u from events where event_type = 'purchase'),
c as (select 'TC-' || lpad(cast(u as varchar), 8, '0') as tarjeta, p.perfil, p.zona_residencia,
      case when p.ultima_operacion is null then 'SIN_PADRON' when p.ultima_operacion = 'DELETE' then 'INACTIVO'
           else 'ACTIVO' end as estado_padron
      from seen left join {current("event_type in ('signup', 'error')")} p on p.tarjeta = u)
select {pseudo("'TRANSMETRO'", 'tarjeta')} as usuario_key, 'TRANSMETRO' as operador, perfil, zona_residencia,
       estado_padron, {pseudo("'PERSONA'", f"cast({NUMBER} as varchar)")} as persona_key,
       'NUMERO_TARJETA' as vinculo_persona from c"""
SQL["dim_inline"] = """
select operador, nombre, modo, count(*) as eventos from events join (values ('click', 'Click', 'digital'),
  ('error', 'Error', 'caja'), ('purchase', 'Purchase', 'caja'), ('signup', 'Signup', 'caja'),
  ('view', 'View', 'digital')) t(operador, nombre, modo) on operador = event_type group by 1, 2, 3"""

# ---- facts and marts ------------------------------------------------------------------

BOARDINGS = """boardings as (
  select 'CUSTOMER' as operador, cast(event_id as varchar) as id_origen, cast(user_id as varchar) as tarjeta,
         cast(user_id as varchar) as codigo, ts as fecha_hora, value as monto_gtq, false as es_transbordo from events
  union all
  select 'SUPPLIER', l_orderkey || '-' || l_linenumber, cast(l_partkey as varchar), cast(l_suppkey as varchar),
         l_shipdate, l_extendedprice, l_returnflag = 'R' from first_lines)"""
BASE = f"{FIRST}, {NATION_ZONES}, {STATIONS}, {BOARDINGS}"
FACT = f"""fact as (select b.operador || ':' || id_origen as abordaje_key, b.operador,
  {pseudo('b.operador', 'tarjeta')} as usuario_key, estacion_key, {hour_key('fecha_hora')} as tiempo_key,
  fecha_hora, monto_gtq, es_transbordo
  from boardings b left join stations s on s.operador = b.operador and s.codigo_nativo = b.codigo)"""
SQL["fact_boarding"] = f"with {BASE}, {FACT} select * from fact"

RAIL = """region_zones as (select row_number() over (order by r_name) as zona_key, r_name as zona_nombre from region),
rail as (select row_number() over (order by cast(n_nationkey as varchar)) as estacion_key,
  cast(n_nationkey as varchar) as codigo, zona_key, zona_nombre
  from nation join region on n_regionkey = r_regionkey join region_zones on zona_nombre = r_name)"""
TRIPS = f"""trips as (select l_orderkey * 10 + l_linenumber as viaje_id,
  {pseudo("'METRORIEL'", 'cast(o_custkey as varchar)')} as usuario_key, o.estacion_key as estacion_origen_key,
  d.estacion_key as estacion_destino_key, {hour_key('o_orderdate')} as tiempo_key_entrada,
  o_orderdate as ts_entrada, l_shipdate as ts_salida,
  cast(date_diff('day', o_orderdate, l_shipdate) as integer) as duracion_s, l_extendedprice as monto_gtq
  from first_lines join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey
  left join rail o on o.codigo = cast(s_nationkey as varchar)
  left join rail d on d.codigo = cast(c_nationkey as varchar))"""
SQL["fact_trip_roles"] = f"with {FIRST}, {RAIL}, {TRIPS} select * from trips"

# Facts reach their zone through the station's native code; the attributes of the hour come from the time itself.
DEMAND = f"""demand as (
  select cast(b.fecha_hora as date) as fecha, hour(b.fecha_hora) as hora_del_dia,
    isodow(b.fecha_hora) < 6 as dia_habil, hour(b.fecha_hora) in {PEAK} as hora_pico, b.operador,
    map {{'CUSTOMER': 'Clientes', 'SUPPLIER': 'Proveedores'}}[b.operador] as operador_nombre,
    map {{'CUSTOMER': 'digital', 'SUPPLIER': 'carga'}}[b.operador] as modo, z.zona_nombre, z.zona_tipo,
    count(*) as abordajes, cast(sum(cast(round(b.monto_gtq * 100) as bigint)) as bigint) / 100.0 as recaudo_gtq
  from boardings b, stations s, nation_zones z
  where s.operador = b.operador and s.codigo_nativo = b.codigo and s.zona_key = z.zona_key group by all)"""
CUBE = f"{BASE}, {DEMAND}"
SQL["mart_demand"] = f"with {CUBE} select * from demand"

# Every zone gets one row per thing that happens in it; one pivot counts them.
COVERAGE = f"""things as (
  select zona_nombre, zona_tipo, 'zone' as what, 0 as n from nation_zones
  union all select r_name, {_KIND.format(z='r_name')}, 'zone', 0 from region
  union all select zona_nombre, zona_tipo, operador, 1 from stations join nation_zones using (zona_key)
  union all select zona_nombre, zona_tipo, 'ride by ' || operador, abordajes from demand),
coverage as (
  select zona_nombre, zona_tipo, cast(count_if(what = 'CUSTOMER') as bigint) as estaciones_cliente,
    cast(count_if(what = 'SUPPLIER') as bigint) as estaciones_metroriel,
    len(list_distinct(list(what) filter (where what in ('CUSTOMER', 'SUPPLIER')))) as modes,
    cast(sum(if(starts_with(what, 'ride'), n, 0)) as bigint) as abordajes_total,
    cast(sum(if(what = 'ride by CUSTOMER', n, 0)) as bigint) as others,
    cast(sum(if(what = 'ride by SUPPLIER', n, 0)) as bigint) as rail
  from things group by zona_nombre, zona_tipo)"""
SQL["mart_coverage"] = f"""with {CUBE}, {COVERAGE}
select zona_nombre, zona_tipo, estaciones_cliente, estaciones_metroriel,
  cast(coalesce(modes, 0) as int) as n_modos_con_servicio, abordajes_total from coverage"""
SERVED = f"""{COVERAGE},
served as (
  select zona_nombre, zona_tipo, estaciones_metroriel, estaciones_metroriel <> 0 as en_trazado_metroriel,
    others as abordajes_otros_modos, rail as abordajes_metroriel,
    1 + (select count(*) from coverage busier where busier.others > c.others) as ranking_demanda_otros_modos
  from coverage c)"""
SQL["mart_served_rank"] = f"with {CUBE}, {SERVED} select * from served"
SQL["mart_multi_mode"] = """
with sets as (
  select list_sort(list_distinct(list(o_orderpriority))) as modes from orders join customer on c_custkey = o_custkey
  group by c_custkey // 2)
select len(modes) as n_operadores, array_to_string(modes, ' + ') as combinacion, count(*) as personas
from sets group by modes"""
OD = f"""{FIRST}, {RAIL}, {TRIPS},
od as (select o.codigo as estacion_origen, o.zona_nombre as zona_origen, d.codigo as estacion_destino,
  d.zona_nombre as zona_destino, count(*) as viajes, round(avg(duracion_s), 6) as duracion_promedio_s
  from trips join rail o on o.estacion_key = estacion_origen_key
  join rail d on d.estacion_key = estacion_destino_key group by 1, 2, 3, 4)"""
SQL["mart_od"] = f"with {OD} select * from od"

# ---- reports ----------------------------------------------------------------------------

SQL["bi_hour_mode"] = (
    f"with {CUBE} select hora_del_dia, operador, cast(sum(abordajes) as bigint) as abordajes from demand group by 1, 2"
)
SQL["bi_zone_mode"] = (
    f"with {CUBE} select zona_nombre, operador, cast(sum(abordajes) as bigint) as abordajes from demand group by 1, 2"
)
SQL["bi_peak_share"] = f"""
with {FIRST}, {BOARDINGS}, x as (select extract(hour from fecha_hora) in {PEAK} as pico from boardings)
select count(*) as abordajes, count(*) filter (where pico) as abordajes_pico,
       round(count(*) filter (where pico) / count(*), 6) as parte_pico from x"""
SQL["bi_weekday_mean"] = f"""
with {FIRST}, {BOARDINGS}, x as (select cast(fecha_hora as date) as d, count(*) as n from boardings group by 1)
select dayofweek(d) not in (0, 6) as dia_habil, count(*) as dias, cast(sum(n) as bigint) as abordajes,
       round(sum(n) / count(*), 6) as media_por_dia from x group by 1"""
SQL["bi_monthly_trips"] = f"""
with {FIRST}, {BOARDINGS} select count(*) as viajes from boardings
where fecha_hora >= date '1998-06-01' and fecha_hora < date '1998-07-01'"""
SQL["bi_active_users"] = """
with c as (select cast(max(ts) as date) + 1 as t from events),
p as (select user_id, count(*) filter (where ts >= t - 7) as v from events, c group by 1)
select count(*) filter (where v > 0) as activos, count(*) as personas from p"""
SQL["bi_same_zone_share"] = f"""
with {OD} select cast(sum(viajes) as bigint) as viajes,
  cast(sum(viajes) filter (where zona_origen = zona_destino) as bigint) as misma_zona,
  round(sum(viajes) filter (where zona_origen = zona_destino) / sum(viajes), 6) as parte from od"""
SQL["bi_zone_matrix"] = (
    f"with {OD} select zona_origen, zona_destino, cast(sum(viajes) as bigint) as viajes from od group by 1, 2"
)
SQL["bi_per_station"] = f"""
with {CUBE}, n as (select operador, count(*) as estaciones from stations group by 1),
b as (select operador, cast(sum(abordajes) as bigint) as abordajes from demand group by 1)
select operador, estaciones, abordajes, round(abordajes / estaciones, 6) as por_estacion from b join n using (operador)"""
SQL["bi_top_zones"] = f"""
with {CUBE}, {SERVED} select zona_nombre, abordajes_otros_modos from served
order by abordajes_otros_modos desc, zona_nombre limit 5"""
SQL["bi_busiest_origin"] = f"""
with {OD} select estacion_origen, zona_origen, cast(sum(viajes) as bigint) as viajes from od group by 1, 2
order by viajes desc, estacion_origen limit 3"""

# ---- features ---------------------------------------------------------------------------------

SQL["feat_person"] = f"""
with ev as (select user_id as persona_key, event_type, ts, cast(ts as date) as dia, cast(round(value * 100) as bigint) as cents,
  'Zona ' || (cast(regexp_extract(props, '[0-9]+') as bigint) % 25) as zona,
  (select cast(max(ts) as date) + 1 from events) as t from events),
per as (select persona_key, any_value(t) as fecha_corte, list(dia) as days, any_value(t) - max(dia) as rest,
  histogram(event_type) as modes, histogram(zona) as zones, count_if(hour(ts) in {PEAK}) as peak,
  count_if(isodow(ts) > 5) as weekend, count(cents) as paid, cast(sum(cents) as bigint) as cents from ev group by persona_key)
select persona_key, fecha_corte, {', '.join(
    f"len(list_filter(days, lambda d: d >= fecha_corte - {n})) as viajes_{n}d" for n in (7, 30, 90)
)}, len(days) as viajes_total, rest as dias_desde_ultimo_viaje, len(list_distinct(days)) as dias_activos,
  cast(cardinality(modes) as bigint) as n_modos_distintos, round(peak / len(days), 6) as prop_hora_pico,
  round(weekend / len(days), 6) as prop_fin_de_semana, cents / 100.0 as gasto_total_gtq,
  round(cents / 100.0 / paid, 6) as gasto_promedio_gtq, {', '.join(
    f"(select e.key from (select unnest(map_entries({m})) as e) order by e.value desc, e.key limit 1) as {out}"
    for m, out in (("modes", "modo_mas_usado"), ("zones", "zona_origen_mas_frecuente"))
)} from per"""

EV_ORDERS = """(select 'P' || o_custkey as unidad_id, o_custkey || '-' || substr(o_orderpriority, 1, 1) as tarjeta,
  o_orderstatus as operador, o_orderdate as fecha_hora, o_totalprice as monto, substr(o_orderpriority, 3) as zona
  from orders)"""
LOG_ORDERS = """(select *, case when op = 'DELETE' then null else o_orderpriority end as perfil from
  (select 'P' || o_custkey as unidad_id, o_custkey || '-' || substr(o_orderpriority, 1, 1) as tarjeta,
   o_orderkey as seq, o_orderdate as commit_ts, o_orderpriority,
   case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 'DELETE'
        when o_orderpriority = '1-URGENT' then 'INSERT' else 'UPDATE' end as op from orders))"""
EV_EVENTS = """(select 'P' || user_id as unidad_id, user_id || '-' || event_type as tarjeta, event_type as operador,
  ts as fecha_hora, value as monto, cast(cast(regexp_extract(props, '[0-9]+') as bigint) % 25 as varchar) as zona
  from events)"""
LOG_EVENTS = f"(select *, 'P' || tarjeta as unidad_id from {registry()})"


def features(ev: str, log: str, name: str, t: date, w, operators, labelled=True, until: date | None = None) -> str:
    """One group per unit over all its events, each flagged by where it lies to the cut; days as a sorted list."""
    before = f"timestamp '{until} 00:00:00'" if until else "timestamp 'infinity'"
    cut = f"timestamp '{t} 00:00:00'"
    fin = f"timestamp '{t + timedelta(days=w.horizon)} 00:00:00'"
    since = lambda days: f"back > 0 and back <= {days} * 86400"
    n, h, s = w.window, w.half, w.short
    rides = f"cast(count_if({since(n)}) as bigint)"
    share = lambda test: f"round(count_if({since(n)} and {test}) / {rides}, 6)"
    spans = "list_transform(range(1, len(days)), lambda i: days[i + 1] - days[i] - 1)"
    state = lambda col, test="true": f"""(select max({{'seq': l.seq, 'v': l.{col}}}).v from {log} l
    where l.unidad_id = g.unidad_id and l.commit_ts < least({cut}, {before}) and {test})"""  # noqa: E731
    label = "if(returned, 0, 1)" if labelled else "null"
    return f"""(with placed as (
  select *, epoch({cut} - fecha_hora) as back, cast(fecha_hora as date) as dia from {ev} where fecha_hora < {before}),
g as (
  select unidad_id, array_to_string(list_sort(list_distinct(list(tarjeta) filter (where back > 0))), ';') as tarjetas,
    list_sort(list_distinct(list(dia) filter (where {since(n)}))) as days, {rides} as n, cast(count_if({since(s)}) as bigint) as ns,
    cast(count_if({since(h)}) as bigint) as nh, date_diff('second', max(fecha_hora) filter (where back > 0), {cut}) / 86400.0 as rest,
    {', '.join(f"{share(f"operador = '{op}'")} as prop_{op.lower()}" for op in operators)},
    len(list_distinct(list(operador) filter (where {since(n)}))) as n_operadores,
    len(list_distinct(list(zona) filter (where {since(n)}))) as n_zonas,
    {share(f"hour(fecha_hora) in {PEAK}")} as prop_hora_pico, {share("isodow(fecha_hora) > 5")} as prop_fin_de_semana,
    cast(sum(if({since(n)}, cast(round(monto * 100) as bigint), 0)) as bigint) as cents,
    bool_or(back <= 0 and fecha_hora < {fin}) as returned
  from placed group by unidad_id having {rides} >= {w.min_trips})
select unidad_id, '{name}' as corte, cast({cut} as date) as fecha_corte, tarjetas, n as viajes_{n}d, ns as viajes_{s}d,
  nh as viajes_{h}d, round((nh + 1.0) / (n - nh + 1.0), 6) as tendencia_{h}d, len(days) as dias_activos_{n}d,
  round(rest, 6) as dias_desde_ultimo_viaje, coalesce(list_max({spans}), 0) as max_dias_sin_viajar,
  round(n / len(days), 6) as viajes_por_dia_activo, n_operadores, n_zonas,
  {', '.join(f'prop_{op.lower()}' for op in operators)}, prop_hora_pico, prop_fin_de_semana,
  round(cents / 100.0, 6) as gasto_{n}d, round(cents / 100.0 / n, 6) as tarifa_promedio,
  coalesce({state('perfil', "l.op <> 'DELETE'")}, 'sin_padron') as perfil,
  cast(if((select max(fecha_hora) from placed) >= {fin} - interval 1 day, {label}, null) as bigint) as etiqueta
from g where {state('op')} is distinct from 'DELETE')"""


def order_cut(c: str, **kw) -> str:
    return features(EV_ORDERS, LOG_ORDERS, c, Q.CUTS[c], Q.WINDOWS, Q.STATUSES, **kw)


SQL["feat_cut_a"] = f"select * from {order_cut('A')}"
SQL["feat_cuts_stacked"] = " union all ".join(f"select * from {order_cut(c)}" for c in Q.CUTS)
SQL["feat_cut_events"] = "select * from " + features(
    EV_EVENTS, LOG_EVENTS, "E", Q.EVENT_CUTS["E"], Q.EVENT_WINDOWS, Q.EVENT_TYPES
)
SQL["population_by_cut"] = f"""
select corte, fecha_corte, count(*) as poblacion, cast(sum(etiqueta) as bigint) as positivos,
  round(sum(etiqueta) / count(etiqueta), 6) as tasa_positiva from ({SQL['feat_cuts_stacked']}) group by 1, 2"""


def _counterfactual(c: str) -> str:
    """Each (card, operator) with the days from the cut to its rides; lost and gone on are lookups in the rides after it."""
    t, w = Q.CUTS[c], Q.WINDOWS
    day = f"date_diff('day', timestamp '{t} 00:00:00', fecha_hora)"
    after = f"fecha_hora >= timestamp '{t} 00:00:00' and {day} < {w.horizon}"
    return f"""(with rides as (select *, {after} as later, fecha_hora < timestamp '{t} 00:00:00' and {day} >= -{w.window} as seen
  from {EV_ORDERS}),
cards as (select tarjeta, any_value(unidad_id) filter (where seen) as unidad_id from rides group by tarjeta, operador
  having count_if(seen) >= {w.min_trips}),
told as (select not exists (from rides r where r.later and r.tarjeta = k.tarjeta) as lost,
  exists (from rides r where r.later and r.unidad_id = k.unidad_id) as went_on from cards k
  where (select max({{'seq': l.seq, 'op': l.op}}).op from {LOG_ORDERS} l where l.tarjeta = k.tarjeta
    and l.commit_ts < timestamp '{t} 00:00:00') is distinct from 'DELETE')
select '{c}' as corte, count(*) as poblacion_tarjetas, cast(count_if(lost) as bigint) as positivos_tarjeta,
  cast(count_if(lost and went_on) as bigint) as positivos_de_personas_que_siguieron,
  round(count_if(lost and went_on) / nullif(count_if(lost), 0), 4) as proporcion from told)"""


SQL["unit_counterfactual"] = f"select * from {_counterfactual('A')} union all select * from {_counterfactual('B')}"
SQL["subpopulation_share"] = f"""
select count(*) filter (where unidad_id like 'P1%') as unidades, count(*) as de_la_poblacion,
  cast(coalesce(sum(etiqueta) filter (where unidad_id like 'P1%'), 0) as bigint) as positivos,
  cast(sum(etiqueta) as bigint) as positivos_totales from {order_cut('A')}"""

# ---- audits --------------------------------------------------------------------------------------

_EMPTY_DIFF = """
with a as (select {cols} from {a}), b as (select {cols} from {b})
select (select count(*) from a) as filas_a, (select count(*) from b) as filas_b,
  (select count(*) from a where unidad_id not in (select unidad_id from b)) as solo_a,
  (select count(*) from b where unidad_id not in (select unidad_id from a)) as solo_b,
  (select count(*) from (select * from a except select * from b))
    + (select count(*) from (select * from b except select * from a)) as diferencias"""
SQL["leak_audit"] = _EMPTY_DIFF.format(
    cols="* exclude (etiqueta)",
    a=order_cut("A", labelled=False),
    b=order_cut("A", labelled=False, until=Q.CUTS["A"]),
)
SCORE = "round(least(1.0, dias_desde_ultimo_viaje / 730), 6)"
SQL["invariance_audit"] = _EMPTY_DIFF.format(
    cols=f"unidad_id, tarjetas, {SCORE} as puntaje, {SCORE} >= 0.25 as contactar",
    a=order_cut("B", labelled=False, until=Q.CUTS["B"]),
    b=order_cut("B", labelled=False),
)


def _year(y: int) -> str:
    return (
        "(select o_custkey, count(*) as pedidos, min(o_orderstatus) as estado, "
        "cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) / 100.0 as total "
        f"from orders where year(o_orderdate) = {y} group by 1)"
    )


SQL["table_diff"] = f"""
with j as (select a.o_custkey as ka, b.o_custkey as kb, a.pedidos as pa, b.pedidos as pb, a.estado as ea,
  b.estado as eb, a.total as ta, b.total as tb from {_year(1997)} a full join {_year(1998)} b
  on a.o_custkey = b.o_custkey),
c as (select count(ka) as filas_a, count(kb) as filas_b, count(*) filter (where kb is null) as solo_a,
  count(*) filter (where ka is null) as solo_b, count(*) filter (where pa <> pb) as dif_pedidos,
  count(*) filter (where ea <> eb) as dif_estado, count(*) filter (where abs(ta - tb) >= 1e-9) as dif_total from j)
select *, solo_a + solo_b + dif_pedidos + dif_estado + dif_total as diferencias from c"""
SQL["only_one_side"] = """
with a as (select distinct o_custkey from orders where year(o_orderdate) = 1997),
b as (select distinct o_custkey from orders where year(o_orderdate) = 1998)
select o_custkey, '1997' as lado from (select * from a except select * from b)
union all select o_custkey, '1998' from (select * from b except select * from a)"""

# ---- evaluation --------------------------------------------------------------------------------------

FOLDS = f"""folds as (select unidad_id, etiqueta, (row_number() over (partition by etiqueta
  order by sha256(unidad_id || ':42'), unidad_id) - 1) % 5 as fold from feats)"""
SQL["folds_stratified"] = f"with feats as (select * from {order_cut('A')}), {FOLDS} select * from folds"
BASELINES = """long as (
  select 'tasa' as modelo, unidad_id, etiqueta, cast((select avg(etiqueta) from feats) as double) as puntaje from feats
  union all select 'dias_desde_ultimo_viaje', unidad_id, etiqueta, dias_desde_ultimo_viaje from feats
  union all select 'menos_viajes', unidad_id, etiqueta, -cast(viajes_730d as double) from feats)"""


def metrics(source: str, keys: str) -> str:
    return f"""(with pts as (select {keys}, puntaje, sum(etiqueta) as p, sum(1 - etiqueta) as q from {source}
  group by {keys}, puntaje),
run as (select *, sum(p) over (partition by {keys} order by puntaje desc) as tp,
  sum(q) over (partition by {keys} order by puntaje desc) as fp from pts)
select {keys}, cast(sum(p + q) as bigint) as n, cast(sum(p) as bigint) as positivos,
  sum(cast(p * tp as double) / (tp + fp)) / sum(p) as pr_auc,
  sum(q * (tp - p / 2.0)) / cast(sum(p) as double) / sum(q) as roc_auc from run group by {keys})"""


SQL["baseline_ap_auc"] = f"""
with feats as (select * from {order_cut('A')}), {BASELINES}
select modelo, n, positivos, round(pr_auc, 6) as pr_auc, round(roc_auc, 6) as roc_auc from {metrics('long', 'modelo')}"""
SQL["fold_summary"] = f"""
with feats as (select * from {order_cut('A')}), {FOLDS}, {BASELINES},
parts as (select modelo, k as fold, case when f.fold = k then 'val' else 'train' end as split, l.etiqueta, puntaje
  from long l join folds f using (unidad_id), (select unnest(range(5)) as k)),
m as (select * from {metrics('parts', 'modelo, fold, split')})
select modelo, round(avg(pr_auc) filter (where split = 'val'), 6) as pr_auc_val_media,
  round(stddev_samp(pr_auc) filter (where split = 'val'), 6) as pr_auc_val_std,
  round(avg(pr_auc) filter (where split = 'train'), 6) as pr_auc_train_media,
  round(avg(roc_auc) filter (where split = 'val'), 6) as roc_auc_val_media,
  round(stddev_samp(roc_auc) filter (where split = 'val'), 6) as roc_auc_val_std,
  round(avg(pr_auc) filter (where split = 'train') - avg(pr_auc) filter (where split = 'val'), 6) as brecha_train_val
from m group by 1"""


def rates(extra: str = "") -> str:
    return f"""vp, fp, fn, {extra} vp + fp as contactados,
  round(case when vp + fp > 0 then vp / (vp + fp) else 0 end, 6) as precision,
  round(case when vp + fn > 0 then vp / (vp + fn) else 0 end, 6) as recall, cast(10 * vp - 5 * fp as double) as ganancia_q"""


def counts(at: str) -> str:
    return f"""count(*) filter (where etiqueta = 1 and puntaje >= {at}) as vp,
  count(*) filter (where etiqueta = 0 and puntaje >= {at}) as fp,
  count(*) filter (where etiqueta = 1 and puntaje < {at}) as fn,
  count(*) filter (where etiqueta = 0 and puntaje < {at}) as vn"""


def scored(c: str) -> str:
    return f"scored as (select *, {SCORE} as puntaje from {order_cut(c)})"


CURVE = f"""curve as (select umbral, {rates()} from (select umbral, {counts('umbral')} from scored,
  (select i / 1000.0 as umbral from (select unnest(range(10, 991, 5)) as i)) group by 1))"""
SQL["threshold_curve"] = f"with {scored('A')}, {CURVE} select * from curve"
SQL["threshold_best"] = f"""
with {scored('A')}, {CURVE}
select 'elegido' as regla, * from (select * from curve order by ganancia_q desc, umbral limit 1)
union all select 'teorico', round(1 / 3, 6), {rates()} from (select {counts('5.0 / 15.0')} from scored)
union all select 'todos', 0.0, {rates()} from (select {counts('0.0')} from scored)"""
SQL["confusion_at"] = f"""
with {scored('B')} select cast(0.25 as double) as umbral, {rates('vn,')} from (select {counts('0.25')} from scored)"""
SQL["segment_profile"] = f"""
select least(viajes_730d // 2, 4) as segmento, count(*) as tamano,
  round(sum(etiqueta) / count(etiqueta), 6) as tasa_abandono,
  {', '.join(f'round(median({c}), 7) as {c}' for c in Q.PROFILE)} from {order_cut('A')} group by 1"""

# ---- streaming --------------------------------------------------------------------------------------

SQL["stream_land"] = """
select *, timestamp '2024-02-01 00:00:00' as ts_ingesta, date '2024-02-01' as fecha_ingesta,
  'events' as fuente_archivo from events"""
SQL["stream_dedup"] = f"select distinct l_orderkey, l_linenumber from lineitem where not {_FUTURE}"
SQL["stream_quarantine"] = f"""
select id_registro, motivo, fecha_hora_evento from ({SQL['quarantine_union']}) where fuente = 'lineitem'
union all select {_LID}, 'valido', l_shipdate from ({SQL['valid_rows']})"""
SQL["stream_hourly"] = """
select date_trunc('hour', ts) as hora_ts, event_type, count(*) as abordajes,
  cast(sum(cast(round(value * 100) as bigint)) as bigint) as centavos from events group by 1, 2"""
SQL["stream_registry"] = f"select * from {current()}"
SQL["stream_profile"] = SQL["scd2_asof_lookup"]
