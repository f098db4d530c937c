"""The whole flow on the micro-fixture: layers, quarantine, marts, features, audits."""

from collections import Counter
from datetime import date, datetime

import lake_fixture as fx
import pytest
from pyspark.sql import functions as F

from farelake import config as C
from farelake.operators import models, quality
from farelake.plans import cut_features as CF
from farelake.plans import lakehouse, marts, silver, staging
from farelake.sources import bronze, sinks
from farelake.sources.schemas import CONTRACTS, SOURCES

CUTS = {"A": date(2026, 7, 1), "C": date(2026, 8, 30)}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    raw, root = str(base / "raw"), str(base / "lake")
    expected = fx.write(raw)
    lake = lakehouse.Lake(spark, root)
    result = lakehouse.full_load(
        lake, raw, fx.SETTINGS, datetime(2026, 9, 1, 5), date(2026, 9, 1), cuts=CUTS, expected={**expected, "otra": 5}
    )
    return lake, raw, expected, result


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_bronze_counts_and_reconciliation(spark, loaded):
    lake, _, expected, result = loaded
    assert result["counts"] == expected
    want = spark.createDataFrame(list(expected.items()), "tabla string, filas_esperadas long")
    got = quality.reconcile(
        want, quality.table_counts({n: bronze.bronze(spark, lake.bronze, n) for n in SOURCES})
    )
    assert got.filter(F.col("diferencia") != 0).count() == 0
    assert bronze.bronze(spark, lake.bronze, "tu_transacciones").schema["num_tarjeta"].dataType.simpleString() == "string"


def test_load_reports_reconciliation_and_stage_times(spark, loaded):
    _, _, expected, result = loaded
    got = {r.tabla: (r.filas_esperadas, r.filas_cargadas, r.diferencia) for r in result["reconciliation"].collect()}
    assert got == {**{n: (c, c, 0) for n, c in expected.items()}, "otra": (5, None, None)}
    assert list(result["seconds"]) == ["ingesta", "transformacion", "pruebas", "exportacion", "features"]
    assert all(v > 0 for v in result["seconds"].values())
    short = lakehouse.reconciliation(spark, {"a": 3}, {"a": 1, "b": 2}).collect()
    assert [tuple(r) for r in short] == [("a", 3, 1, -2)]


def test_newest_load_only(spark, loaded, tmp_path):
    _, raw, expected, _ = loaded
    root = str(tmp_path / "bronze")
    one = {"tm_validaciones": SOURCES["tm_validaciones"]}
    for day in (date(2026, 9, 1), date(2026, 9, 2), date(2026, 9, 2)):  # second day loaded twice
        bronze.ingest(spark, raw, root, datetime(2026, 9, 1), day, one)
    every = bronze.bronze(spark, root, "tm_validaciones")
    assert every.count() == 2 * expected["tm_validaciones"]
    newest = bronze.newest_load(every)
    assert newest.count() == expected["tm_validaciones"]
    assert rows(newest.select("fecha_ingesta").distinct(), "fecha_ingesta") == [(date(2026, 9, 2),)]
    assert "PartitionFilters: [isnotnull(fecha_ingesta" in newest._jdf.queryExecution().toString()


def test_views_and_out_of_fold_sink(spark, loaded, tmp_path):
    names = bronze.register_views(spark, loaded[0].bronze)
    assert len(names) == 9 and spark.table("bronze_tm_estaciones").count() == 3
    oof = spark.createDataFrame([("P1", 0, 1, 0.5)], "unidad_id string, fold int, etiqueta int, modelo double")
    assert sinks.publish(oof, str(tmp_path / "oof")) == 1
    assert sinks.read_table(spark, str(tmp_path / "oof")).columns == oof.columns


def test_header_mismatch_fails(spark, tmp_path):
    (tmp_path / "tu_paradas.csv").write_text("cod_parada,otra,ruta,sector\na,b,c,d\n")
    with pytest.raises(Exception, match="header"):
        bronze.read_raw(spark, SOURCES["tu_paradas"], str(tmp_path)).collect()


def test_silver(loaded):
    t = loaded[3]["tables"]
    assert [r[0] for r in rows(t["silver_tm_validaciones"], "validacion_id")] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12]
    assert t["silver_tu_transacciones"].count() == 6
    assert [r[0] for r in rows(t["silver_mr_viajes"], "viaje_id")] == [1, 2, 3, 5]
    assert rows(t["silver_am_boardings"], "boarding_id", "fecha_hora")[0] == (1, datetime(2026, 6, 11, 20))
    assert rows(t["silver_tu_paradas"], "cod_parada", "zona_canonica") == [
        ("R-101-1", "Zona 10"), ("R-101-2", "Villa Nueva"), ("R-102-1", "San Miguel Petapa"),
    ]
    missing = t["silver_tm_validaciones"].filter("validacion_id = 12").first()
    assert missing.zona_canonica is None  # unknown station keeps the boarding


def test_quarantine(loaded):
    t = loaded[3]["tables"]
    reasons = Counter((r.fuente, r.motivo) for r in t["silver_cuarentena"].collect())
    assert reasons == {
        ("TRANSMETRO", "duplicado_torniquete"): 2,
        ("TRANSMETRO", "fecha_futura"): 1,
        ("TRANSMETRO", "formato_invalido"): 1,
        ("TRANSURBANO", "parada_nula"): 2,
        ("TRANSURBANO", "fecha_futura"): 2,
        ("TRANSURBANO", "transaccion_no_exitosa"): 2,
        ("METRORIEL", "viaje_sin_salida"): 1,
        ("METRORIEL", "formato_invalido"): 1,
        ("AEROMETRO", "fecha_futura"): 1,
        ("PADRON", "formato_invalido"): 1,
    }


def test_no_row_is_lost(spark, loaded):
    """Loaded ids = accepted ids plus distinct rejected ids, per source."""
    t = loaded[3]["tables"]
    stg = loaded[0].read("stg_tu_transacciones")
    ok = t["silver_tu_transacciones"].select(F.col("transaccion_id").alias("id"))
    bad = t["silver_cuarentena"].filter("fuente = 'TRANSURBANO'").select(F.col("id_registro").alias("id")).distinct()
    assert ok.intersect(bad).count() == 0
    assert ok.unionByName(bad).count() == stg.count() == loaded[2]["tu_transacciones"]


def test_registry(loaded):
    t = loaded[3]["tables"]
    now = {r.tarjeta_tm: r for r in t["silver_padron_transmetro_vigente"].collect()}
    assert (now["TC-00000009"].perfil, now["TC-00000009"].estado_vigente) == ("general", "INACTIVO")
    assert (now["TC-00000007"].perfil, now["TC-00000007"].zona_residencia) == ("adulto_mayor", None)
    assert now["TC-00000012"].estado_vigente == "ACTIVO"  # order is seq, not commit time
    versions = t["silver_padron_transmetro_scd2"]
    current = versions.groupBy("tarjeta_tm").agg(F.count_if("es_version_vigente").alias("n"))
    assert set(r.n for r in current.collect()) == {1}
    filled = {r.seq: r.zona_residencia for r in versions.collect()}
    assert filled[7] == "Zona 1"  # the history fills each column on its own


def test_dimensions_and_contracts(loaded):
    t = loaded[3]["tables"]
    for name, contract in CONTRACTS.items():
        assert [(f.name, f.dataType) for f in t[name].schema if f.name != "dia"] == [
            (f.name, f.dataType) for f in contract
        ], name
    zones = [z for _, z in rows(t["dim_zona"], "zona_key", "zona_nombre")]
    assert zones == sorted(zones) and "Villa Nueva" in zones
    assert t["dim_estacion"].count() == 10
    hours = t["dim_tiempo"].agg(F.count("*").alias("n"), F.min("tiempo_key").alias("a"), F.max("tiempo_key").alias("b")).first()
    assert (hours.a, hours.b) == (2026060300, 2026083010)
    users = t["dim_usuario"]
    seven = users.filter(F.col("vinculo_persona") == "NUMERO_TARJETA").groupBy("persona_key").count()
    assert seven.agg(F.max("count")).first()[0] == 3  # three cards, one person
    plain = {r.estado_padron for r in users.filter("operador = 'TRANSMETRO'").collect()}
    assert plain == {"ACTIVO", "INACTIVO", "SIN_PADRON"}


def test_key_report(loaded):
    failing = {(r.tabla, r.prueba, r.columna): r.fallas for r in loaded[3]["checks"].collect() if r.fallas}
    assert failing == {("fact_abordaje", "not_null", "estacion_key"): 1}  # the unknown station, reported


def test_facts_and_marts(loaded):
    t = loaded[3]["tables"]
    fact = t["fact_abordaje"]
    assert fact.count() == 11 + 6 + 4 + 4
    assert t["mart_demanda"].agg(F.sum("abordajes")).first()[0] == fact.filter("estacion_key is not null").count()
    cover = {r.zona_nombre: r for r in t["mart_cobertura_zona"].collect()}
    assert len(cover) == 25 + 3 and cover["Zona 25"].n_modos_con_servicio == 0
    assert (cover["Mixco"].n_modos_con_servicio, cover["Zona 12"].estaciones_metroriel) == (2, 1)
    combos = {r.combinacion: r.personas for r in t["mart_transbordo"].collect()}
    assert combos == {
        "METRORIEL + TRANSMETRO + TRANSURBANO": 1, "TRANSMETRO": 3, "TRANSURBANO": 1, "METRORIEL": 1, "AEROMETRO": 2,
    }
    od = {(r.estacion_origen, r.estacion_destino): (r.viajes, r.duracion_promedio_s) for r in t["mart_metroriel_od"].collect()}
    assert od == {("1", "2"): (1, 1200.0), ("2", "1"): (2, 1500.0), ("1", "1"): (1, 300.0)}
    served = {r.zona_nombre: r for r in t["mart_metroriel_zona"].collect()}
    assert served["Zona 12"].en_trazado_metroriel and served["Zona 12"].abordajes_otros_modos == 2
    assert min(r.ranking_demanda_otros_modos for r in served.values()) == 1
    assert marts.trips_in(fact, "fecha_hora", date(2026, 6, 1), date(2026, 7, 1)).first()[0] == 21
    assert marts.same_zone_share(t["mart_metroriel_od"]).first().misma_zona == 1


def test_person_features(loaded):
    f = loaded[3]["tables"]["feat_usuario"]
    total = f.agg(F.sum("viajes_total")).first()[0]
    assert total == 25 and {r.fecha_corte for r in f.collect()} == {date(2026, 8, 31)}
    top = f.orderBy(F.desc("viajes_total")).first()
    assert (top.n_modos_distintos, top.modo_mas_usado) == (3, "TRANSMETRO")
    assert abs(top.gasto_total_gtq - (5 * 1.0 + 3 * 1.1 + 3.5)) < 1e-9


def test_rank_ids_follow_the_text_order(spark, loaded):
    raw = bronze.latest_sources(spark, loaded[0].bronze)["tu_transacciones"]
    ranked = staging.tu_transactions(raw, "rank").orderBy("transaccion_id").collect()
    assert [r.transaccion_id for r in ranked] == list(range(1, 12))
    assert ranked[0].fecha_hora == datetime(2026, 7, 2, 10)  # 02/07 sorts first as text


# ---- cut features ------------------------------------------------------------------------------


def test_cut_features(loaded):
    f = loaded[3]["tables"]["feat_cortes"].filter("corte = 'A'")
    got = {r.unidad_id: r for r in f.collect()}
    # P9 deleted before the cut, P12/P13 no trip before it
    assert set(got) == {"P7", "P8", "P10", "P11", "Aaaaaaaaaaaaa", "Abbbbbbbbbbbb"}
    p7 = got["P7"]
    assert p7.viajes_28d == 4 + 3 + 1 and p7.tarjetas == "0000000007;MR0000007;TC-00000007"
    assert (p7.n_operadores, p7.n_zonas) == (3, 5)  # unknown zone is not counted
    assert p7.perfil == "adulto_mayor" and got["P8"].perfil == "sin_padron"
    assert p7.etiqueta == 1  # next event exactly at t + 30 d
    assert got["P8"].etiqueta == 0  # event exactly at t
    assert got["P8"].max_dias_sin_viajar == 0 and got["P8"].dias_activos_28d == 1
    assert got["P10"].etiqueta == 0 and got["P10"].perfil == "estudiante"  # deleted only later
    assert p7.max_dias_sin_viajar == 8  # June 11 to June 20
    assert got["P11"].viajes_28d == 3
    shares = ["prop_transmetro", "prop_transurbano", "prop_metroriel", "prop_aerometro"]
    for r in got.values():
        assert abs(sum(r[c] for c in shares) - 1) < 1e-12
    assert abs(got["Abbbbbbbbbbbb"].dias_desde_ultimo_viaje - 1 / 86400) < 1e-12


def test_labels_need_the_horizon(loaded):
    lake = loaded[0]
    f = lake.read("feat_cortes").filter("corte = 'C'")
    assert all(r.etiqueta is None for r in f.collect())
    with pytest.raises(CF.InsufficientData):
        lakehouse.cuts_table(lake, {"C": CUTS["C"]}, C.CutWindows(), labels="require")


def test_stacked_cuts_equal_single_cuts(loaded):
    lake = loaded[0]
    stacked = lakehouse.cuts_table(lake, CUTS, C.CutWindows())
    for name, day in CUTS.items():
        alone = lakehouse.cuts_table(lake, {name: day}, C.CutWindows())
        diff = quality.table_diff(stacked.filter(F.col("corte") == name), alone, ["unidad_id"]).first()
        assert diff.diferencias == 0


def test_leak_audit_silver_and_raw(spark, loaded):
    lake = loaded[0]
    cut, limit = {"A": CUTS["A"]}, datetime(2026, 7, 1)
    full = lakehouse.cuts_table(lake, cut, C.CutWindows(), labels="none")
    known = lakehouse.cuts_table(lake, cut, C.CutWindows(), labels="none", until=limit)
    assert lakehouse.leak_report(full, known).first().diferencias == 0

    frames = bronze.latest_sources(spark, lake.bronze)
    strict = lakehouse.features_from_raw(frames, fx.SETTINGS, cut, C.CutWindows(), until=limit)
    found = lakehouse.leak_report(full, strict).first()
    # one rail trip entered before the cut and closed after it: only the raw audit can see it
    assert found.dif_viajes_28d == 1 and found.solo_a == found.solo_b == 0
    same = lakehouse.features_from_raw(frames, fx.SETTINGS, cut, C.CutWindows())
    assert lakehouse.leak_report(full, same).first().diferencias == 0


def test_table_diff_finds_differences(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, None, "y"), (3, 1.0, None)], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.0 + 1e-12, "x"), (2, 0.0, "y"), (4, 1.0, None)], "k int, v double, s string")
    d = quality.table_diff(a, b, ["k"]).first()
    assert (d.solo_a, d.solo_b, d.dif_v, d.dif_s, d.diferencias) == (1, 1, 1, 0, 3)
    assert [r.k for r in quality.only_in(a, b, ["k"]).collect()] == [3]


def test_counterfactual_and_subpopulation(loaded):
    lake = loaded[0]
    tables = {n: lake.read(n) for n in lakehouse.BY_DAY if n.startswith("silver")}
    ev, log = CF.events(tables), CF.registry(lake.read("silver_cdc_padron"))
    r = CF.card_counterfactual(ev, log, CUTS["A"]).first()
    # cards: TC-7, 0..7, TC-8, 0..10, MR-11, two hashes; TC-9 deleted, MR-7 has one trip
    assert (r.poblacion_tarjetas, r.positivos_tarjeta) == (7, 5)
    f = lakehouse.cuts_table(lake, {"A": CUTS["A"]}, C.CutWindows())
    s = CF.subpopulation(f, F.col("unidad_id").startswith("A")).first()
    assert (s.unidades, s.de_la_poblacion, s.positivos) == (2, 6, 2)


# ---- idempotency, prediction ------------------------------------------------------------------------


def test_second_load_is_identical(spark, loaded, tmp_path):
    _, raw, _, result = loaded
    again = lakehouse.full_load(
        lakehouse.Lake(spark, str(tmp_path / "again")), raw, fx.SETTINGS, datetime(2026, 9, 1, 5), date(2026, 9, 1),
        cuts=CUTS,
    )
    a = lakehouse.lake_fingerprint(result["tables"])
    b = lakehouse.lake_fingerprint(again["tables"])
    assert quality.table_diff(a, b, ["tabla"]).first().diferencias == 0


def test_fingerprints_add_up_by_part(spark, tmp_path):
    rows = [(i, "a|b" if i % 2 else "a", "c", None if i % 5 else f"n{i}", f"2026-01-0{1 + i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "i long, x string, y string, z string, dia string")
    whole = quality.fingerprint(df, "t").first()
    parts = quality.part_fingerprints(df, "t", "dia")
    assert parts.count() == 3 and quality.merged_fingerprint(parts).first() == whole and len(whole.huella) == 32
    assert quality.fingerprint(df.repartition(5), "t").first() == whole
    swapped = df.selectExpr("i", "y as x", "x as y", "z", "dia")
    moved = df.selectExpr("i", "case when i = 1 then 'a' else x end x", "case when i = 1 then 'b|c' else y end y", "z", "dia")
    empty = df.selectExpr("i", "x", "y", "coalesce(z, '') z", "dia")
    assert len({quality.fingerprint(d, "t").first().huella for d in (df, swapped, moved, empty, df.unionByName(df))}) == 5
    # only the changed day is read again
    df.write.partitionBy("dia").parquet(f"{tmp_path}/t")
    new = spark.createDataFrame([(99, "q", "c", None)], "i long, x string, y string, z string")
    new.write.mode("append").parquet(f"{tmp_path}/t/dia=2026-01-02")
    table = spark.read.schema(df.schema).parquet(f"{tmp_path}/t")
    again = quality.refreshed_parts(parts, table, "t", "dia", ["2026-01-02"])
    assert quality.merged_fingerprint(again).first() == quality.fingerprint(table, "t").first() != whole
    plan = quality.part_fingerprints(table.filter("dia in ('2026-01-02')"), "t", "dia")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dia" in plan and "2026-01-02" in plan
    assert quality.fingerprint(df.limit(0), "t").first().huella == "0" * 32


def test_predict_and_invariance(spark, loaded, tmp_path):
    lake = loaded[0]
    w = C.CutWindows()
    num = CF.feature_columns(w, C.OPERATOR_CODES)
    feats = lake.read("feat_cortes").filter("corte = 'A'")
    model = models.logistic_pipeline(num, 0.0, 1.0, feats.count()).fit(feats)
    pack = str(tmp_path / "model")
    models.save_package(model, pack, "v1", "logistica", 0.325, "corte A", num)
    long = lakehouse.predict(lake, pack, CUTS["A"], str(tmp_path / "long"), w)
    short = lakehouse.predict(lake, pack, CUTS["A"], str(tmp_path / "short"), w, until=datetime(2026, 7, 1))
    assert long.columns == ["unidad_id", "tarjetas", "puntaje", "contactar"] and long.count() == 6
    assert lakehouse.invariance_report(short, long).first().diferencias == 0
    meta = models.load_package(spark, pack)[1]
    assert (meta.version, meta.umbral) == ("v1", 0.325)


def test_write_once_and_contract(spark, tmp_path):
    df = spark.range(3)
    sinks.write_once(df, str(tmp_path / "once"))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.write_once(df, str(tmp_path / "once"))
    with pytest.raises(TypeError, match="zona_key"):
        sinks.conform(df, CONTRACTS["dim_zona"], "dim_zona")


def test_rules_of_one_source_share_a_scan(loaded, spark):
    frames = bronze.latest_sources(spark, loaded[0].bronze)
    stg = staging.build(frames)
    checked = quality.with_reasons(stg["stg_am_boardings"], silver.am_rules(fx.SETTINGS))
    assert quality.accepted(checked).count() + checked.filter(F.size(quality.REASONS) > 0).count() == 5
