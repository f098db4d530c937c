"""Streaming jobs over several micro-batches against their batch results."""

import os
from datetime import date, datetime

import lake_fixture as fx
import pytest
from pyspark.sql import functions as F

from farelake import config as C
from farelake.operators import cdc
from farelake.operators.quality import Rule
from farelake.plans import silver, staging
from farelake.sources.schemas import SOURCES
from farelake.streaming import jobs, updates


def split_csv(folder, lines, size):
    """The file in pieces of ``size`` rows, in arrival order."""
    os.makedirs(folder)
    for k in range(0, len(lines) - 1, size):
        path = f"{folder}/{k:04d}.csv"
        with open(path, "w") as f:
            f.write("\n".join([lines[0], *lines[1 + k : 1 + k + size]]) + "\n")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


@pytest.fixture()
def validations(spark, tmp_path):
    split_csv(f"{tmp_path}/topic", fx.tm_rows(), 3)
    schema = SOURCES["tm_validaciones"].schema
    return jobs.read_files(spark, f"{tmp_path}/topic", schema, "csv", files_per_batch=1)


def typed(stream):
    return staging.tm_validations(stream.withColumn("ts_ingesta", F.lit(None).cast("timestamp_ntz"))).drop("ts_ingesta")


def test_landing_is_exactly_once(spark, validations, tmp_path):
    for _ in range(2):  # the second run finds nothing new
        jobs.land(
            validations, "tm_validaciones", f"{tmp_path}/bronze", f"{tmp_path}/cp", datetime(2026, 9, 1), date(2026, 9, 1)
        )
    got = spark.read.parquet(f"{tmp_path}/bronze")
    assert got.count() == len(fx.tm_rows()) - 1
    assert {"ts_ingesta", "fecha_ingesta", "fuente_archivo"} <= set(got.columns)


def test_clean_splits_valid_and_quarantine(spark, validations, tmp_path):
    duplicate = Rule(C.REASON_DUPLICATE, F.lit(True), "repetida")
    jobs.clean(
        typed(validations), f"{tmp_path}/out", f"{tmp_path}/cp", C.TRANSMETRO, ["validacion_id"], ["fecha_hora"],
        "fecha_hora", F.col("validacion_id"), silver.tm_rules(fx.SETTINGS), duplicate,
    )
    valid = spark.read.parquet(f"{tmp_path}/out/validos")
    assert sorted(r.validacion_id for r in valid.collect()) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12]
    bad = spark.read.parquet(f"{tmp_path}/out/cuarentena").groupBy("motivo").count()
    assert {r.motivo: r["count"] for r in bad.collect()} == {
        "duplicado_torniquete": 2, "fecha_futura": 1, "formato_invalido": 1,
    }
    assert valid.select(updates.BATCH).distinct().count() > 1  # repeats were found across batches


def _batches(spark, tmp_path, files):
    """A folder of one file per list of rows, read one micro-batch at a time."""
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "id long, t timestamp_ntz, ok boolean").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    return jobs.read_files(spark, f"{tmp_path}/in", schema, "parquet", "*.parquet", files_per_batch=1)


def test_clean_remembers_rejected_reads_and_survives_a_batch_without_valid_rows(spark, tmp_path):
    at = lambda h: datetime(2026, 1, 1, h)
    files = [[(1, at(1), False)], [(1, at(2), True), (2, at(3), True)], [(2, at(4), True), (None, at(5), True), (3, at(6), True)]]
    rules = [Rule("malo", ~F.col("ok"), "no vale")]
    jobs.clean(
        _batches(spark, tmp_path, files), f"{tmp_path}/out", f"{tmp_path}/cp", "x", ["id"], ["t"], "t", F.col("id").cast("string"),
        rules, Rule(C.REASON_DUPLICATE, F.lit(True), "repetida"),
    )
    valid = spark.read.parquet(f"{tmp_path}/out/validos")
    assert sorted(str(r.id) for r in valid.collect()) == ["2", "3", "None"]
    bad = spark.read.parquet(f"{tmp_path}/out/cuarentena")
    assert sorted((r.id_registro, r.motivo) for r in bad.collect()) == [
        ("1", C.REASON_DUPLICATE), ("1", "malo"), ("2", C.REASON_DUPLICATE),
    ]


def test_clean_writes_a_file_for_a_day_and_not_one_a_task(spark, tmp_path):
    rows = [(i, datetime(2026, 1, 1 + i % 10, 5), True) for i in range(400) for _ in range(2)]  # repeats meet in several tasks
    jobs.clean(
        _batches(spark, tmp_path, [rows]), f"{tmp_path}/out", f"{tmp_path}/cp", "x", ["id"], ["t"], "t", F.col("id").cast("string"),
        [Rule("malo", ~F.col("ok"), "no vale")], Rule(C.REASON_DUPLICATE, F.lit(True), "repetida"),
    )
    valid = spark.read.parquet(f"{tmp_path}/out/validos")
    assert valid.count() == 400 and len(valid.inputFiles()) == 10


def test_first_arrivals_over_batches(spark, tmp_path):
    at = lambda h: datetime(2026, 1, 1, h)
    files = [[(1, at(1), True), (1, at(0), True)], [(1, at(2), True), (2, at(3), True)], [(2, at(4), True), (None, at(5), True), (None, at(5), True)]]
    jobs.first_arrivals(_batches(spark, tmp_path, files), f"{tmp_path}/out", f"{tmp_path}/cp", ["id"], ["t"])
    got = spark.read.parquet(f"{tmp_path}/out/primeras")
    assert sorted((str(r.id), r.t.hour) for r in got.collect()) == [("1", 0), ("2", 3), ("None", 5), ("None", 5)]


@pytest.mark.parametrize("spread", [0, 4])
def test_dedup_needs_the_future_rule_first(spark, validations, tmp_path, spread):
    rows = jobs.not_future(typed(validations), "fecha_hora", fx.AS_OF)
    kept = jobs.drop_repeats(rows, ["validacion_id"], "fecha_hora", "60 days", spread)
    updates.run_available(kept, f"{tmp_path}/cp", updates.batch_writer(f"{tmp_path}/out"))
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.validacion_id for r in got.collect()) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12]


def test_hourly_demand(spark, validations, tmp_path):
    rows = jobs.not_future(typed(validations), "fecha_hora", fx.AS_OF)
    jobs.hourly_demand(rows, "fecha_hora", "monto_gtq", ["linea"], "90 days", f"{tmp_path}/out", f"{tmp_path}/cp")
    got = updates.newest(spark, f"{tmp_path}/out", ["hora_ts", "linea"])
    by_hour = {(r.hora_ts, r.linea): (r.abordajes, r.centavos) for r in got.collect()}
    assert by_hour[datetime(2026, 6, 15, 8), "L1"] == (3, 300)  # repeated reads not yet removed here
    assert sum(n for n, _ in by_hour.values()) == len(fx.tm_rows()) - 3


@pytest.fixture()
def log(spark, tmp_path):
    split_csv(f"{tmp_path}/cdc", fx.CDC, 2)
    schema = SOURCES["cdc_padron_usuarios"].schema
    return (
        staging.registry_log(jobs.read_files(spark, f"{tmp_path}/cdc", schema, "csv", files_per_batch=1)),
        staging.registry_log(spark.read.schema(schema).option("header", True).csv(f"{tmp_path}/cdc")),
    )


def test_registry_equals_batch(spark, log, tmp_path):
    stream, batch = log
    body = ["perfil", "zona_residencia"]
    jobs.registry(stream, "tarjeta", body, f"{tmp_path}/out", f"{tmp_path}/cp")
    got = updates.newest(spark, f"{tmp_path}/out", ["tarjeta"])
    want = cdc.current_state(batch, "tarjeta", body)
    cols = want.columns
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.collect()))


def test_profile_lookup_on_a_stream(spark, validations, log, tmp_path):
    history = cdc.versions(log[1], "tarjeta", ["perfil", "zona_residencia"]).withColumnRenamed("tarjeta", "tarjeta_tm")
    rows = jobs.not_future(typed(validations), "fecha_hora", fx.AS_OF)
    jobs.profile_at_event(rows, history, "tarjeta_tm", "fecha_hora", ["perfil", "estado"], f"{tmp_path}/o", f"{tmp_path}/cp")
    got = {(r.validacion_id): (r.perfil, r.estado) for r in spark.read.parquet(f"{tmp_path}/o").collect()}
    assert got[1] == ("adulto_mayor", "ACTIVO")
    assert got[6] == ("general", "INACTIVO")
    assert got[4] == (None, None)


def test_key_state_survives_a_restart_and_reads_only_its_own_batch(spark, tmp_path):
    """Each run starts the query anew; repeats of keys read by earlier runs are still found."""
    at = lambda h: datetime(2026, 1, 1, h)
    runs = [[(k, at(1), True) for k in range(50)], [(k, at(2), True) for k in range(40, 60)], [(7, at(3), True), (59, at(4), True), (60, at(5), True)]]
    rules = [Rule("malo", ~F.col("ok"), "no vale")]
    for i, rows in enumerate(runs):
        spark.createDataFrame(rows, "id long, t timestamp_ntz, ok boolean").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        schema = spark.read.parquet(f"{tmp_path}/in").schema
        stream = jobs.read_files(spark, f"{tmp_path}/in", schema, "parquet", "*.parquet")
        jobs.clean(
            stream, f"{tmp_path}/out", f"{tmp_path}/cp", "x", ["id"], ["t"], "t", F.col("id").cast("string"), rules,
            Rule(C.REASON_DUPLICATE, F.lit(True), "repetida"),
        )
    valid = spark.read.parquet(f"{tmp_path}/out/validos")
    assert sorted(r.id for r in valid.collect()) == list(range(61))
    bad = spark.read.parquet(f"{tmp_path}/out/cuarentena").groupBy(updates.BATCH).count()
    assert {r[updates.BATCH]: r["count"] for r in bad.collect()} == {1: 10, 2: 2}
    assert not os.path.exists(f"{tmp_path}/out/vistos")


def test_marks_name_the_new_keys_of_each_batch(spark, tmp_path):
    at = lambda h: datetime(2026, 1, 1, h)
    files = [[(1, at(1), True), (1, at(1), True), (None, at(1), True)], [(1, at(2), True), (2, at(3), True)], [(2, at(4), True)]]
    seen, sizes = {}, []

    def write(batch, batch_id):
        batch.persist()
        seen[batch_id] = sorted(r.id for r in batch.filter(jobs.MARK).collect())
        sizes.append(batch.filter(~F.col(jobs.MARK)).count())
        batch.unpersist()

    with updates.rocksdb(spark):
        updates.run_available(jobs.mark_new_keys(_batches(spark, tmp_path, files), ["id"]), f"{tmp_path}/cp", write)
    assert seen == {0: [1], 1: [2], 2: []} and sizes == [3, 2, 1]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


@pytest.mark.parametrize("hot", [1 << 18, 3, 0])
def test_first_reads_are_flagged_as_the_aggregates_split_them(spark, monkeypatch, hot):
    """Keys of many reads go by the aggregates, all others by one window; both give the same rows."""
    monkeypatch.setattr(jobs, "HOT_ROWS", hot)
    at = lambda h: datetime(2026, 1, 1, h % 24) if h else None
    rows = [(k % 37 or None, at(k * 7 % 11), k % 3 == 0, False) for k in range(300)] + [(5, at(3), True, False)] * 40
    rows += [(k, None, None, True) for k in range(1, 30)]  # keys 30 to 36 were read before
    batch = spark.createDataFrame(rows, f"id long, t timestamp_ntz, ok boolean, {jobs.MARK} boolean").repartition(5).cache()
    got = jobs.with_first(batch, ["id"], ["t"])
    for part, flag in zip(jobs.split_by_marks(batch, ["id"], ["t"]), (True, False)):
        own = got.filter(F.col(jobs.FIRST) == flag).drop(jobs.FIRST)
        assert sorted(map(str, own.collect())) == sorted(map(str, part.collect()))
    assert got.count() == 340
