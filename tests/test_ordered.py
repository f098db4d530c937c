"""Ordered operators against plain Python on small, skewed inputs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelake.operators import ordered
from farelake.operators.cdc import as_of, current_state, versions, registry_status
from farelake.operators.dedup import content_ids, first_reads, ranked_ids, repeat_reads


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_number_all_matches_sort(spark):
    rng = random.Random(1)
    data = [(rng.randint(0, 3), rng.random()) for _ in range(200)]
    df = spark.createDataFrame(data, "a int, b double").repartition(5)
    got = ordered.number_all(df, ["a", "b"], "rn").orderBy("rn").collect()
    assert [(r.a, r.b) for r in got] == sorted(data)
    assert [r.rn for r in got] == list(range(1, 201))


@pytest.mark.parametrize("width", [1, 7, 40])
def test_fill_and_lead_does_not_depend_on_blocks(spark, width):
    rng = random.Random(2)
    keys = ["hot"] * 60 + ["a", "b"] * 10
    data = [(k, i, rng.choice([None, f"v{i}"]), i * 10) for i, k in enumerate(keys)]
    df = spark.createDataFrame(data, "k string, seq long, v string, t long")
    got = ordered.fill_and_lead(
        ordered.sequence_blocks(df, "seq", width), ["k"], "seq", ["v"], {"nxt": "t"}
    ).select("k", "seq", "v", "nxt")
    want, last = [], {}
    for i, (k, seq, v, t) in enumerate(data):
        last[k] = v if v is not None else last.get(k)
        nxt = next((r[3] for r in data[i + 1 :] if r[0] == k), None)
        want.append((k, seq, last[k], nxt))
    assert sorted(map(str, _rows_any(got))) == sorted(map(str, want))


def _rows_any(df):
    return [tuple(r) for r in df.collect()]


def test_expand_copies_large_and_small(spark):
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 10)], "k string, n long")
    got = ordered.expand_copies(df, "n", "i", chunk=10).groupBy("k").agg(
        F.count("*").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi"), F.count_distinct("i").alias("d")
    )
    assert _rows(got) == [("a", 25, 1, 25, 25), ("b", 1, 1, 1, 1), ("c", 10, 1, 10, 10)]


def test_first_and_repeat_reads_partition_the_input(spark):
    data = [(1, 5, "x"), (1, 5, "x"), (1, 5, "x"), (1, 7, "y"), (2, 1, None), (None, 3, "z"), (None, 2, "z")]
    df = spark.createDataFrame(data, "id int, t int, s string")
    first = first_reads(df, ["id"], ["t"])
    rest = repeat_reads(df, ["id"], ["t"])
    key = lambda r: str(r)
    # reads without a key are malformed, not repeats of each other
    assert sorted(_rows_any(first), key=key) == sorted([(1, 5, "x"), (2, 1, None), (None, 2, "z"), (None, 3, "z")], key=key)
    assert sorted(_rows_any(rest), key=key) == sorted([(1, 5, "x"), (1, 5, "x"), (1, 7, "y")], key=key)


def test_a_read_without_a_time_does_not_displace_the_good_one(spark):
    df = spark.createDataFrame([(5, None, "bad"), (5, 9, "good"), (6, None, "only")], "id int, t int, s string")
    assert sorted(_rows_any(first_reads(df, ["id"], ["t"]))) == [(5, 9, "good"), (6, None, "only")]
    assert _rows_any(repeat_reads(df, ["id"], ["t"])) == [(5, None, "bad")]


def test_ids_for_rows_without_key(spark):
    data = [("b", None), ("a", "1"), ("a", "1"), ("a", "0")]
    df = spark.createDataFrame(data, "x string, y string")
    ranked = ranked_ids(df, [F.col("x").asc_nulls_last(), F.col("y").asc_nulls_last()], "id")
    assert [tuple(r) for r in ranked.orderBy("id").collect()] == [
        (1, "a", "0"), (2, "a", "1"), (3, "a", "1"), (4, "b", None),
    ]
    ids = [r.id for r in content_ids(df, "id").collect()]
    assert len(set(ids)) == 4
    more = spark.createDataFrame([*data, ("0", "0")], "x string, y string")
    assert set(ids) < {r.id for r in content_ids(more, "id").collect()}  # other rows keep their ids


LOG = [
    (1, "2026-01-01T00:00:00", "INSERT", "k", "p1", "z1"),
    (2, "2026-01-03T00:00:00", "UPDATE", "k", None, "z2"),
    (3, "2026-01-05T00:00:00", "DELETE", "k", None, None),
    (4, "2026-01-04T00:00:00", "INSERT", "k", "p3", None),
    (5, "2026-01-06T00:00:00", "UPDATE", "orphan", "p9", "z9"),
    (6, "2026-01-07T00:00:00", "DELETE", "never", None, None),
]


def _log(spark):
    df = spark.createDataFrame(LOG, "seq long, ts string, op string, k string, perfil string, zona string")
    return df.withColumn("commit_ts", F.col("ts").cast("timestamp_ntz")).drop("ts")


def test_current_state(spark):
    got = {r.k: (r.perfil, r.zona, r.ultima_operacion, r.ultimo_seq)
           for r in current_state(_log(spark), "k", ["perfil", "zona"]).collect()}
    assert got == {
        "k": ("p3", None, "INSERT", 4),  # body comes from one whole row
        "orphan": ("p9", "z9", "UPDATE", 5),
        "never": (None, None, "DELETE", 6),
    }
    early = current_state(
        _log(spark), "k", ["perfil", "zona"], when=F.col("commit_ts") < F.lit("2026-01-04").cast("timestamp_ntz")
    )
    assert {r.k: r.ultima_operacion for r in early.collect()}["k"] == "UPDATE"


@pytest.mark.parametrize("width", [1, 3, 40])
def test_versions(spark, width):
    got = versions(_log(spark), "k", ["perfil", "zona"], width).orderBy("seq").collect()
    k = [r for r in got if r.k == "k"]
    assert [(r.perfil, r.zona, r.estado) for r in k] == [
        ("p1", "z1", "ACTIVO"), ("p1", "z2", "ACTIVO"), ("p1", "z2", "INACTIVO"), ("p3", "z2", "ACTIVO"),
    ]
    assert [r.es_version_vigente for r in k] == [False, False, False, True]
    assert k[2].valid_to < k[2].valid_from  # commit times run against seq: kept as they are
    assert [r.valid_to is None for r in k] == [False, False, False, True]


@pytest.mark.parametrize("group_rows", [1, 2, 1000])
@pytest.mark.parametrize("block_seconds", [60, 86400, 10**9])
def test_as_of_is_the_same_however_it_is_cut(spark, group_rows, block_seconds):
    rng = random.Random(6)
    t0 = datetime(2026, 1, 1)
    log, t = [], t0
    for seq in range(40):
        t += timedelta(minutes=rng.randint(0, 90))
        log.append((seq, t, "UPDATE", rng.choice(["hot", "b"]), f"p{seq}"))
    events = [(i, rng.choice(["hot", "hot", "b", "none"]), t0 + timedelta(minutes=rng.randint(-60, 3000))) for i in range(120)]
    hist = versions(spark.createDataFrame(log, "seq long, commit_ts timestamp_ntz, op string, k string, perfil string"), "k", ["perfil"])
    df = spark.createDataFrame(events, "id int, k string, at timestamp_ntz")
    got = {r.id: r.perfil for r in as_of(df, hist, "k", "at", ["perfil"], block_seconds, group_rows).collect()}
    want = {
        i: next((p for s, c, _, kk, p in reversed(log) if kk == k and c <= at), None) for i, k, at in events
    }
    assert got == want


def test_as_of_lookup(spark):
    events = spark.createDataFrame(
        [(i, k, t) for i, (k, t) in enumerate([
            ("k", "2025-12-31T00:00:00"), ("k", "2026-01-01T00:00:00"), ("k", "2026-01-03T12:00:00"),
            ("k", "2026-01-04T00:00:00"), ("k", "2026-02-01T00:00:00"), ("other", "2026-02-01T00:00:00"),
        ])], "id int, k string, t string",
    ).withColumn("fecha_hora", F.col("t").cast("timestamp_ntz")).drop("t")
    hist = versions(_log(spark), "k", ["perfil", "zona"])
    got = {r.id: (r.perfil, r.version_seq) for r in as_of(events, hist, "k", "fecha_hora", ["perfil"]).collect()}
    assert got == {0: (None, None), 1: ("p1", 1), 2: ("p1", 2), 3: ("p3", 4), 4: ("p3", 4), 5: (None, None)}


def test_sparse_sequences_have_few_blocks(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), (F.col("id") * (1 << 22)).alias("seq"), F.col("id").alias("t"))
    blocks = ordered.sequence_blocks(df, "seq", 16)
    sizes = [r["count"] for r in blocks.groupBy(ordered.BLOCK).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 5000 / 16


def test_changes_without_a_place_in_the_log_have_no_state(spark):
    log = spark.createDataFrame(
        [("a", None, "INSERT", "x"), ("b", 1, "INSERT", "y"), ("b", None, "DELETE", None), (None, 3, "INSERT", "z"), ("c", 4, None, "w")],
        "k string, seq long, op string, perfil string",
    ).withColumn("commit_ts", F.lit("2026-01-01").cast("timestamp_ntz"))
    got = current_state(log, "k", ["perfil"]).withColumn("estado", registry_status(F.col("ultima_operacion")))
    assert sorted((r.k, r.perfil, r.estado) for r in got.collect()) == [("b", "y", "ACTIVO"), ("c", None, None)]
