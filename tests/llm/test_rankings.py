"""Shards, ranked search and the audit of filters against plain versions."""

import math
import re
import uuid
import zlib
from collections import Counter
from itertools import permutations

import pytest

from farelake.llm import filter_audit, lexical_search, sharding

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


# ---- shards ---------------------------------------------------------------------------------------

EXTRA = "doc_id long, text string, size string, shard string, part string, row string"


def rows_with_extras(pairs):
    return [(i, t, "a", "b", "c", "d") for i, t in pairs]


def plain_shards(pairs, shards):
    measure = sorted(((i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), i) for i, t in pairs), key=lambda x: x[:4])
    total, at, out, slots = sum(m[2] for m in measure), 0, [], Counter()
    for _, _, size, crc, i in measure:
        shard = (2 * at + size) * shards // (2 * total)
        out.append((i, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    return sorted(out, key=str)


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_shards_are_contiguous_and_even(spark, shards):
    pairs = [(i * 7 % 101, "wörd " * (i % 13)) for i in range(101)] + [(None, None), (None, "x"), (5, ""), (5, "same"), (5, "same")]
    pairs += [(0, "hot " * 5)] * 80
    docs = spark.createDataFrame(rows_with_extras(pairs), EXTRA).repartition(5)
    got = sorted((tuple(r) for r in sharding.assign(docs, shards).select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=str)
    assert got == plain_shards(pairs, shards)
    by_shard = Counter()
    for _, size, _, shard, _ in got:
        by_shard[shard] += size
    target, largest = sum(by_shard.values()) / shards, max(g[1] for g in got)
    assert all(abs(by_shard[s] - target) <= largest for s in range(shards))


def test_a_text_larger_than_a_shard_and_an_empty_table(spark):
    docs = spark.createDataFrame(rows_with_extras([(1, "a"), (2, "b" * 50_000), (3, "c")]), EXTRA)
    got = sorted((r.doc_id, r.shard, r.slot) for r in sharding.assign(docs, 8).collect())
    assert got == [(1, 0, 0), (2, 4, 0), (3, 7, 0)]
    assert sharding.assign(docs.limit(0), 8).count() == 0


def test_written_shards_hold_all_columns(spark, tmp_path):
    pairs = [(i % 40, f"text {i} " * (i % 9)) for i in range(300)] + [(None, None)] * 3
    docs = spark.createDataFrame(rows_with_extras(pairs), EXTRA).repartition(3)
    report = {r.shard: (r.rows, r.bytes) for r in sharding.write_shards(docs, f"{tmp_path}/s", 6).collect()}
    back = spark.read.parquet(f"{tmp_path}/s")
    rows = [(r["shard"], r.doc.doc_id, r.doc.text, r.doc.shard) for r in back.collect()]
    assert sorted(((i, t) for _, i, t, _ in rows), key=str) == sorted(pairs, key=str) and {x for *_, x in rows} == {"b"}
    want = Counter(s for *_, s, _ in plain_shards(pairs, 6))
    assert Counter(s for s, *_ in rows) == want and {s: n for s, (n, _) in report.items()} == want


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(rows_with_extras([(1, "a"), (2, "b")]), EXTRA)
    plan = sharding.assign(docs, 2)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InArrow|InPandas|ExistingRDD", plan)


# ---- search -----------------------------------------------------------------------------------------


def terms(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def plain_search(docs, items, top=20):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_words = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for i, bag, n in bags:
            m = 75 + 25 * n * n_docs // n_words if n_words else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
                for t in terms(text) if t in bag
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1)]
    return sorted(out, key=str)


COPIES = [(1000 - i, "the same copied text about rivers") for i in range(60)]
DOCS = [
    (i, " ".join(["river", "Straße", "the", "of", "MOUNTAIN", "x9", "lake", "a"][(i * k) % 8] for k in range(1, 3 + i % 11)))
    for i in range(80)
]
ODD = [(None, None), (None, "the river"), (7, ""), (3, "!!! ---"), (4, "river " * 4000), (4, "the lake"), (4, "the lake"), (None, "the same copied text about rivers")]
ITEMS = [(1, "The river, the lake"), (2, "about RIVERS copied"), (3, None), (4, ""), (5, "unknown words"), (None, "straße x9 x9"), (6, "The river, the lake"), (6, "the same")]


def search(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, n string, bag string").repartition(4)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in lexical_search.search(d, q, **kw).select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"top": 3}, {"block_chars": 15}])
def test_search_equals_the_definition(spark, kw):
    docs = DOCS + COPIES + ODD
    assert search(spark, docs, ITEMS, **kw) == plain_search(docs, ITEMS, kw.get("top", 20))


def test_search_with_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "_CELLS", 7)
    terms_ = lexical_search.Terms([t or "" for _, t in ITEMS])
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in DOCS], "text": [t for _, t in DOCS]})
    bags = lexical_search._bag_batch(batch, terms_)
    n = len(DOCS)
    classes = pa.RecordBatch.from_arrays(
        [bags.column("bag"), pa.array([80] * n), pa.array(range(n)), pa.array(range(n))], ["bag", "m", "h", "least"]
    )
    weights = lexical_search.np.arange(1, len(terms_) + 1)
    small = [tuple(r.values()) for b in lexical_search._score_batches([classes], terms_, weights, 5) for r in b.to_pylist()]
    monkeypatch.setattr(lexical_search, "_CELLS", 1 << 20)
    large = [tuple(r.values()) for b in lexical_search._score_batches([classes], terms_, weights, 5) for r in b.to_pylist()]
    assert small == large and len(small) > 5


def test_search_without_rows(spark):
    assert search(spark, [], ITEMS) == [] and search(spark, DOCS, []) == [] and search(spark, [(1, None), (2, "--")], ITEMS) == []


# ---- filters ----------------------------------------------------------------------------------------


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    last = 1 << 63
    least = {}
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", last), last if i is None else i)
    found = []
    for i, t, s in docs:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": (last if i is None else i) > least[t],
        }
        found.append((s or "", {f for f in fails if fails[f]}, i in good and i is not None, i in toxic and i is not None))
    out, removed = {}, Counter()
    for part in {p for p, *_ in found}:
        for order in permutations("ABCDE"):
            left = [x for x in found if x[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                alone = sum(x[0] == part and x[1] == {f} for x in found)
                out[part, "".join(order), step] = [
                    len(left), len(here), sum(f in x[1] for x in gone), alone, sum(x[2] for x in here), sum(x[3] for x in here)
                ]
                removed[part, f] += len(here)
                gone += here
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


LONG = " ".join(f"word{i}" for i in range(60))
TEXTS = [LONG, LONG + " #", "a " * 70, LONG.upper(), "", None, "short", "SHORT *", "ü " * 80, "x\x0by\x1cz", LONG + " " + "A" * 30]


def write_files(spark, folder, files):
    for docs in files:
        rows = [(i, t, s, "x", "y") for i, t, s in docs]
        spark.createDataFrame(rows, "doc_id long, text string, source string, part string, key string").coalesce(1).write.mode("append").parquet(folder)


def files_of_documents():
    docs = [((37 * k) % 200, TEXTS[(k * k) % len(TEXTS)], [None, "", "a", "b", "a"][k % 5]) for k in range(200)]
    docs += [(3, LONG, "c"), (3, LONG, "a"), (3, LONG, "a"), (None, LONG, "a"), (None, None, None), (None, "nobody else's", "b")]
    docs.sort(key=lambda d: -(d[0] or 0))  # the smallest ids come last
    return [docs[:70], docs[70:150], docs[150:]], docs


LABELS = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 200, 3)] + [(3, 0, 1), (None, 1, 1), (6, None, None)]


def label_frame(spark):
    return spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, part string")


def as_dict(report):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in report.collect()}


def test_audit_retracts_over_batches(spark, tmp_path):
    files, docs = files_of_documents()
    write_files(spark, f"{tmp_path}/in", files)
    stream = filter_audit.read_documents(spark, f"{tmp_path}/in", files_per_batch=1)
    got = filter_audit.audit(stream, label_frame(spark), f"{tmp_path}/out")
    assert as_dict(got) == plain_audit(docs, LABELS)
    assert spark.read.parquet(f"{tmp_path}/out/counts").filter("n < 0").count() > 0  # something was retracted


def test_audit_goes_on_after_a_restart(spark, tmp_path):
    files, docs = files_of_documents()
    run = lambda: filter_audit.audit(
        filter_audit.read_documents(spark, f"{tmp_path}/in", 1), label_frame(spark), f"{tmp_path}/out")
    write_files(spark, f"{tmp_path}/in", files[:1])
    assert as_dict(run()) == plain_audit(files[0], LABELS)
    write_files(spark, f"{tmp_path}/in", files[1:])
    assert as_dict(run()) == plain_audit(docs, LABELS)


def test_one_hot_text_is_few_rows_of_state(spark):
    rows = spark.range(5000).selectExpr("unhex('00') key", "id", "cast(id % 3 as string) part", "0 mask", "0 good", "0 toxic")
    state = spark.createDataFrame([(b"\0", "9", 0, 0, 0, 2, 7)], filter_audit._STATE)
    table = filter_audit.merged(rows, state)
    assert table.count() == 4
    assert [tuple(r)[1:] for r in filter_audit.next_state(table).collect()] == [("0", 0, 0, 0, 1, 0)]
    got = {(r.part, r.mask): r.n for r in filter_audit.changes(table).collect()}
    assert got == {("0", 0): 1, ("0", 16): 1666, ("1", 16): 1667, ("2", 16): 1666, ("9", 0): -2, ("9", 16): 2}


def test_audit_of_an_empty_table(spark, tmp_path):
    write_files(spark, f"{tmp_path}/in", [[]])
    stream = filter_audit.read_documents(spark, f"{tmp_path}/in")
    assert filter_audit.audit(stream, label_frame(spark).limit(0), f"{tmp_path}/out").count() == 0
