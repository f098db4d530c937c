"""The pipeline against a plain version, stage by stage, and the registered queries."""

import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_pairs import edited, plain_classes, prose, words
from test_suffix_dedup import LENGTH
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from farelake.llm import decontamination, quality, queries


def make_tables(folder):
    rnd = random.Random(12)
    items = [(i, prose(rnd, 30)) for i in range(6)]
    shared = prose(rnd, 25)
    docs = []
    for i in range(150):
        text = prose(rnd, rnd.randint(15, 90))
        if i % 5 == 0:
            text += " " + shared + " " + prose(rnd, 12)
        if i % 11 == 0:
            text += " " + edited(rnd, items[i % 6][1], 0.1) + " " + prose(rnd, 9)
        if i % 7 == 0:
            text = " %%% ".join(text.split()[:20]) + " %%%" * 20
        docs.append((i * 2, text))
    docs += [(400 + i, edited(rnd, docs[1][1] if i < 15 else docs[2][1], 0.01)) for i in range(30)]
    docs += [(600, None), (601, ""), (602, docs[8][1]), (603, docs[9][1] + " " + prose(rnd, 2000)), (None, prose(rnd, 40)), (604, "é" * 80), (605, "x" + "é" * 60)]
    labels = [(i, int("%%%" not in (t or "")), 0) for i, t in docs if i is not None and i < 300] + [(600, None, 0), (None, 1, 0)]
    n = len(docs)
    tables = {
        "documents": pa.table({
            "doc_id": pa.array([d for d, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string()),
            "lang": ["en"] * n, "source": [None if i % 9 else "s" for i in range(n)],
            "n_chars": pa.array([len(t or "") for _, t in docs], pa.int64()),
        }),
        "labels": pa.table({"doc_id": pa.array([x[0] for x in labels], pa.int64()), "quality": pa.array([x[1] for x in labels], pa.int32()), "toxic": pa.array([0] * len(labels), pa.int32())}),
        "benchmark": pa.table({"item_id": pa.array([i for i, _ in items] + [9], pa.int64()), "text": [t for _, t in items] + [None]}),
    }
    for name, table in tables.items():
        pq.write_table(table, f"{folder}/{name}.parquet")
    return docs, labels, items


def plain_passages(rows):
    """Texts without what stands in a document with a smaller id; characters go whole."""
    last, first = (1 << 63) - 1, {}
    for i, text in rows:
        raw, key = (text or "").encode(), last if i is None else i
        for p in range(len(raw) - LENGTH + 1):
            first[raw[p : p + LENGTH]] = min(key, first.get(raw[p : p + LENGTH], key))
    for i, text in rows:
        raw, key = (text or "").encode(), last if i is None else i
        gone = bytearray(len(raw))
        for p in range(len(raw) - LENGTH + 1):
            if first[raw[p : p + LENGTH]] < key:
                gone[p : p + LENGTH] = b"\1" * LENGTH
        yield i, bytes(b for b, g in zip(raw, gone) if not g).decode(errors="ignore")


def leaked(text, items):
    w = np.array(words(text), np.uint64)
    for _, item in items if len(w) else []:
        item = np.array(words(item), np.uint64)
        score, matches, first, end = decontamination.align(item, w)
        if score >= 0.5 * 2 * len(item) or matches >= 13 and matches >= 0.8 * (end - first):
            return True
    return False


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_pipeline(spark, tmp_path):
    docs, labels, items = make_tables(tmp_path)
    sf = str(tmp_path)
    now = spark.read.parquet(f"{sf}/documents.parquet")
    names, seen = now.columns, rows_of(now)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "passages", "leaks", "tokens"]

    def step(name):
        nonlocal now
        now = stages[name](spark, now, sf)
        now.write.parquet(f"{sf}/out-{name}")
        now = spark.read.parquet(f"{sf}/out-{name}")
        assert name == "tokens" or now.columns == names
        return now

    model = quality.train(now, spark.read.parquet(f"{sf}/labels.parquet"))
    score = lambda t: model.scores(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]
    want = [(i, t) for i, t in seen if score(t or "") >= 0.5]
    assert rows_of(step("quality")) == want and 0 < len(want) < len(seen)
    assert sum("%%%" in (t or "") for _, t in want) < 3 and len(want) > 0.75 * len(seen)

    of = dict(plain_classes([(i, t) for i, t in want]))
    got = rows_of(step("near_duplicates"))
    assert [i for i, _ in got] == sorted(set(of.values()), key=str) and set(got) <= set(want)

    want = sorted(plain_passages(got), key=str)
    got = rows_of(step("passages"))
    assert got == want and all(r.n_chars == len(r.text) for r in now.collect())
    assert now.filter("lang is null").count() == 0

    want = [(i, t) for i, t in got if not leaked(t, items)]
    assert rows_of(step("leaks")) == want and len(want) < len(got)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    tokens = [(i, library.encode(t, add_special_tokens=False).ids, t) for i, t in want]
    tokens = sorted(((i, len(x), sha(",".join(map(str, x))), sha(t)) for i, x, t in tokens), key=str)
    assert sorted(map(tuple, step("tokens").collect()), key=str) == tokens
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=str) == tokens


def test_registered():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert queries.SQL.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", ["op4_suffix_dedup", "op9_near_duplicates"])
def test_sql(spark, tmp_path, name):
    make_tables(tmp_path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet')")
    got = queries.QUERIES[name](spark, str(tmp_path))
    want = con.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(map(tuple, want.fetchall()), key=str)
