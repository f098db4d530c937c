"""Repeated passages against a plain version over all strings of 50 bytes."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farelake.llm import suffix_dedup

LENGTH = suffix_dedup.LENGTH


def plain(rows):
    first, last = {}, (1 << 63) - 1
    for i, text, *_ in rows:
        raw = (text or "").encode()
        key = last if i is None else i
        for p in range(len(raw) - LENGTH + 1):
            s = raw[p : p + LENGTH]
            first[s] = min(first.get(s, key), key)
    out = []
    for i, text, *_ in rows:
        raw, key = (text or "").encode(), last if i is None else i
        gone = bytearray(len(raw))
        for p in range(len(raw) - LENGTH + 1):
            if first[raw[p : p + LENGTH]] < key:
                gone[p : p + LENGTH] = b"\1" * LENGTH
        spans = sum(gone[p] and not (p and gone[p - 1]) for p in range(len(gone)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abé") for _ in range(rnd.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rnd.randint(8, 40)) for _ in range(6)]
    rows = []
    for i in rnd.sample(range(1000), 60):
        text = prose(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 3)):
            piece = rnd.choice(shared)
            a = rnd.randint(0, len(piece) // 2)
            text += piece[a : a + rnd.randint(30, len(piece))] + prose(rnd.randint(0, 9))
        rows.append((i, text, "x"))
    rows += [(2000, "ab" * 400, "x"), (1999, "ab" * 26, "x"), (2001, "c" * 300, "x"), (2002, "c" * 49, "x"), (2003, "c" * 50, "x")]
    rows += [(3000, None, "x"), (3001, "", "x"), (None, rows[0][1] + "tail", "x"), (3002, rows[1][1], "x"), (3003, rows[1][1], "x")]
    rows += [(rows[2][0], rows[2][1], "x"), (rows[3][0], rows[4][1], "x"), (3004, shared[0] * 30 + prose(2000), "x")]
    rows += [(3005, "q" * 20 + "r" * 50, "x"), (3006, "r" * 50 + "s", "x"), (3007, "t" * 9 + "r" * 49, "x")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_removal(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(4)
    got = sorted(map(tuple, suffix_dedup.dedup(docs, ["doc_id"]).collect()), key=str)
    assert got == plain(rows)


def test_one_group_of_copies_and_one_common_line(spark):
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    line, copy = text(80), text(150)
    rows = [(i, copy) for i in range(200)] + [(1000 + i, text(90) + line + text(30)) for i in range(300)]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_text_that_remains(spark):
    rows = [(1, "é" * 60 + "first", "x"), (2, "a" + "é" * 60 + "b", "y"), (3, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = suffix_dedup.dedup(docs, ["doc_id", "lang"], suffix_dedup.remaining, suffix_dedup.REMAINING)
    assert sorted(map(tuple, got.collect())) == [(1, "x", "é" * 60 + "first"), (2, "y", "ab"), (3, "z", "")]


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.dedup(docs, ["doc_id"]).count() == 0
    one = docs.unionByName(spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.lit("w " * 99).alias("text")))
    assert [tuple(r)[1:4] for r in suffix_dedup.dedup(one, ["doc_id"]).collect()] == [(198, 0, 0)]


def test_texts_that_agree_in_half_of_their_hashes(spark):
    line = "the licence text that every file here repeats "[:42]
    rows = [(1, line + "55awdx0x"), (2, line + "cittjhh3"), (3, line + "i1ktv5ao"), (4, line + "x1wa3kg4")]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows) and not any(r.n_removed for r in got)


def test_a_crowded_trigger_is_spread(spark, monkeypatch):
    rnd = random.Random(7)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    line = text(80)
    rows = [(i, line + text(60)) for i in rnd.sample(range(9000), 1500)] + [(None, line + text(60)), (None, line + text(60))]
    rows += [(9000 + i, text(70) + line[:60] + text(30)) for i in range(20)] + [(rows[0][0], line + text(55))]
    suffixes = suffix_dedup._suffixes

    def bounded(batches):
        taken = {}
        for batch in batches:
            for trigger in batch.column("q_trigger").to_pylist():
                taken[trigger] = taken.get(trigger, 0) + 1
                assert taken[trigger] <= 1000
            yield from suffixes([batch])

    monkeypatch.setattr(suffix_dedup, "_suffixes", bounded)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, suffix_dedup.dedup(docs, ["doc_id"]).collect()), key=str) == plain(rows)


def test_a_phrase_that_its_document_repeats_is_asked_for_once(spark, monkeypatch):
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    line = text(90)
    rows = [(i, " ".join([text(20) + line + text(20)] * 30) + line[i : 70 + i] + text(40)) for i in range(8)]
    suffixes = suffix_dedup._suffixes

    def bounded(batches):
        asked = set()
        for batch in batches:
            pairs = list(zip(batch.column("q_doc").to_pylist(), batch.column("q_code").to_pylist()))
            assert len({*pairs}) == len(pairs) and not asked & {*pairs}
            asked |= {*pairs}
            yield from suffixes([batch])

    monkeypatch.setattr(suffix_dedup, "_suffixes", bounded)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, suffix_dedup.dedup(docs, ["doc_id"]).collect()), key=str) == plain(rows)


def test_triggers_stay_together_wherever_batches_end(monkeypatch):
    rnd = random.Random(3)
    rows = []
    for trigger in range(40):
        base = bytes(rnd.choice(b"ab") for _ in range(60))
        rows += [(trigger, 100 * trigger + i, rnd.randint(0, 50), base[i % 3 : 53 + i % 7]) for i in range(rnd.randint(1, 9))]
    names = ["q_trigger", "q_code", "q_doc", "q_text"]

    def answers(size, held):
        monkeypatch.setattr(suffix_dedup, "SORT_ROWS", held)
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i : i + size]]) for i in range(0, len(rows), size)]
        out = list(suffix_dedup._suffixes(batches))
        return len(out), sorted(tuple(r.values()) for batch in out for r in batch.to_pylist())

    (_, expected), (n, got) = answers(len(rows), 10**6), answers(7, 5)
    assert expected and n > 5
    assert all(answers(*sizes)[1] == expected for sizes in ((7, 5), (1, 1), (3, 50), (64, 10))) and got == expected


def test_temporary_arrays_of_a_piece_stay_small():
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("abcdefgh ", k=3000)) for _ in range(1000)]
    batch = pa.RecordBatch.from_pydict({"doc_key": list(range(1000)), "text": texts})
    suffix_dedup.K.prefix_sums(np.zeros(1, np.uint8))
    suffix_dedup.K.powers(suffix_dedup.K._INVERSE, 1)
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in suffix_dedup._entries(4)([batch]))
        assert rows and tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()
