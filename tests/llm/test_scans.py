"""Fingerprints, licences and the classifier against plain versions."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from types import SimpleNamespace

import pyarrow as pa
import pytest

from farelake.llm import fingerprints, kernels, licences, near_duplicates, quality

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered_words(text):
    return WORD.findall(bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in (text or "").encode()))


def test_kernels_follow_the_definition():
    text = "Größe, MIT-License 3.0 x y Ünder_score"
    assert len(kernels.hash_words(text)) == len(lowered_words(text))
    assert (kernels.hash_words("MIT x") == kernels.hash_words("mit X")).all()


DOCS = [
    (1, "Now released under the MIT License. mit license", "a", "b"),
    (2, None, "a", "b"), (3, "", "a", "b"), (None, "Apache license and the General Public\nLicense", "a", "b"),
    (5, "This work is licensed under the GNU General Public License, version 3.", "a", "b"),
    (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "a", "b"),
    (7, "Redistribution and use in source, and binary forms: with or without", "a", "b"), (8, "mit", "a", "b"),
    (9, "license apache mit licenses general license", "a", "b"), (10, "word " * 3000 + "mit license", "a", "b"),
    (11, "license mit", "a", "b"), (1, "Licensed under CC BY-NC 4.0.", "a", "b"), (12, "plain text of a person", "a", "b"),
]
SCHEMA = "doc_id long, text string, labels string, score string"


def test_licences(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    got = {(r.doc_id, r.n_words): r for r in licences.scan(docs).collect()}
    assert len(got) == len(DOCS) and all(0 <= r.score <= 1 for r in got.values())
    for doc_id, text, _, _ in DOCS:
        words = lowered_words(text)
        places, labels = [], set()
        for phrase, label in licences.BASE.items():
            p = phrase.encode().split()
            found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        r = got[doc_id, len(words)]
        assert (r.n_base, r.first_word, r.last_word) == (len(places), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(filter(None, r.labels.split(",")))
    by_id = {k[0]: r.labels for k, r in got.items() if k != (1, 8)}
    assert by_id[6] == "mit" and by_id[7] == "bsd" and by_id[12] == "" and got[1, 7].labels == "cc-by-nc"
    assert licences.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_syncmers(text, k=24, s=8):
    raw = text.encode()
    sums = kernels.prefix_sums(kernels.np.frombuffer(raw, kernels.np.uint8))
    h = lambda i, j: int(kernels.span_hashes(sums, kernels.np.array([i]), kernels.np.array([j]))[0])
    out = {}
    for i in range(len(raw) - k + 1):
        inner = [h(j, j + s) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.setdefault(h(i, i + k) >> 24, i)
    return sorted(out.items())[: fingerprints.ANCHORS]


def test_syncmers_follow_the_definition():
    some = ["The quick brown fox jumps over the lazy dog, ünd so on and on. " * 2, "", "short", "a" * 90, "x" * 24]
    found = fingerprints.fingerprints(some)
    for text, one in zip(some, found):
        plain = plain_syncmers(text)
        assert list(zip(*one)) == plain or not plain
    assert found[1] == ([], []) and len(found[2][0]) == 1


def prose(seed, n):
    return " ".join(hashlib.md5(f"{seed}-{i}".encode()).hexdigest()[: 3 + (i * seed) % 7] for i in range(n))


@pytest.mark.parametrize("blocks", [1, 5, 40])
def test_neighbours(spark, blocks):
    data = [(i * 3 if i != 5 else None, prose(i, 40 + i), "x") for i in range(30)]
    data += [(200, None, "x"), (201, "", "x"), (202, "same text " * 20, "x"), (203, "same text " * 20, "x"), (204, "ü", "x")]
    data += [(50_000, prose(77, 9000), "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, fingerprint string").repartition(4)
    got = {r.doc_id: r for r in fingerprints.compare_neighbours(docs, blocks=blocks).collect()}
    assert len(got) == len(data)
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for (doc_id, text, _), (_, after, _) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        h = len(text) // 3
        edited = text[: len(text) - h] + after[:h]
        a, b, c = fingerprints.fingerprints([text, edited, after])
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprints.to_text(a), fingerprints.to_text(b))
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(a, b), fingerprints.likeness(a, c))
    assert got[203].near_next == 1.0 and got[50_000].near_edited > 0.3 > got[50_000].near_next


def test_neighbours_of_few_rows(spark):
    schema = "doc_id long, text string"
    assert fingerprints.compare_neighbours(spark.createDataFrame([], schema)).count() == 0
    one = fingerprints.compare_neighbours(spark.createDataFrame([(4, "abc" * 30)], schema)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    twice = spark.createDataFrame([(4, "abc" * 30), (4, "abd" * 30)], schema)
    assert fingerprints.compare_neighbours(twice, blocks=3).count() == 2


def test_classifier(spark):
    good = [(i, prose(i, 60)) for i in range(120)]
    bad = [(1000 + i, (prose(i, 3) + " %%% ") * 15) for i in range(90)]
    empty = [(2000, None), (2001, ""), (None, prose(3, 60)), (2002, prose(5, 40_000))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in good + bad + empty], "doc_id long, text string, score string")
    labels = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(5000, 1), (None, 1), (1, None), (2, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    for r in got:
        out = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1
        assert r.held_out == out and r.predicted == int(r.score >= 0.5)
    held = [(r.predicted, int(r.doc_id < 1000)) for r in got if r.held_out and r.doc_id < 2000]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    again = quality.score(docs.repartition(7), quality.train(docs.repartition(3), labels)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    nothing = spark.createDataFrame([], docs.schema)
    assert quality.score(nothing, model).count() == 0
    flat = quality.train(docs, spark.createDataFrame([], labels.schema))
    assert {r.score for r in quality.score(docs, flat).collect()} == {0.5}


def test_a_score_does_not_depend_on_its_neighbours():
    model = quality.fit([prose(1, 50), "%%% %%% " * 20], [1, 0])
    texts = [prose(i, 20 + i) for i in range(9)]
    one = lambda some: model.scores(*arrays(some)).tolist()
    assert one(texts) == [one([t])[0] for t in texts] and not math.isnan(one([""])[0])


def arrays(texts):
    raw = [t.encode() for t in texts]
    np = kernels.np
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_a_file_with_many_notices(spark):
    notices = [text for _, text, _ in licences.TEMPLATES]
    rows = [(i, text) for i, text in enumerate(notices)] + [(100, " --- ".join(notices))]
    rows += [(200 + i, "licensed under cc by nc 4 0 and cc by sa") for i in range(40)]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    every = {label for label, _, _ in licences.TEMPLATES}
    assert set().union(*(got[i].labels.split(",") for i in range(len(notices)))) >= every
    assert every <= set(got[100].labels.split(","))


def test_long_texts_that_share_a_passage():
    import random

    rnd = random.Random(5)
    text = lambda n: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))
    shared = text(3000)
    a, b = (fingerprints.fingerprints([text(60_000) + shared + text(40_000)])[0] for _ in range(2))
    least = len(fingerprints.fingerprints([shared])[0][0])
    assert fingerprints.likeness(a, b) == pytest.approx(least / len({*a[0], *b[0]}), rel=0.02)


def test_tables_that_a_worker_keeps_follow_its_pieces(monkeypatch):
    monkeypatch.setattr(kernels, "_powers", {})
    for n, most in ((10, 1 << 18), ((1 << 18) + 1, 1 << 18), (1 << 19, 1 << 20), ((1 << 20) + 9, (1 << 20) + 8)):
        got = kernels.powers(7, n)
        assert len(got) == n and int(got[-1]) == pow(7, n - 1, 1 << 64) and len(kernels._powers[7]) == most + 1


def test_temporary_arrays_of_a_piece_stay_small():
    """The Python of a task, on a batch as Spark sends it; the arrays over a text are many times as large."""
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("abcdefgh ", k=3000)) for _ in range(1000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": texts})
    model = quality.fit([prose(1, 50), "%%% %%% " * 20], [1, 0])
    own = SimpleNamespace(mapInArrow=lambda run, _: run, columns=[], schema=None)
    own.select = lambda *names: own
    own.sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x)))
    kept = {}
    quality.keep(SimpleNamespace(**vars(own) | {"mapInArrow": lambda run, _: kept.update(run=run) or own}), model)
    for run in (kept["run"], near_duplicates._signed(own)):
        assert sum(b.num_rows for b in run([batch.slice(0, 1)])) <= 1  # tables that the worker keeps
        tracemalloc.start()
        try:
            rows = sum(b.num_rows for b in run([batch]))
            assert tracemalloc.get_traced_memory()[1] < 21 << 20 and rows <= 1000
        finally:
            tracemalloc.stop()
