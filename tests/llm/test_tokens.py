"""Encoding, decoding, token counts: against the library, on hard texts and whole rows."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from farelake.llm import token_counts, tree_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ATOMS = ["a", "b", "the", " ", "  ", "\n", "'s", "'re", "'", "1", "23", "!", "é", "日", "aaaa", "<|endoftext|>", "<|endo",
         "\t", "ll", "ThE", "=", " ", "😀", "́", "\x1c", "\x85", "​", "½", "٣"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(seed, n, size):
    rnd = random.Random(seed)
    for _ in range(n):
        some = rnd.sample(ATOMS, rnd.randint(1, 6))
        yield "".join(rnd.choice(some) for _ in range(rnd.randint(0, size)))


def expect(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [1, 3, 16])
def test_tree_gives_the_same_tokens(library, leaf):
    vocab = tree_bpe.vocabulary(PATH)
    for text in texts(leaf, 150, 200):
        assert tree_bpe.encode(vocab, text, leaf) == expect(library, text)


def test_long_unsplit_runs(library):
    vocab = tree_bpe.vocabulary(PATH)
    rnd = random.Random(1)
    for text in ("a" * 5000, "ab" * 3000, "".join(rnd.choice("abcdef") for _ in range(6000)), "!" * 4000, " " * 4000,
                 "".join(rnd.choice("ab1=+/") for _ in range(6000))):
        assert tree_bpe.encode(vocab, text, 64) == expect(library, text)


def rows(library):
    some = [*texts(9, 40, 80), "", None, "x" * 700 + " y" * 200, "same", "same", "long word " * 300 + "z" * 900]
    return [(i if i != 3 else None, t, "clash", 1) for i, t in enumerate(some)] + [(7, "twice", "clash", 2)]


SCHEMA = "doc_id long, text string, ids string, n_tokens int"


def test_rows(spark, library):
    data = rows(library)
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    encoded = tree_bpe.encode_rows(docs, PATH, row_chars=200, leaf=32)
    got = sorted(map(tuple, tree_bpe.digests(encoded, PATH).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text, _, _ in data:
        ids = expect(library, text)
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
        assert library.decode(ids, skip_special_tokens=False) == (text or "")
    assert got == sorted(want, key=str)
    texts_ = sorted((tuple(r) for r in tree_bpe.decode_rows(encoded, PATH).collect()), key=str)
    assert texts_ == sorted(((i, t or "") for i, t, _, _ in data), key=str)
    counts = sorted(map(tuple, token_counts.count_tokens(docs, PATH, 50).collect()), key=str)
    assert counts == sorted(
        ((i, len((t or "").encode()), n, n > 50) for (i, t, _, _), (_, n, _, _) in zip(data, want)), key=str
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert tree_bpe.digests(tree_bpe.encode_rows(docs, PATH), PATH).count() == 0
    assert token_counts.count_tokens(docs, PATH).count() == 0


def test_a_task_holds_one_python_worker(spark):
    """No Python operator reads from another one without an exchange between them."""
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "xy " * 90)], "doc_id long, text string")
    found = tree_bpe.encoded_digests(docs, PATH, row_chars=200, leaf=32)
    want = tree_bpe.digests(tree_bpe.encode_rows(docs, PATH, row_chars=200, leaf=32), PATH)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))

    def workers(node):
        below = [workers(node.children().apply(i)) for i in range(node.children().size())]
        most, here = max((b[0] for b in below), default=0), max((b[1] for b in below), default=0)
        here = 0 if "Exchange" in node.nodeName() else here + node.nodeName().startswith("MapInArrow")
        return max(most, here), here

    def most_workers(df):
        plan = df._jdf.queryExecution().executedPlan()
        return workers(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)[0]

    assert [most_workers(x) for x in (found, dict(corpus_pipeline.STAGES)["tokens"](spark, docs, ""), want)] == [1, 1, 2]


def test_counts_at_every_prefix(library):
    counts = token_counts.counter(PATH)
    for text in texts(4, 60, 40):
        want = [len(expect(library, text[:i])) for i in range(len(text) + 1)]
        assert counts.at_every_prefix(text).tolist() == want
        budget = max(want) // 2
        assert counts.longest_prefix(text, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_long_words_and_many_texts(library):
    counts = token_counts.counter(PATH)
    some = ["w" * 300, "", "ab" * 200 + " c", "''''s don't we'll", *texts(5, 50, 60)]
    raw = [t.encode() for t in some]
    found = counts.counts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert found.tolist() == [len(expect(library, t)) for t in some]
