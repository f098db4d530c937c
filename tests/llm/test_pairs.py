"""Near-duplicates and decontamination against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest

from farelake.llm import decontamination, kernels, near_duplicates


def words(text):
    return kernels.hash_words(text).tolist()


def bag(text, n=near_duplicates.SHINGLE):
    w = words(text)
    n = min(n, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else Counter()


def alike(x, y):
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both)


def plain_classes(rows, least=near_duplicates.SIMILARITY):
    texts = {}
    for i, text, *_ in rows:
        texts.setdefault(tuple(words(text)), []).append(i)
    keys, bags = list(texts), []
    for key in keys:
        n = min(5, len(key))
        bags.append(Counter(key[i : i + n] for i in range(len(key) - n + 1)) if n else Counter())
    parent = list(range(len(keys)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if bags[i] and bags[j] and alike(bags[i], bags[j]) >= least:
                parent[root(i)] = root(j)
    least_id = {}
    for i, key in enumerate(keys):
        for doc in texts[key]:
            if doc is not None:
                least_id[root(i)] = min(doc, least_id.get(root(i), doc))
    index = {key: i for i, key in enumerate(keys)}
    return sorted(((i, least_id.get(root(index[tuple(words(t))]))) for i, t, *_ in rows), key=str)


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(n))


def edited(rnd, text, share):
    return " ".join(w if rnd.random() > share else prose(rnd, 1) for w in text.split(" "))


def corpus(seed):
    rnd = random.Random(seed)
    rows, at = [], 0
    for _ in range(25):
        text = prose(rnd, rnd.choice([6, 20, 60, 200]))
        for _ in range(rnd.randint(1, 4)):
            rows.append((at := at + rnd.randint(1, 9), edited(rnd, text, rnd.choice([0, 0.01, 0.02, 0.04, 0.3]))))
    hub = prose(rnd, 150)
    rows += [(2000 + i, edited(rnd, hub, 0.012)) for i in range(60)]
    # A chain: each like the next, the ends unlike.
    chain = prose(rnd, 120).split(" ")
    rows += [(3000 + i, " ".join(chain[i * 9 :] + prose(random.Random(i), i * 9).split(" "))) for i in range(5)]
    rows += [(4000, None), (4001, ""), (4002, "..."), (4003, "one two"), (4004, "One, two!"), (4005, "one two three"),
             (None, rows[0][1]), (4006, rows[0][1].upper()), (rows[3][0], rows[3][1]), (rows[4][0], prose(rnd, 30)),
             (4007, "again and " * 200), (4008, "again and " * 230), (4009, "again and " * 20), (None, prose(rnd, 30)),
             (4010, prose(rnd, 9000))]
    rnd.shuffle(rows)
    return [(*r, "clash") for r in rows]


SCHEMA = "doc_id long, text string, class_id string"


@pytest.mark.parametrize("seed", [1, 2])
def test_classes(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = near_duplicates.classes(docs).select("doc_id", "class_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_classes(rows)
    kept = near_duplicates.first_of_class(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert {i for i in ids if i is not None} == {c for _, c in plain_classes(rows) if c is not None}


def test_few_documents(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert near_duplicates.classes(nothing).count() == 0 and near_duplicates.first_of_class(nothing).count() == 0
    same = spark.createDataFrame([(5, "a b c d e f", "x")] * 3 + [(7, "a b c d e f", "y")], SCHEMA)
    assert [tuple(r) for r in near_duplicates.first_of_class(same).collect()] == [(5, "a b c d e f", "x")]


def test_signatures_estimate_weighted_similarity():
    rnd, errors = random.Random(3), []
    for _ in range(150):
        x = Counter({rnd.getrandbits(63): rnd.randint(1, 6) for _ in range(40)})
        y = Counter({k: max(1, n + rnd.randint(-2, 2)) for k, n in x.items() if rnd.random() < 0.9})
        y.update({rnd.getrandbits(63): 2 for _ in range(3)})
        bags = [(np.array(sorted(b), np.uint64), np.array([b[k] for k in sorted(b)])) for b in (x, y)]
        doc = np.repeat([0, 1], [len(bags[0][0]), len(bags[1][0])])
        sig = near_duplicates.signatures(doc, *(np.concatenate(c) for c in zip(*bags)), 2)
        exact = near_duplicates.similarity(*bags[0], *bags[1])
        assert exact == pytest.approx(alike(x, y))
        errors.append((sig[0] == sig[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.07


def test_a_signature_does_not_depend_on_its_neighbours():
    rnd = random.Random(8)
    texts = [prose(rnd, n) for n in (1, 5, 9, 80, 500)]

    def sign(some):
        raw = [t.encode() for t in some]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        doc, grams, counts, _ = near_duplicates.bags(data, offsets)
        return near_duplicates.signatures(doc, grams, counts, len(some))

    assert (sign(texts) == np.concatenate([sign([t]) for t in texts])).all()


# Decontamination


def plain_alignment(x, y):
    h = np.zeros((len(x) + 1, len(y) + 1), dtype=int)
    for i, a in enumerate(x, 1):
        for j, b in enumerate(y, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a == b else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment():
    rnd = random.Random(5)
    for _ in range(200):
        x, y = ([rnd.randint(0, 4) for _ in range(rnd.randint(1, n))] for n in (10, 25))
        score, matches, first, end = decontamination.align(np.array(x, np.uint64), np.array(y, np.uint64))
        assert score == plain_alignment(x, y)
        if score:
            assert matches <= end - first and plain_alignment(x, y[first:end]) == score


ITEM = "item_id long, text string"


def leaked(spark, rows, items, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    found = decontamination.leaks(docs, spark.createDataFrame(items, ITEM), **options)
    clean = decontamination.without_leaks(docs, spark.createDataFrame(items, ITEM), **options)
    assert clean.columns == docs.columns
    got = found.collect()
    dirty = {r.doc_id for r in got}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r[0]) for r in rows if r[0] not in dirty)
    return got


@pytest.mark.parametrize("block_words", [16, 4096])
def test_leaks(spark, block_words):
    rnd = random.Random(6)
    items = [(i, prose(rnd, rnd.randint(15, 50))) for i in range(12)] + [(50, None), (51, ""), (52, "uniq word"), (53, prose(rnd, 300))]
    rows, expect = [], set()
    for i in range(120):
        text = prose(rnd, rnd.randint(0, 150))
        if i % 3 == 0:
            item, how = items[i % 12], i % 4
            w = item[1].split(" ")
            if how == 1:  # one word in six replaced
                w = [x if k % 6 else prose(rnd, 1) for k, x in enumerate(w)]
            elif how == 2:  # words added and left out
                w = [y for k, x in enumerate(w) for y in ([x, "extra"] if k % 7 == 3 else [] if k % 9 == 8 else [x])]
            text += " " + ", ".join(w).title() + "\n" + prose(rnd, rnd.randint(0, 60))
            expect.add((i, item[0]))
        rows.append((i, text, "x"))
    rows += [(500 + i, items[3][1], "x") for i in range(150)]
    expect |= {(500 + i, 3) for i in range(150)}
    long = items[-1][1].split(" ")
    rows += [(900, None, "x"), (901, "", "x"), (902, "an uniq word", "x"), (903, prose(rnd, 8000) + " " + items[5][1], "x"),
             (904, " ".join(long[100:130]), "x"), (905, " ".join(long[100:105]), "x"), (906, "word uniq", "x"), (None, items[7][1], "x"), (None, "", "x")]
    rows = [r for r in rows if r[0] is not None or r[1]]
    expect |= {(902, 52), (903, 5), (904, 53), (None, 7)}
    got = leaked(spark, rows, items, block_words=block_words)
    assert {(r.doc_id, r.item_id) for r in got} == expect and len(got) == len(expect)
    by_doc, by_item = dict((r[0], r[1]) for r in rows), dict(items)
    for r in got:
        w = words(by_doc[r.doc_id])
        assert 0 < r.score <= 1 and 0 <= r.first_word < r.end_word <= len(w)
        whole = plain_alignment(words(by_item[r.item_id]), w[r.first_word : r.end_word])
        assert whole == round(r.score * 2 * len(words(by_item[r.item_id])))


def test_nothing_to_check(spark):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d")], ITEM)
    assert decontamination.leaks(docs, items.limit(0)).count() == 0
    assert decontamination.without_leaks(docs, items.limit(0)).count() == 1
    assert decontamination.leaks(docs.limit(0), items).count() == 0
    assert decontamination.leaks(docs, items.unionByName(items)).count() == 2


def test_a_passage_in_many_documents_and_a_whole_copy_in_one(spark):
    rnd = random.Random(11)
    item = prose(rnd, 40)
    shared = " ".join(item.split(" ")[:15])
    rows = [(i, prose(rnd, 5) + " " + shared + " " + prose(rnd, 20), "x") for i in range(200)]
    for more in ([], [(900, item, "x")]):
        got = leaked(spark, rows + more, [(1, item)])
        assert {r.doc_id for r in got} == {r[0] for r in rows + more}


def test_a_passage_beside_a_looser_copy(spark):
    rnd = random.Random(12)
    item = prose(rnd, 60).split(" ")
    loose = lambda a, b: [w if k % 3 else prose(rnd, 1) for k, w in enumerate(item[a:b])]
    apart, other = prose(rnd, 90), prose(rnd, 30)
    exact = item[:14]
    rows = [
        (1, " ".join([other, *exact, *loose(14, 44), other]), "x"),
        (2, " ".join([*loose(14, 58), apart, *exact]), "x"),
        (3, " ".join([other, *exact[:6], "new", *exact[7:12], "more", *exact[12:], *item[14:16], *loose(16, 40)]), "x"),
        (4, " ".join(loose(0, 44)), "x"),
        (5, " ".join([other, *exact[:12], apart]), "x"),
    ]
    got = leaked(spark, rows, [(1, " ".join(item))])
    assert {r.doc_id for r in got} == {1, 2, 3}
    assert all(r.n_matched >= decontamination.PASSAGE for r in got)


def test_passages_against_all_paths():
    rnd = random.Random(13)
    for _ in range(60):
        x = [rnd.randint(0, 30) for _ in range(24)]
        y = [w if rnd.random() > 0.2 else rnd.randint(0, 30) for w in x if rnd.random() > 0.05]
        most = {}  # (i, j, unlike) -> matches
        for i in range(len(x) + 1):
            for j in range(len(y) + 1):
                for u in range(8):
                    ways = [0]
                    if i and j and x[i - 1] == y[j - 1]:
                        ways.append(most[i - 1, j - 1, u] + 1)
                    if u:
                        ways += [most[a, b, u - 1] for a, b in ((i - 1, j - 1), (i - 1, j), (i, j - 1)) if a >= 0 <= b]
                    most[i, j, u] = max(ways)
        want = any(m >= 13 and m >= 4 * u for (_, _, u), m in most.items())
        assert (decontamination.passage(np.array(x), np.array(y)) is not None) == want


def test_an_opening_that_many_items_share_makes_no_pairs(spark):
    rnd = random.Random(14)
    opening = prose(rnd, 9)
    items = [(i, opening + " " + prose(rnd, 20)) for i in range(300)]
    table = spark.createDataFrame(items, ITEM)
    grams = decontamination.item_grams(decontamination.item_words(table).select("key", "words"))
    held = grams.groupBy("h").count().filter("count > 100")
    assert held.count() == 7 and decontamination.choose_seeds(grams).join(held, "h").count() == 0
    rows = [(i, prose(rnd, 30) + " " + opening + " " + prose(rnd, 30), "x") for i in range(50)]
    rows += [(100, prose(rnd, 10) + " " + items[7][1], "x")]
    assert {(r.doc_id, r.item_id) for r in leaked(spark, rows, items)} == {(100, 7)}


def plain_leaks(rows, items):
    """All pairs, by the best alignment in the whole document and the passages of any place."""
    out = set()
    for doc_id, text, _ in rows:
        w = np.array(words(text), np.uint64)
        for item_id, item in items:
            own = np.array(words(item), np.uint64)
            if len(w) and len(own):
                score, matches, first, end = decontamination.align(own, w)
                whole = score >= decontamination.SHARE * decontamination.MATCH * len(own)
                if whole or decontamination.passage(own, w) is not None:
                    out.add((doc_id, item_id))
    return out


def test_leaks_against_all_pairs(spark):
    rnd = random.Random(15)
    common = prose(rnd, 400).split(" ")
    some = lambda n: " ".join(rnd.choice(common) for _ in range(n))
    items = [(i, some(rnd.randint(14, 40))) for i in range(25)]
    items += [(30 + i, items[i][1] + " " + some(8)) for i in range(5)]
    rows = []
    for i in range(150):
        text = edited(rnd, items[i % 30][1], rnd.choice([0, 0.05, 0.1, 0.2, 0.3, 0.6])).split(" ")
        low = rnd.randint(0, max(0, len(text) - 14))
        rows.append((i, some(rnd.randint(0, 80)) + " " + " ".join(text[low:]) + " " + some(rnd.randint(0, 40)), "x"))
    got, want = {(r.doc_id, r.item_id) for r in leaked(spark, rows, items)}, plain_leaks(rows, items)
    assert got <= want and len(want) > 80
    # What has no two unbroken seeds left is missed.
    assert len(got) >= 0.95 * len(want), sorted(want - got)
