"""Ranked lexical search of a stated set of items over all documents.

Method: of each document only the terms of the items are kept, as a bag of (term, occurrences). Documents with equal bags
and an equal length factor ``m`` have equal scores for every item, so they form one class: bags meet by a hash and are told
apart by their whole content. Classes are scored once, by adding up the weights of their terms over the postings of the
items; each task keeps the best ``top`` classes of an item and only those leave it. The classes chosen for an item are
then expanded to their documents by ascending ``doc_id``. No more than ``top`` classes can contribute to an item, since
each has at least one document, and no more than ``top`` documents of a class.

Terms are runs of ``[0-9A-Za-z]`` and characters beyond ASCII with A-Z lower-cased. With N documents that hold a term, L
terms in all of them and n in one of them, ``m = 75 + (25 * n * N) div L``; a term in df documents weighs
``floor(1000 * ln((2N + 2) / (2df + 1)))``, and the score sums ``weight * ((10**9 * tf) div (1000 * tf + 12 * m))`` over the
terms of the item, repeats included.

Items go in blocks of ``BLOCK_CHARS`` characters of different texts; a block's terms and postings are sent to all tasks, so
what is sent is bounded however many items there are, and each block reads the documents once. Null and empty documents
and items hold no term and appear in no result; equal scores go by ``doc_id``, nulls last; repeated rows of documents are
ranked one by one, repeated rows of items are answered as often as they stand there. Very long texts are read whole, one
at a time. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm import kernels as K
from farelake.llm import tables

BLOCK_CHARS = 16_000_000
TOP = 20
_CELLS = 1 << 20
_LAST = np.iinfo(np.int64).max


class Terms:
    """The terms of a block of items, in the order of their hashes, and where they stand."""

    def __init__(self, texts: list[str]):
        known: dict[bytes, list[int]] = {}
        for item, text in enumerate(texts):
            data = K.lower_ascii(np.frombuffer(text.encode(), dtype=np.uint8))
            starts, ends, _ = K.word_spans(data, np.array([0, len(data)]))
            raw = data.tobytes()
            for a, b in zip(starts.tolist(), ends.tolist()):
                known.setdefault(raw[a:b], []).append(item)
        words = list(known)
        joined = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        starts = ends - np.array([len(w) for w in words], dtype=np.int64)
        hashes = K.span_hashes(K.prefix_sums(joined), starts, ends)
        order = np.argsort(hashes)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms of the items share a hash of 64 bits")
        self.items = len(texts)
        self.lookup = K.Lookup(hashes[order])
        self.bytes, self.starts, self.sizes = joined, starts[order], (ends - starts)[order]
        lists = [np.unique(known[words[i]], return_counts=True) for i in order]
        self.item = np.concatenate([x for x, _ in lists] or [np.empty(0, np.int64)])
        self.times = np.concatenate([x for _, x in lists] or [np.empty(0, np.int64)])
        self.first = np.concatenate([[0], np.cumsum([len(x) for x, _ in lists], dtype=np.int64)]).astype(np.int64)

    def __len__(self):
        return len(self.starts)

    def find(self, lowered, starts, ends):
        """Which words are terms, and which: found by hash, confirmed by their bytes."""
        at, which = self.lookup.find(K.span_hashes(K.prefix_sums(lowered), starts, ends))
        sizes = (ends - starts)[at]
        same = sizes == self.sizes[which]
        at, which, sizes = at[same], which[same], sizes[same]
        if len(at):
            heads = np.cumsum(sizes) - sizes
            step = np.arange(sizes.sum()) - np.repeat(heads, sizes)
            equal = lowered[np.repeat(starts[at], sizes) + step] == self.bytes[np.repeat(self.starts[which], sizes) + step]
            whole = np.logical_and.reduceat(equal, heads)
            at, which = at[whole], which[whole]
        return at, which


def _bag_batch(batch, terms: Terms):
    """The batch with the number of words and the bag of each document."""
    counts, pairs, ends, done = [], [], [], 0
    for _, _, data, offsets in K.text_pieces(batch):
        lowered = K.lower_ascii(data)
        starts, stops, first = K.word_spans(lowered, offsets)
        at, which = terms.find(lowered, starts, stops)
        doc = np.searchsorted(first, at, side="right") - 1
        key, tf = np.unique(doc * len(terms) + which, return_counts=True)
        owner = key // max(len(terms), 1)
        pairs.append(np.stack([key - owner * len(terms), tf], axis=1).astype("<i4"))
        counts.append(np.diff(first))
        ends.append(done + np.searchsorted(owner, np.arange(len(offsets) - 1), side="right"))
        done += len(key)
    body = np.concatenate(pairs or [np.empty((0, 2), "<i4")])
    offsets = np.concatenate([[0], *ends]).astype(np.int64) * 8
    bags = pa.Array.from_buffers(
        pa.large_binary(), batch.num_rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes())]
    )
    n = np.concatenate(counts or [np.empty(0, np.int64)]).astype(np.int64)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), bags.cast(pa.binary())], ["doc_id", "n", "bag"])


def bags_of(docs: DataFrame, terms: Terms) -> DataFrame:
    """``(doc_id, n, bag)``: the number of words, and pairs (term, occurrences) of 32 bits in the order of terms."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        for batch in batches:
            yield _bag_batch(batch, sent.value)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, bag binary")


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of all bags, and the number of pairs of each bag."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = bytes(data)[offsets[0] : offsets[-1]] if data is not None else b""
    return np.frombuffer(raw, dtype="<i4").reshape(-1, 2).astype(np.int64), np.diff(offsets) // 8


def document_counts(classes: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term stands; one row a term and task is merged by Spark."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            pairs, sizes = _flat(batch.column("bag"))
            np.add.at(total, pairs[:, 0], np.repeat(batch.column("copies").to_numpy(), sizes))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])

    found = classes.select("bag", "copies").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, dtype=np.int64)
    for r in found.collect():  # at most one row a term of the block
        out[r.term] = r.df
    return out


class _Best:
    """The best ``top`` classes of each item among those offered."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, dtype=np.int64)
        self.pool = [np.empty(0, np.int64)] * 4  # item, score, least document, class
        self.classes: dict[int, tuple] = {}
        self.seen = 0

    def offer(self, scores: np.ndarray, leasts: np.ndarray, rows) -> None:
        row, item = np.nonzero(scores >= self.least)
        for r in np.unique(row).tolist():
            self.classes[self.seen + r] = rows(r)
        new = [item, scores[row, item], leasts[row], self.seen + row]
        self.pool = [np.concatenate(pair) for pair in zip(self.pool, new)]
        self.seen += len(leasts)
        if len(self.pool[0]) > 4 * self.top * len(self.least) + 10_000:
            self.prune()

    def prune(self) -> None:
        item, score, least, _ = self.pool
        order = np.lexsort((least, -score, item))
        self.pool = [x[order] for x in self.pool]
        item = self.pool[0]
        nth = np.arange(len(item)) - np.searchsorted(item, item)
        keep = nth < self.top
        full = nth == self.top - 1
        self.least[item[full]] = self.pool[1][full]
        self.pool = [x[keep] for x in self.pool]
        alive = set(self.pool[3].tolist())
        self.classes = {k: v for k, v in self.classes.items() if k in alive}


def _score_batches(batches, terms: Terms, weights: np.ndarray, top: int):
    best = _Best(terms.items, top)
    step = max(1, _CELLS // max(terms.items, 1))
    for whole in batches:
        for begin in range(0, whole.num_rows, step):
            batch = whole.slice(begin, step)
            pairs, sizes = _flat(batch.column("bag"))
            m = np.repeat(batch.column("m").to_numpy(), sizes)
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            term, tf = pairs[:, 0], pairs[:, 1]
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            scores = np.zeros((batch.num_rows, terms.items), dtype=np.int64)
            length = terms.first[term + 1] - terms.first[term]
            upto = np.cumsum(length)
            inner = np.searchsorted(upto, np.arange(_CELLS, upto[-1] if len(upto) else 0, _CELLS))
            edges = np.unique(np.concatenate([[0], inner, [len(term)]]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                some = length[a:b]
                at = np.repeat(terms.first[term[a:b]] - np.cumsum(some) + some, some) + np.arange(some.sum())
                cell = np.repeat(owner[a:b] * terms.items, some) + terms.item[at]
                np.add.at(scores.reshape(-1), cell, np.repeat(value[a:b], some) * terms.times[at])
            leasts = batch.column("least").fill_null(_LAST).to_numpy()
            columns = [batch.column(c) for c in ("h", "m", "bag")]
            best.offer(scores, leasts, lambda r: tuple(c[r].as_py() for c in columns))
    best.prune()
    item, score, least, number = best.pool
    for a in range(0, len(item), 1000):
        rows = [best.classes[i] for i in number[a : a + 1000].tolist()]
        h, m, bag = zip(*rows)
        low = least[a : a + 1000]
        arrays = [pa.array(item[a : a + 1000]), pa.array(score[a : a + 1000]), pa.array(low, mask=low == _LAST)]
        arrays += [pa.array(h, pa.int64()), pa.array(m, pa.int64()), pa.array(bag, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["number", "score", "least", "h", "m", "bag"])


def _search_block(docs: DataFrame, texts: list[str], top: int) -> DataFrame | None:
    """``(number, rank, doc_id, score)`` for the items of one block, written down."""
    terms = Terms(texts)
    if not len(terms):
        return None
    spark = docs.sparkSession
    bags = tables.written(bags_of(docs, terms))
    size = bags.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
    if not size.docs:
        tables.drop(bags)
        return None
    m = F.expr(f"CAST(75 + (CAST(25 * n AS DECIMAL(38, 0)) * {size.docs}) div {size.words} AS BIGINT)")
    held = bags.filter(F.octet_length("bag") > 0).select("doc_id", m.alias("m"), "bag")
    held = held.withColumn("h", F.xxhash64("m", "bag"))
    key = ["h", "m", "bag"]
    classes = tables.written(
        held.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"))
    )
    weights = np.array(
        [math.floor(1000 * math.log((2 * size.docs + 2) / (2 * df + 1))) for df in document_counts(classes, len(terms)).tolist()],
        dtype=np.int64,
    )
    sent = spark.sparkContext.broadcast((terms, weights))
    kind = "number long, score long, least long, h long, m long, bag binary"
    scored = classes.select(*key, "least").mapInArrow(lambda batches: _score_batches(batches, *sent.value, top), kind)
    order = [F.desc("score"), F.asc_nulls_last("least"), "h", "m"]
    nth = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    chosen = tables.written(scored.withColumn("nth", nth).filter(F.col("nth") <= top).drop("nth", "least"))
    # At most ``top`` hashes an item of the block.
    some = held.join(F.broadcast(chosen.select("h").distinct()), "h", "left_semi")
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.asc_nulls_last("doc_id")))
    members = some.withColumn("nth", nth).filter(F.col("nth") <= top).drop("nth")
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = chosen.join(members, key).select("number", "score", "doc_id", rank.alias("rank"))
    out = tables.written(ranked.filter(F.col("rank") <= top))
    tables.drop(bags, classes, chosen)
    return out


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` best rows of ``docs(doc_id, text)`` for each row of ``items(item_id, text)``."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = items.select("text").distinct()
    chars = texts.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = chars // block_chars + 1
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)))
    number = F.row_number().over(Window.partitionBy("block").orderBy("text")) - 1  # a block is bounded
    dealt = tables.written(dealt.withColumn("number", number.cast("long")))
    parts = []
    for block in range(blocks):
        rows = dealt.filter(F.col("block") == block).orderBy("number").collect()
        found = _search_block(docs, [r.text for r in rows], top) if rows else None
        if found is not None:
            parts.append(found.withColumn("block", F.lit(block).cast("long")))
    if not parts:
        empty = "item_id long, rank int, doc_id long, score long"
        return docs.sparkSession.createDataFrame([], empty)
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    numbered = items.join(dealt, "text").select("item_id", "block", "number")
    return numbered.join(found, ["block", "number"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
