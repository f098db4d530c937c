"""Document fingerprints from closed syncmers.

Method: a k-mer of bytes is an anchor if, of its inner substrings, the one with the smallest hash lies at its first or
last place. That depends on the k-mer alone, so equal passages have equal anchors whatever surrounds them. A
fingerprint keeps all distinct anchors, with the place of their first occurrence. The likeness of two fingerprints is
the share of anchors, among those of both together, that both hold in the same order (longest chain of places that rise
in both). Callers may ask for the ``size`` anchors of smallest hash only.

A text too short for an anchor has its whole hash as its only anchor; a null or empty text has an empty fingerprint,
like only to another empty one. Equal texts have equal fingerprints. Rows with a null id come last in the order by
descending id; rows with equal ids are ordered by text, descending; a single row is its own neighbour.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm import kernels as K
from farelake.llm import tables

KMER, INNER, ANCHORS = 24, 8, None
_FLUSH_CHARS = 1 << 19
_LOWEST = -(1 << 63)


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n, have = len(x) - width + 1, 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n])


def syncmers(data: np.ndarray, offsets: np.ndarray, k: int = KMER, s: int = INNER):
    """Places (in ``data``) and hashes of the closed syncmers; none crosses a document."""
    if len(data) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = K.prefix_sums(data)
    at = np.arange(len(data) - s + 1)
    inner = K.span_hashes(sums, at, at + s)
    width = k - s + 1
    least = _window_min(inner, width)
    n = len(least)
    chosen = (inner[:n] == least) | (inner[width - 1 :] == least)
    edge = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(edge, np.maximum(offsets[:-1], offsets[1:] - k + 1), 1)
    np.add.at(edge, offsets[1:], -1)
    chosen &= np.cumsum(edge)[:n] == 0
    at = np.flatnonzero(chosen)
    return at, K.span_hashes(sums, at, at + k)


def fingerprints(texts: list[str], k: int = KMER, s: int = INNER, size: int | None = ANCHORS) -> list[tuple[list, list]]:
    """For each text the hashes of its anchors, rising, and their places."""
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    at, hashes = syncmers(data, offsets, k, s)
    hashes >>= np.uint64(24)
    doc = np.searchsorted(offsets, at, side="right") - 1
    order = np.lexsort((at, hashes, doc))
    at, hashes, doc = at[order], hashes[order], doc[order]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    at, hashes, doc = at[first], hashes[first], doc[first]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    out = []
    for i, (begin, end) in enumerate(zip(bounds, bounds[1:])):
        end = end if size is None else min(end, begin + size)
        if begin < end:
            out.append((hashes[begin:end].tolist(), (at[begin:end] - offsets[i]).tolist()))
        elif raw[i]:
            out.append(([int.from_bytes(hashlib.sha256(raw[i]).digest()[:5], "big")], [0]))
        else:
            out.append(([], []))
    return out


def to_text(fingerprint: tuple[list, list]) -> str:
    """Five bytes of hash and four of place for each anchor, in base 64."""
    packed = b"".join(h.to_bytes(5, "big") + p.to_bytes(4, "big") for h, p in zip(*fingerprint))
    return base64.b64encode(packed).decode()


def likeness(x: tuple[list, list], y: tuple[list, list], size: int | None = ANCHORS) -> float:
    if x == y:
        return 1.0
    if not x[0] or not y[0]:
        return 0.0
    places = dict(zip(*y))
    least = sorted({*x[0], *y[0]})[:size]
    limit = least[-1]
    shared = sorted((p, places[h]) for h, p in zip(*x) if h <= limit and h in places)
    chain: list[int] = []
    for _, p in shared:
        i = bisect_left(chain, p)
        chain[i : i + 1] = [p]
    return len(chain) / len(least)


def _in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows dealt out by ranges of the id, in descending order, each range closed by the first row of the next.

    The driver sees one bound and one id for each block. A text moves once.
    """
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("key"), "doc_id", "text")
    share = [i / blocks for i in range(1, blocks)]
    bounds = keyed.agg(F.percentile_approx("key", share, max(10_000, 20 * blocks)).alias("b")).first().b or []
    bounds = np.unique(np.array(bounds, dtype=np.int64))

    @F.pandas_udf("int")
    def block_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), side="left").astype(np.int32))

    placed = keyed.withColumn("block", block_of("key")).withColumn("guest", F.lit(False))
    tops = sorted(
        (r.block, r.top) for r in placed.groupBy("block").agg(F.max("key").alias("top")).collect()
    )
    after = [(block, tops[i - 1][1]) for i, (block, _) in enumerate(tops)]
    if not after:
        return placed
    first = docs.sparkSession.createDataFrame(after, "block int, key long")
    guests = keyed.join(F.broadcast(first), "key").withColumn("guest", F.lit(True)).select(*placed.columns)
    return (
        placed.unionByName(guests)
        .repartition(tables.parts(docs.sparkSession), "block")
        .sortWithinPartitions("block", "guest", F.desc("key"), F.desc("text"))
    )


def _pairs(rows):
    """``(doc_id, text, next text)`` from rows in order; the first guest of a block follows its last row."""
    held = None
    for block, guest, doc_id, text in rows:
        if held is not None and held[0] == block:
            yield held[1], held[2], text
            held = None
        if not guest:
            held = (block, doc_id, text)


def compare_neighbours(docs: DataFrame, k: int = KMER, s: int = INNER, size: int | None = ANCHORS, blocks: int | None = None):
    """Fingerprints of each row of ``docs(doc_id, text)`` and of its edited text, compared with each other and with the
    next row's (see the module for the order). The last third of an edited text comes from the start of the next."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = _in_blocks(docs, blocks or 4 * tables.parts(docs.sparkSession))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def output(items):
        edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for _, t, n in items]
        texts, at_text, at_next = [], [], []
        for _, text, following in items:
            if not texts or texts[-1] is not text:
                texts.append(text)
            at_text.append(len(texts) - 1)
            texts.append(following)
            at_next.append(len(texts) - 1)
        found = fingerprints(texts, k, s, size)
        changed = fingerprints(edited, k, s, size)
        own, following = [found[i] for i in at_text], [found[i] for i in at_next]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in items], pa.int64()),
                pa.array([len(t) for _, t, _ in items], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array([to_text(x) for x in own]),
                pa.array([to_text(x) for x in changed]),
                pa.array([likeness(x, y, size) for x, y in zip(own, changed)], pa.float64()),
                pa.array([likeness(x, y, size) for x, y in zip(own, following)], pa.float64()),
            ],
            names,
        )

    def run(batches):
        def rows():
            for whole in batches:
                for at in range(0, whole.num_rows, 128):
                    batch = whole.slice(at, 128)
                    yield from zip(*(batch.column(c).to_pylist() for c in ("block", "guest", "doc_id", "text")))

        items, chars = [], 0
        for item in _pairs(rows()):
            items.append(item)
            chars += len(item[1])
            if chars >= _FLUSH_CHARS or len(items) >= 2000:
                yield output(items)
                items, chars = [], 0
        if items:
            yield output(items)

    return placed.select("block", "guest", "doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
