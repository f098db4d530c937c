"""Quality classifier: supervised subword embeddings.

Method: words and character n-grams are hashed into a table of learned vectors; a document is the average of its
vectors, and a softmax over two classes follows. The table and the output are trained together by stochastic gradient
descent in numpy, on a bounded sample of labelled documents (``SAMPLE`` for each class, the least by a hash of the id,
so the sample doesn't depend on the partitioning). Besides words and n-grams there is a feature for a word that
repeats the one before it or the second before it. For scoring, each vector shrinks to one number, its part in the
log-odds, in whole 2**-20; the score of a document is the logistic function of the average over its features, so it is
the same wherever the document stands.

A text without features (null, empty) has the score of the bias alone. Without labels of both classes all scores are
the share of label 1 (0.5 with no labels). Labels that are null are not learned from; a document with several labels
counts once with the least.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm import kernels as K

BUCKETS, DIMENSIONS, GRAMS = 1 << 17, 8, (3, 4)
SAMPLE, EPOCHS, RATE, SEED = 1500, 6, 0.5, 7
_SCALE = 1 << 20
_AGAIN = np.uint64(1)
_VISIBLE = np.ones(256, dtype=bool)
_VISIBLE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = False


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Bucket numbers and document numbers, for words, repetitions and each length of n-grams."""
    mask = np.uint64(buckets - 1)
    starts, ends = K.runs(_VISIBLE[data], offsets)
    sums = K.prefix_sums(data)
    words = K.span_hashes(sums, starts, ends)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    ids, docs = [(words & mask).astype(np.int32)], [doc]
    for back in (1, 2):
        again = np.flatnonzero((words[back:] == words[:-back]) & (doc[back:] == doc[:-back])) + back
        ids.append(np.full(len(again), int(_AGAIN), dtype=np.int32))
        docs.append(doc[again])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in GRAMS:
        at = np.arange(max(0, len(data) - n + 1))
        at = at[owner[at] == owner[at + n - 1]] if len(at) else at
        ids.append((K.span_hashes(sums, at, at + n) & mask).astype(np.int32))
        docs.append(owner[at])
    return ids, docs


class Model:
    """Weights of one fit: a number for each bucket, and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        total, count = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for ids, docs in zip(*features(data, offsets, len(self.weights))):
            # Whole numbers: sums don't depend on the order.
            steps = np.concatenate([[0], np.cumsum(self.weights[ids], dtype=np.int64)])
            bounds = np.searchsorted(docs, np.arange(n + 1))
            total += steps[bounds[1:]] - steps[bounds[:-1]]
            count += np.diff(bounds)
        odds = total / _SCALE / np.maximum(count, 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -50, 50)))


def fit(texts: list[str], labels: list[int], buckets=BUCKETS, dims=DIMENSIONS, epochs=EPOCHS, rate=RATE, seed=SEED) -> Model:
    """Stochastic gradient descent over the given documents."""
    if len(set(labels)) < 2:
        share = float(np.mean(labels)) if labels else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(buckets, dtype=np.int64), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / dims, (buckets, dims)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (dims, 2)).astype(np.float32), np.zeros(2, dtype=np.float32)
    docs = []
    for text in texts:
        data = np.frombuffer((text or "").encode(), dtype=np.uint8)
        ids, counts = np.unique(np.concatenate(features(data, np.array([0, len(data)]), buckets)[0]), return_counts=True)
        docs.append((ids, (counts / max(1, counts.sum())).astype(np.float32)))
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            ids, share = docs[i]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = share @ table[ids] if len(ids) else np.zeros(dims, dtype=np.float32)
            odds = hidden @ out + bias
            p = np.exp(odds - odds.max())
            p /= p.sum()
            p[labels[i]] -= 1
            if len(ids):
                # Averages are short vectors, so the step along them is scaled up by their number.
                table[ids] -= lr * np.outer(share * min(len(ids), 200), out @ p)
                out -= lr * np.outer(hidden, p)
            bias -= lr * 0.1 * p
    weights = table.astype(np.float64) @ (out[:, 1] - out[:, 0]).astype(np.float64)
    return Model(np.round(weights * _SCALE).astype(np.int64), float(bias[1] - bias[0]))


def held_out(doc_id="doc_id"):
    """Whether a row is kept from learning: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> Model:
    """A model from at most ``sample`` labelled, not held out documents of each class. Only these reach the driver."""
    known = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").alias("doc_id")).agg(F.min("quality").alias("y"))
    known = known.filter(F.coalesce(~held_out(), F.lit(False))).withColumn("at", F.xxhash64("doc_id"))
    chosen = None
    for y in (0, 1):
        one = known.filter(F.col("y") == y).orderBy("at", "doc_id").limit(sample)
        chosen = one if chosen is None else chosen.unionByName(one)
    rows = (
        docs.select(F.col("doc_id"), "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "at", "y").agg(F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: (r["at"], r["doc_id"]))
    return fit([r.text for r in rows], [r.y for r in rows], **options)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 8 bytes a bucket

    def run(batches):
        fitted = Model(*sent.value)
        for batch in batches:
            for begin, end, data, offsets in K.text_pieces(batch, limit=K.SMALL_PIECE_BYTES):
                found = fitted.scores(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, end - begin), pa.array(found, pa.float64())], ["doc_id", "score"]
                )
        K.trim()

    scored = docs.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that the classifier does not reject, with all their columns."""
    names = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches):
        fitted = Model(*sent.value)
        for batch in batches:
            wanted = np.zeros(batch.num_rows, dtype=bool)
            for begin, end, data, offsets in K.text_pieces(batch, limit=K.SMALL_PIECE_BYTES):
                wanted[begin:end] = fitted.scores(data, offsets) >= 0.5
            yield batch.filter(pa.array(wanted))
        K.trim()

    return docs.mapInArrow(run, docs.schema).select(*names)
