"""Benchmark decontamination.

Method: rare n-grams of the test items are seeds that join documents to items, and Smith-Waterman alignment of words
scores the stretch of the document around them, with replaced, added and left out words.

1. Items become word hashes; items of equal words are one. N-grams of ``GRAM`` words are rare by the number of items that
   hold them, that is the pairs each place of a document would make: in each window of ``PASSAGE`` words of an item the
   ``RAREST`` n-grams held by the fewest items are seeds, and any held by up to ``LENIENT`` times as many. So a passage of
   ``PASSAGE`` words always has seeds of its own, and an opening shorter than that, which many items share, makes no pairs.
   Documents have no part in the choice: what is found in one depends on that document and the items only.
2. Documents are scanned once, whatever the number of items. Tasks get a bitmap of the seeds of at most ``SIEVE_BITS`` bits,
   which lets few other n-grams pass; documents with any are written as blocks of words, equal texts once.
3. Seeds meet by a join on their hash. Where ``MIN_SEEDS`` different seeds of an item (all, if it has fewer) fall on one
   stretch, the stretch is cut out of the blocks and meets the words of the item. A bound on the words they share skips
   most alignments.

A stretch is a leak if its score reaches ``SHARE`` of what the whole item would score, or if it holds a passage of
``PASSAGE`` matching words with at least four in five alike, anywhere in the stretch, whatever scores higher around it:
where the best alignment as a whole is no leak, a second one counts matches for each number of unlike words. In that
one words left out of the item count as unlike too. Every stretch is tested, of any length of text; the best one of a
document and item is reported, of equal scores the first.

A document that holds ``PASSAGE`` consecutive words of an item, or more, is always found. An edited copy is found if enough
of its unbroken n-grams are seeds. Words are runs of bytes ``[0-9a-z]`` or beyond ASCII after lower-casing A-Z. An item
of fewer words than an n-gram has itself as its only seed. Null and empty items are never found; null and empty
documents have no leaks; empty tables give empty results, or all documents back. Repeated rows of documents and items are all
reported. Other columns of documents, whatever their names, are untouched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm import kernels as K
from farelake.llm import tables

GRAM, MIN_SEEDS = 3, 2
RAREST, LENIENT = 4, 4
SHARE, PASSAGE, ALIKE = 0.5, 13, 0.8
MATCH, MISS, GAP = 2, -1, -1
BLOCK_WORDS = 4096
SIEVE_BITS = 1 << 27
_PROBES = (0, 12, 24, 36)
_ROWS = 64
_FACTS = "score double, n_matched long, first_word long, end_word long"


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: score, matching words, first and end word in ``words``. Memory is linear."""
    n = len(words)
    steps = np.arange(1, n + 1) * -GAP
    before = np.zeros(n + 1, dtype=np.int64)
    # Of the best path to each cell: matches and first word, packed under the score so that one maximum carries them.
    best = (0, 0, 0, 0)
    info = np.stack([np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)])
    for word in item:
        equal = words == word
        diagonal = before[:-1] + np.where(equal, MATCH, MISS)
        above = before[1:] + GAP
        reach = np.maximum(np.maximum(diagonal, above), 0)
        from_diagonal = (diagonal >= above) & (diagonal > 0)
        matches = np.where(from_diagonal, info[0, :-1] + equal, np.where(reach > 0, info[0, 1:], 0))
        first = np.where(from_diagonal, info[1, :-1], np.where(reach > 0, info[1, 1:], np.arange(1, n + 1)))
        # Left-out words: the running maximum of reach + steps, minus steps.
        lifted = np.maximum.accumulate(reach + steps)
        where = np.maximum.accumulate(np.where(reach + steps == lifted, np.arange(n), 0))
        now = np.zeros(n + 1, dtype=np.int64)
        now[1:] = lifted - steps
        info = np.stack([np.append(0, matches[where]), np.append(0, first[where])])
        before = now
        j = int(np.argmax(now))
        if now[j] > best[0]:
            best = (int(now[j]), int(info[0, j]), int(info[1, j]), j)
    return best


def _most_unlike() -> list[int]:
    """For each number of unlike words the least matches of a passage. A longer passage holds one below twice ``PASSAGE``."""
    out: list[int] = []
    for matches in range(PASSAGE, 2 * PASSAGE):
        while matches + 1e-9 >= ALIKE * (matches + len(out)):
            out.append(matches)
    return out


def passage(item: np.ndarray, words: np.ndarray) -> tuple[int, int] | None:
    """First and end word in ``words`` of a passage with enough alike, on any path. Memory is linear."""
    n, one = len(words), np.int64(1) << 32
    least = np.array(_most_unlike(), dtype=np.int64)[:, None] << 32
    # Of the best path to each cell with so many unlike words: matches above, first word below.
    fresh = np.arange(n + 1)
    before = np.tile(fresh, (len(least), 1))
    for word in item:
        now = np.tile(fresh, (len(least), 1))
        now[:, 1:] = np.where(words == word, before[:, :-1] + one, now[:, 1:])
        now[1:, 1:] = np.maximum(now[1:, 1:], before[:-1, :-1])
        now[1:] = np.maximum(now[1:], before[:-1])
        for u in range(1, len(now)):
            now[u, 1:] = np.maximum(now[u, 1:], now[u - 1, :-1])
        found = np.argwhere(now >= least)
        if len(found):
            u, end = found[0]
            return int(now[u, end] & (one - 1)), int(end)
        before = now
    return None


def _may_leak(known: np.ndarray, size: int, words: np.ndarray) -> tuple[bool, bool]:
    """Whether words of the item stand dense enough for the share of the whole item, and for a passage."""
    index = np.minimum(np.searchsorted(known, words), len(known) - 1)
    member = known[index] == words
    score = np.concatenate([[0], np.cumsum(np.where(member, MATCH, MISS))])
    whole = (score - np.minimum.accumulate(score)).max() >= SHARE * MATCH * size
    alike = np.concatenate([[0], np.cumsum(np.where(member, 1 - ALIKE, -ALIKE))])
    passage = len(words) >= PASSAGE and (alike[PASSAGE:] - np.minimum.accumulate(alike[:-PASSAGE])).max() >= -1e-6
    return bool(whole), bool(passage)


def _score(own: np.ndarray, known: np.ndarray, stretch: np.ndarray):
    """Score, matching words, first and end word of a leak in a stretch, or nothing."""
    size = len(own)
    whole, part = _may_leak(known, size, stretch)
    if not whole and not part:
        return None
    score, matches, first, end = align(own, stretch)
    if score < SHARE * MATCH * size and (matches < PASSAGE or matches < ALIKE * (end - first)):
        found = passage(own, stretch) if part else None
        if found is None:
            return None
        score, matches, first, end = align(own, stretch[found[0] : found[1]])
        first, end = found[0] + first, found[0] + end
    return score / (MATCH * size), matches, first, end


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def item_words(benchmark: DataFrame) -> DataFrame:
    """``(item_id, key, words)``: the word hashes of each item with any, as bytes, and their digest."""

    def run(batches):
        for batch in batches:
            ids, keys, words = [], [], []
            for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                own = K.hash_words(text)
                if len(own):
                    ids.append(item_id)
                    words.append(own.tobytes())
                    keys.append(hashlib.sha1(words[-1]).hexdigest())
            yield _batch({"item_id": pa.array(ids, pa.int64()), "key": pa.array(keys, pa.string()), "words": pa.array(words, pa.binary())})

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return items.mapInArrow(run, "item_id long, key string, words binary")


def item_grams(items: DataFrame) -> DataFrame:
    """``(key, h, place, size)``: every n-gram of each of the different items of ``items(key, words)``, ``size`` words long."""

    def run(batches):
        for batch in batches:
            for key, raw in zip(batch.column("key").to_pylist(), batch.column("words").to_pylist()):
                own = np.frombuffer(raw, dtype=np.uint64)
                size = min(GRAM, len(own))
                h = K.gram_hashes(own, size).view(np.int64)
                yield _batch({
                    "key": pa.array([key] * len(h), pa.string()), "h": pa.array(h),
                    "place": pa.array(np.arange(len(h))), "size": pa.array(np.full(len(h), size)),
                })

    return items.mapInArrow(run, "key string, h long, place long, size long")


class Sieve:
    """A bitmap that each of the given n-grams passes, and few others."""

    def __init__(self, grams: DataFrame):
        sizes = grams.groupBy("size").agg(F.approx_count_distinct("h").alias("n")).collect()  # at most GRAM rows
        self.sizes = sorted(r["size"] for r in sizes)
        bits = 1 << max(16, (64 * sum(r["n"] for r in sizes)).bit_length())
        self.mask = min(bits, SIEVE_BITS) - 1
        probes = F.array(*(F.shiftrightunsigned("h", s).bitwiseAND(F.lit(self.mask)) + 1 for s in _PROBES))
        pages = (
            grams.select(F.explode(probes).alias("bit"))
            .groupBy(F.bitmap_bucket_number("bit").alias("page"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        )
        self.bits = np.zeros((self.mask + 1) // 8, dtype=np.uint8)
        for r in pages.collect():  # at most SIEVE_BITS / 8 bytes
            page = np.frombuffer(r["bits"], dtype=np.uint8)
            at = (r["page"] - 1) * len(page)
            self.bits[at : at + len(page)] = page

    def passing(self, h: np.ndarray) -> np.ndarray:
        """Positions of the hashes that pass."""
        left = np.arange(len(h))
        for s in _PROBES:
            bit = (h[left] >> np.uint64(s)) & np.uint64(self.mask)
            left = left[(self.bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return left

    def pieces(self, batch):
        """``(first row, bytes, offsets, words, first words, places, hashes)`` of the n-grams that pass, by piece of a batch."""
        for begin, _, data, offsets in K.text_pieces(batch, limit=K.SMALL_PIECE_BYTES):
            lowered = K.lower_ascii(data)
            starts, ends, first = K.word_spans(lowered, offsets)
            words = K.span_hashes(K.prefix_sums(lowered), starts, ends)
            at, h = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for size in self.sizes:
                grams = K.gram_hashes(words, size)
                found = self.passing(grams)
                found = found[found + size <= first[np.searchsorted(first, found, side="right")]]
                at.append(found)
                h.append(grams[found])
            at, h = np.concatenate(at), np.concatenate(h)
            order = np.argsort(at, kind="stable")
            yield begin, data, offsets, words, first, at[order], h[order]


def rare(held: np.ndarray) -> np.ndarray:
    """Which n-grams of an item are seeds, given in order how many items hold each."""
    span = min(PASSAGE - GRAM + 1, len(held))
    windows = np.sort(sliding_window_view(held, span), axis=1)
    limit = windows[:, min(RAREST, span) - 1] * LENIENT
    # The highest limit of all windows that hold the n-gram.
    limit = sliding_window_view(np.pad(limit, span - 1), span).max(axis=1)
    return held <= limit


def choose_seeds(grams: DataFrame) -> DataFrame:
    """``(key, h, place, n_words, needed)``: the rare n-grams of each item."""
    held = grams.groupBy("h").agg(F.count_distinct("key").alias("held"))
    per_item = grams.join(held, "h").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("place", "h", "held"))).alias("all"), F.first("size").alias("size")
    )

    def run(batches):
        for batch in batches:
            for key, size, grams in zip(*(batch.column(c) for c in ("key", "size", "all"))):
                place, h, held = (grams.values.field(c).to_numpy() for c in ("place", "h", "held"))
                seeds = rare(held)
                n = int(seeds.sum())
                yield _batch({
                    "key": pa.array([key.as_py()] * n, pa.string()), "h": pa.array(h[seeds]), "place": pa.array(place[seeds]),
                    "n_words": pa.array(np.full(n, len(h) + size.as_py() - 1)),
                    "needed": pa.array(np.full(n, min(MIN_SEEDS, len(np.unique(h[seeds]))))),
                })

    return per_item.mapInArrow(run, "key string, h long, place long, n_words long, needed long")


def seeded_blocks(docs: DataFrame, sieve: Sieve, block_words: int) -> DataFrame:
    """``(doc_id, uid, block, words, at, h)``: the words of documents with seeds, by block, and where seeds stand."""
    sent = docs.sparkSession.sparkContext.broadcast(sieve)
    kind = pa.schema([
        ("doc_id", pa.int64()), ("uid", pa.string()), ("block", pa.int64()), ("words", pa.binary()),
        ("at", pa.list_(pa.int64())), ("h", pa.list_(pa.int64())),
    ])

    def run(batches):
        rows = []
        for batch in batches:
            doc_id = batch.column("doc_id")
            for begin, data, offsets, words, first, at, h in sent.value.pieces(batch):
                doc = np.searchsorted(first, at, side="right") - 1
                for d in np.unique(doc).tolist():
                    own = words[first[d] : first[d + 1]]
                    a, b = np.searchsorted(doc, [d, d + 1])
                    place, gram = at[a:b] - first[d], h[a:b].view(np.int64)
                    uid = hashlib.sha1(data[offsets[d] : offsets[d + 1]].tobytes()).hexdigest()
                    for block, low in enumerate(range(0, len(own), block_words)):
                        x, y = np.searchsorted(place, [low, low + block_words])
                        part = own[low : low + block_words].tobytes()
                        rows.append((doc_id[begin + d].as_py(), uid, block, part, place[x:y], gram[x:y]))
                        if len(rows) == _ROWS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
        rows = []
        K.trim()

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, "doc_id long, uid string, block long, words binary, at array<long>, h array<long>")


def stretches(blocks: DataFrame, seeds: DataFrame, block_words: int) -> DataFrame:
    """``(uid, key, span, low, stretch)``: where enough seeds of an item fall together, with room for words added or left out.

    An item would start at the place of its seed less that in the item. Starts are dealt to spans that overlap by half,
    so that starts no further apart than the item is long share one.
    """
    slack = F.greatest(F.lit(4).cast("long"), F.expr("n_words div 4"))
    step = (F.col("n_words") + slack).alias("step")
    hits = blocks.select("uid", F.explode(F.arrays_zip("at", "h")).alias("x")).select("uid", "x.at", "x.h")
    met = hits.join(seeds, "h").select("uid", "key", "h", "n_words", "needed", step, (F.col("at") - F.col("place")).alias("start"))
    span = F.floor(F.col("start") / F.col("step"))
    spans = met.withColumn("span", F.explode(F.array(span - 1, span)))
    together = spans.groupBy("uid", "key", "span", "n_words", "step").agg(
        F.count_distinct("h").alias("seeds"), F.max("needed").alias("needed")
    )
    low = F.greatest(F.lit(0).cast("long"), F.col("span") * F.col("step") - slack).alias("low")
    high = ((F.col("span") + 3) * F.col("step")).alias("high")
    wanted = together.filter("seeds >= needed").select("uid", "key", "span", low, high).filter("high > low")
    parts = wanted.withColumn("block", F.explode(F.expr(f"sequence(low div {block_words}, (high - 1) div {block_words})")))
    base = F.col("block") * block_words
    begin = F.greatest("low", base)
    count = F.least("high", base + block_words) - begin
    piece = F.substring("words", ((begin - base) * 8 + 1).cast("int"), (count * 8).cast("int"))
    pieces = parts.join(blocks.select("uid", "block", "words"), ["uid", "block"]).select("uid", "key", "span", "low", "block", piece.alias("piece"))
    whole = F.sort_array(F.collect_list(F.struct("block", "piece")))
    joined = F.aggregate(whole, F.lit(b""), lambda text, x: F.concat(text, x["piece"]))
    return pieces.groupBy("uid", "key", "span", "low").agg(joined.alias("stretch"))


def scored(found: DataFrame, items: DataFrame) -> DataFrame:
    """``(uid, key, score, n_matched, first_word, end_word)``: the best leak of each text and item."""

    def run(batches):
        for batch in batches:
            rows, last = [], None
            for uid, key, low, raw, stretch in zip(*(batch.column(c).to_pylist() for c in ("uid", "key", "low", "words", "stretch"))):
                if key != last:
                    last, own = key, np.frombuffer(raw, dtype=np.uint64)
                    known = np.unique(own)
                leak = _score(own, known, np.frombuffer(stretch, dtype=np.uint64))
                if leak:
                    rows.append((uid, key, leak[0], leak[1], low + leak[2], low + leak[3]))
            if rows:
                kinds = [pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                names = ["uid", "key", "score", "n_matched", "first_word", "end_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    tested = found.join(items, "key").select("uid", "key", "low", "words", "stretch").mapInArrow(run, f"uid string, key string, {_FACTS}")
    order = F.struct("score", -F.col("first_word"), -F.col("end_word"), "n_matched")
    facts = F.struct("score", "n_matched", "first_word", "end_word")
    return tested.groupBy("uid", "key").agg(F.max_by(facts, order).alias("best")).select("uid", "key", "best.*")


def _found(docs: DataFrame, benchmark: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: leaks by text and words of an item, ``(uid, doc_id)`` and others of documents, and items."""
    named = tables.written(item_words(benchmark))
    items = named.groupBy("key").agg(F.first("words").alias("words"))
    grams = tables.written(item_grams(items))
    seeds = tables.written(choose_seeds(grams))
    sizes = seeds.withColumn("size", F.least("n_words", F.lit(GRAM)))
    rows = tables.written(seeded_blocks(docs, Sieve(sizes), block_words))
    blocks = rows.groupBy("uid", "block").agg(*(F.first(c).alias(c) for c in ("words", "at", "h")))
    best = tables.written(scored(stretches(blocks, seeds, block_words), items))
    tables.drop(grams, seeds)
    return best, rows, named


def leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, item_id, score, n_matched, first_word, end_word)`` for every row of ``docs(doc_id, text)`` and each
    item it holds; the words are numbered from 0."""
    best, rows, named = _found(docs, benchmark, block_words)
    facts = ("score", "n_matched", "first_word", "end_word")
    copies = rows.filter("block = 0").select("uid", "doc_id")
    out = tables.written(best.join(copies, "uid").join(named.select("key", "item_id"), "key").select("doc_id", "item_id", *facts))
    tables.drop(best, rows, named)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows without a leak of any item, with all their columns."""
    best, rows, named = _found(docs.select("doc_id", "text"), benchmark, block_words)
    tables.drop(rows, named)
    found = best.select("uid").distinct()
    return docs.join(found, F.sha1(docs["text"]) == found["uid"], "left_anti")
