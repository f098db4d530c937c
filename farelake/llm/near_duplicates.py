"""Near-duplicates by BagMinHash over five-word shingles.

Method: a document is a bag of shingles with counts. Each shingle has Poisson processes of its own, one for each
stratum of weights [0, 1), [1, 2), [2, 4), [4, 8), ...; a point has a time, a component and, inside its stratum, a
weight. It counts for a document if its weight lies below the shingle's count there, so processes are shared by all
documents and cut at each one's count. A component of the signature is the point with the least time, and two documents
agree in it with the probability of their weighted Jaccard similarity. Points are generated up to a time that leaves no
component empty; in the rare case that one is, the time is doubled.

Signatures are banded (``BANDS`` times ``ROWS``: a pair at 0.8 shares a band but for about 3 in 10**6). In each bucket
everyone is compared, on the whole bags, with the bucket's hub: the member whose buckets are largest in sum, as the
original of many edited copies shares more buckets with them than they do with each other. What is left open are members of
other classes than their hub. Each of them is compared, again on whole bags, with all members that met the same hub, in
blocks of about ``_BLOCK_MEMBERS``; a block gives back at most one link to each class. Classes are the connected components
of the verified links. Two documents of one bucket have met the same hub, so no pair of a bucket stays unexamined unless
both are of one class. Blocks and salts bound every group of bags, but not their number: an open member is sent to each
block of its hub, so the rows sent grow with the open members of a hub times the blocks of all that met it.

Words are runs of bytes ``[0-9a-z]`` or beyond ASCII after lower-casing A-Z. Texts with equal words are equal documents.
A text of one to four words is one shingle; texts without words (null, empty) are equal to each other. The class of a
document is the least id among its class (null if that has none); repeated rows are members of one class.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from farelake.llm import kernels as K
from farelake.llm import tables

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
COMPONENTS = BANDS * ROWS
_SALT_MEMBERS, _BLOCK_MEMBERS = 1000, 250
_POINTS = (1, 2, 2, 4, 8)  # points generated at a time for each process


def bags(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE):
    """``(document, shingle, count)`` sorted by document, and a 16-byte key of each document's words."""
    lowered = K.lower_ascii(data)
    starts, ends, first = K.word_spans(lowered, offsets)
    words = K.span_hashes(K.prefix_sums(lowered), starts, ends)
    grams = K.gram_hashes(words, n)
    doc = np.searchsorted(first, np.arange(len(grams)), side="right") - 1
    inside = np.arange(len(grams)) + n <= first[doc + 1]
    doc, grams = doc[inside], grams[inside]
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < n))
    if len(few):
        whole = [K.gram_hashes(words[first[d] : first[d + 1]], int(first[d + 1] - first[d])) for d in few]
        doc, grams = np.concatenate([doc, few]), np.concatenate([grams, *whole])
    order = np.argsort((doc.astype(np.uint64) << np.uint64(44)) | (grams >> np.uint64(20)))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    at = np.flatnonzero(new)
    raw = words.tobytes()
    bounds = (first * 8).tolist()
    keys = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(bounds, bounds[1:])]
    return doc[at], grams[at], np.diff(np.append(at, len(doc))), keys


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(doc, grams, counts, n_docs: int, components: int = COMPONENTS) -> np.ndarray:
    """BagMinHash signatures (documents x components); rows of empty bags are zero."""
    weight = np.bincount(doc, counts, minlength=n_docs)
    limit = (np.log(components) + 4.0) / np.maximum(weight, 1)
    out = np.zeros((n_docs, components), dtype=np.uint32)
    todo = np.flatnonzero(weight > 0)
    # A row for each process: stratum s > 0 is [2**(s-1), 2**s), stratum 0 is [0, 1).
    strata = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
    entry = np.repeat(np.arange(len(doc)), strata)
    stratum = np.arange(len(entry)) - np.repeat(np.cumsum(strata) - strata, strata)
    low = np.where(stratum > 0, 1 << np.maximum(stratum - 1, 0), 0)
    width = np.where(stratum > 0, low, 1)
    seed = K.mix(grams[entry] + stratum.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    owner, count = doc[entry], counts[entry]
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    while len(todo):
        # The upper half of a cell is the time of its point (positive floats order as whole numbers), the lower its name.
        best = np.full(n_docs * components, none)
        wanted = np.zeros(n_docs, dtype=bool)
        wanted[todo] = True
        alive = np.flatnonzero(wanted[owner])
        time, step = np.zeros(len(alive)), 0
        while len(alive):
            size = _POINTS[min(step, len(_POINTS) - 1)]
            number = np.arange(step, step + size, dtype=np.uint64)
            draw = K.mix(seed[alive, None] + number * np.uint64(0xD1B54A32D192ED03))
            times = np.log(_uniform(draw))
            times *= (-1.0 / (components * width[alive]))[:, None]
            if size > 1:
                np.cumsum(times, axis=1, out=times)
            times += time[:, None]
            near = times <= limit[owner[alive], None]
            row = np.flatnonzero(near.any(axis=1)) if size == 1 else np.nonzero(near)[0]
            if len(row):
                process, at = alive[row], times[near]
                place = K.mix(draw[near] ^ np.uint64(0xA0761D6478BD642F))
                if (width[process] > 1).any():
                    level = low[process] + ((place >> np.uint64(32)) % width[process].astype(np.uint64)).astype(np.int64)
                    use = level < count[process]
                    process, at, place = process[use], at[use], place[use]
                cell = owner[process] * components + ((place & np.uint64(0xFFFFFF)) % np.uint64(components)).astype(np.int64)
                name = (place * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(32)
                np.minimum.at(best, cell, (at.view(np.uint64) & np.uint64(0xFFFFFFFF00000000)) | name)
            time = times[:, -1]
            on = near[:, -1]
            alive, time, step = alive[on], time[on], step + size
        rows = best.reshape(n_docs, components)
        full = todo[(rows[todo] != none).all(axis=1)]
        out[full] = (rows[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        todo = np.setdiff1d(todo, full)
        limit[todo] *= 2
    return out


def similarity(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags (sorted shingles, counts)."""
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(nx[i], ny[j]).sum())
    return both / max(1, int(nx.sum()) + int(ny.sum()) - both)


def _signed(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, sig)`` of every row; sig is null for texts without words."""

    def run(batches):
        for batch in batches:
            for begin, end, data, offsets in K.text_pieces(batch, limit=K.SMALL_PIECE_BYTES):
                doc, grams, counts, keys = bags(data, offsets)
                sig = signatures(doc, grams, counts, end - begin)
                some = np.zeros(end - begin, dtype=bool)
                some[doc] = True
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, end - begin),
                        pa.array(keys, pa.binary()),
                        pa.array([s.tobytes() if ok else None for s, ok in zip(sig, some)], pa.binary()),
                    ],
                    ["doc_id", "key", "sig"],
                )
        K.trim()

    return docs.mapInArrow(run, "doc_id long, key binary, sig binary")


def _shared_buckets(signed: DataFrame) -> DataFrame:
    """``(bucket, key, rank)``: buckets of two or more distinct documents; the member of largest rank is the hub."""
    width = 4 * ROWS
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * width + 1, F.lit(width))),
    )
    keyed = signed.filter("sig is not null").groupBy("key").agg(F.first("sig").alias("sig"))
    banded = tables.written(keyed.select("key", F.explode(bands).alias("bucket")))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = tables.written(banded.join(sizes, "bucket"))
    degrees = shared.groupBy("key").agg(F.sum("n").alias("degree"))
    rank = F.struct("degree", F.xxhash64("key").alias("at"), "key").alias("rank")
    ranked = tables.written(shared.join(degrees, "key").select("bucket", "key", rank))
    tables.drop(banded, shared)
    return ranked


def _texts_of(docs: DataFrame, ids: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(key, tests)`` with the text of a row that has the key. ``ids``: a row id for each key."""
    wanted = wanted.join(ids, "key")
    return docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["of_id"])).select("text", "key", "tests")


def _send(names, kinds, fields):
    """Rows of ``names``: for each test of a document its ``fields``, the document's key and bag."""

    def run(batches):
        for batch in batches:
            for begin, end, data, offsets in K.text_pieces(batch, limit=K.SMALL_PIECE_BYTES):
                doc, grams, counts, keys = bags(data, offsets)
                bounds = np.searchsorted(doc, np.arange(end - begin + 1)).tolist()
                for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    key = batch.column("key")[begin + i].as_py()
                    if keys[i] != key:
                        continue  # another text with the same id
                    bag = grams[a:b].tobytes(), counts[a:b].astype(np.int32).tobytes()
                    tests = batch.column("tests")[begin + i].as_py()
                    for at in range(0, len(tests), 64):
                        rows = [(*(t[f] for f in fields), key, *bag) for t in tests[at : at + 64]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        K.trim()

    return run


def _bag(grams: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(grams, dtype=np.uint64), np.frombuffer(counts, dtype=np.int32)


def _compared(docs: DataFrame, ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """The distinct ``(x, y)`` of ``pairs`` with the similarity of their bags. Bags meet at (y, salt): that of y comes
    first and is held, the others stream by."""
    n = tables.parts(docs.sparkSession)
    salts = pairs.groupBy("y").agg(F.ceil(F.count("*") / F.lit(_SALT_MEMBERS)).cast("int").alias("salts"))
    own = salts.select(F.col("y").alias("key"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    tests = (
        pairs.join(salts, "y")
        .select(F.col("x").alias("key"), "y", F.pmod(F.xxhash64("x"), "salts").cast("int").alias("salt"), F.lit(True).alias("member"))
        .unionByName(own.select("key", F.col("key").alias("y"), "salt", F.lit(False).alias("member")))
        .groupBy("key").agg(F.collect_set(F.struct("y", "salt", "member")).alias("tests"))
    )

    def meet(batches):
        group, own = None, None
        for batch in batches:
            found = []
            for at in range(batch.num_rows):
                y, salt, member, x, grams, counts = (batch.column(i)[at].as_py() for i in range(6))
                if not member:
                    group, own = (y, salt), _bag(grams, counts)
                elif group == (y, salt):
                    found.append((x, y, similarity(*_bag(grams, counts), *own)))
            if found:
                kinds = (pa.binary(), pa.binary(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["x", "y", "sim"])
        K.trim()

    send = _send(
        ["y", "salt", "member", "x", "grams", "counts"],
        [pa.binary(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()], ["y", "salt", "member"],
    )
    sent = _texts_of(docs, ids, tests).mapInArrow(send, "y binary, salt int, member boolean, x binary, grams binary, counts binary")
    dealt = sent.repartition(n, "y", "salt").sortWithinPartitions("y", "salt", "member")
    return dealt.mapInArrow(meet, "x binary, y binary, sim double").groupBy("x", "y").agg(F.max("sim").alias("sim"))


class _Block:
    """Bags of some members, by shingle."""

    def __init__(self, members: list):
        self.keys = [m[0] for m in members]
        self.roots = [m[1] for m in members]
        owner = np.repeat(np.arange(len(members)), [len(m[2]) for m in members])
        grams = np.concatenate([m[2] for m in members])
        counts = np.concatenate([m[3] for m in members])
        order = np.argsort(grams, kind="stable")
        self.grams, self.owner, self.counts = grams[order], owner[order], counts[order]
        self.sizes = np.bincount(owner, counts, minlength=len(members))

    def similarities(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.grams, grams), np.searchsorted(self.grams, grams, side="right")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        least = np.minimum(self.counts[at], np.repeat(counts, n))
        both = np.bincount(self.owner[at], least, minlength=len(self.keys))
        return both / np.maximum(1, self.sizes + counts.sum() - both)


def _resolved(docs: DataFrame, ids: DataFrame, tested: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """Links ``(x, y)`` of members of other classes than their hub to members that met the same hub: for each block of
    members at most one to each class."""
    n = tables.parts(docs.sparkSession)
    hub_roots = roots.select(F.col("key").alias("y"), F.col("root").alias("hub_root"))
    met = (
        tested.select(F.col("x").alias("key"), "y")
        .join(roots, "key", "left").join(hub_roots, "y", "left")
        .select("key", "y", F.coalesce("root", "key").alias("root"), F.coalesce("hub_root", "y").alias("hub_root"))
        .withColumn("open", F.col("root") != F.col("hub_root"))
    )
    groups = met.groupBy("y").agg(F.count("*").alias("n"), F.max("open").alias("some")).filter("some and n > 1")
    groups = groups.select("y", F.ceil(F.col("n") / F.lit(_BLOCK_MEMBERS)).cast("int").alias("blocks"))
    met = tables.written(met.join(groups, "y"))
    members = met.select("key", "y", F.pmod(F.xxhash64("key"), "blocks").cast("int").alias("block"), "root", F.lit(False).alias("asks"))
    askers = met.filter("open").select(
        "key", "y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "root", F.lit(True).alias("asks")
    )
    tests = members.unionByName(askers).groupBy("key").agg(F.collect_set(F.struct("y", "block", "asks", "root")).alias("tests"))

    def meet(batches):
        group, members, block = None, [], None
        for batch in batches:
            found = []
            for at in range(batch.num_rows):
                y, number, asks, root, x, grams, counts = (batch.column(i)[at].as_py() for i in range(7))
                if group != (y, number):
                    group, members, block = (y, number), [], None
                bag = _bag(grams, counts)
                if not asks:
                    members.append((x, root, *bag))
                    continue
                block = block or _Block(members)
                classes_ = {root}
                for i in np.flatnonzero(block.similarities(*bag) >= least).tolist():
                    if block.roots[i] not in classes_:
                        classes_.add(block.roots[i])
                        found.append((x, block.keys[i]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["x", "y"])
        members, block = [], None
        K.trim()

    send = _send(
        ["y", "block", "asks", "root", "x", "grams", "counts"],
        [pa.binary(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary()], ["y", "block", "asks", "root"],
    )
    kind = "y binary, block int, asks boolean, root binary, x binary, grams binary, counts binary"
    dealt = _texts_of(docs, ids, tests).mapInArrow(send, kind).repartition(n, "y", "block").sortWithinPartitions("y", "block", "asks")
    return dealt.mapInArrow(meet, "x binary, y binary").distinct()


def _checksum(edges: DataFrame) -> tuple:
    sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(sums)


def components(edges: DataFrame) -> DataFrame:
    """``(key, root)`` for each node of ``edges(x, y)``, by alternating large and small stars; root is the least node."""
    now = tables.written(edges.filter("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    seen = _checksum(now)
    while seen[0]:
        # Larger neighbours of a node move to its least neighbour, ...
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.filter("u > v")
        # ... and smaller ones to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = tables.written(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        tables.drop(now)
        now, before = after, seen
        seen = _checksum(now)
        if seen == before:
            break
    roots = now.select(F.col("u").alias("key"), F.col("v").alias("root"))
    roots = tables.written(roots.unionByName(roots.select(F.col("root").alias("key"), "root").distinct()))
    tables.drop(now)
    return roots


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``(doc_id, key, class_id)`` for every row of ``docs(doc_id, text)``; key is a digest of the words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = tables.written(_signed(docs))
    ids = signed.groupBy("key").agg(F.min("doc_id").alias("of_id"))
    shared = _shared_buckets(signed)
    hubs = shared.groupBy("bucket").agg(F.max("rank").alias("r")).select("bucket", F.col("r.key").alias("hub"))
    pairs = shared.join(hubs, "bucket").filter("key <> hub").select(F.col("key").alias("x"), F.col("hub").alias("y"))
    pairs = tables.written(pairs.distinct())
    tested = tables.written(_compared(docs, ids, pairs))
    tables.drop(shared, pairs)
    links = tested.filter(F.col("sim") >= least)
    roots = components(links)
    more = tables.written(_resolved(docs, ids, tested, roots, least))
    if not more.isEmpty():
        first, roots = roots, components(links.select("x", "y").unionByName(more))
        tables.drop(first)
    tables.drop(tested, more)
    named = ids.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    names = named.groupBy("root").agg(F.min("of_id").alias("class_id"))
    named = named.join(names, "root").select("key", "class_id")
    found = signed.select("doc_id", "key").join(named, "key").select("doc_id", "key", "class_id")
    found.reads = [signed, roots]
    return found


def first_of_class(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class, that with the least id, with all its columns."""
    found = classes(docs, least)
    inside = tables.written(found)
    tables.drop(*found.reads)
    kept = inside.filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    # Of equal ids in one class the least text stays; ids are few per class, texts stay where they are joined once.
    kept = kept.groupBy("doc_id", "class_id").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"), F.col("n").alias("kept_n"))
    names = docs.columns
    whole = docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("long").alias("kept_doc"), "text")

    def keyed(batches):
        for batch in batches:
            for begin, end, data, offsets in K.text_pieces(batch, limit=K.SMALL_PIECE_BYTES):
                keys = bags(data, offsets)[3]
                some = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [some.column("row"), some.column("kept_doc"), pa.array(keys, pa.binary())], ["row", "kept_doc", "key"]
                )
        K.trim()

    rows = whole.mapInArrow(keyed, whole.select("row", "kept_doc", F.lit(b"").alias("key")).schema)
    joined = rows.join(kept, rows["kept_doc"].eqNullSafe(kept["kept_id"]) & (rows["key"] == kept["kept_key"]))
    once = Window.partitionBy("kept_doc", "key").orderBy("kept_n")
    return joined.withColumn("nth", F.row_number().over(once)).filter("nth = 1").select("row.*").select(*names)
