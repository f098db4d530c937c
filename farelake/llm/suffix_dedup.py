"""Removal of repeated passages by prefix-free parsing and suffix arrays of the dictionary.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id.

Method. A rolling hash over ``WINDOW`` bytes runs along each document. The trigger of a string of ``LENGTH`` bytes is the
place of the (leftmost) least hash in it; that depends on the string alone, and every such string holds one. Strings that
follow each other with the same trigger form a phrase, so a document is parsed into phrases that equal passages share.

1. *Parse.* Each phrase becomes an entry of 16 bytes (32 bits of its trigger's hash, 64 of its own, and 16 of half a
   context to each side) and its document. Entries meet by trigger. A phrase that also occurs in a smaller document goes whole. Of
   the others, a first occurrence has to be looked at if another phrase has the same trigger and half context: any
   string of ``LENGTH`` bytes that two phrases share holds the trigger and one of the half contexts.
2. *Dictionary.* Documents get these answers, drop the repeated phrases, and send the bytes of the phrases in doubt,
   each distinct one from its first document only.
3. *Suffix array.* The suffixes of these phrases are sorted by their first ``LENGTH`` bytes; neighbours in that order
   that agree are occurrences of one string, whose least document keeps it. The answers go back to the documents.
4. *Crowded triggers.* Of a trigger with more than ``CROWD`` phrases in doubt no task takes all. These phrases go as 128-bit
   hashes of their strings, each with its least document once for a group of documents, and meet by string.

Strings are judged on the input. Text moves once, and a second time for documents with phrases in doubt. All groups
are by hash; the number of buckets follows from the bytes of the input. Only the entries of one trigger stay together,
16 bytes and a document each.

Null and empty texts have nothing to remove. Rows with equal ids do not judge each other. A row with a null id counts
as larger than all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm import kernels as K
from farelake.llm import tables
from farelake.llm.fingerprints import _window_min

LENGTH, WINDOW = 50, 16
BUCKET_BYTES = 8 << 20
CROWD = 1000
SORT_ROWS = 20_000
_FLUSH_STRINGS = 1 << 19
_HALF = (LENGTH - WINDOW + 1) // 2
_FLUSH_BYTES = 12 << 20
_PIECE_BYTES = 1 << 18  # temporary arrays of eight bytes a byte of text fit a core's cache
_LAST = (1 << 63) - 1
_PLACE = 40


def parse(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Phrases in order: document, first and last start of their strings, trigger place, and their hashes."""
    if len(data) < length:
        none, empty = np.empty(0, np.int64), np.empty(0, np.uint64)
        return dict(doc=none, first=none, last=none, place=none, trigger=empty, code=empty, left=none, right=none)
    sums = K.prefix_sums(data)
    at = np.arange(len(data) - window + 1)
    rolling = K.span_hashes(sums, at, at + window)
    # The upper bits order windows, the lower ones are their place, so that the leftmost least wins.
    low = np.uint64((1 << _PLACE) - 1)
    code = ((rolling >> np.uint64(_PLACE)) << np.uint64(_PLACE)) | at.astype(np.uint64)
    place = (_window_min(code, length - window + 1) & low).astype(np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.flatnonzero(owner[: len(data) - length + 1] == owner[length - 1 :])
    place = place[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start)) - 1 if len(head) else head
    first, last, place = start[head], start[tail], place[head]
    doc = owner[first]
    trigger = K.mix(rolling[place] + np.uint64(1))
    code = K.mix(K.span_hashes(sums, first, last + length) + (place - first).astype(np.uint64))
    half = (length - window + 1) // 2
    left = K.span_hashes(sums, np.maximum(place - half, offsets[doc]), place)
    right = K.span_hashes(sums, place + window, np.minimum(place + window + half, offsets[doc + 1]))
    return dict(
        doc=doc, first=first, last=last, place=place, trigger=trigger, code=code,
        left=(left >> np.uint64(48)).astype(np.uint16), right=(right >> np.uint64(48)).astype(np.uint16),
    )


def _packed_longs(values: np.ndarray) -> bytes:
    """Sorted or repeating 64-bit numbers in little room."""
    steps = np.diff(values, prepend=np.int64(0)).astype(np.int64)
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked_longs(raw: bytes) -> np.ndarray:
    columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(columns.reshape(8, -1).T).view(np.int64).ravel())


def _entries(buckets: int):
    """Rows ``(bucket, docs, hashes)`` with the distinct phrases of many documents."""

    def flush(kept):
        trigger, code, left, right, doc = (np.concatenate(x) for x in zip(*kept))
        bucket = (trigger % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((code, doc, bucket))
        bucket, code, left, right, doc = (x[order] for x in (bucket, code, left, right, doc))
        trigger = (trigger[order] >> np.uint64(32)).astype(np.uint32)
        new = np.ones(len(code), dtype=bool)
        new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1]) | (bucket[1:] != bucket[:-1])
        bucket, trigger, code, left, right, doc = (x[new] for x in (bucket, trigger, code, left, right, doc))
        used, bounds = np.unique(bucket, return_index=True)
        rows = []
        for b, i, j in zip(used.tolist(), bounds.tolist(), [*bounds[1:].tolist(), len(bucket)]):
            hashes = b"".join(x[i:j].tobytes() for x in (code, trigger, left, right))
            rows.append((b, _packed_longs(doc[i:j]), hashes))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["bucket", "docs", "hashes"]
        )

    def run(batches):
        kept, size = [], 0
        for batch in batches:
            keys = batch.column("doc_key").to_numpy()
            for begin, _, data, offsets in K.text_pieces(batch, limit=_PIECE_BYTES):
                p = parse(data, offsets)
                if len(p["doc"]):
                    kept.append((p["trigger"], p["code"], p["left"], p["right"], keys[begin + p["doc"]]))
                size += len(data)
                if size >= _FLUSH_BYTES and kept:
                    yield flush(kept)
                    kept, size = [], 0
                    K.trim()
        if kept:
            yield flush(kept)
        kept = None
        K.trim()

    return run


def _group_min_max(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the values of each key differ."""
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    head = np.ones(len(keys), dtype=bool)
    head[1:] = sorted_[1:] != sorted_[:-1]
    at = np.flatnonzero(head)
    differ = np.minimum.reduceat(values[order], at) != np.maximum.reduceat(values[order], at)
    out = np.empty(len(keys), dtype=bool)
    out[order] = differ[np.cumsum(head) - 1]
    return out


def _judge(docs: np.ndarray, code: np.ndarray, trigger: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Of one bucket: (document, code) of repeated phrases, of first occurrences in doubt, and of those on crowded triggers."""
    order = np.lexsort((docs, code, trigger))
    docs, code, trigger, left, right = docs[order], code[order], trigger[order], left[order], right[order]
    head = np.ones(len(code), dtype=bool)
    head[1:] = (code[1:] != code[:-1]) | (trigger[1:] != trigger[:-1])
    at = np.flatnonzero(head)
    least = docs[at]
    repeated = docs > least[np.cumsum(head) - 1]
    trigger = trigger[at].astype(np.uint64) << np.uint64(32)
    doubt = np.zeros(len(at), dtype=bool)
    for side, context in enumerate((left, right)):
        doubt |= _group_min_max(trigger | np.uint64(side << 16) | context[at].astype(np.uint64), least)
    _, which, counts = np.unique(trigger[doubt], return_inverse=True, return_counts=True)
    crowded = counts[which] > CROWD
    least, first = least[doubt], code[at][doubt]
    return (docs[repeated], code[repeated]), (least[~crowded], first[~crowded]), (least[crowded], first[crowded])


def _answers(groups: int):
    """Rows ``(g, kind, docs, codes)`` from buckets that arrive in order; kind 0: repeated, 1: in doubt, 2: in doubt on a crowded trigger."""

    def replies(kept):
        docs, hashes = zip(*kept)
        docs = [_unpacked_longs(x) for x in docs]
        parts = []
        for d, h in zip(docs, hashes):
            n = len(d)
            kinds = ((np.uint64, 0), (np.uint32, 8), (np.uint16, 12), (np.uint16, 14))
            parts.append([np.frombuffer(h, k, n, at * n) for k, at in kinds])
        found = _judge(np.concatenate(docs), *(np.concatenate(x) for x in zip(*parts)))
        rows = []
        for kind, (doc, code) in enumerate(found):
            g = np.mod(doc, groups)
            order = np.lexsort((doc, g))
            g, doc, code = g[order], doc[order], code[order]
            used, bounds = np.unique(g, return_index=True)
            for x, i, j in zip(used.tolist(), bounds.tolist(), [*bounds[1:].tolist(), len(g)]):
                rows.append((x, kind, _packed_longs(doc[i:j]), code[i:j].tobytes()))
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["g", "kind", "docs", "codes"])

    def run(batches):
        bucket, kept = None, []
        for batch in batches:
            for b, docs, hashes in zip(*(batch.column(c).to_pylist() for c in ("bucket", "docs", "hashes"))):
                if b != bucket and kept:
                    yield from replies(kept)
                    kept = []
                    K.trim()
                bucket = b
                kept.append((docs, hashes))
        if kept:
            yield from replies(kept)
        kept = None
        K.trim()

    return run


def _named(docs: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """One hash of a document and a phrase."""
    return K.mix(codes + K.mix(docs.astype(np.uint64)))


def _string_names(data: np.ndarray, sums: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the strings of ``LENGTH`` bytes that start at ``at``."""
    two = np.zeros(len(at), dtype=np.uint64)
    for step in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        eight = np.lib.stride_tricks.sliding_window_view(data, 8)[at + step]
        two = K.mix(two * np.uint64(K._MULTIPLIER) + eight.view("<u8").ravel())
    return K.span_hashes(sums, at, at + LENGTH), two


def _least_of_strings(one: np.ndarray, two: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Each distinct string with its least and its greatest document."""
    order = np.lexsort((doc, two, one))
    one, two, doc = one[order], two[order], doc[order]
    head = np.ones(len(one), dtype=bool)
    head[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    at = np.flatnonzero(head)
    return [one[at].view(np.int64), two[at].view(np.int64), doc[at], doc[np.append(at[1:], len(doc)) - 1]]


def _runs_of(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings that start in ``first..last``, with their documents; all rising."""
    if not len(first):
        return doc, first, last
    end = np.maximum.accumulate(last + LENGTH)
    new = np.ones(len(first), dtype=bool)
    new[1:] = (first[1:] > end[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], first[at], end[np.append(at[1:], len(first)) - 1]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The owner of each of ``counts`` items in a row, and its number there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]


def _pack(batches):
    """Texts compressed for the way through a shuffle."""
    packer = zstandard.ZstdCompressor(level=3)
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            packed = [packer.compress(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key"), batch.column("rest"), pa.array(packed, pa.binary())], ["doc_key", "rest", "packed"]
            )


def _unpacked(batch: pa.RecordBatch, rows: int = 128):
    """Parts of a batch of text rows, with their texts."""
    unpacker = zstandard.ZstdDecompressor()
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        texts = pa.array([unpacker.decompress(x) for x in part.column("packed").to_pylist()], pa.binary())
        yield part.append_column("text", texts.cast(pa.string()))


def _text_pieces(batch: pa.RecordBatch):
    for part in _unpacked(batch):
        keys = part.column("doc_key").to_numpy()
        for begin, end, data, offsets in K.text_pieces(part, limit=_PIECE_BYTES):
            yield part, keys, begin, end, data, offsets


def _in_groups(batches):
    """Runs of rows of one group: ``(g, text rows?, batch)``."""
    for batch in batches:
        g = batch.column("g").to_numpy()
        is_text = batch.column("kind").to_numpy() == 9
        cut = np.flatnonzero((g[1:] != g[:-1]) | (is_text[1:] != is_text[:-1])) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(g)]):
            if j > i:
                yield int(g[i]), bool(is_text[i]), batch.slice(i, j - i)


def _settle(finish: Callable, schema: pa.Schema):
    """Texts with their answers: finished rows, or open rows and their phrases in doubt."""

    def flush(group, strings):
        found = _least_of_strings(*(np.concatenate(x) for x in zip(*strings)))
        columns = dict(zip(("g", "s_one", "s_two", "s_least", "s_most"), [np.full(len(found[0]), group), *found]))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(found[0]), f.type) for f in schema],
            schema=schema,
        )

    def run(batches):
        group, docs, codes, kinds, tables_ = None, [], [], [], None
        strings, size = [], 0
        packer = zstandard.ZstdCompressor(level=3)
        for g, is_text, batch in _in_groups(batches):
            if g != group:
                if strings:
                    yield flush(group, strings)
                strings, size = [], 0
                group, docs, codes, kinds, tables_ = g, [], [], [], None
                K.trim()
            if not is_text:
                for kind, d, c in zip(*(batch.column(x).to_pylist() for x in ("kind", "docs", "codes"))):
                    d = _unpacked_longs(d)
                    docs.append(d)
                    codes.append(np.frombuffer(c, dtype=np.uint64))
                    kinds.append(np.full(len(d), kind))
                continue
            if tables_ is None:
                name = _named(np.concatenate(docs), np.concatenate(codes)) if docs else np.empty(0, np.uint64)
                kind = np.concatenate(kinds) if docs else np.empty(0, np.int64)
                tables_ = [K.Lookup(np.sort(name[kind == k])) for k in (0, 1, 2)]
                docs, codes, kinds, name, kind = [], [], [], None, None
            for batch, keys, begin, end, data, offsets in _text_pieces(batch):
                p = parse(data, offsets)
                name = _named(keys[begin + p["doc"]], p["code"])
                repeated = np.sort(tables_[0].find(name)[0])
                doubt, crowded = tables_[1].find(name)[0], tables_[2].find(name)[0]
                if len(crowded):
                    owner, inner = _spread(p["last"][crowded] - p["first"][crowded] + 1)
                    doc = keys[begin + p["doc"][crowded][owner]]
                    strings.append((*_string_names(data, K.prefix_sums(data), p["first"][crowded][owner] + inner), doc))
                    size += len(owner)
                    if size >= _FLUSH_STRINGS:
                        yield flush(group, strings)
                        strings, size = [], 0
                rows = {f.name: [] for f in schema if f.name != "rest" and f.name[:2] not in ("q_", "s_")}
                in_doubt = {*p["doc"][doubt].tolist(), *p["doc"][crowded].tolist()}
                doc, first, last = _runs_of(p["doc"][repeated], p["first"][repeated], p["last"][repeated])
                first, last = first - offsets[doc], last - offsets[doc]
                bounds = np.searchsorted(doc, np.arange(end - begin + 1)).tolist()
                for i in range(end - begin):
                    own = slice(bounds[i], bounds[i + 1])
                    raw = data[offsets[i] : offsets[i + 1]]
                    if i in in_doubt:
                        row = {"doc_key": int(keys[begin + i]), "g": group, "packed": packer.compress(raw.tobytes()), "runs": _pack_runs(first[own], last[own])}
                    else:
                        row = finish(raw, first[own], last[own])
                    _add(rows, row)
                yield _batch(schema, end - begin, rows | {"rest": batch.column("rest").slice(begin, end - begin)})
                if len(doubt):
                    # a phrase that its document repeats is asked for once
                    doubt = doubt[np.unique(name[doubt], return_index=True)[1]]
                    a, lengths = p["first"][doubt], p["last"][doubt] + LENGTH - p["first"][doubt]
                    owner, inner = _spread(lengths)
                    yield _batch(schema, len(doubt), {
                        "q_trigger": (p["trigger"][doubt] >> np.uint64(32)).astype(np.int64), "q_code": p["code"][doubt].view(np.int64),
                        "q_doc": keys[begin + p["doc"][doubt]], "q_text": _binary(data[a[owner] + inner], lengths),
                    })
        if strings:
            yield flush(group, strings)
        strings = tables_ = None
        K.trim()

    return run


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of these lengths that follow each other in ``data``."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings without nulls, one after the other, and their lengths."""
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], np.diff(offsets).astype(np.int64)


def _batch(schema: pa.Schema, n: int, columns: dict) -> pa.RecordBatch:
    """``n`` rows with these columns, the others null."""

    def array(values, kind):
        if isinstance(values, pa.Array):
            return values if values.type == kind else pa.array(values.to_pylist(), kind)
        return pa.nulls(n, kind) if values is None else pa.array(values, kind)

    return pa.RecordBatch.from_arrays([array(columns.get(f.name), f.type) for f in schema], schema=schema)


def _add(rows: dict, row: dict) -> None:
    for name, values in rows.items():
        values.append(row.get(name))


def _pack_runs(first: np.ndarray, last: np.ndarray) -> bytes:
    return np.stack([first, last], axis=1).astype(np.int64).tobytes()


def _suffixes(batches):
    """Sorts the suffixes of phrases in doubt; which starts of each also start in a smaller document.

    Rows arrive sorted by trigger; whole triggers are taken together, many at a time.
    """
    names, last = ["q_doc", "q_code", "starts"], None

    def answer(held):
        docs, codes = (np.concatenate([h[c].to_numpy() for h in held]) for c in ("q_doc", "q_code"))
        parts = [_joined(h["q_text"]) for h in held]
        data, lengths = (np.concatenate(x) for x in zip(*parts))
        counts = lengths - LENGTH + 1
        owner, inner = _spread(counts)
        at = (np.cumsum(lengths) - lengths)[owner] + inner
        # The first LENGTH bytes of each suffix as big-endian words, most significant first.
        words = -(-LENGTH // 8)
        wide = np.zeros((len(at), words * 8), dtype=np.uint8)
        wide[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[at]
        columns = wide.view(">u8").astype(np.uint64)
        doc = docs[owner]
        order = np.lexsort((doc, *columns.T[::-1]))
        columns, doc = columns[order], doc[order]
        head = np.ones(len(order), dtype=bool)
        head[1:] = (columns[1:] != columns[:-1]).any(axis=1)
        repeated = np.zeros(len(order), dtype=bool)
        repeated[order] = doc > doc[np.flatnonzero(head)][np.cumsum(head) - 1]
        bits = np.where(repeated, np.int64(1) << inner, np.int64(0))
        starts = np.bitwise_or.reduceat(bits, np.cumsum(counts) - counts)
        keep = np.flatnonzero(starts)
        return pa.RecordBatch.from_arrays([pa.array(x[keep], pa.int64()) for x in (docs, codes, starts)], names)

    held, size = [], 0
    for batch in batches:
        columns = {c: batch.column(c) for c in ("q_doc", "q_code", "q_text")}
        trigger = batch.column("q_trigger").to_numpy()
        heads = np.flatnonzero(trigger[1:] != trigger[:-1]) + 1
        if size and trigger[0] != last:
            heads = np.concatenate([[0], heads])
        at = 0
        while True:
            # up to the first trigger that begins when enough rows are held
            cut = heads[np.searchsorted(heads, at + max(0, SORT_ROWS - size)) :]
            end = int(cut[0]) if len(cut) else len(trigger)
            held.append({c: x.slice(at, end - at) for c, x in columns.items()})
            size += end - at
            if not len(cut):
                break
            yield answer(held)
            held, size, at = [], 0, end
        last = trigger[-1]
    if size:
        yield answer(held)
    held = None
    K.trim()


def _close(finish: Callable, schema: pa.Schema):
    """Open texts with the answers from the suffix array, and with the strings of crowded triggers (kind 1)."""

    def repeated_strings(keys, data, offsets, strings):
        """Starts of strings that a smaller document than their own has, rising."""
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        at = np.flatnonzero(owner[: max(0, len(data) - LENGTH + 1)] == owner[LENGTH - 1 :])
        table, twos, least = strings
        one, two = _string_names(data, K.prefix_sums(data), at)
        hit, which = table.find(one)
        at, two = at[hit], two[hit]
        return at[(twos[which] == two) & (least[which] < keys[owner[at]])]

    def run(batches):
        group, found, crowd, answers, strings = None, [], [], None, None
        for g, is_text, batch in _in_groups(batches):
            if g != group:
                group, found, crowd, answers, strings = g, [], [], None, None
                K.trim()
            if not is_text:
                for kind, held in ((0, found), (1, crowd)):
                    some = batch.filter(pa.array(batch.column("kind").to_numpy() == kind))
                    if some.num_rows:
                        held.append([some.column(c).to_numpy() for c in ("doc_key", "code", "starts")])
                continue
            if found:
                docs, codes, starts = (np.concatenate(x) for x in zip(*found))
                name, at = np.unique(_named(docs, codes.view(np.uint64)), return_index=True)
                answers, found = (K.Lookup(name), starts[at]), []
            if crowd:
                least, one, two = (np.concatenate(x) for x in zip(*crowd))
                one, at = np.unique(one.view(np.uint64), return_index=True)
                strings, crowd = (K.Lookup(one), two[at].view(np.uint64), least[at]), []
            for batch, keys, begin, end, data, offsets in _text_pieces(batch):
                raw, lengths = _joined(batch.column("runs").slice(begin, end - begin))
                doc = np.repeat(np.arange(end - begin), lengths // 16)
                first, last = raw.view(np.int64).reshape(-1, 2).T + offsets[doc]
                runs = [(doc, first, last - LENGTH)]
                if answers:
                    p = parse(data, offsets)
                    hit, which = answers[0].find(_named(keys[begin + p["doc"]], p["code"]))
                    bits = answers[1][which, None] >> np.arange(LENGTH - WINDOW + 1) & 1
                    at, inner = np.nonzero(bits)
                    first = p["first"][hit][at] + inner
                    runs.append((p["doc"][hit][at], first, first))
                if strings and len(data) >= LENGTH:
                    first = repeated_strings(keys[begin:end], data, offsets, strings)
                    runs.append((np.searchsorted(offsets, first, side="right") - 1, first, first))
                doc, first, last = (np.concatenate(x) for x in zip(*runs))
                order = np.lexsort((first, doc))
                doc, first, last = _runs_of(doc[order], first[order], last[order])
                first, last = first - offsets[doc], last - offsets[doc]
                bounds = np.searchsorted(doc, np.arange(end - begin + 1)).tolist()
                rows = {c: [] for c in schema.names if c != "rest"}
                for i in range(end - begin):
                    own = slice(bounds[i], bounds[i + 1])
                    _add(rows, finish(data[offsets[i] : offsets[i + 1]], first[own], last[own]))
                yield _batch(schema, end - begin, rows | {"rest": batch.column("rest").slice(begin, end - begin)})

    return run


def _kept(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> bytes:
    mask = np.ones(len(raw), dtype=bool)
    for a, b in zip(first.tolist(), last.tolist()):
        mask[a:b] = False
    return raw[mask].tobytes()


def digest(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> dict:
    """Counts and the digest of the remaining bytes."""
    return dict(
        n_bytes=len(raw), n_removed=int((last - first).sum()), n_spans=len(first),
        kept_sha256=hashlib.sha256(_kept(raw, first, last)).hexdigest(),
    )


def remaining(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> dict:
    """The remaining text; characters of which bytes were removed go whole."""
    return dict(kept=_kept(raw, first, last).decode(errors="ignore"))


DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
REMAINING = "kept string"


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def dedup(docs: DataFrame, rest: list[str], finish: Callable = digest, kind: str = DIGEST) -> DataFrame:
    """The columns ``rest`` of every row of ``docs(doc_id, text, ...)`` and what ``finish`` makes of its removed runs."""
    spark = docs.sparkSession
    n = tables.parts(spark)
    docs = docs.select(
        F.struct(*rest).alias("rest"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first().n or 0
    buckets = max(n, size // BUCKET_BYTES + 1)

    entries = docs.select("doc_key", "text").mapInArrow(_entries(buckets), "bucket int, docs binary, hashes binary")
    entries = entries.repartition(n, "bucket").sortWithinPartitions("bucket")
    answers = entries.mapInArrow(_answers(buckets), "g long, kind int, docs binary, codes binary")

    none = lambda kind: F.lit(None).cast(kind)
    rest_type = docs.schema["rest"].dataType
    packed = docs.mapInArrow(_pack, f"doc_key long, rest {rest_type.simpleString()}, packed binary")
    texts = packed.select(
        F.pmod("doc_key", F.lit(buckets)).alias("g"), F.lit(9).alias("kind"), none("binary").alias("docs"),
        none("binary").alias("codes"), "doc_key", "packed", "rest",
    )
    both = texts.unionByName(
        answers.select("*", none("long").alias("doc_key"), none("binary").alias("packed"), none(rest_type).alias("rest"))
    )
    both = both.repartition(n, "g").sortWithinPartitions("g", "kind")
    done = f"rest {rest_type.simpleString()}, {kind}"
    settled = (
        f"{done}, g long, doc_key long, packed binary, runs binary, q_trigger long, q_code long, q_doc long, "
        "q_text binary, s_one long, s_two long, s_least long, s_most long"
    )
    shape = lambda ddl: _arrow(spark.createDataFrame([], ddl).schema)
    state = tables.written(both.mapInArrow(_settle(finish, shape(settled)), settled))

    doubts = state.filter("q_text is not null").select("q_trigger", "q_code", "q_doc", "q_text")
    doubts = doubts.repartition(n, "q_trigger").sortWithinPartitions("q_trigger")
    found = doubts.mapInArrow(_suffixes, "q_doc long, q_code long, starts long")
    found = found.select(
        F.pmod("q_doc", F.lit(buckets)).alias("g"), F.lit(0).alias("kind"), F.col("q_doc").alias("doc_key"),
        F.col("q_code").alias("code"), "starts", none("binary").alias("packed"), none("binary").alias("runs"),
        none(rest_type).alias("rest"),
    )
    whole = Window.partitionBy("s_one", "s_two")
    common = state.filter("s_one is not null").withColumn("least", F.min("s_least").over(whole)).filter("least < s_most")
    common = common.select(
        "g", F.lit(1).alias("kind"), F.col("least").alias("doc_key"), F.col("s_one").alias("code"),
        F.col("s_two").alias("starts"), none("binary").alias("packed"), none("binary").alias("runs"), none(rest_type).alias("rest"),
    )
    open_ = state.filter("runs is not null").select(
        "g", F.lit(9).alias("kind"), "doc_key", none("long").alias("code"), none("long").alias("starts"), "packed", "runs", "rest"
    )
    closing = open_.unionByName(found).unionByName(common).repartition(n, "g").sortWithinPartitions("g", "kind")
    closed = closing.mapInArrow(_close(finish, shape(done)), done)
    names = [c.split()[0] for c in kind.split(", ")]
    settled_rows = state.filter("rest is not null and runs is null").select("rest", *names)
    return settled_rows.unionByName(closed).select("rest.*", *names)
