"""Vectorised byte work on Arrow string columns.

The operators of this subpackage run inside ``mapInArrow`` tasks. Texts are taken as one byte array with document
offsets, in pieces of a few megabytes, so that the temporary arrays (eight bytes for each byte of text) stay small
whatever the size of an Arrow batch. A null text counts as empty.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
SMALL_PIECE_BYTES = 1 << 18  # where the arrays over a piece take tens of bytes for each of its bytes
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# Bytes of words after lower-casing: digits, a-z and everything beyond ASCII.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i < n, kept for the life of the worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        least = SMALL_PIECE_BYTES if n <= SMALL_PIECE_BYTES + 1 else PIECE_BYTES
        have = np.full(max(n, least + 1), base & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        have[0] = 1
        _powers[base] = np.multiply.accumulate(have)
    return _powers[base][:n]


def _find_trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return lambda _: None


_malloc_trim = _find_trim()


def trim() -> None:
    """Give freed memory back to the machine; workers live on between tasks, and each keeps its largest size else."""
    pa.default_memory_pool().release_unused()
    _malloc_trim(0)


def text_pieces(batch: pa.RecordBatch, name: str = "text", limit: int = PIECE_BYTES):
    """Yields ``(first row, end row, bytes, offsets)`` with at most ``limit`` bytes, or one longer text."""
    column = batch.column(batch.schema.get_field_index(name))
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end
    if offsets[-1] - offsets[0] > max(limit, PIECE_BYTES):
        trim()


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; no run crosses a document."""
    if not len(mask):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before = np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    heads = offsets[:-1]
    before[heads[heads < len(mask)]] = False
    after = np.empty_like(mask)
    after[-1], after[:-1] = False, mask[1:]
    tails = offsets[1:]
    after[tails[tails > 0] - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def word_spans(lowered: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each document the number of its first word (one more entry than documents)."""
    starts, ends = runs(_IN_WORD[lowered], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which :func:`span_hashes` takes the hash of any span."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(_MULTIPLIER, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes that depend on the bytes of each span only."""
    raw = (sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each ``n`` consecutive word hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(_MULTIPLIER) + words[i : i + count])
    return out


def hash_words(text: str) -> np.ndarray:
    """The word hashes of one text."""
    data = lower_ascii(np.frombuffer((text or "").encode(), dtype=np.uint8))
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    return span_hashes(prefix_sums(data), starts, ends)


class Lookup:
    """A sorted table of 64-bit values that is searched for many values at once."""

    def __init__(self, table: np.ndarray):
        self.table = np.asarray(table, dtype=np.uint64)
        bits = max(16, len(self.table).bit_length() + 4)
        self.low = np.uint64((1 << bits) - 1)
        # A bitmap over the low bits rejects nearly all values before the binary search.
        self.seen = np.zeros(1 << bits, dtype=bool)
        self.seen[self.table & self.low] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the values that are in the table, and their indices there."""
        maybe = np.flatnonzero(self.seen[values & self.low])
        if not len(maybe):
            return maybe, maybe
        index = np.searchsorted(self.table, values[maybe])
        index[index == len(self.table)] = 0
        found = self.table[index] == values[maybe]
        return maybe[found], index[found]
