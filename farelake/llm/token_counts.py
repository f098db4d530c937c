"""Token counts by dynamic programming over prefixes.

Method: the encoding of a prefix ends with a token ``t``, and what stands before ``t`` is the encoding of a shorter
prefix. Of all tokens that end there exactly one fits: the one that, put after the last token of the shorter prefix,
stays apart from it when both are encoded together. So one pass over a word gives the last token and the count at
every prefix, and each later question (how many tokens has this prefix, where must a text be cut to keep a budget) is
a lookup. The splitter's words are found for a whole piece of texts at once; each distinct word is worked through once
while it stays in the worker's table, whose size is fixed.

Null and empty texts have 0 tokens. Special strings count as one token. Rows are independent.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm import kernels as K
from farelake.llm.tree_bpe import Vocabulary, vocabulary

LIMIT = 512
SHORT = 48
_SIGN, _LETTER, _DIGIT, _SPACE = 0, 1, 2, 3
_WORD_TABLE, _PAIR_TABLE = 1 << 20, 1 << 20


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    out = np.zeros(0x110000, dtype=np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _DIGIT), (r"\p{White_Space}+", _SPACE)):
        for m in regex.finditer(pattern, points):
            out[ord(points[m.start()]) : ord(points[m.end() - 1]) + 1] = kind
    return out


def word_starts(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """True where a word of the splitter begins. ``heads``: first characters of independent texts, sorted, distinct."""
    n = len(points)
    kind = _classes()[points]
    start = np.ones(n, dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    start[heads] = True
    head = np.zeros(n + 1, dtype=bool)
    head[heads] = True
    head[n] = True
    # The last of some white space before a character goes to that character, or stands alone.
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~head[1:n])
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    # Contractions, where a word begins with the apostrophe.
    quote = np.flatnonzero((points == 0x27) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~head[quote + 1]]
    one = points[quote + 1]
    short = np.isin(one, [ord(c) for c in "stmd"])
    start[quote[short] + 1] = False
    after = quote[short] + 2
    start[after[after < n]] = True
    rest = quote[~short]
    rest = rest[rest + 2 < n]
    rest = rest[~head[rest + 2]]
    one, two = points[rest + 1], points[rest + 2]
    both = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    start[rest[both] + 1] = False
    after = rest[both] + 3
    start[after[after < n]] = True
    return start


class _Table:
    """A table of fixed size; a newer key takes the place of an older one."""

    def __init__(self, size: int):
        self.mask = np.uint64(size - 1)
        self.keys = np.zeros(size, dtype=np.uint64)
        self.values = np.zeros(size, dtype=np.int32)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = K.mix(keys) & self.mask
        return self.keys[slot] == keys, self.values[slot]

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        slot = K.mix(keys) & self.mask
        slot, first = np.unique(slot, return_index=True)
        self.keys[slot], self.values[slot] = keys[first], values[first]


class PrefixCounts:
    """Counts tokens of texts for one vocabulary."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        data = np.frombuffer(b"".join(vocab.ranks), dtype=np.uint8)
        lengths = np.fromiter(map(len, vocab.ranks), dtype=np.int64, count=len(vocab.ranks))
        ends = np.cumsum(lengths)
        hashes = K.span_hashes(K.prefix_sums(data), ends - lengths, ends)
        order = np.argsort(hashes)
        self.tokens = K.Lookup(hashes[order])
        self.ids = np.fromiter(vocab.ranks.values(), dtype=np.int64, count=len(vocab.ranks))[order]
        self.longest = int(lengths.max())
        self.words, self.pairs = _Table(_WORD_TABLE), _Table(_PAIR_TABLE)

    # Pairs of tokens

    def _apart(self, left: int, right: int) -> bool:
        table = self.vocab.bytes
        return self.vocab.short._encode_single_piece(table[left] + table[right]) == [left, right]

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each right token can follow the left one."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64) | np.uint64(1 << 63)
        known, values = self.pairs.get(keys)
        out = values.astype(bool)
        if not known.all():
            new, back = np.unique(keys[~known], return_inverse=True)
            found = np.array(
                [self._apart(int(k >> 32) & 0x7FFFFFFF, int(k) & 0xFFFFFFFF) for k in new.tolist()], dtype=np.int32
            )
            self.pairs.put(new, found)
            out[~known] = found[back].astype(bool)
        return out

    # Words

    def prefix_table(self, sums: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Counts at every prefix (row: word, column: bytes) of words of at most ``SHORT`` bytes."""
        n, width = len(starts), int(lengths.max(initial=0))
        last = np.full((n, width + 1), -1, dtype=np.int32)
        count = np.zeros((n, width + 1), dtype=np.int32)
        order = np.argsort(-lengths, kind="stable")
        alive = np.searchsorted(-lengths[order], -np.arange(width + 1), side="right")
        for end in range(1, width + 1):
            open_ = order[: alive[end]]
            for size in range(min(end, self.longest), 0, -1):
                if not len(open_):
                    break
                stop = starts[open_] + end
                at, index = self.tokens.find(K.span_hashes(sums, stop - size, stop))
                if not len(at):
                    continue
                word, token = open_[at], self.ids[index]
                before = last[word, end - size]
                good = np.ones(len(word), dtype=bool) if end == size else before >= 0
                if end != size:
                    check = np.flatnonzero(good)
                    good[check] = self._fits(before[check], token[check])
                word, token = word[good], token[good]
                last[word, end] = token
                count[word, end] = count[word, end - size] + 1
                keep = np.ones(len(open_), dtype=bool)
                keep[at[good]] = False
                open_ = open_[keep]
        return count

    def long_prefixes(self, word: bytes) -> list[int]:
        """Counts at every prefix of one word of any length."""
        ranks, last, count = self.vocab.ranks, [-1], [0]
        for end in range(1, len(word) + 1):
            for size in range(min(end, self.longest), 0, -1):
                token = ranks.get(word[end - size : end])
                if token is not None and (end == size or last[end - size] >= 0 and self._apart(last[end - size], token)):
                    last.append(token)
                    count.append(count[end - size] + 1)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return count

    def _word_counts(self, data, sums, starts, ends) -> np.ndarray:
        """Token counts of words; distinct ones are worked through once."""
        keys = K.span_hashes(sums, starts, ends) | np.uint64(1)
        known, out = self.words.get(keys)
        miss = np.flatnonzero(~known)
        if len(miss):
            new, first, back = np.unique(keys[miss], return_index=True, return_inverse=True)
            first = miss[first]
            length = ends[first] - starts[first]
            value = np.zeros(len(new), dtype=np.int32)
            short = np.flatnonzero(length <= SHORT)
            for at in range(0, len(short), 1 << 14):
                some = short[at : at + (1 << 14)]
                table = self.prefix_table(sums, starts[first[some]], length[some])
                value[some] = table[np.arange(len(some)), length[some]]
            for i in np.flatnonzero(length > SHORT):
                value[i] = self.long_prefixes(data[starts[first[i]] : ends[first[i]]].tobytes())[-1]
            self.words.put(new, value)
            out[miss] = value[back]
        return out

    # Texts

    def _specials(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts and ends of special strings; none crosses a text."""
        raw, found, at = data.tobytes(), [], 0
        if not any(s.encode() in raw for s in self.vocab.special):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            at = begin
            for segment in self.vocab.segments(raw[begin:end].decode()):
                size = len(segment.encode())
                if segment in self.vocab.special:
                    found.append((at, at + size))
                at += size
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]

    def words_of(self, data: np.ndarray, offsets: np.ndarray):
        """Byte starts and ends of the splitter's words, and which of them are special strings."""
        if not len(data):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        byte_at = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        s_from, s_to = self._specials(data, offsets)
        heads = np.unique(np.concatenate([offsets[:-1], s_from, s_to]))
        heads = np.searchsorted(byte_at, heads[heads < len(data)])
        start = word_starts(points, heads)
        starts = byte_at[start]
        special = np.zeros(len(starts), dtype=bool)
        if len(s_from):
            inside = np.searchsorted(s_from, starts, side="right") - 1
            within = (inside >= 0) & (starts < s_to[inside])
            special[np.searchsorted(starts, s_from)] = True
            keep = ~within | special
            starts, special = starts[keep], special[keep]
        return starts, np.append(starts[1:], len(data)), special

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The token count of each text."""
        starts, ends, special = self.words_of(data, offsets)
        if not len(starts):
            return np.zeros(len(offsets) - 1, dtype=np.int64)
        value = self._word_counts(data, K.prefix_sums(data), starts, ends)
        value[special] = 1
        total = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
        word = np.searchsorted(starts, offsets)
        return total[word[1:]] - total[word[:-1]]

    def at_every_prefix(self, text: str) -> np.ndarray:
        """Token counts of ``text[:i]`` for each ``i``; no prefix is encoded."""
        out, base = [0], 0
        segments = self.vocab.segments(text)
        for ordinary, special in zip(segments[::2], [*segments[1::2], ""]):
            # Cut short, a special string is ordinary text that may join what stands before it.
            own = self._ordinary_prefixes(ordinary + special[:-1])
            out += [base + n for n in own]
            base += own[len(ordinary) - 1] if ordinary else 0
            if special:
                base += 1
                out.append(base)
        return np.array(out, dtype=np.int64)

    def _ordinary_prefixes(self, text: str) -> list[int]:
        """Token counts at the end of each character of a text whose special strings count as ordinary."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        if not len(data):
            return []
        byte_at = np.flatnonzero((data & 0xC0) != 0x80)
        starts = byte_at[word_starts(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), np.array([0]))]
        raw, out, base, gap = data.tobytes(), [], 0, ""
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(data)]):
            word = raw[begin:end].decode()
            steps = self.long_prefixes(word.encode())
            at = np.cumsum([len(c.encode()) for c in word]).tolist()
            own = [base + steps[i] for i in at]
            if word[0] == "'" and len(word) > 1 and word[1] in "stmdrvl":
                # Cut before it is whole, a contraction is an apostrophe and letters.
                for i in range(1, len(word) - 1):
                    own[i] = base + 1 + self.long_prefixes(word[1 : i + 1].encode())[-1]
            if gap and word[0].isspace():
                # At the end of a prefix, white space is one word with the space that else goes to the next word.
                before = base - self.long_prefixes(gap.encode())[-1]
                own[0] = before + self.long_prefixes((gap + word[0]).encode())[-1]
            out += own
            base += steps[-1]
            gap = word if word.isspace() else ""
        return out

    def longest_prefix(self, text: str, budget: int) -> int:
        """The length in characters of the longest prefix of at most ``budget`` tokens."""
        return int(np.flatnonzero(self.at_every_prefix(text) <= budget)[-1])


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounts:
    """One counter for each worker and vocabulary file."""
    return PrefixCounts(vocabulary(path))


def count_tokens(docs: DataFrame, vocab_path: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs(doc_id, text)``."""

    def run(batches):
        counts = counter(vocab_path)
        for batch in batches:
            for first, end, data, offsets in K.text_pieces(batch):
                n = counts.counts(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, end - first),
                        pa.array(np.diff(offsets), pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
