"""Byte-pair encoding of long texts by tree concatenation, and decoding.

Method: a text is halved, without regard to words, until the leaves are short. Leaves are encoded independently.
Two neighbours are joined by encoding anew a window of tokens around the join; the window grows until its first and
last tokens agree with what both sides had. What lies outside the window is kept. Texts beyond ``ROW_CHARS`` are cut
into rows that different tasks encode, and their results are joined by the same rule.

Why the result is exact. The vocabulary's splitter cuts a text where a letter, digit or sign is followed by a
character of another class, whatever stands further off (only an apostrophe before a letter is no such place). If a
window shares such a cut with a side, the tokens beyond the cut can't depend on the other side. Inside one run of
letters, digits or signs there is no cut, but there a sequence of tokens is the encoding exactly if each two
neighbours are the encoding of their concatenation; so it is enough there that the outermost tokens of the window
agree. Otherwise the window grows, at last to both sides whole. Special strings are taken out beforehand.

Null and empty texts have no tokens. Rows are independent: repeated rows and null or repeated ids pass through.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.kernels import trim

LEAF_CHARS = 2048
ROW_CHARS = 1 << 16
WINDOW = 8
ENCODED = "doc_id long, ids binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# The splitter of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Two neighbours between which the splitter always cuts.
_CUT = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=[^\s\p{L}\p{N}])(?=[\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=\p{L})")
_RUN = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones as they are, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens by id, special tokens, and the encoder of short texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        self.special = {x["content"]: x["id"] for x in model.get("added_tokens", [])}
        self.ranks = {
            bytes(letters[c] for c in token): i
            for token, i in model["model"]["vocab"].items()
            if token not in self.special
        }
        self.bytes = {i: token for token, i in self.ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.size = max(self.bytes) + 1
        self.names = [str(i) for i in range(self.size)]
        self.short = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self._specials = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )

    def segments(self, text: str) -> list[str]:
        """Ordinary texts and special strings in turn."""
        if self._specials is None or not any(s in text for s in self.special):
            return [text]
        return self._specials.split(text)

    def decode(self, ids) -> bytes:
        table = self.bytes
        return b"".join([table[i] for i in ids])


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each worker and file."""
    return Vocabulary(path)


def _whole(left: bytes, right: bytes) -> bool:
    """Neither side begins or ends inside a character."""
    return not left or not right or (right[0] & 0xC0) != 0x80


def _cuts(text: str) -> set[int]:
    return {len(text[: m.start()].encode()) for m in _CUT.finditer(text) if 0 < m.start() < len(text)}


def join(vocab: Vocabulary, left: list[int], right: list[int], window: int = WINDOW) -> list[int]:
    """The encoding of the concatenated texts of two encodings."""
    if not left or not right:
        return left or right
    table, encode = vocab.bytes, vocab.short.encode_ordinary
    while True:
        a, b = max(0, len(left) - window), min(len(right), window)
        while a > 0 and (table[left[a]][0] & 0xC0) == 0x80:
            a -= 1
        while b < len(right) and (table[right[b]][0] & 0xC0) == 0x80:
            b += 1
        text = vocab.decode(left[a:] + right[:b]).decode()
        anew = encode(text)
        if a == 0 and b == len(right):
            return anew
        head = _common(left[a:], anew)
        tail = _common(right[:b][::-1], anew[::-1])
        inside = bool(_RUN.fullmatch(text))
        cuts = None if inside else _cuts(text)
        if (a == 0 or _agrees(vocab, anew[:head], 0, inside, cuts)) and (
            b == len(right) or _agrees(vocab, anew[len(anew) - tail :], len(text.encode()), inside, cuts, back=True)
        ):
            return left[:a] + anew + right[b:]
        window *= 2


def _common(x: list[int], y: list[int]) -> int:
    n = 0
    for i, j in zip(x, y):
        if i != j:
            break
        n += 1
    return n


def _agrees(vocab, shared, edge, inside, cuts, back=False) -> bool:
    """Whether the tokens shared with one side hold a place at which the sides can't influence each other."""
    if not shared:
        return False
    if inside:
        return True
    at = edge
    for token in reversed(shared) if back else shared:
        at += -len(vocab.bytes[token]) if back else len(vocab.bytes[token])
        if at in cuts:
            return True
    return False


def tree(join_two: Callable, nodes: list) -> list:
    """Join neighbours pair by pair, level by level."""
    while len(nodes) > 1:
        pairs = [join_two(x, y) for x, y in zip(nodes[::2], nodes[1::2])]
        nodes = pairs + (nodes[-1:] if len(nodes) % 2 else [])
    return nodes[0] if nodes else []


def _leaves(text: str, size: int) -> list[str]:
    """Halves of halves, none longer than ``size``."""
    if len(text) <= size:
        return [text]
    middle = len(text) // 2
    return _leaves(text[:middle], size) + _leaves(text[middle:], size)


def encode_plain(vocab: Vocabulary, text: str, leaf: int = LEAF_CHARS) -> list[int]:
    """The encoding of a text without special strings."""
    nodes = [vocab.short.encode_ordinary(x) for x in _leaves(text, leaf)]
    return tree(lambda x, y: join(vocab, x, y), nodes)


def encode(vocab: Vocabulary, text: str | None, leaf: int = LEAF_CHARS) -> list[int]:
    """The encoding of any text; special strings become their tokens."""
    out: list[int] = []
    for segment in vocab.segments(text or ""):
        if segment in vocab.special:
            out.append(vocab.special[segment])
        elif segment:
            out += encode_plain(vocab, segment, leaf)
    return out


def _row_pieces(vocab: Vocabulary, text: str, size: int) -> list[tuple[str, bool]]:
    """Pieces of at most ``size`` characters; true where the piece may merge with the one before."""
    out = []
    for segment in vocab.segments(text):
        if segment in vocab.special:
            out.append((segment, False))
        elif segment:
            at = [(segment[i : i + size], i > 0) for i in range(0, len(segment), size)]
            out += at
    return out


def encode_rows(
    docs: DataFrame, vocab_path: str, row_chars: int = ROW_CHARS, leaf: int = LEAF_CHARS, finish: Callable = iter, kind: str = ENCODED
) -> DataFrame:
    """``(doc_id, ids)`` for every row of ``docs(doc_id, text)``; ids is a binary of 32-bit integers.

    Rows up to ``row_chars`` characters are encoded where they are read. Longer ones are cut into rows that are dealt
    out, encoded, and joined for each text. ``finish`` takes the encoded batches in the Python worker that made them, and
    ``kind`` names what it makes of them: as a ``mapInArrow`` of its own it would hold a second worker for each task.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    here = docs.filter(F.length("text") <= row_chars).mapInArrow(_after(_encoder(vocab_path, leaf), finish), kind)
    long = docs.filter(F.length("text") > row_chars).withColumn("row_id", F.monotonically_increasing_id())
    pieces = (
        long.mapInArrow(_cutter(vocab_path, row_chars), "row_id long, doc_id long, piece int, merges boolean, text string")
        .repartition(F.xxhash64("row_id", "piece"))
        .mapInArrow(_piece_encoder(vocab_path, leaf), "row_id long, doc_id long, piece int, merges boolean, ids binary")
    )
    joined = (
        pieces.groupBy("row_id", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("piece", "merges", "ids"))).alias("pieces"))
        .select("doc_id", F.col("pieces.merges").alias("merges"), F.col("pieces.ids").alias("ids"))
        .mapInArrow(_after(_joiner(vocab_path), finish), kind)
    )
    return here.unionByName(joined)


def _after(step: Callable, finish: Callable) -> Callable:
    return lambda batches: finish(step(batches))


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype=np.int32).tobytes()


def _batches(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
    trim()


def _encoder(path, leaf):
    def run(batches):
        vocab = vocabulary(path)
        for whole in batches:
            for batch in _batches(whole):
                ids = [_packed(encode(vocab, t, leaf)) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def _cutter(path, size):
    def run(batches):
        vocab = vocabulary(path)
        for whole in batches:
            for batch in _batches(whole, 1):
                row, doc, text = (batch.column(c)[0].as_py() for c in ("row_id", "doc_id", "text"))
                found = _row_pieces(vocab, text, size)
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * n, pa.int64()), pa.array([doc] * n, pa.int64()), pa.array(range(n), pa.int32()),
                        pa.array([m for _, m in found], pa.bool_()), pa.array([t for t, _ in found], pa.string()),
                    ],
                    ["row_id", "doc_id", "piece", "merges", "text"],
                )

    return run


def _piece_encoder(path, leaf):
    def run(batches):
        vocab = vocabulary(path)
        for whole in batches:
            for batch in _batches(whole, 16):
                ids = [_packed(encode(vocab, t, leaf)) for t in batch.column("text").to_pylist()]
                kept = [batch.column(c) for c in ("row_id", "doc_id", "piece", "merges")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(ids, pa.binary())], ["row_id", "doc_id", "piece", "merges", "ids"]
                )

    return run


def _joiner(path):
    def run(batches):
        vocab = vocabulary(path)
        for whole in batches:
            for batch in _batches(whole, 4):
                out = []
                for merges, ids in zip(batch.column("merges").to_pylist(), batch.column("ids").to_pylist()):
                    groups: list[list[list[int]]] = []
                    for merge, node in zip(merges, ids):
                        node = np.frombuffer(node, dtype=np.int32).tolist()
                        if merge:
                            groups[-1].append(node)
                        else:
                            groups.append([node])
                    done = [tree(lambda x, y: join(vocab, x, y), g) for g in groups]
                    out.append(_packed([i for g in done for i in g]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "ids"])

    return run


def _text(vocab: Vocabulary, ids: list[int]) -> str:
    """The text of an id sequence; bytes that are no UTF-8 become replacement characters."""
    return vocab.decode(ids).decode(errors="replace")


def decode_rows(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """``(doc_id, text)``: the text of each id sequence."""

    def run(batches):
        vocab = vocabulary(vocab_path)
        for whole in batches:
            for batch in _batches(whole):
                ids = [np.frombuffer(x, dtype=np.int32).tolist() for x in batch.column("ids").to_pylist()]
                texts = pa.array([_text(vocab, x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _digester(path):
    def run(batches):
        vocab = vocabulary(path)
        names = vocab.names
        for whole in batches:
            for batch in _batches(whole):
                counts, hashes, texts = [], [], []
                for packed in batch.column("ids").to_pylist():
                    ids = np.frombuffer(packed, dtype=np.int32).tolist()
                    counts.append(len(ids))
                    hashes.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                    texts.append(hashlib.sha256(_text(vocab, ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(texts)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def digests(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """Counts and digests of the ids of :func:`encode_rows` and of the text decoded from them."""
    return encoded.select("doc_id", "ids").mapInArrow(_digester(vocab_path), DIGESTS)


def encoded_digests(docs: DataFrame, vocab_path: str, row_chars: int = ROW_CHARS, leaf: int = LEAF_CHARS) -> DataFrame:
    """:func:`encode_rows` and :func:`digests` with one Python worker a task."""
    return encode_rows(docs, vocab_path, row_chars, leaf, _digester(vocab_path), DIGESTS)
