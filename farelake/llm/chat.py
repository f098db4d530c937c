"""Chat formatting by incremental black-box rendering.

Method: a template is any function from turns to text. It is rendered on successively longer prefixes of the turns;
where the next output begins with the one before, what it adds is the span of the new turn. A template whose output
does not begin with the one before rewrites history, and is refused. Only spans, never the inside of the template, are
used to find roles, texts and the loss mask.

The work is dealt out by ranges of (conversation, turn, role, text), so one conversation may fill many partitions. In a
partition each run of ``BLOCK`` turns is rendered after the ``CONTEXT`` real turns before it, or all of them if there are
fewer; this bounds the prefixes whatever the length of the conversation. What a block renders for the later half of its
context must equal what the block before gave for the same turns; a template whose spans reach back further is refused where
this differs. The first block of a partition waits for the last turns of the partitions before and is rendered in a second
stage, where it must come out the same after twice as many turns.
``check_template`` renders prefixes of an invented conversation as long as the longest one (up to ``PROBE_TURNS``), which
refuses templates that drop or shorten turns beyond some length. Only conversations that touch the edge of a partition or
fill more than one block go on to a last stage, which streams their blocks in order through the digests.

Turns are ordered by turn (nulls first), then role, then text; null texts and roles count as empty. Repeated rows are
turns of their own. Rows with a null conversation id form one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm import tables

BLOCK = CONTEXT = 32
PROBE_TURNS = 1_000_000
_NAMES = {"user": "User", "assistant": "Assistant", "system": "System"}
_CONTROL = re.compile(r"\\|#{3,}|</turn>")
_ESCAPED = re.compile(r"\\(.)", re.S)
_PLAIN = {"h": "#", "l": "<", "\\": "\\"}


def escape(text: str) -> str:
    """Backslashes, runs of three or more number signs and turn ends, so that no control string is left."""
    return _CONTROL.sub(lambda m: m[0].replace("\\", "\\\\").replace("#", "\\h").replace("<", "\\l"), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


def _title(role: str) -> str:
    return _NAMES.get(role) or "=" + escape(role).replace(":", "\\:")


def turn_template(turns: list[tuple[str, str]]) -> str:
    """``### Role: text </turn>`` and a line end for each turn; unknown roles stand escaped as they are."""
    return "".join(f"### {_title(role)}: {escape(text)} </turn>\n" for role, text in turns)


_SPAN = re.compile(r"### (=)?((?:\\.|[^\\:])*): (.*) </turn>\n", re.S)
_PLAIN[":"] = ":"


def parse_turn(span: str) -> tuple[str, str, int, int]:
    """Role and text of a rendered turn, and where the escaped text stands in it."""
    m = _SPAN.fullmatch(span)
    role = unescape(m[2]) if m[1] else m[2].lower()
    return role, unescape(m[3]), m.start(3), m.end(3)


class RewritesHistory(ValueError):
    """A longer conversation does not begin with the output of a shorter one."""


def spans(render: Callable, turns: list[tuple[str, str]], before: list[tuple[str, str]] = ()) -> list[str]:
    """The text each turn adds to the output, found from outputs of successive prefixes."""
    seen, out = render(list(before)) if before else "", []
    for i in range(1, len(turns) + 1):
        now = render([*before, *turns[:i]])
        if not now.startswith(seen):
            raise RewritesHistory(f"turn {i} changes what was rendered before it")
        out.append(now[len(seen) :])
        seen = now
    return out


PROBES = [[("system", "a"), ("user", "b"), ("assistant", "c"), ("user", "d"), ("assistant", "e"), ("user", "")],
          [("user", "x"), ("user", "y"), ("assistant", "</turn> ### User:"), ("assistant", "z"), ("", "q")]]


def check_template(render: Callable, longest: int = 0, context: int = CONTEXT) -> None:
    """Refuses templates that rewrite history in the probes or in a conversation of ``longest`` turns, or whose spans
    depend on more than the ``context`` turns before."""
    for probe in PROBES:
        long = [("user", "p"), *(probe[i % len(probe)] for i in range(context + 1))]
        whole = spans(render, long)
        spans(render, probe)
        if spans(render, long[-1:], long[-1 - context : -1])[0] != whole[-1]:
            raise RewritesHistory("the span of a turn depends on earlier turns")
    turns = [(("user", "assistant")[i % 2], str(i)) for i in range(min(longest, PROBE_TURNS))]
    whole, n = render(turns) if turns else "", 1
    while n < len(turns):
        if not whole.startswith(render(turns[:n])):
            raise RewritesHistory(f"{len(turns)} turns change what was rendered for the first {n}")
        n *= 2


def _after(render: Callable, turns: list, before: list, known: list) -> list[str]:
    """Spans of ``turns`` after the real turns ``before``, of which those with half the context before them must have the
    spans ``known`` (null: not known)."""
    found = spans(render, [*before, *turns])
    for i in range(max(1, len(before) // 2), len(before)):
        if known[i] is not None and known[i] != found[i]:
            raise RewritesHistory(f"the span of a turn depends on turns more than {i} before it")
    return found[len(before) :]


def _ordered(conversations: DataFrame) -> DataFrame:
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = ["conv_id", "turn", "role", F.substring("text", 1, 64)]
    n = tables.parts(conversations.sparkSession)
    return turns.repartitionByRange(n, *keys).sortWithinPartitions("conv_id", "turn", "role", "text")


_DONE = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_FACTS = f"conv_id long, seq long, {_DONE}, turns_text binary, loss_text binary"
_BLOCKS = f"{_FACTS}, kind string, roles array<string>, texts array<string>"
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[dict], columns: str) -> pa.RecordBatch:
    schema = pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in columns.split(", "))])
    return pa.RecordBatch.from_pylist(rows, schema)


def _facts(found: list[str], parse: Callable, open_: bool) -> dict:
    """What is read back from the spans of a block: digests, or the bytes for them if other blocks follow or precede."""
    told, loss = [], []
    for span in found:
        role, text, _, _ = parse(span)
        told.append(f"{role}\n{text}\n")
        if role == "assistant":
            loss.append(text)
    all_, own = "".join(told).encode(), "".join(loss).encode()
    row = dict(n_turns=len(found), loss_chars=sum(map(len, loss)), formatted_chars=sum(map(len, found)))
    if open_:
        return row | dict(turns_text=all_, loss_text=own)
    return row | dict(turns_sha256=hashlib.sha256(all_).hexdigest(), loss_sha256=hashlib.sha256(own).hexdigest())


def format_conversations(
    conversations: DataFrame, render: Callable = turn_template, parse: Callable = parse_turn, block: int = BLOCK,
    context: int = CONTEXT,
) -> DataFrame:
    """One row of facts for each conversation, read back from the rendered spans."""
    longest = conversations.groupBy("conv_id").count().agg(F.max("count").alias("n")).first().n or 0
    check_template(render, longest, context)

    def stage(batches):
        rows, conv, seq, held, recent, known, at_edge, began = [], None, 0, [], [], [], True, False

        def emit(open_):
            """The block held; the first of the partition goes out as it is."""
            nonlocal recent, known
            row = dict(conv_id=conv, seq=seq, kind="open" if open_ else "done")
            if at_edge and seq == 0:
                found = [None] * len(held)
                row |= dict(kind="head", roles=[r for r, _ in held], texts=[t for _, t in held])
            else:
                found = _after(render, held, recent[-context:], known)
                row |= _facts(found, parse, open_)
            rows.append(row)
            recent, known = [*recent, *held][-2 * context :], [*known, *found][-context:]

        for batch in batches:
            for now, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if began and now != conv:
                    emit(at_edge or seq > 0)
                    seq, held, recent, known, at_edge = 0, [], [], [], False
                elif len(held) == block:
                    emit(True)
                    seq, held = seq + 1, []
                began, conv = True, now
                held.append((role, text))
            if rows:
                yield _batch(rows, _BLOCKS)
                rows.clear()
        if held:
            emit(True)
            tail = dict(roles=[r for r, _ in recent], texts=[t for _, t in recent], n_turns=len(recent))
            yield _batch([*rows, dict(conv_id=conv, seq=seq, kind="tail", **tail)], _BLOCKS)

    blocks = _ordered(conversations).select("conv_id", "role", "text").mapInArrow(stage, _BLOCKS)
    blocks = tables.written(blocks.withColumn("part", F.spark_partition_id().cast("long")))
    names = [x.split()[0] for x in _DONE.split(", ")]
    used = ["conv_id", "part", "seq", "n_turns", "loss_chars", "formatted_chars", "turns_text", "loss_text"]
    opened = blocks.filter("kind = 'open'").select(used).unionByName(_heads(blocks, render, parse, context).select(used))
    return blocks.filter("kind = 'done'").select("conv_id", *names).unionByName(_streamed(opened))


def _heads(blocks: DataFrame, render: Callable, parse: Callable, context: int) -> DataFrame:
    """The first block of each partition, rendered after the last turns of the partitions before if it goes on from there."""
    edges = blocks.filter("kind in ('head', 'tail')").select("part", "kind", "conv_id", "n_turns").collect()  # two a partition
    first = {r.part: r.conv_id for r in edges if r.kind == "head"}
    last = {r.part: (r.conv_id, r.n_turns) for r in edges if r.kind == "tail"}
    order, follows = sorted(first), []
    for i, part in enumerate(order):
        have, conv = 0, first[part]
        for prev in reversed(order[:i]):
            if last[prev][0] != conv or have >= 2 * context:
                break
            follows.append((part, prev))
            have += last[prev][1]
            if first[prev] != conv:
                break
    follows = blocks.sparkSession.createDataFrame(follows, "part long, prev long")
    tails = blocks.filter("kind = 'tail'").select(F.col("part").alias("prev"), F.arrays_zip("roles", "texts").alias("turns"))
    # at most 2 * context turns of each of at most 2 * context partitions
    found = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("prev", "turns"))), lambda t: t["turns"]))
    before = follows.join(tails, "prev").groupBy("part").agg(found.alias("before"))
    heads = blocks.filter("kind = 'head'").select("conv_id", "part", "seq", "roles", "texts").join(before, "part", "left")

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                turns = list(zip(r["roles"], r["texts"]))
                before = [(t["roles"], t["texts"]) for t in r["before"] or []][-2 * context :]
                found = _after(render, turns, before[-context:], [None] * context)
                if len(before) > context and _after(render, turns, before, [None] * len(before)) != found:
                    raise RewritesHistory(f"the span of a turn depends on turns more than {context} before it")
                rows.append(dict(conv_id=r["conv_id"], seq=r["seq"], part=r["part"], **_facts(found, parse, True)))
            yield _batch(rows, f"{_FACTS}, part long")

    return heads.mapInArrow(run, f"{_FACTS}, part long")


def _streamed(blocks: DataFrame) -> DataFrame:
    """Conversations in several blocks: their digests, block after block."""

    def run(batches):
        conv, state = None, None

        def done():
            n, told, chars, loss, formatted = state
            row = dict(conv_id=conv, n_turns=n, turns_sha256=told.hexdigest(), loss_chars=chars)
            return _batch([row | dict(loss_sha256=loss.hexdigest(), formatted_chars=formatted)], f"conv_id long, {_DONE}")

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != conv:
                    if state is not None:
                        yield done()
                    conv, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += row["n_turns"]
                state[1].update(row["turns_text"])
                state[2] += row["loss_chars"]
                state[3].update(row["loss_text"])
                state[4] += row["formatted_chars"]
        if state is not None:
            yield done()

    n = tables.parts(blocks.sparkSession)
    dealt = blocks.repartition(n, "conv_id").sortWithinPartitions("conv_id", "part", "seq")
    used = ["conv_id", "n_turns", "loss_chars", "formatted_chars", "turns_text", "loss_text"]
    return dealt.select(*used).mapInArrow(run, f"conv_id long, {_DONE}")
