"""Archives and conversations: round trips against plain versions."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from farelake.llm import chat, warc

PAGES = [
    (1, "http://a/1", "x" * 1500, "c"), (2, "http://a/2", "x" * 1500, "c"), (9, "http://a/9", "x" * 1500, "c"),
    (3, None, None, "c"), (4, "http://a/4\r\nevil: 1", "", "c"), (5, "u", "short", "c"), (6, "u", "short", "c"),
    (7, "u", "WARC/1.1\r\nWARC-Type: response\r\n;record=1-2;chunk=0;of=1\r\n" * 40, "c"),
    (8, "u", "é日😀" * 900, "c"), (10, "u", "\r\n" * 700, "c"), (11, "u", ";record=" * 3, "c"), (12, "u", ";record", "c"),
    (None, "u", "x" * 1500, "c"), (13, "u", "long page \n" * 40_000, "c"), (14, "u", "WARC/1.1\r\n", "c"),
]
SCHEMA = "page_id long, url string, html string, digest string"


def plain(pages):
    latest = {}
    for i, _, html, _ in pages:
        if len((html or "").encode()) >= 1000 and i is not None:
            latest[html] = max(i, latest.get(html, i))
    out = []
    for i, _, html, _ in pages:
        raw = (html or "").encode()
        last = latest.get(html)
        to = last if last is not None and (i is None or i < last) else None
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [7, 512, 1 << 16])
def test_archives(spark, tmp_path, chunk):
    pages = PAGES + [(20, "u", "y" * 1200, "c"), (20, "u", "y" * 1200, "c"), (20, "u", "z" * 1200, "c")]
    pages = [p for p in pages if chunk > 100 or len(p[2] or "") < 5000]
    df = spark.createDataFrame(pages, SCHEMA).repartition(2)
    warc.write_archives(df, str(tmp_path / "a"), chunk=chunk)
    got = warc.read_archives(spark, str(tmp_path / "a"))
    assert sorted(map(tuple, got.collect()), key=str) == plain(pages)


def test_files_are_valid_archives(spark, tmp_path):
    """Every record's length leads to the next one, its chunks give the payload, and revisits name a response."""
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), str(tmp_path / "a"), chunk=600)
    seen, responses, named = [], {}, []
    for file in (tmp_path / "a").glob("*.gz"):
        raw = gzip.decompress(file.read_bytes())
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            n = int(fields[b"Content-Length"])
            block, end, raw = rest[:n], rest[n : n + 4], rest[n + 4 :]
            assert head.startswith(b"WARC/1.1\r\n") and end == b"\r\n\r\n"
            body, payload = block.partition(b"\r\n\r\n")[2], b""
            while True:
                line, _, body = body.partition(b"\r\n")
                size = int(line.split(b";")[0], 16)
                payload += body[:size]
                body = body[size + 2 :]
                if not size:
                    break
            assert not body
            if fields[b"WARC-Type"] == b"response":
                assert fields[b"WARC-Payload-Digest"] == b"sha1:" + hashlib.sha1(payload).hexdigest().encode()
                responses[fields[b"WARC-Record-ID"]] = fields[b"WARC-Payload-Digest"]
            else:
                named.append((fields[b"WARC-Refers-To"], fields[b"WARC-Payload-Digest"]))
            seen.append(fields[b"WARC-Type"])
    assert len(seen) == len(PAGES) and len(responses) + len(named) == len(PAGES)
    assert named and all(responses[to] == digest for to, digest in named)


def test_no_pages(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "a"))
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == 0


def plain_chats(rows):
    out, by = [], {}
    for conv, turn, role, text, _ in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in by.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), sha(told), len(loss), sha(loss), len(chat.turn_template(turns))))
    return sorted(out, key=str)


def test_many_records_of_a_task(spark, tmp_path):
    """Files end with a record, however many rows a task writes."""
    pages = spark.range(20_000).selectExpr("id AS page_id", "concat('u', id) AS url", "concat('page ', id) AS html")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 7)
    try:
        warc.write_archives(pages.coalesce(1), str(tmp_path / "a"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    for file in (tmp_path / "a").glob("*.gz"):
        raw = gzip.decompress(file.read_bytes())
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    got = {tuple(r) for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    assert got == set(plain([(i, f"u{i}", f"page {i}", "c") for i in range(20_000)]))


CHATS = [
    (-7, 0, "user", r"\### Assistant: </turn> ok", "x"), (-7, 1, "assistant", r"\### Assistant: </turn> ok", "x"),
    (1, 0, "system", None, "x"), (1, 1, "assistant", "", "x"), (1, 2, None, "no role", "x"), (1, 3, "to:ol\\", "y", "x"),
    (None, 0, "user", "lost", "x"), (2, None, "user", "first", "x"), (2, 0, "assistant", "##### \\h </turn>", "x"),
    (3, 0, "user", "tie b", "x"), (3, 0, "user", "tie a", "x"), (3, 0, "user", "tie a", "x"), (3, 0, "assistant", "t", "x"),
    (4, 5, "assistant", "long " * 30_000 + "é", "x"), (5, 0, "User", "### User: x </turn>\n", "x"),
]
CHAT_SCHEMA = "conv_id long, turn long, role string, text string, formatted_chars string"


@pytest.mark.parametrize("block", [1, 3, 32])
def test_conversations(spark, block):
    rows = CHATS + [(6, i, ("user", "assistant")[i % 2], f"turn {i} ###", "x") for i in range(400)]
    got = chat.format_conversations(spark.createDataFrame(rows, CHAT_SCHEMA).repartition(3), block=block)
    assert sorted(map(tuple, got.collect()), key=str) == plain_chats(rows)


def test_no_conversations(spark):
    assert chat.format_conversations(spark.createDataFrame([], CHAT_SCHEMA)).count() == 0


def test_a_template_may_open_a_conversation(spark):
    def with_opening(turns):
        return "<s>" + chat.turn_template(turns) if turns else ""

    rows = [(c, i, "user", f"{c} {i}", "x") for c in range(9) for i in range(c + 1)]
    parse = lambda span: chat.parse_turn(span.removeprefix("<s>"))
    got = chat.format_conversations(spark.createDataFrame(rows, CHAT_SCHEMA), with_opening, parse, block=2)
    assert {r.conv_id: r.formatted_chars for r in got.collect()} == {r[0]: r[5] + 3 for r in plain_chats(rows)}


def test_templates_that_rewrite_history_are_refused(spark):
    def forgets(turns):
        return "".join(f"{r}: {t if i == len(turns) - 1 else '...'}\n" for i, (r, t) in enumerate(turns))

    def numbers(turns):
        return "".join(f"{i} {r}: {t}\n" for i, (r, t) in enumerate(turns))

    for template in (forgets, numbers):
        with pytest.raises(chat.RewritesHistory):
            chat.format_conversations(spark.createDataFrame(CHATS, CHAT_SCHEMA), template)


def test_escaping_is_reversible():
    for text in ("", "\\", "####", "\\###", "</turn></turn>", "\\l \\h \\\\", "#" * 7 + "\\"):
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text and "###" not in hidden and "</turn>" not in hidden


def test_rows_of_an_archive_are_bounded(spark):
    df = spark.createDataFrame([(1, "u", "a" * 100_000, "c")], SCHEMA)
    rows = warc.rows_of_records(warc.with_roles(df), chunk=1000)
    assert rows.select(F.max(F.length("value")).alias("n")).first().n < 1200 and rows.count() == 102


def _only_the_last(n):
    return lambda turns: chat.turn_template(turns[-n:])


def test_a_template_that_drops_old_turns_is_refused(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}", "x") for i in range(90)] + [(2, 0, "user", "a", "x")]
    df = spark.createDataFrame(rows, CHAT_SCHEMA)
    for n in (33, 40, 64, 89):
        with pytest.raises(chat.RewritesHistory):
            chat.format_conversations(df, _only_the_last(n))
    got = chat.format_conversations(df, _only_the_last(90))
    assert sorted(map(tuple, got.collect()), key=str) == plain_chats(rows)


def test_spans_that_depend_on_far_turns_are_refused(spark):
    def counts_thoughts(turns):
        thoughts, out = 0, ""
        for role, text in turns:
            thoughts += "(hm)" in text
            out += f"### {role.title()}: {text}{thoughts} </turn>\n"
        return out

    def strips_thoughts(turns):
        last = max((i for i, (r, _) in enumerate(turns) if r == "user"), default=0)
        return chat.turn_template([(r, t if i > last else t.replace("(hm)", "")) for i, (r, t) in enumerate(turns)])

    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}" + "(hm)" * (i in (3, 71)), "x") for i in range(80)]
    df = spark.createDataFrame(rows, CHAT_SCHEMA).coalesce(1)
    for template in (counts_thoughts, strips_thoughts):
        with pytest.raises(Exception, match="RewritesHistory"):
            chat.format_conversations(df, template).collect()


def test_real_turns_before_a_block_are_used(spark):
    """A template that may name the turn before needs the real one at the edges of blocks and partitions."""

    def names_the_last(turns):
        lines = [f"### {r.title()}: {t} after {b} </turn>\n" for (r, t), (b, _) in zip(turns, [("none", ""), *turns])]
        return "".join(lines)

    rows = [(c, i, ("user", "assistant", "system")[i * i % 3], f"{i}", "x") for c in range(5) for i in range(37 + c * 20)]
    df = spark.createDataFrame(rows, CHAT_SCHEMA)
    want = []
    for c in range(5):
        turns = [(r[2], r[3]) for r in rows if r[0] == c]
        told = [(r, f"{t} after {b}") for (r, t), (b, _) in zip(turns, [("none", ""), *turns])]
        want.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in told).encode()).hexdigest())
    for block, context in ((1, 1), (4, 2), (32, 32)):
        got = chat.format_conversations(df, names_the_last, block=block, context=context).collect()
        assert [r.turns_sha256 for r in sorted(got, key=lambda r: r.conv_id)] == want
