"""WARC archives written and read as tables of chunks.

Method: a record is a row for its header and, for its payload, rows of (record identifier, chunk number, text) of
bounded size. The payload stands in the archive as an HTTP message in chunked coding, and each chunk carries its record
and number as chunk extensions::

    WARC/1.1 ... Content-Length: n            header of the record
    HTTP/1.1 200 OK ... chunked               header of the message
    00010000;record=17-4;chunk=0;of=2         a chunk: size in hex, then its text
    00000c1f;record=17-4;chunk=1;of=2
    00000000;record=17-4;chunk=2;of=2         the end of the payload

Every row ends with CRLF, so Spark's text writer makes the archive files, each of whole records. The reader splits the files at ``;record=``
(the writer cuts chunks inside that string where a payload holds it), so Spark reads chunk by chunk, whatever the size
of a record. Payloads of one chunk are digested where they are read; the chunks of larger ones are dealt out by record
and streamed in order through an incremental SHA-1. No record is put together anywhere.

Of records with equal payloads of at least ``LEAST`` bytes that with the largest id is the response and the others
revisit it, without payload; equal means equal SHA-1 digest. Null html counts as empty. Smaller payloads are always
responses. A revisit refers to the record id of its response. A row with a null id revisits one with an id; repeated rows with the largest id are all responses. Line
ends in a URL are dropped.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import tables

LEAST = 1000
CHUNK_CHARS = 1 << 16
CRLF = "\r\n"
MARK = ";record="
_TAIL = len(CRLF) + 8  # what stands after the text of a chunk: a line end and the size of the next chunk


def with_roles(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Payload facts, the record id ``rid`` and, for revisits, the page and the record of the response. Record ids number the
    rows, so ``pages`` must be read alike each time, as a table is."""
    facts = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", "").alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
    ).select("*", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("digest"))
    facts = facts.withColumn("row", F.monotonically_increasing_id())
    rid = lambda page, row: F.concat_ws("-", F.coalesce(F.col(page).cast("string"), F.lit("null")), row)
    # Digests and ids only, combined before the shuffle; digests that occur once have no revisits.
    latest = (
        facts.filter(F.col("n") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("latest"), F.max_by("row", "page_id").alias("latest_row"), F.count("*").alias("rows"))
        .filter("rows > 1 and latest is not null")
        .drop("rows")
    )
    is_revisit = F.col("latest").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("latest")))
    return (
        facts.join(latest, "digest", "left")
        .withColumn("refers_to", F.when(is_revisit, F.col("latest")))
        .withColumn("refers_to_rid", F.when(is_revisit, rid("latest", "latest_row")))
        .withColumn("rid", rid("page_id", "row"))
        .drop("latest", "latest_row", "row")
    )


def _chunks(payload: Column, size: int) -> Column:
    """Pieces of at most ``size`` characters, none holding the mark."""
    pieces = F.when(payload.contains(MARK), F.split(payload, "(?<=;record)(?==)", -1)).otherwise(F.array(payload))
    cut = F.transform(
        pieces,
        lambda p: F.when(F.length(p) <= size, F.array(p)).otherwise(F.regexp_extract_all(p, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))),
    )
    return F.filter(F.flatten(cut), lambda p: p != "")


def rows_of_records(roles: DataFrame, date: str = "2024-01-01T00:00:00Z", chunk: int = CHUNK_CHARS) -> DataFrame:
    """The rows of the archive, in order, as ``value``."""
    records = roles.select(
        "*",
        F.when(F.col("refers_to").isNull(), _chunks(F.col("payload"), chunk)).otherwise(F.array().cast("array<string>")).alias("c"),
    )
    extension = lambda i: F.concat(F.lit(MARK), "rid", F.lit(";chunk="), i, F.lit(";of="), F.size("c"), F.lit(CRLF))
    size = lambda text: F.lpad(F.lower(F.hex(F.octet_length(text).cast("long"))), 8, "0")
    body = F.concat(
        F.transform("c", lambda text, i: F.concat(size(text), extension(i), text)),
        F.array(F.concat(F.lit("0" * 8), extension(F.size("c")), F.lit(2 * CRLF))),
    )
    message = F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Transfer-Encoding: chunked", ""]))
    records = records.withColumn("body", body)
    # Line ends of the rows; two line ends of the last row stand after the block.
    length = F.aggregate("body", F.lit(0).cast("long"), lambda n, text: n + F.octet_length(text) + 2)
    length = F.octet_length(message) + 2 + length - 4
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), "rid", F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.coalesce(
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), "refers_to_rid", F.lit(">"))),
                line("WARC-Payload-Length", F.col("n").cast("string")),
            ),
            F.lit(""),
        ),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(CRLF),
        message,
    )
    return records.select(F.explode(F.concat(F.array(header), F.col("body"))).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST, chunk: int = CHUNK_CHARS) -> None:
    """A file a task, whatever the session's limit of rows a file, which counts rows of the text source and would end files
    inside a record."""
    (
        rows_of_records(with_roles(pages, least), chunk=chunk)
        .write.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", 0)
        .text(path)
    )


def chunk_table(spark: SparkSession, path: str) -> DataFrame:
    """``(rid, chunk, of, text, header)``: a row for each chunk and each end of a payload, with the header that follows
    an end or opens a file."""
    raw = spark.read.option("lineSep", MARK).text(path)
    opens = F.col("value").startswith("WARC/1.1" + CRLF)
    head = F.when(~opens, F.substring_index("value", CRLF, 1))
    parts = F.split(head, ";")
    number = lambda i: F.substring_index(parts[i], "=", -1).cast("int")
    cut = raw.select("value", opens.alias("opens"), head.alias("head"), number(1).alias("chunk"), number(2).alias("of"), parts[0].alias("rid"))
    rest = F.expr(f"substr(value, length(head) + {1 + len(CRLF)})")
    text = F.expr(f"substr(value, length(head) + {1 + len(CRLF)}, length(value) - length(head) - {len(CRLF) + _TAIL})")
    is_end = F.col("chunk") == F.col("of")
    return cut.select(
        "rid", "chunk", "of",
        F.when(~is_end, text).alias("text"),
        F.when(F.col("opens"), F.col("value")).when(is_end, F.ltrim(rest, F.lit(CRLF))).alias("header"),
    )


def _digest_streams(chunks: DataFrame) -> DataFrame:
    """Bytes and SHA-1 of payloads from their chunks in order; the state of one digest is all that is held."""

    def run(batches):
        rid, digest, n = None, None, 0

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([rid]), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])], ["rid", "n", "digest"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                if (now := batch.column("rid")[i].as_py()) != rid:
                    if rid is not None:
                        yield done()
                    rid, digest, n = now, hashlib.sha1(), 0
                raw = batch.column("text")[i].as_py().encode()
                digest.update(raw)
                n += len(raw)
        if rid is not None:
            yield done()

    spark = chunks.sparkSession
    dealt = chunks.repartition(tables.parts(spark), "rid").sortWithinPartitions("rid", "chunk")
    return dealt.select("rid", "text").mapInArrow(run, "rid string, n long, digest string")


def _page(rid: Column) -> Column:
    """The page of a record id, which ends with the number of a row."""
    return F.regexp_extract(rid, "^(.*)-", 1).try_cast("bigint")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of each record."""
    table = chunk_table(spark, path)
    field = lambda name, pattern="(.*?)": F.regexp_extract("header", f"\\r\\n{name}: {pattern}\\r\\n", 1)
    kind = field("WARC-Type")
    none = F.lit(None).cast("string")
    about_header = F.when(
        F.col("header").startswith("WARC/1.1"),
        F.struct(
            field("WARC-Record-ID", "<urn:page:(.*?)>").alias("rid"),
            kind.alias("kind"),
            F.when(kind == "revisit", _page(field("WARC-Refers-To", "<urn:page:(.*?)>"))).alias("refers_to"),
            F.when(kind == "revisit", field("WARC-Payload-Length").cast("long")).alias("n"),
            F.when(kind == "revisit", field("WARC-Payload-Digest", "sha1:(.*?)")).alias("digest"),
            F.lit(False).alias("empty"),
        ),
    )
    single = (F.col("of") == 1) & (F.col("chunk") == 0)
    about_chunk = F.when(
        single | (F.col("of") == 0),
        F.struct(
            F.col("rid").alias("rid"), none.alias("kind"), F.lit(None).cast("long").alias("refers_to"),
            F.when(single, F.octet_length("text").cast("long")).alias("n"),
            F.when(single, F.sha1("text")).alias("digest"),
            (F.col("of") == 0).alias("empty"),
        ),
    )
    facts = table.select(F.explode(F.array_compact(F.array(about_header, about_chunk))).alias("f")).select("f.*")
    large = _digest_streams(table.filter("of > 1 and chunk < of")).select(
        "rid", none.alias("kind"), F.lit(None).cast("long").alias("refers_to"), "n", "digest", F.lit(False).alias("empty")
    )
    empty = F.lit(hashlib.sha1(b"").hexdigest())
    return (
        facts.unionByName(large)
        .groupBy("rid")
        .agg(*(F.max(c).alias(c) for c in ("kind", "refers_to", "n", "digest")))
        .select(
            _page(F.col("rid")).alias("page_id"),
            F.coalesce("n", F.lit(0)).cast("long").alias("payload_bytes"),
            F.coalesce("digest", empty).alias("payload_digest"),
            F.col("kind").alias("record_type"),
            "refers_to",
        )
    )
