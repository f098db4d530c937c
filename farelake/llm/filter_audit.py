"""How document filters interact, from counters kept by a stream.

Method: the files arrive as micro-batches. Which of the filters A to D a text fails depends on the text alone and is found
by column expressions. Filter E, a copy of a text with a smaller id, depends on what else has arrived: state keyed by the
digest of the text holds the least id so far and who holds it. A document with a larger id than the least fails E; when a
smaller id arrives, the earlier holder's mask is retracted from the counter of its part and counted again with E set.
What comes of a micro-batch are changes of counters by (part, mask, labels), added up over the micro-batches; after the
last one they are those of the whole table in whatever order its files came. The report for all orders of the filters is
computed from these counters.

Before rows meet the state they are counted by text, part, mask and labels with partial sums on the map side, so a text
with a third of all rows is a few rows. The state is a table of the shared folder with one row a text and kind of holder
(digest, id, counts; no texts). A micro-batch merges it with its own rows and writes the next generation: its cost grows
with the state, so micro-batches are taken few and large (``BATCHES``), and the work of a run is linear in its input. A
retried micro-batch reads the generation before it and writes its own anew; a restart goes on from the last one.

A null text is empty; a null source is the part ``''``; a null id is greater than all others. Rows with the same id and
text are copies of each other, not of a smaller id, so none fails E for the other. Several label rows of an id count as 1
where any is 1. An empty table gives no rows. Texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm import tables
from farelake.streaming import updates

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
BATCHES = 4
_LAST_ID = (1 << 63) - 1
_CLASS = ["part", "mask", "good", "toxic"]
_COUNT = "part string, mask int, good int, toxic int, n long"
_STATE = f"key binary, {_COUNT}, low long"


def measured(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Digest of the text, id, part, mask of filters A to D, and labels of each document."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "source", text.alias("text"), words.alias("words"))
    fails = [
        F.size("words") < 50,
        100 * F.size(F.array_distinct("words")) < 65 * F.size("words"),
        100 * F.regexp_count("text", F.lit("[A-Z]")) > 5 * F.length("text"),
        F.col("text").rlike("[#$%&*|]"),
    ]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    short = rows.select(
        F.unhex(F.sha2("text", 256)).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"), mask.cast("int").alias("mask"),
    )
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max((F.col(c) == 1).cast("int")).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    )
    known = tables.written(marked.filter((F.col("good") == 1) | (F.col("toxic") == 1)))
    return short.join(known, "doc_id", "left").select(
        "key", F.coalesce("doc_id", F.lit(_LAST_ID)).alias("id"), "part", "mask",
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


def merged(rows: DataFrame, state: DataFrame) -> DataFrame:
    """State rows and new rows by text and class, with the least id of the text over both.

    ``n`` documents of the class hold the row's own least id ``low``; ``more`` new ones have larger ids.
    """
    by_id = rows.groupBy("key", *_CLASS, "id").agg(F.count(F.lit(1)).alias("n"))
    total = by_id.groupBy("key", *_CLASS).agg(
        F.sum("n").alias("total"), F.min("id").alias("low"), F.min_by("n", "id").alias("n")
    )
    fresh = total.select("key", *_CLASS, "n", "low", (F.col("total") - F.col("n")).alias("more"), F.lit(True).alias("is_new"))
    known = state.select("*", F.lit(0).cast("long").alias("more"), F.lit(False).alias("is_new"))
    least = F.min("low").over(Window.partitionBy("key"))  # as many rows as kinds of holders
    return fresh.unionByName(known).select("*", (F.col("low") == least).alias("holds"))


def next_state(rows: DataFrame) -> DataFrame:
    """Who holds the least id of each text, from :func:`merged`."""
    return rows.filter("holds").groupBy("key", *_CLASS, "low").agg(F.sum("n").alias("n")).select("key", *_CLASS, "n", "low")


def changes(rows: DataFrame) -> DataFrame:
    """Changes of the counters, from :func:`merged`: new documents counted, earlier holders retracted."""
    n = F.col("n")
    first = F.when(F.col("is_new") & F.col("holds"), n).when(~F.col("is_new") & ~F.col("holds"), -n).otherwise(0)
    later = F.col("more") + F.when(~F.col("holds"), n).otherwise(0)
    both = F.array(
        F.struct(F.col("mask"), first.alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(COPY)).alias("mask"), later.alias("n"))
    )
    counted = rows.select("part", "good", "toxic", F.explode(both).alias("c")).select("part", "c.mask", "good", "toxic", "c.n")
    return counted.filter("n <> 0").groupBy(*_CLASS).agg(F.sum("n").alias("n"))


def count_masks(stream: DataFrame, labels: DataFrame, out: str) -> DataFrame:
    """Process all there is; documents by (part, mask, good, toxic). Run again, it goes on with files that came since."""
    spark = stream.sparkSession

    def write(rows: DataFrame, batch_id: int) -> None:
        state = spark.read.schema(_STATE).parquet(f"{out}/state-{batch_id - 1}")
        table = tables.written(merged(rows, state))
        next_state(table).write.mode("overwrite").parquet(f"{out}/state-{batch_id}")
        changes(table).write.mode("overwrite").parquet(f"{out}/counts/{updates.BATCH}={batch_id}")
        tables.drop(table)
        tables.drop_path(spark, f"{out}/state-{batch_id - 2}")

    if not tables.exists(spark, f"{out}/counts"):
        spark.createDataFrame([], _STATE).write.mode("overwrite").parquet(f"{out}/state--1")
        spark.createDataFrame([], _COUNT).write.parquet(f"{out}/counts/{updates.BATCH}=-1")
    updates.run_available(measured(stream, labels), f"{out}/checkpoint", write)
    found = spark.read.schema(f"{_COUNT}, {updates.BATCH} long").parquet(f"{out}/counts")
    return found.groupBy(*_CLASS).agg(F.sum("n").alias("n"))


def _steps(spark) -> DataFrame:
    rows = []
    for order in permutations(FILTERS):
        earlier = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            rows.append(("".join(order), step, bit, earlier))
            earlier |= bit
    return spark.createDataFrame(rows, "filter_order string, step int, bit int, earlier int")


def report(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``counts(part, mask, good, toxic, n)``."""
    spark = counts.sparkSession
    bits = [1 << i for i in range(len(FILTERS))]
    cases = [(b, e) for b in bits for e in range(1 << len(FILTERS)) if not b & e]
    case = F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(e).alias("earlier")) for b, e in cases]))
    rows = counts.select("*", case.alias("case")).select(*counts.columns, "case.*")
    mask, n = F.col("mask"), F.col("n")
    fails, gone = mask.bitwiseAND(F.col("bit")) != 0, mask.bitwiseAND(F.col("earlier")) != 0
    here = fails & ~gone
    orders = len(list(permutations(FILTERS)))
    # In one of every bit_count(mask) orders the filter is the first of those that the document fails.
    share = F.expr(f"n * {orders} div greatest(bit_count(mask), 1)")

    def total(when, value=n):
        return F.sum(F.when(when, value).otherwise(F.lit(0))).cast("long")

    sums = rows.groupBy("part", "bit", "earlier").agg(
        total(~fails & ~gone).alias("kept"), total(here).alias("removed"), total(fails & gone).alias("redundant"),
        total(mask == F.col("bit")).alias("unique_fails"), total(here, n * F.col("good")).alias("good_lost"),
        total(here, n * F.col("toxic")).alias("toxic_lost"), total(fails, share).alias("shapley"),
    )
    return sums.join(F.broadcast(_steps(spark)), ["bit", "earlier"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit(stream: DataFrame, labels: DataFrame, out: str) -> DataFrame:
    """The report over all files of ``stream(doc_id, text, source)`` with ``labels(doc_id, quality, toxic)``."""
    return report(count_masks(stream, labels, out))


def read_documents(spark, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The files of a table as a stream, by default in about ``BATCHES`` micro-batches."""
    batch = spark.read.parquet(path)
    files = files_per_batch or -(-len(batch.inputFiles()) // BATCHES) or 1
    reader = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", files)
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.parquet(f"{folder}/{{{name}}}")  # as a pattern the path may be a folder or a single file
