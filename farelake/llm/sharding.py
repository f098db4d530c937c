"""Contiguous shards of about equal bytes.

Method: rows are put in the order of ``doc_id`` by a range partitioning; each partition's total of rows and bytes gives
the offset at which it begins, so that a row's place in the whole table is the offset plus the sum inside its partition.
The sum of all sizes is cut at equal targets: a row belongs to the shard in which the middle of its bytes falls, so a
shard misses its target by at most half of the row at each of its two ends. All of it is DataFrame work.

A size is the UTF-8 bytes of the text plus ``ROW_BYTES``. The order is ``doc_id`` (nulls last), then size, checksum and the
place of the row in its input, so repeated ids and repeated rows are spread like any others, and one key with a third
of the table is no larger a task than the rest. Null and empty texts have ``ROW_BYTES``; a text larger than a target
leaves shards without rows; a very long one is never cut. An empty table gives no rows. Extra columns, whatever their
names, are carried in one struct. Equal texts under different ids may lie in different shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.llm import tables

ROW_BYTES = 8
ROWS_A_PART = 2_000_000
_ORDER = ["far", "at_id", "size", "text_crc32", "tie"]


def _measured(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.struct(*keep).alias("row"),
        F.col("doc_id").isNull().alias("far"),
        F.col("doc_id").cast("long").alias("at_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )


def _in_order(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The rows in range partitions of the order; the number of a partition is kept as data."""
    parts = max(tables.parts(docs.sparkSession), docs.count() // ROWS_A_PART + 1)
    ranges = _measured(docs, keep).repartitionByRange(parts, *_ORDER)
    return tables.written(ranges.withColumn("part", F.spark_partition_id()))


def _placed(rows: DataFrame, shards: int, keep: Sequence[str]) -> DataFrame:
    """Number of each row in the whole order, and its shard."""
    here = Window.partitionBy("part").orderBy(*_ORDER)
    inside = rows.select(
        *keep, "part", *_ORDER, F.sum("size").over(here).alias("upto"), F.row_number().over(here).alias("nth")
    )
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    middle = F.expr("CAST(2 * (bytes_before + upto) - size AS DECIMAL(38, 0))")
    whole = F.expr("CAST(2 * all_bytes AS DECIMAL(38, 0))")
    joined = inside.join(F.broadcast(offsets), "part").withColumn("middle", middle * F.lit(shards)).withColumn("whole", whole)
    return joined.select(
        *keep, "part", *_ORDER, F.expr("CAST(middle div whole AS INT)").alias("shard"),
        (F.col("rows_before") + F.col("nth") - 1).alias("number"),
    )


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for each row of ``docs(doc_id, text)``; slots count from 0 in a shard."""
    rows = _in_order(docs, ["doc_id"])
    placed = tables.written(_placed(rows, shards, ["row"]).select("row", "size", "text_crc32", "shard", "number"))
    tables.drop(rows)
    heads = placed.groupBy("shard").agg(F.min("number").alias("head"))  # as many rows as shards
    return placed.join(F.broadcast(heads), "shard").select(
        F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", "shard", (F.col("number") - F.col("head")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int) -> DataFrame:
    """Write all columns of ``docs`` under ``path/shard=<n>``, in order inside each file; returns rows and bytes by shard.

    The texts are shuffled once: sums run over the measures alone, and a row finds its shard by the heads of shards that
    lie in its partition.
    """
    rows = _in_order(docs, docs.columns)
    key = F.struct(*_ORDER)
    placed = tables.written(_placed(rows, shards, []))
    sizes = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
    by_part = placed.groupBy("part", "shard").agg(F.min(key).alias("head"))  # parts + shards rows at most
    heads = by_part.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("head", "shard"))).alias("heads"))
    started = F.filter("heads", lambda h: h["head"] <= key)
    with_shard = rows.join(F.broadcast(heads), "part").select("row", *_ORDER, F.element_at(started, -1)["shard"].alias("shard"), "part")
    lines = with_shard.repartition(tables.parts(docs.sparkSession), "part").sortWithinPartitions("shard", *_ORDER)
    taken = F.struct(*[F.col("row")[c].alias(c) for c in docs.columns]).alias("doc")
    lines.select("shard", taken).write.partitionBy("shard").parquet(path)
    report = tables.written(sizes)
    tables.drop(rows, placed)
    return report
