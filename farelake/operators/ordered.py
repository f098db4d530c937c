"""Ordered computations (numbering, running sums, fill-forward, next value) without giant groups.

A plain window puts all rows of one key, or of the whole table, into one task. Here rows carry a
*block*: an order-preserving piece of the key's sequence. Windows run inside (keys, block); one
summary row per (keys, block) carries the state across blocks and is joined back on the same
columns, so the rows themselves are shuffled once. The summary holds at most one row per key and
block, which is what bounds its own window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.session import materialise

BLOCK = "_block"


def range_blocks(df: DataFrame, order: Sequence[Column | str], parts: int | None = None) -> DataFrame:
    """Blocks of about equal size whatever the distribution of the order columns.

    Rows are range-partitioned by the whole order and the partition number is written as data, so
    later jobs and retried tasks all see the same blocks.
    """
    if parts is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.repartitionByRange(parts, *order).withColumn(BLOCK, F.spark_partition_id()))


def hash_prefix_blocks(df: DataFrame, hex_col: str, digits: int = 4) -> DataFrame:
    """Blocks for rows ordered by a uniform hex digest: its first digits are already balanced."""
    return df.withColumn(BLOCK, F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("long"))


def sequence_blocks(df: DataFrame, seq: str, parts: int | None = None) -> DataFrame:
    """At most ``parts`` blocks of a running number, bounded by its measured quantiles.

    Dense or sparse, a block holds about the same share of the rows, so the summary of one key has at most ``parts``
    rows, even if the key owns the whole sequence. Only the bounds reach the driver.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    bounds = df.agg(F.percentile_approx(seq, shares, max(10_000, 20 * parts)).alias("b")).first().b if shares else []
    inner = F.array(*[F.lit(b) for b in sorted(set(bounds or []))])
    below = F.size(F.filter(inner, lambda b: b < F.col(seq))) if bounds else F.lit(0)
    return df.withColumn(BLOCK, below.cast("long"))


def _local(keys, order):
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)


def _across(keys):
    return (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(BLOCK)


def _join_summary(df: DataFrame, summary: DataFrame, keys, null_keys: bool = False) -> DataFrame:
    # Without keys the summary is one row per block, as many as there are partitions.
    if not null_keys:
        return df.join(summary if keys else F.broadcast(summary), [*keys, BLOCK])
    on = [*keys, BLOCK]
    right = summary.select(*[F.col(c).alias(f"_s_{c}") for c in on], *[c for c in summary.columns if c not in on])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in on])
    return df.join(right, same).drop(*[f"_s_{c}" for c in on])


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], sums: dict[str, str], null_keys: bool = False
) -> DataFrame:
    """Add ``out`` = sum of ``col`` over all rows up to and including this one, for each out: col.

    The order must be total inside a block, or ties must carry equal meaning for the caller. With ``null_keys`` a null
    is a key like any other, at the price of a shuffle; without it keys are never null.
    """
    upto = _local(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, BLOCK).agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    offsets = totals.select(
        *keys, BLOCK, *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_o_{o}") for o in sums]
    )
    local = df.select("*", *[F.sum(c).over(upto).alias(f"_l_{o}") for o, c in sums.items()])
    joined = _join_summary(local, offsets, keys, null_keys)
    return joined.select(
        *[F.col(c) for c in df.columns], *[(F.col(f"_l_{o}") + F.col(f"_o_{o}")).alias(o) for o in sums]
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "rn", null_keys: bool = False
) -> DataFrame:
    """1, 2, 3 … in ``order`` inside ``keys``; ``df`` must carry blocks."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    return running_sums(one, keys, order, {out: "_one"}, null_keys).drop("_one")


def number_all(df: DataFrame, order: Sequence[Column | str], out: str, parts: int | None = None) -> DataFrame:
    """Global row numbers over any number of rows, in a total order.

    Range partitions sorted in place hold consecutive runs of the order, so a row's number is its
    position in the partition plus the sizes of the partitions before it: one shuffle of the rows.
    """
    if parts is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # partition number in the upper bits, position inside it in the lower 33
    placed = materialise(runs.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn(BLOCK, F.shiftright("_at", 33)).withColumn(
        "_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # at most one count per partition comes back to the driver
    sizes = {r[BLOCK]: r["n"] for r in placed.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts = [0, *accumulate(sizes.get(b, 0) for b in range(max(sizes, default=0)))]
    start = F.get(F.array(*[F.lit(s).cast("long") for s in starts]), F.col(BLOCK).cast("int"))
    return placed.select(*df.columns, (start + F.col("_at") + 1).alias(out))


def fill_and_lead(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    fill: Sequence[str] = (),
    lead: dict[str, str] | None = None,
) -> DataFrame:
    """Replace nulls of ``fill`` columns by the last earlier value; add next row's value per ``lead``.

    ``order`` is unique inside a key; neither it nor the keys are ever null. ``lead`` maps output name to source column.
    """
    lead = lead or {}
    w = _local(keys, [order])
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    summary = df.groupBy(*keys, BLOCK).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}") for c in fill],
        *[F.min_by(c, order).alias(f"_first_{o}") for o, c in lead.items()],
    )
    across = _across(keys)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys,
        BLOCK,
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_in_{c}") for c in fill],
        *[F.lead(f"_first_{o}").over(across).alias(f"_out_{o}") for o in lead],
    )
    rest = [c for c in df.columns if c not in fill]
    local = df.select(
        *rest,
        *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in fill],
        *([F.lead(order).over(w).isNull().alias("_tail")] if lead else []),
        *[F.lead(c).over(w).alias(f"_next_{o}") for o, c in lead.items()],
    )
    joined = _join_summary(local, carried, keys)
    return joined.select(
        *[F.coalesce(c, f"_in_{c}").alias(c) if c in fill else F.col(c) for c in df.columns],
        *[F.when(F.col("_tail"), F.col(f"_out_{o}")).otherwise(F.col(f"_next_{o}")).alias(o) for o in lead],
    )


CHUNK = 100_000


def expand_copies(df: DataFrame, copies: str, ordinal: str, chunk: int = CHUNK) -> DataFrame:
    """Turn a row standing for ``copies`` equal rows back into that many, numbered from 1.

    Rows are cut into chunks of copies, which are dealt out by size before they are expanded, so no task emits more
    than ``chunk`` copies of a row per chunk it was dealt.
    """
    cols = [c for c in df.columns if c != copies]
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / chunk)))
    first = F.col("_c") * chunk + 1
    last = F.least((F.col("_c") + 1) * chunk, F.col(copies))
    dealt = df.select("*", chunks.alias("_c")).hint("rebalance")
    return dealt.select(*cols, F.explode(F.sequence(first, last)).alias(ordinal))
