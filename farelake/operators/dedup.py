"""Repeated reads of one business key: keep the first, account for every other one.

Which keys repeat is found first, by a hash aggregate over the key columns alone; it is written down, so its size is known
to the joins that follow. Reads of other keys pass untouched, with only the columns the caller asks for. Reads without a
key (a null in any key column) are malformed, not repeats of each other: they pass, and the quarantine rules see them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.operators.ordered import BLOCK, expand_copies, range_blocks, running_sums
from farelake.session import materialise


def ordering(df: DataFrame, keys: Sequence[str], order: Sequence[str]):
    """Nulls last; every column takes part, so the first row is unique up to copies."""
    rest = [c for c in df.columns if c not in keys]
    cols = [*order, *[c for c in rest if c not in order]]
    return F.struct(*[F.struct(F.col(c).isNull().alias("null"), F.col(c).alias("value")).alias(c) for c in cols])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that were read more than once."""
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    counted = df.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_reads"))
    return materialise(counted.filter(F.col("_reads") > 1).select(*keys))


def best_rows(part: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by one aggregate, for rows whose keys are known to repeat."""
    best = part.groupBy(*keys).agg(F.min(ordering(part, keys, order)).alias("_r"))
    rest = [c for c in part.columns if c not in keys]
    return best.select(*keys, *[F.col(f"_r.{c}.value").alias(c) for c in rest]).select(*part.columns)


def other_rows(part: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows that :func:`best_rows` leaves out, copies included."""
    spread = part.groupBy(*part.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_r", ordering(part, keys, order))
    firsts = part.groupBy(*keys).agg(F.min(ordering(part, keys, order)).alias("_first"))
    rest = F.col("_n") - F.col("_r").eqNullSafe(F.col("_first")).cast("long")
    later = spread.join(firsts, list(keys)).select(*part.columns, rest.alias("_n")).filter(F.col("_n") > 0)
    return expand_copies(later, "_n", "_i").select(*part.columns)


def first_reads(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` (nulls last), remaining columns breaking ties."""
    again = repeated_keys(df, keys)
    once = df.join(again, list(keys), "left_anti").select(*df.columns)
    return once.unionByName(best_rows(df.join(again, list(keys), "left_semi").select(*df.columns), keys, order))


def repeat_reads(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows that :func:`first_reads` leaves out, copies included."""
    return other_rows(df.join(repeated_keys(df, keys), list(keys), "left_semi").select(*df.columns), keys, order)


def content_ids(df: DataFrame, out: str) -> DataFrame:
    """A stable id for rows without a key: whole digest of the content plus ordinal among equal rows.

    Unlike a global row number it does not renumber when other rows arrive, and needs no sort.
    """
    cols = df.columns
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols])
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    rows = expand_copies(counted, "_n", "_i")
    return rows.select(
        F.concat(F.sha2(text, 256), F.lit("-"), F.col("_i").cast("string")).alias(out),
        *cols,
    )


def ranked_ids(df: DataFrame, order: Sequence, out: str) -> DataFrame:
    """Global row number over every column (parity with a total sort), for tables of any size.

    Equal rows are counted first, so a hot group of copies is one row while it is being ranked.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sums(range_blocks(counted, order), [], order, {"_upto": "_n"}).drop(BLOCK)
    spread = ranked.withColumn("_base", F.col("_upto") - F.col("_n")).drop("_upto")
    rows = expand_copies(spread, "_n", "_i")
    return rows.select((F.col("_base") + F.col("_i")).cast("long").alias(out), *cols)
