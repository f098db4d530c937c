"""Replay of an ordered change log (``seq, commit_ts, op, key, body…``; a DELETE has no body)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelake.operators.ordered import BLOCK, fill_and_lead, sequence_blocks

WRITES = ["INSERT", "UPDATE"]


def current_state(
    log: DataFrame,
    key: Sequence[str] | str,
    body: Sequence[str],
    when: Column | None = None,
    extra: Sequence[str] = ("commit_ts",),
) -> DataFrame:
    """Last state per key: body of the last INSERT/UPDATE, operation of the last event.

    One aggregate with map-side partials does both "latest row" lookups; ``when`` limits the events
    that count (for example to those before a cut). Events without a key or a position in the log have no state
    (they are quarantined).
    """
    keys = [key] if isinstance(key, str) else list(key)
    log = log.filter(F.col("seq").isNotNull()).dropna(subset=keys)
    seen = F.when(when, F.col("seq")) if when is not None else F.col("seq")
    wrote = F.when(F.col("op").isin(WRITES), seen)
    state = log.groupBy(*keys).agg(
        F.max_by(F.struct(*body), wrote).alias("_body"),
        F.max_by(F.struct("op", *extra, "seq"), seen).alias("_last"),
    )
    return state.select(
        *keys,
        *[F.col("_body")[b].alias(b) for b in body],
        F.col("_last.op").alias("ultima_operacion"),
        *[F.col("_last")[e].alias(e) for e in extra],
        F.col("_last.seq").alias("ultimo_seq"),
    )


def registry_status(op: Column) -> Column:
    """Null while no operation is known."""
    return F.when(op == "DELETE", "INACTIVO").when(op.isNotNull(), "ACTIVO")


def versions(log: DataFrame, key: str, body: Sequence[str], blocks: int | None = None) -> DataFrame:
    """Type-2 history in ``seq`` order: one row per event, body filled forward, validity interval.

    Adds ``estado``, ``valid_from``, ``valid_to`` (null while current) and ``es_version_vigente``.
    Events without a key or a position in the log have no place in a history (they are quarantined).
    """
    rows = log.filter(F.col(key).isNotNull() & F.col("seq").isNotNull())
    rows = rows.select(key, "seq", "commit_ts", "op", *body)
    filled = fill_and_lead(
        sequence_blocks(rows, "seq", blocks),
        [key],
        "seq",
        fill=list(body),
        lead={"valid_to": "commit_ts", "_next_seq": "seq"},
    )
    return filled.select(
        key,
        *body,
        registry_status(F.col("op")).alias("estado"),
        F.col("op").alias("operacion_origen"),
        "seq",
        F.col("commit_ts").alias("valid_from"),
        "valid_to",
        F.col("_next_seq").isNull().alias("es_version_vigente"),
    )


def as_of(
    events: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    take: Sequence[str],
    block_seconds: int = 3600,
    group_rows: int = 5_000_000,
) -> DataFrame:
    """For each event, the version valid at its time: ``valid_from <= ts < valid_to``.

    A join on key and interval would pair every event of a hot key with all its versions. Instead
    events and version starts are merged on one time line and the last start is carried forward, so
    the work is linear in both inputs. The line is cut into time blocks; a block of a hot key with
    more than ``group_rows`` events is dealt out over several groups, each with all its version
    starts. What was valid when a block began comes from one summary row per (key, block). Versions
    with an empty interval (commit times that run against ``seq``) are never valid.
    """
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    block = F.floor(F.timestamp_diff("SECOND", epoch, F.col("_t")) / block_seconds).alias(BLOCK)
    real = history.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    version = F.struct("valid_from", "valid_to", "seq", *take).alias("_version")
    starts = real.select(F.col(key), F.col("valid_from").alias("_t"), version).select("*", block)
    placed = F.col(key).isNotNull() & F.col(ts).isNotNull()
    adrift = events.filter(~placed)  # no key or no time: no version, and no common group either
    points = events.filter(placed).select(
        F.col(key), F.col(ts).alias("_t"), F.struct(*events.columns).alias("_event")
    )
    points = points.select("*", block)

    slot = [key, BLOCK]
    groups = F.greatest(F.ceil(F.col("_n") / group_rows), F.lit(1)).cast("long").alias("_groups")
    busy = points.groupBy(*slot).agg(F.count(F.lit(1)).alias("_n")).select(*slot, groups)
    hot = busy.filter(F.col("_groups") > 1)  # at most one row per ``group_rows`` events
    part = F.pmod(F.xxhash64("_event"), F.coalesce("_groups", F.lit(1))).cast("long")
    last_part = F.coalesce("_groups", F.lit(1)) - 1
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), last_part.cast("long")))
    no_event = F.lit(None).cast(points.schema["_event"].dataType)
    no_version = F.lit(None).cast(starts.schema["_version"].dataType)
    columns = [*slot, "_part", "_t", "_event", "_version"]
    line = (
        points.join(hot, slot, "left")
        .select("*", part.alias("_part"), no_version.alias("_version"))
        .select(*columns)
        .unionByName(
            starts.join(hot, slot, "left")
            .select("*", every_part.alias("_part"), no_event.alias("_event"))
            .select(*columns)
        )
    )
    # at the same instant version starts come first, in log order
    order = ["_t", F.col("_event").isNotNull(), F.col("_version.seq")]
    upto = Window.partitionBy(*slot, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = line.withColumn("_here", F.last("_version", ignorenulls=True).over(upto))

    ends = starts.groupBy(*slot).agg(
        F.max_by("_version", F.struct("_t", F.col("_version.seq"))).alias("_end")
    )
    earlier = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        busy.join(ends, slot, "full_outer")
        .select(*slot, "_groups", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
        .filter(F.col("_groups").isNotNull())
        .select(*slot, "_before", every_part.alias("_part"))
    )
    found = local.filter(F.col("_event").isNotNull()).join(carried, [*slot, "_part"])
    found = found.select("_event", F.coalesce("_here", "_before").alias("_version"))
    until = F.col("_version.valid_to")
    valid = until.isNull() | (F.col(f"_event.{ts}") < until)
    matched = found.select(
        "_event.*",
        *[F.when(valid, F.col(f"_version.{c}")).alias(c) for c in take],
        F.when(valid, F.col("_version.seq")).alias("version_seq"),
    )
    return matched.unionByName(adrift, allowMissingColumns=True)
