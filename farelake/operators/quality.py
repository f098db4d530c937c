"""Rules with reasons, key checks, reconciliation and table comparison."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A reason to reject a row. A ``fallback`` rule counts only when no other reason applies."""

    reason: str
    broken: Column
    detail: Column | str
    fallback: bool = False


REASONS = "_motivos"


def _entry(rule: Rule) -> Column:
    detail = F.lit(rule.detail) if isinstance(rule.detail, str) else rule.detail
    return F.struct(F.lit(rule.reason).alias("motivo"), detail.alias("detalle"))


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Attach the list of broken rules to each row, all rules evaluated in one pass."""
    kind = "array<struct<motivo:string,detalle:string>>"

    def listed(group):
        if not group:
            return F.array().cast(kind)
        return F.array_compact(F.array(*[F.when(r.broken, _entry(r)) for r in group])).cast(kind)

    main = listed([r for r in rules if not r.fallback])
    rest = listed([r for r in rules if r.fallback])
    return df.withColumn(REASONS, main).withColumn(
        REASONS, F.when(F.size(REASONS) == 0, rest).otherwise(F.col(REASONS))
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(REASONS) == 0).drop(REASONS)


def rejected(checked: DataFrame, source: str, row_id: Column, event_ts: Column) -> DataFrame:
    """One quarantine row per broken rule."""
    return checked.select(
        F.lit(source).alias("fuente"),
        row_id.cast("string").alias("id_registro"),
        F.explode(REASONS).alias("_m"),
        event_ts.alias("fecha_hora_evento"),
    ).select("fuente", "id_registro", "_m.motivo", "_m.detalle", "fecha_hora_evento")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---- declarative key checks --------------------------------------------------------


def unique_failures(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once; null keys are not counted."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    repeated = df.filter(present).groupBy(*key).count().filter(F.col("count") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("failures"))


def check_report(tables: dict[str, DataFrame], checks: dict[str, dict[str, list]]) -> DataFrame:
    """``(tabla, prueba, columna, fallas)``; nothing is raised, the report is the result.

    ``checks`` maps a table to ``{"unique": [cols or [cols]], "not_null": [cols]}``. All not-null
    checks of a table share one scan.
    """
    parts = []
    for name, wanted in checks.items():
        df = tables[name]
        for key in wanted.get("unique", []):
            cols = [key] if isinstance(key, str) else list(key)
            parts.append(
                unique_failures(df, cols).select(
                    F.lit(name).alias("tabla"),
                    F.lit("unique").alias("prueba"),
                    F.lit(",".join(cols)).alias("columna"),
                    F.col("failures").alias("fallas"),
                )
            )
        nulls = wanted.get("not_null", [])
        if nulls:
            counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in nulls])
            parts.append(
                counted.select(
                    F.explode(
                        F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("fallas")) for c in nulls])
                    ).alias("_c")
                ).select(
                    F.lit(name).alias("tabla"),
                    F.lit("not_null").alias("prueba"),
                    F.col("_c.columna"),
                    F.col("_c.fallas"),
                )
            )
    return union_all(parts)


# ---- counts --------------------------------------------------------------------------


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
            for name, df in tables.items()
        ]
    )


def reconcile(expected: DataFrame, loaded: DataFrame, on: str = "tabla") -> DataFrame:
    """Expected against loaded row counts; a source that was not loaded shows a null count."""
    return expected.join(loaded.withColumnRenamed("filas", "filas_cargadas"), on, "left").select(
        on,
        F.col("filas_esperadas").cast("long").alias("filas_esperadas"),
        "filas_cargadas",
        (F.col("filas_cargadas") - F.col("filas_esperadas")).alias("diferencia"),
    )


WORDS = ["w0", "w1", "w2", "w3"]
_WORD = 1 << 32


def _row_words(df: DataFrame) -> list[Column]:
    """Four numbers of 32 bits a row: the md5 of all columns in the order of their names, each with its length."""
    texts = [F.col(c).cast("string") for c in sorted(df.columns)]
    plain = F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])
    digest = F.md5(plain)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)").alias(w) for i, w in enumerate(WORDS)]


def _added(rows: DataFrame, count: Column, by: Sequence[str]) -> DataFrame:
    sums = [F.pmod(F.coalesce(F.sum(w), F.lit(0)), F.lit(_WORD)).cast("decimal(20,0)").alias(w) for w in WORDS]
    return rows.groupBy(*by).agg(F.coalesce(count, F.lit(0)).cast("long").alias("filas"), *sums)


def part_fingerprints(df: DataFrame, name: str, part: str) -> DataFrame:
    """Rows and content digest of each value of ``part`` (a day, say). Digests of parts add up to that of the table."""
    rows = df.select(F.col(part).cast("string").alias("parte"), *_row_words(df))
    return _added(rows, F.count(F.lit(1)), ["parte"]).select(F.lit(name).alias("tabla"), "parte", "filas", *WORDS)


def refreshed_parts(stored: DataFrame, df: DataFrame, name: str, part: str, changed: Sequence) -> DataFrame:
    """Stored digests with those of the ``changed`` parts taken anew; of ``df`` only these parts are read."""
    changed = list(changed)
    rest = stored.filter(~F.coalesce(F.col("parte").isin([str(c) for c in changed]), F.lit(False)))
    return rest.unionByName(part_fingerprints(df.filter(F.col(part).isin(changed)), name, part))


def merged_fingerprint(parts: DataFrame) -> DataFrame:
    """One row a table from the digests of its parts: rows, and the sums of the four words as 32 hex digits."""
    whole = _added(parts, F.sum("filas"), ["tabla"])
    digits = [F.lpad(F.lower(F.hex(F.col(w).cast("long"))), 8, "0") for w in WORDS]
    return whole.select("tabla", "filas", F.concat(*digits).alias("huella"))


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Row count and an order-independent digest of 128 bits of a table's content, which any SQL engine can repeat."""
    whole = _added(df.select(*_row_words(df)), F.count(F.lit(1)), [])
    return merged_fingerprint(whole.select(F.lit(name).alias("tabla"), "filas", *WORDS))


# ---- comparison -----------------------------------------------------------------------


def _differs(name: str, dtype: str, tol: float) -> Column:
    a, b = F.col(f"a.{name}"), F.col(f"b.{name}")
    if dtype in ("double", "float"):
        return ~((a.isNull() & b.isNull()) | F.coalesce(F.abs(a - b) < tol, F.lit(False)))
    return ~a.cast("string").eqNullSafe(b.cast("string"))


def table_diff(left: DataFrame, right: DataFrame, key: Sequence[str], tol: float = 1e-9) -> DataFrame:
    """One row: sizes, keys on one side only, and the number of differing values per column."""
    values = [f for f in left.schema if f.name not in key]
    a = left.withColumn("_in_a", F.lit(True)).alias("a")
    b = right.withColumn("_in_b", F.lit(True)).alias("b")
    cond = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key])
    both = a.join(b, cond, "full_outer")
    paired = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    counts = both.agg(
        F.count("_in_a").alias("filas_a"),
        F.count("_in_b").alias("filas_b"),
        F.count_if(F.col("_in_b").isNull()).alias("solo_a"),
        F.count_if(F.col("_in_a").isNull()).alias("solo_b"),
        *[
            F.count_if(paired & _differs(f.name, f.dataType.simpleString(), tol)).alias(f"dif_{f.name}")
            for f in values
        ],
    )
    total = reduce(
        lambda x, y: x + y, [F.col("solo_a"), F.col("solo_b"), *[F.col(f"dif_{f.name}") for f in values]]
    )
    return counts.withColumn("diferencias", total)


def only_in(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of ``left`` without a partner in ``right``."""
    return left.select(*key).join(right.select(*key), list(key), "left_anti")
