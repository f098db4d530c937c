"""Raw files in, bronze Parquet out, newest load back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelake.sources.schemas import SOURCES, Source


def read_raw(spark: SparkSession, source: Source, folder: str) -> DataFrame:
    """Read one raw file (or a folder of its pieces) with its declared schema.

    A CSV header that differs from the schema fails the load; unreadable JSON lines are kept in
    ``_corrupt_record`` and end up in quarantine.
    """
    path = f"{folder.rstrip('/')}/{source.file}"
    reader = spark.read.schema(source.schema)
    if source.fmt == "json":
        return reader.option("mode", "PERMISSIVE").json(path)
    return reader.option("header", True).option("enforceSchema", False).csv(path)


def with_provenance(df: DataFrame, source: str, loaded_at: datetime, load_date: date) -> DataFrame:
    """Load instant (UTC), load date and source name."""
    return df.withColumns(
        {
            "ts_ingesta": F.lit(loaded_at).cast("timestamp_ntz"),
            "fecha_ingesta": F.lit(load_date).cast("date"),
            "fuente_archivo": F.lit(source),
        }
    )


def write_bronze(df: DataFrame, root: str, source: str) -> int:
    """Replace the load's own day, keep the others; the row count is observed during the write."""
    counted = Observation()
    (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("fecha_ingesta")
        .parquet(f"{root}/{source}")
    )
    return counted.get["rows"]


def ingest(
    spark: SparkSession,
    raw: str,
    root: str,
    loaded_at: datetime,
    load_date: date,
    sources: dict[str, Source] | None = None,
) -> dict[str, int]:
    """Land every source and return its row count. The change log is stored as it came."""
    counts = {}
    for name, source in (sources or SOURCES).items():
        df = with_provenance(read_raw(spark, source, raw), name, loaded_at, load_date)
        counts[name] = write_bronze(df, root, name)
    return counts


def bronze(spark: SparkSession, root: str, source: str) -> DataFrame:
    """All loads of a source."""
    return spark.read.parquet(f"{root}/{source}")


def newest_load(df: DataFrame, load_col: str = "fecha_ingesta") -> DataFrame:
    """Only the newest load. The scalar subquery prunes partitions, older loads are not read."""
    newest = df.agg(F.max(load_col).alias("_newest"))
    return df.filter(F.col(load_col) == newest.scalar())


def register_views(spark: SparkSession, root: str, prefix: str = "bronze_") -> list[str]:
    names = []
    for name in SOURCES:
        bronze(spark, root, name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def latest_sources(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: newest_load(bronze(spark, root, name)) for name in SOURCES}
