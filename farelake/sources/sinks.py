"""Published tables, exports and write-once results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, contract: StructType, name: str = "table") -> DataFrame:
    """Columns in contract order; a missing column or another type is an error, not a cast."""
    got = {f.name: f.dataType for f in df.schema}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, got "
        f"{got[f.name].simpleString() if f.name in got else 'nothing'}"
        for f in contract
        if got.get(f.name) != f.dataType
    ]
    if wrong:
        raise TypeError(f"{name} breaks its contract: {'; '.join(wrong)}")
    return df.select(*contract.names)


def publish(
    df: DataFrame,
    path: str,
    contract: StructType | None = None,
    day_of: str | None = None,
    catalog_name: str | None = None,
) -> int:
    """Replace a table and return its row count, observed while writing.

    ``day_of`` names an event-time column: the table is then laid out by its day (column ``dia``),
    which is what lets a feature window read only its own days. ``rebalance`` makes AQE split a
    huge day over many files and merge the small ones.
    """
    if contract is not None:
        df = conform(df, contract, path.rsplit("/", 1)[-1])
    counted = Observation()
    df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if day_of is not None:
        df = df.withColumn("dia", F.col(day_of).cast("date")).hint("rebalance", "dia")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if day_of is not None:
        writer = writer.partitionBy("dia")
    if catalog_name is not None:
        writer.format("parquet").option("path", path).saveAsTable(catalog_name)
    else:
        writer.parquet(path)
    return counted.get["rows"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A published table as it is now."""
    return spark.read.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Header CSV in one file, for marts whose size is bounded by zones, hours and operators."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_sorted_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Totally ordered CSV parts; concatenated by name they are the same bytes on every run."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def write_once(df: DataFrame, path: str) -> None:
    """A result that may be produced only once; a second attempt fails."""
    df.write.mode("errorifexists").parquet(path)


def write_features(df: DataFrame, path: str, catalog_name: str | None = None) -> None:
    """Stacked feature table, one folder per cut, fully replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("corte")
    if catalog_name is not None:
        writer.format("parquet").option("path", path).saveAsTable(catalog_name)
    else:
        writer.parquet(path)
