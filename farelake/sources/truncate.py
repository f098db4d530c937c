"""Raw data as it stood at an instant: what the leak audit feeds to the whole flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions import columns as X


def _before(source: str, limit: Column) -> Column | None:
    if source == "tm_validaciones":
        return X.parse_ts(F.col("fecha_hora"), "yyyy-MM-dd HH:mm:ss") < limit
    if source == "tu_transacciones":
        stamp = F.concat_ws(" ", "fecha", "hora")
        return X.parse_ts(stamp, "dd/MM/yyyy HH:mm:ss") < limit
    if source == "am_boardings":
        utc = X.parse_ts(F.col("timestamp_utc"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return X.local_from_utc(utc) < limit
    if source == "cdc_padron_usuarios":
        return F.col("commit_ts").try_cast("timestamp_ntz") < limit
    if source == "mr_viajes":
        # A trip exists in the file only once it is closed, or if it never was.
        left = F.col("exit.ts").try_cast("timestamp_ntz")
        return (F.col("entry.ts").try_cast("timestamp_ntz") < limit) & (left.isNull() | (left < limit))
    return None  # catalogues carry no event time


def truncate_source(df: DataFrame, source: str, limit) -> DataFrame:
    rule = _before(source, F.lit(limit).cast("timestamp_ntz"))
    return df if rule is None else df.filter(rule)


def truncate_all(frames: dict[str, DataFrame], limit) -> dict[str, DataFrame]:
    return {name: truncate_source(df, name, limit) for name, df in frames.items()}
