"""Streaming queries whose result changes over time, kept as a Parquet log of changed rows.

Each micro-batch writes the rows it changed to its own folder, named by the batch number, so a
batch that is retried after a failure replaces what it wrote. Readers take the newest row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "lote"


# State on local disk with its changes logged under the checkpoint: a micro-batch costs what it touches, not what is kept.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # counting the rows of a store looks each key up once more when it is put
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
ADAPTIVE = "spark.sql.adaptive.enabled"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's settings are put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in ROCKSDB}
    for key, value in ROCKSDB.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def adaptive(batch: DataFrame) -> Iterator[None]:
    """Queries on a micro-batch are planned adaptively inside.

    A stateful query turns this off in its own session, since its state has a fixed number of partitions. What reads the batch
    has none: without it ``rebalance`` hints are ignored, and each task writes a file for each day of its rows.
    """
    conf = batch.sparkSession.conf
    before = conf.get(ADAPTIVE)
    conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        conf.set(ADAPTIVE, before)


def batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")

    return write


def run_available(stream: DataFrame, checkpoint: str, write, mode: str = "append") -> None:
    """Process everything there is, in micro-batches, then stop; restarts go on from the checkpoint."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def publish_updates(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Run a stateful aggregation in update mode; ``out`` collects the changed rows per batch."""
    run_available(stream, checkpoint, batch_writer(out), mode="update")


def newest(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The current row per key."""
    log = spark.read.parquet(out)
    values = [c for c in log.columns if c not in keys and c != BATCH]
    return (
        log.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("_v")).select(*keys, "_v.*")
    )
