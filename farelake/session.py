"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# What the jobs expect of a session. Partition counts are left to the cluster: AQE coalesces
# and splits them from measured sizes.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a ``local[...]`` session without the setting gets a temporary folder; a cluster session
    without it is an error, since a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _local_folder()
    return folder.rstrip("/")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="farelake-")


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_sent = set()


def ship(spark: SparkSession) -> None:
    """Let Spark send the package to its Python workers, unless they find it by themselves."""
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    app = spark.sparkContext.applicationId
    if app in _sent or any(os.path.abspath(p) == _ROOT for p in paths if p):
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "farelake"), "zip", root_dir=_ROOT, base_dir="farelake")
    spark.sparkContext.addPyFile(archive)
    _sent.add(app)


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared one for a single run."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`run_dir` that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once as a table in the shared folder and read it from there on.

    Unlike a row checkpoint the table has a known size, which lets the optimizer choose its joins, and
    later reads take only the columns they need. It outlives lost executors.
    """
    path = run_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_all(jobs: Sequence[Callable], at_once: int = 4) -> list:
    """Independent Spark actions submitted side by side from the driver."""
    spark = SparkSession.active()
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(lambda job: job(), [inheritable_thread_target(spark)(j) for j in jobs]))
