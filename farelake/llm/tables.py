"""Reading the given tables, and sending the package to executors that can't import it."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from farelake.session import shared_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_sent = set()


def ship(spark: SparkSession) -> None:
    """Let Spark send the package along, unless Python finds it by itself on the executors."""
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    app = spark.sparkContext.applicationId
    if app in _sent or os.getcwd() == _ROOT or any(os.path.abspath(p) == _ROOT for p in paths if p):
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(), "farelake"), "zip", root_dir=_ROOT, base_dir="farelake"
    )
    spark.sparkContext.addPyFile(archive)
    _sent.add(app)


# Rows of an Arrow batch: texts are long, and a batch stands in memory several times on its way to Python.
BATCH_ROWS = "1000"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage through a table in the shared folder."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _file_system(spark, path)
    return files.exists(where)


def drop_path(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)


def drop(*written_tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for table in written_tables:
        drop_path(table.sparkSession, table.written_to)
