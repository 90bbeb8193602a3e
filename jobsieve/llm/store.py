"""Tables and intermediate results in the shared folder of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import tables
from ..tables import new_path, removed, shared_dir  # noqa: F401

#: Rows of an Arrow batch: texts may be long, and each Python worker and the JVM hold a few batches.
BATCH_ROWS = 2000


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _small_batches(spark)
    return tables.table(spark, sf_dir, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: cuts the lineage, survives lost executors."""
    _small_batches(df.sparkSession)
    return tables.written(df, name)


def deleted(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int = 64, most_bytes: int = 64 << 20):
    """df with a broadcast hint if its counted rows, of about row_bytes each, take at most most_bytes; else as it is, for a
    shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= most_bytes else df
