"""Tables of a session: driver tables, and intermediate results in the shared folder of the cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: list[str] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Where that is unset, a temporary one, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="jobsieve-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return f"file://{_local[0]}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: cuts the lineage, survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def removed(spark: SparkSession, *frames: DataFrame) -> None:
    """Deletes tables that ``written`` made and that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    shared = path(shared_dir(spark)).toUri().getPath()
    for folder in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
        own = path(folder)
        if own.getParent().toUri().getPath() == shared:
            own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def written_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """``written`` in as many buckets of key as a shuffle has partitions, so that joins by key don't shuffle its rows.  df: in partitions
    of key already, for each partition writes a file to each of its buckets."""
    spark = df.sparkSession
    path = new_path(spark, name)
    known, buckets = f"jobsieve_{name}_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(known)
    return spark.table(known)


#: Bytes of counted rows that are broadcast at most.
MOST_BYTES = 64 << 20


def join_counted(rows: DataFrame, keyed: DataFrame, key: list[str], n: str, total: int, how: str = "left", row_bytes: int = 64, most_bytes: int = MOST_BYTES, *, most: int | None = None) -> DataFrame:
    """rows joined (left or inner) with ``keyed``, which has one row per key and, in column n, how many rows share the key.

    Of ``total`` rows at most ``most`` keys can have more than total / most, whatever the data: those are joined by
    broadcast, so a key that a third of all rows share is no task of its own, and the rest are shuffled.  If all of
    keyed is as small, it is broadcast as a whole.  most is what most_bytes hold of rows of row_bytes, if
    it isn't given.  Both inputs
    are read more than once: write them first.
    """
    most = max(1, most_bytes // row_bytes) if most is None else most
    share = max(50, -(-total // most))
    often = F.col(n) > share
    size = keyed.agg(F.count("*").alias("every"), F.count_if(often).alias("often")).first()
    if size["every"] <= most:
        return rows.join(F.broadcast(keyed), key, how)
    if not size["often"]:
        return rows.join(keyed, key, how)
    hot = F.broadcast(keyed.where(often))
    rest = rows.join(F.broadcast(keyed.where(often).select(*key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(keyed.where(~often), key, how))
