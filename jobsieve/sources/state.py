"""Versioned state in a log of deltas: all tables of a version move under one pointer.

A version is a manifest: a base, with every table in buckets of its key, and the deltas of the runs since.  A run writes
its own rows alone, as one more delta, and the version becomes current when the pointer file is replaced, which is the
commit; a run that dies before that leaves a folder that nobody reads.  Tables are merged when they are read.  A lookup
joins the base bucket by bucket, so that only the keys that are looked up are shuffled.  After COMPACT_AFTER deltas the merged
tables become the next base, under the same pointer.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import merge
from ..operators.merge import PART
from ..sinks.files import exists, read_text, write_text
from ..tables import MOST_BYTES, written

POINTER, MANIFEST = "CURRENT", "MANIFEST.json"
#: Deltas of a version at most, and buckets of a base.
COMPACT_AFTER, BUCKETS = 8, 16
MERGED = {"seen_source_jobs": merge.merged_seen, "seen_jobs": merge.merged_jobs, "source_status": merge.merged_status}


class StateStore:
    def __init__(self, spark: SparkSession, folder: str, compact_after: int = COMPACT_AFTER, buckets: int = BUCKETS):
        self.spark, self.folder, self.compact_after, self.buckets = spark, folder.rstrip("/"), compact_after, buckets

    def current(self) -> str | None:
        found = read_text(self.spark, f"{self.folder}/{POINTER}")
        return found.strip() if found else None

    def manifest(self) -> dict:
        """base and deltas (names of versions that hold them) and, by stream, the last batch of the current version."""
        now = self.current()
        return {"base": None, "deltas": [], "streams": {}} if now is None else json.loads(read_text(self.spark, self._path(now, MANIFEST)))

    def _path(self, version: str, name: str) -> str:
        return f"{self.folder}/versions/{version}/{name}"

    def _base(self, version: str, name: str, buckets: int) -> DataFrame:
        """A base's table as a bucketed one: the session's catalogue is told where its files are."""
        path = self._path(version, name)
        table = f"jobsieve_{hashlib.md5(path.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(table):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.STATE[name])
            key = schemas.STATE_KEYS[name]
            self.spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(table)

    def parts(self, name: str) -> list[DataFrame]:
        """The rows of a table as the base and each delta have them, with their part's number."""
        known, out = self.manifest(), []
        if known["base"]:
            out.append(self._base(known["base"], name, known["buckets"]).withColumn(PART, F.lit(0)))
        for k, version in enumerate(known["deltas"], 1):
            out.append(self.spark.read.schema(schemas.STATE[name]).parquet(self._path(version, name)).withColumn(PART, F.lit(k)))
        return out

    def _rows(self, name: str, parts: list[DataFrame]) -> DataFrame:
        empty = self.spark.createDataFrame([], schemas.STATE[name]).withColumn(PART, F.lit(0))
        return MERGED[name](reduce(DataFrame.unionByName, parts, empty)).select([f.name for f in schemas.STATE[name]])

    def load(self) -> dict[str, DataFrame]:
        """The tables of the current version, merged; empty ones before the first."""
        return {name: self._rows(name, self.parts(name)) for name in schemas.STATE}

    def whole(self, name: str) -> DataFrame:
        """A table as ``load`` gives it, for those of wide rows: rows whose key no other row has aren't shuffled, unless there are very
        many others."""
        key, parts = schemas.STATE_KEYS[name], self.parts(name)
        if not parts:
            return self._rows(name, parts)
        rows = reduce(DataFrame.unionByName, parts)
        several = written(rows.groupBy(key).agg(F.count("*").alias("_k")).where("_k > 1").select(key), "several")
        if several.count() * 128 > MOST_BYTES:
            return self._rows(name, parts)
        alone = rows.join(F.broadcast(several), key, "left_anti").select([f.name for f in schemas.STATE[name]])
        return alone.unionByName(self._rows(name, [rows.join(F.broadcast(several), key, "left_semi")]))

    def lookup(self, name: str, keys: DataFrame) -> DataFrame:
        """The merged rows of the given keys (one column, named as the table's key): each part is joined before any merge."""
        key = schemas.STATE_KEYS[name]
        own = keys.select(key).distinct()
        return self._rows(name, [p.join(own, key, "left_semi") for p in self.parts(name)])

    def without(self, name: str, rows: DataFrame, condition: str) -> DataFrame:
        """rows without those whose key any part has in a row that meets the condition: an anti-join per part."""
        key = schemas.STATE_KEYS[name]
        return reduce(lambda left, part: left.join(part.where(condition).select(key), key, "left_anti"), self.parts(name), rows)

    def append(self, version: str, delta: dict[str, DataFrame], stream: tuple[str, int] | None = None) -> None:
        """Writes a version that is the current one and a delta; an earlier attempt at the same version is replaced."""
        known = self.manifest()
        if version == self.current() or version in (known["base"], *known["deltas"]):
            raise ValueError(f"version {version} is current")
        for name, rows in delta.items():
            rows.select([f.name for f in schemas.STATE[name]]).write.mode("overwrite").option("compression", "zstd").parquet(self._path(version, name))
        for name in schemas.STATE.keys() - delta.keys():
            self.spark.createDataFrame([], schemas.STATE[name]).write.mode("overwrite").parquet(self._path(version, name))
        after = known | {"deltas": [*known["deltas"], version]}
        if stream:
            after["streams"] = known["streams"] | {stream[0]: stream[1]}
        write_text(self.spark, self._path(version, MANIFEST), json.dumps(after, indent=1) + "\n")

    def commit(self, version: str) -> None:
        write_text(self.spark, f"{self.folder}/{POINTER}", version + "\n")

    def committed_batch(self, stream: str) -> int:
        """The last batch of a stream that the current version holds; -1 before the first."""
        return self.manifest()["streams"].get(stream, -1)

    def compact(self) -> bool:
        """Makes the merged tables the next base if there are many deltas, and commits it; a death on the way changes nothing."""
        known, now = self.manifest(), self.current()
        if len(known["deltas"]) < self.compact_after:
            return False
        version = f"{now}.base"
        for name, rows in self.load().items():
            key, table = schemas.STATE_KEYS[name], f"jobsieve_{hashlib.md5(self._path(version, name).encode()).hexdigest()}"
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            # in as many tasks as buckets, so that a bucket is a file
            own = rows.repartition(self.buckets, key)
            own.write.mode("overwrite").option("compression", "zstd").bucketBy(self.buckets, key).sortBy(key).option("path", self._path(version, name)).saveAsTable(table)
        write_text(self.spark, self._path(version, MANIFEST), json.dumps(known | {"base": version, "deltas": [], "buckets": self.buckets}, indent=1) + "\n")
        self.commit(version)
        return True


def read_json_state(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """State of a JSON document: an array of objects, or an object by key.  A missing or empty file is empty state;
    a truncated one raises, since lost rows would notify again."""
    empty = spark.createDataFrame([], schema)
    if not exists(spark, path):
        return empty
    whole = spark.read.option("wholetext", True).text(path).where(F.trim("value") != "")
    opening = whole.select(F.substring(F.ltrim("value"), 1, 1)).first()
    if opening is None:
        return empty
    strict = {"mode": "FAILFAST"}
    if opening[0] == "[":
        rows = whole.select(F.explode(F.from_json("value", T.ArrayType(schema), strict)).alias("x")).select("x.*")
    else:
        rows = whole.select(F.explode(F.from_json("value", T.MapType(T.StringType(), schema), strict)).alias("k", "x"))
        rows = rows.select(*[F.coalesce(F.col(f"x.{f.name}"), F.col("k")).alias(f.name) if f.name == key else F.col(f"x.{f.name}").alias(f.name) for f in schema])
    return rows


def read_run(spark: SparkSession, folder: str, run_id: str) -> DataFrame:
    """The stored postings of a run: one partition of the runs' data is read."""
    return spark.read.schema(schemas.POSTINGS).parquet(f"{folder}/data").where(F.col("run_id") == run_id)


def write_run(postings: DataFrame, folder: str, run_id: str) -> None:
    """Writes a run's partition, in place of what an earlier attempt at the same run left."""
    own = postings.withColumn("run_id", F.lit(run_id))
    own = own.select([F.col(f.name) if f.name in own.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.POSTINGS])
    own.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{folder}/data")
