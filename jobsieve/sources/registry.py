"""The registry of sources, and reads of what acquisition has landed for them."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import job_id, url_key
from ..sinks.files import NO_HOST, exists, qualified
from ..tables import written

# The companies.
COMPANIES = ("NVIDIA", "Dell", "HPE", "Lenovo", "Red Hat", "Canonical", "Microsoft / Azure", "AWS", "Google Cloud")


def default_registry(spark: SparkSession, folder: str) -> DataFrame:
    """The known companies with a landing folder each."""
    rows = [(c, True, f"{folder}/{c.lower().replace(' / ', '-').replace(' ', '-')}") for c in COMPANIES]
    return spark.createDataFrame(rows, schemas.SOURCES)


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """The enabled sources of a JSON document (an array of objects); a broken document raises."""
    read = spark.read.schema(schemas.SOURCES).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return read.where("source is not null and coalesce(enabled, true)")


def _paths(spark: SparkSession, registry: DataFrame, name: str) -> list[str]:
    """Landed folders of the sources, in the folder of each or where its path has ``{name}``; a source that has none has nothing to
    read."""
    return sorted({p for p in _folders(registry, name).values() if exists(spark, p)})


def _folders(registry: DataFrame, name: str) -> dict[str, str]:
    """The folder that each source lands in, of the sources that have one."""
    rows = registry.where("path is not null").select("source", "path").collect()  # a row per company
    return {r["source"]: r["path"].replace("{name}", name) if "{name}" in r["path"] else f"{r['path']}/{name}" for r in rows}


def scan_listings(spark: SparkSession, registry: DataFrame) -> DataFrame:
    """Light metadata of all landed listings, one read over all companies' folders."""
    found = _paths(spark, registry, "listings")
    return spark.read.schema(schemas.LISTINGS).json(found) if found else spark.createDataFrame([], schemas.LISTINGS)


def scan_details(spark: SparkSession, registry: DataFrame) -> DataFrame:
    found = _paths(spark, registry, "details")
    return spark.read.schema(schemas.DETAILS).json(found) if found else spark.createDataFrame([], schemas.DETAILS)


def scan_status(spark: SparkSession, registry: DataFrame) -> DataFrame:
    found = _paths(spark, registry, "status")
    return spark.read.schema(schemas.SOURCE_STATUS).json(found) if found else spark.createDataFrame([], schemas.SOURCE_STATUS)


def identified(rows: DataFrame) -> DataFrame:
    """rows (source, native_id, url) with job_id and url_key; a row without an identity fails the query.

    Two jobs of one source are never one: what links jobs of different sources is evidence (``likeness``), not identity.
    """
    return rows.withColumns({"job_id": job_id(F.col("source"), F.col("native_id"), F.col("url")), "url_key": url_key(F.col("url"))})


#: Failures that Spark reports of an input: of the plan, or of a task.
FAILURES = (PySparkException, Py4JJavaError)
_CORRUPT = "_corrupt"


def _parsed(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Rows of JSON lines with ``_corrupt``, the line where it is no record of the schema, and ``_folder``."""
    whole = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    read = spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).json(paths)
    return read.withColumn("_folder", F.regexp_replace(F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1), NO_HOST, "$1:/"))


def _readable(spark: SparkSession, path: str) -> str | None:
    """Why a folder's files can't be read through; None if they can."""
    try:
        spark.read.text(path).write.format("noop").mode("overwrite").save()
    except FAILURES as failed:
        return f"unreadable: {type(failed).__name__}"
    return None


def scan_sources(spark: SparkSession, registry: DataFrame, name: str = "listings", schema: T.StructType = schemas.LISTINGS) -> tuple[DataFrame, DataFrame]:
    """(rows, status): what the sources landed, without those that failed, and (source, status, error) of each source.

    A source fails as a whole, so that half a scan is never taken for all of it, and never fails the others.  ``unavailable``: it
    has no folder.  ``blocked``: its folder has a file that can't be read through, a line that is no record, a record without
    an identity, or one of a source that doesn't land there.  An empty folder is an ok source without listings; repeated
    rows stay.  The files of a source are in its folder itself; where several sources share a folder, each has its own
    records there, and what is broken there fails them all.

    All folders are one read, of any size.  Only if it fails are folders read one by one, to find which can't be.
    """
    folders = _folders(registry, name)
    there = {p for p in set(folders.values()) if exists(spark, p)}
    error: dict[str, str] = {}
    rows = None
    while rows is None:
        good = sorted(there - error.keys())
        try:
            rows = written(_parsed(spark, good, schema), "scanned") if good else written(spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType()), T.StructField("_folder", T.StringType())])), "scanned")
        except FAILURES:
            found = {p: why for p in good if (why := _readable(spark, p))}
            if not found:
                raise
            error |= found
    lands = [(s, qualified(spark, p)) for s, p in folders.items()]
    own = spark.createDataFrame(lands, "source string, _folder string")
    known = rows.join(F.broadcast(own.withColumn("_lands", F.lit(True))), ["source", "_folder"], "left")  # a row per company
    nameless = F.coalesce(F.nullif(F.trim("native_id"), F.lit("")), url_key(F.col("url"))).isNull()
    fault = F.when(F.col(_CORRUPT).isNotNull(), "a line is no record").when(F.col("_lands").isNull(), "a record of another source").when(nameless, "a record without an identity")
    faults = known.withColumn("_fault", fault).where("_fault is not null").groupBy("_folder").agg(F.min("_fault").alias("fault"), F.count("*").alias("n"))
    broken = {r["_folder"]: f"{r['fault']} ({r['n']} in all)" for r in faults.collect()}  # a row per company
    state = []
    for r in registry.select("source").distinct().collect():  # a row per company
        path = folders.get(r["source"])
        why = None if path is None else error.get(path) or broken.get(qualified(spark, path))
        state.append((r["source"], "unavailable" if path not in there else "blocked" if why else "ok", "no landed folder" if path not in there else why))
    status = spark.createDataFrame(state, schemas.SOURCE_STATUS)
    fine = F.broadcast(status.where("status = 'ok'").select("source"))
    # a record of another source is no listing of that source either
    return known.where("_lands").join(fine, "source", "left_semi").select(schema.names), status


def worse_status(one: DataFrame, other: DataFrame) -> DataFrame:
    """(source, status, error) of sources in either: ok only where all that is said of the source is ok; of several failures the first
    by name.  An acquisition's own status and that of reading what it landed are told apart by nothing else."""
    every = one.select(schemas.SOURCE_STATUS.names).unionByName(other.select(schemas.SOURCE_STATUS.names))
    worst = F.min(F.struct((F.col("status") == "ok").alias("fine"), "status", "error")).alias("x")
    return every.groupBy("source").agg(worst).select("source", "x.status", "x.error")
