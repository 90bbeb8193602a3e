"""Listings as a file stream: each start takes what has landed since the last, each identity once, or as runs over the state."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..plans import daily
from ..rules import DEFAULT, Rules
from ..sources import registry as R
from ..sources.registry import identified


def listing_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(schemas.LISTINGS).json(folder)


def intake(stream: DataFrame, target: str, checkpoint: str, delay: str | None = None):
    """Starts a query that appends new identities' listings to target, as Parquet, and stops when all is taken.

    Identities are kept for good, or within ``delay`` of event time (scanned_at).  A restart from the checkpoint
    hands on nothing twice.
    """
    own = identified(stream)
    once = own.dropDuplicates(["job_id"]) if delay is None else own.withWatermark("scanned_at", delay).dropDuplicatesWithinWatermark(["job_id"])
    return once.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(target)


def gated_runs(spark: SparkSession, stream: DataFrame, root: str, registry: Callable[[], DataFrame], checkpoint: str, name: str = "s", mode: str = "daily", rules: Rules = DEFAULT, send: daily.Send | None = None):
    """Starts a query that makes a run of each batch of the stream, and stops when all is taken.

    A batch is gated, classified, compared and reported as in ``daily.run``, at the latest time of its scans.  Its rows and what it
    adds to the state are written first; the batch's number is committed with the state, under the state's pointer.  A batch that
    Spark replays after a crash is made again if the pointer hadn't moved, and changes nothing if it had.  registry
    gives, at the time of a batch, the sources whose landed details and status count; an empty batch is no run.
    """

    def take(batch: DataFrame, number: int) -> None:
        last = batch.agg(F.max("scanned_at")).first()[0]
        if last is None:
            return
        known = registry()
        at = last.astimezone(UTC)
        daily.run(spark, root, known, batch, R.scan_details(spark, known), R.scan_status(spark, known), at, mode, rules, send, (name, number))

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counts(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Listings per source and day of closed windows."""
    return stream.withWatermark("scanned_at", delay).groupBy(F.window("scanned_at", "1 day"), "source").agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), "source", "n")
