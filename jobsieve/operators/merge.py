"""New state from old state and a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gate import RESOLVED


#: Which part of a state a row is from; the larger came later.
PART = "_part"


def merged_seen(rows: DataFrame) -> DataFrame:
    """seen_source_jobs of all parts: each identity once; attempts add up, first and last runs stretch, what was resolved once stays so."""
    return rows.groupBy("job_id").agg(
        F.min_by("source", "first_seen_run").alias("source"),
        F.when(F.bool_or(F.col("status") == RESOLVED), RESOLVED).otherwise(F.max_by("status", "last_seen_run")).alias("status"),
        F.sum("attempts").cast("int").alias("attempts"),
        F.min("first_seen_run").alias("first_seen_run"),
        F.max("last_seen_run").alias("last_seen_run"),
        F.bool_or("baseline").alias("baseline"),
        F.bool_or("late").alias("late"),
    )


def merged_jobs(rows: DataFrame) -> DataFrame:
    """seen_jobs of all parts: each job once, as it was first met, but with the tier of the latest part."""
    names = [c for c in rows.columns if c not in ("job_id", "tier", "rules_version", PART)]
    return rows.groupBy("job_id").agg(*[F.min_by(c, PART).alias(c) for c in names], *[F.max_by(c, PART).alias(c) for c in ("tier", "rules_version")])


def merged_status(rows: DataFrame) -> DataFrame:
    """source_status of all parts: of each source the latest."""
    return rows.groupBy("source").agg(*[F.max_by(c, PART).alias(c) for c in ("status", "run_id")])


def first_last(events: DataFrame, key: str, ts: str) -> DataFrame:
    return events.groupBy(key).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count("*").alias("n"))
