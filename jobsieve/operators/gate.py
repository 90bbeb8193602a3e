"""Which listings need their details: those never seen, and those not resolved yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESOLVED, UNRESOLVED = "resolved", "unresolved"


def unseen(listings: DataFrame, seen: DataFrame, key: str = "job_id") -> DataFrame:
    """Listings whose identity no state row has."""
    return listings.join(seen.select(key), key, "left_anti")


def unresolved(status: Column) -> Column:
    return F.coalesce(status != RESOLVED, F.lit(True))


def gated(listings: DataFrame, seen: DataFrame, key: str = "job_id") -> DataFrame:
    """Listings that are unseen or unresolved: an anti-join with what is resolved, a filter that reaches the scan."""
    return listings.join(seen.where(F.col("status") == RESOLVED).select(key), key, "left_anti")


def with_reason(listings: DataFrame, seen: DataFrame, key: str = "job_id") -> DataFrame:
    """The gated listings and why they are: ``unseen`` or ``unresolved``."""
    state = seen.select(key, F.col("status").alias("_status"))
    reason = F.when(F.col("_status").isNull(), "unseen").otherwise("unresolved")
    joined = listings.join(state, key, "left").where(F.col("_status").isNull() | unresolved(F.col("_status")))
    return joined.withColumn("reason", reason).drop("_status")


def fetch(gate: DataFrame, details: DataFrame, key: str = "job_id") -> DataFrame:
    """Details of gated identities alone: the semi-join drops all others before anything else is done to them."""
    return details.join(gate.select(key), key, "left_semi")
