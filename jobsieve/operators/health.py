"""Failed sources are told apart from empty ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_health(registry: DataFrame, status: DataFrame, counts: DataFrame) -> DataFrame:
    """(source, status, n, error) of every source of the registry: ``not_run`` without a status; n is 0 for an ok source without
    listings and null for any that isn't ok."""
    own = registry.select("source").distinct().join(status, "source", "left").join(counts.select("source", "n"), "source", "left")
    state = F.coalesce("status", F.lit("not_run"))
    return own.select("source", state.alias("status"), F.when(state == "ok", F.coalesce("n", F.lit(0))).cast("long").alias("n"), "error")


def from_ok_sources(listings: DataFrame, status: DataFrame) -> DataFrame:
    """Listings of sources whose scan succeeded; a failed source adds nothing and changes no state."""
    return listings.join(F.broadcast(status.where("status = 'ok'").select("source").distinct()), "source", "left_semi")  # one row per source
