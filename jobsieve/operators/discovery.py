"""How a posting was discovered; new postings alone may notify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the type that may notify.
NEW = "new_posting"


def discovery_type(duplicate: Column, processed: Column, baseline: Column, catch_up: Column) -> Column:
    """The first that holds: duplicate_posting, previously_processed, historical_baseline, catch_up, new_posting."""
    no = F.lit(False)
    return (
        F.when(F.coalesce(duplicate, no), "duplicate_posting")
        .when(F.coalesce(processed, no), "previously_processed")
        .when(F.coalesce(baseline, no), "historical_baseline")
        .when(F.coalesce(catch_up, no), "catch_up")
        .otherwise(NEW)
    )


def met(rows: DataFrame, seen_source: DataFrame, history: DataFrame) -> DataFrame:
    """rows (job_id, source) with ``seen``, ``baseline`` and ``late`` as the state has them or, for identities met for
    the first time, as they will be.

    Such an identity is late if its source's last run wasn't ok (or there was none), since it may be older than this run.
    It stays so in the state: one whose details fail at first is late also when they come.
    """
    state = seen_source.select("job_id", F.lit(True).alias("seen"), "baseline", F.col("late").alias("_late"))
    last = history.select("source", F.col("status").alias("_last"))
    own = rows.join(state, "job_id", "left").join(F.broadcast(last), "source", "left")  # last: one row per source
    no = F.lit(False)
    late = F.when(F.col("seen"), F.coalesce("_late", no)).otherwise(F.coalesce(F.col("_last"), F.lit("not_run")) != "ok")
    return own.withColumns({"seen": F.coalesce("seen", no), "baseline": F.coalesce("baseline", no), "late": late}).drop("_late", "_last")


def discovered(found: DataFrame, seen_jobs: DataFrame, seen_source: DataFrame, history: DataFrame, baseline_run: bool) -> DataFrame:
    """found (job_id, source, duplicate) with discovery_type.

    A job that evidence links to another source's is a duplicate, one known by its own identity was processed.  An identity
    first met in a baseline run stays baseline, one that was late stays a catch-up (see ``met``).
    """
    own = met(found.join(seen_jobs.select("job_id", F.lit(True).alias("_known")), "job_id", "left"), seen_source, history)
    kind = discovery_type(F.col("duplicate"), F.col("_known"), F.lit(baseline_run) | F.col("baseline"), F.col("late"))
    return own.withColumn("discovery_type", kind).drop("_known", "seen", "baseline", "late")


def decision(found: DataFrame, kind: str = "discovery_type") -> DataFrame:
    """(n_new, should_notify): one row, also of no rows."""
    n = F.count_if(F.col(kind) == NEW)
    return found.agg(n.alias("n_new"), (n > 0).alias("should_notify"))
