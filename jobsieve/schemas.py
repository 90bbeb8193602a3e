"""Explicit schemas of all inputs, states and outputs; nothing is inferred."""

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "timestamp": T.TimestampType(), "double": T.DoubleType(), "long": T.LongType(), "longs": T.ArrayType(T.LongType())}


def _of(fields: str) -> T.StructType:
    """A schema of "name type, name type"; unlike a DDL string it needs no session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (f.split() for f in fields.split(","))])


SOURCES = _of("source string, enabled boolean, path string")
LISTINGS = _of("source string, native_id string, url string, title string, location string, scanned_at timestamp")
SOURCE_STATUS = _of("source string, status string, error string")
DETAILS = _of("source string, native_id string, url string, title string, department string, text string, posted_at timestamp, fetch_status string")
SEEN_SOURCE_JOBS = _of("job_id string, source string, status string, attempts int, first_seen_run string, last_seen_run string, baseline boolean, late boolean")
SEEN_JOBS = _of("canonical_id string, job_id string, source string, tier int, first_seen_run string, discovery_type string, rules_version string, url_key string, runs longs")
STATUS_HISTORY = _of("source string, status string, run_id string")

POSTINGS = _of("job_id string, canonical_id string, source string, url string, url_key string, location string, title string, department string, text string, posted_at timestamp, own_text string, qualifies boolean, reject_reason string, tier int, fit_score double, rank long, duplicate boolean, discovery_type string, rules_version string, run_id string")

#: The states of one version, under one pointer, and the column that each is looked up by.
STATE = {"seen_source_jobs": SEEN_SOURCE_JOBS, "seen_jobs": SEEN_JOBS, "source_status": STATUS_HISTORY}
STATE_KEYS = {"seen_source_jobs": "job_id", "seen_jobs": "job_id", "source_status": "source"}

STATUSES = ("ok", "blocked", "unavailable", "not_run")
DISCOVERY_TYPES = ("duplicate_posting", "previously_processed", "historical_baseline", "catch_up", "new_posting")
