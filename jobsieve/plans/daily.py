"""A run: gate, fetch, classify, rank, compare, report, commit, notify."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.time import run_id as make_id
from ..operators import classify, discovery, gate, health, likeness, rank
from ..rules import DEFAULT, Rules
from ..sinks import reports
from ..sources import registry as sources
from ..sources.registry import identified
from ..sources.state import StateStore, read_run, write_run
from ..tables import written, written_by

Send = Callable[[dict], str]


@dataclass(frozen=True)
class Outcome:
    run_id: str
    folder: str
    decision: dict
    delivery: dict
    gated: int


def _one_per_job(rows: DataFrame, order: list[str]) -> DataFrame:
    """A listing or posting that a source has twice counts once, chosen by content and not by order of arrival."""
    names = [c for c in rows.columns if c != "job_id"]
    first = [*order, *(c for c in names if c not in order)]
    return rows.groupBy("job_id").agg(F.min(F.struct(*first)).alias("x")).select("job_id", *[F.col(f"x.{c}").alias(c) for c in names])


#: What duplicates and states need of known jobs.
KNOWN = ["job_id", "canonical_id", "source", "url_key", "runs"]


def evaluate(listings: DataFrame, details: DataFrame, store: StateStore, rules: Rules, baseline: bool) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(gate, postings, sets): the listings whose details count, these classified, ranked and compared with the state, and the runs
    of words of those that qualify, if any does.

    A posting whose details failed, or lack a title or text, is in the gate alone: it stays unresolved.
    """
    spark, own = listings.sparkSession, _one_per_job(identified(listings), ["scanned_at"])
    gated = written(store.without("seen_source_jobs", own, f"status = '{gate.RESOLVED}'"), "gate")
    if gated.isEmpty():  # nothing is opened or classified again
        return gated, spark.createDataFrame([], schemas.POSTINGS), None
    got = identified(details).where((F.coalesce("fetch_status", F.lit("ok")) == "ok") & F.col("title").isNotNull() & F.col("text").isNotNull())
    got = _one_per_job(gate.fetch(gated, got).select("job_id", "title", "department", "text", "posted_at"), ["posted_at"])
    # written, since the rules of boilerplate read the texts several times, and in buckets, since texts are shuffled once
    full = written_by(got.join(gated.select("job_id", "source", "url", "url_key", "location"), "job_id"), "job_id", "fetched")
    found = classify.classify(full, rules, by_job=True)
    rest = found.where(~F.col("qualifies")).withColumn("canonical_id", F.col("job_id"))
    if found.where("qualifies").isEmpty():
        return gated, rest, None
    sets, marks = likeness.links(found.where("qualifies"), store.whole("seen_jobs").select(KNOWN), by_job=True)
    ids = gated.select("job_id")
    good = found.where("qualifies").select("job_id", "source", "tier", "fit_score").join(marks, "job_id")
    good = discovery.discovered(good, store.lookup("seen_jobs", ids), store.lookup("seen_source_jobs", ids), store.load()["source_status"], baseline)
    return gated, _ranked(found, good).unionByName(rest, allowMissingColumns=True), sets


def _ranked(found: DataFrame, good: DataFrame) -> DataFrame:
    """The postings that qualify with their ranks and what good says of them: ranks are made of narrow rows, and texts are joined once."""
    ranked = written(rank.global_rank(good, [F.col("tier").asc(), F.col("fit_score").desc(), F.col("job_id").asc()]).drop("source", "tier", "fit_score"), "ranks")
    return found.where("qualifies").join(ranked, "job_id")


def run(spark: SparkSession, root: str, registry: DataFrame, listings: DataFrame, details: DataFrame, status: DataFrame, as_of: datetime, mode: str = "daily", rules: Rules = DEFAULT, send: Send | None = None, batch: tuple[str, int] | None = None) -> Outcome | None:
    """One incremental run; mode is ``daily`` or ``baseline`` (which never notifies).

    Order: data and reports, the decision, new state, the pointer (the commit), then delivery.  A rerun on the same
    input gates nothing and notifies nobody.  batch: the stream and the number of its batch that this run takes in; one that
    the state already holds changes nothing, but for a delivery that wasn't begun.
    """
    if mode not in ("daily", "baseline"):
        raise ValueError(f"no such mode: {mode}")
    root, name = root.rstrip("/"), make_id(as_of, "" if batch is None else f"{batch[0]}{batch[1]}")
    folder, store = f"{root}/runs/{name}", StateStore(spark, f"{root}/state")
    if batch is not None and store.committed_batch(batch[0]) >= batch[1]:
        if reports.read_json(spark, f"{folder}/{reports.DECISION}") and name == store.current():
            reports.deliver(spark, folder, send)
        return None
    scanned = health.from_ok_sources(listings, status)
    gated, postings, sets = evaluate(scanned, details, store, rules, mode == "baseline")
    seen = Observation("run")
    if "discovery_type" not in postings.columns:  # none of them qualifies
        postings = postings.withColumn("discovery_type", F.lit(None).cast("string"))
    is_new = F.coalesce(F.col("qualifies") & (F.col("discovery_type") == discovery.NEW), F.lit(False))
    digest = F.sum(F.when(is_new, F.xxhash64("job_id").cast("decimal(38,0)")))
    write_run(postings.observe(seen, F.count_if(is_new).alias("n_new"), digest.cast("string").alias("digest")), root, name)
    stored = read_run(spark, root, name)
    good = stored.where("qualifies")

    counts = scanned.groupBy("source").agg(F.count("*").alias("n"))
    sources = sorted(health.source_health(registry, status, counts).collect(), key=lambda r: r["source"])  # a row per company
    tally = sorted(good.groupBy("source", "tier").agg(F.count("*").alias("n")).collect())
    reports.write_report(spark, f"{folder}/{reports.REPORT}", f"Qualifying roles, {name}", good, sources, tally)
    reports.write_report(spark, f"{folder}/{reports.SHORTLIST}", f"Priority 1 and 2, {name}", good.where("tier IN (1, 2)"))
    new = good.where(F.col("discovery_type") == discovery.NEW)
    reports.write_report(spark, f"{folder}/{reports.NEW_JOBS}", f"New jobs, {name}", new)
    decision = reports.decision_document(name, seen.get["n_new"], seen.get["digest"])
    reports.write_json(spark, f"{folder}/{reports.DECISION}", decision)

    store.append(name, delta(store, gated, scanned, stored, sets, status, name, mode == "baseline"), batch)
    store.commit(name)
    delivery = reports.deliver(spark, folder, send)
    store.compact()
    return Outcome(name, folder, decision, delivery, gated.count())


def run_landed(spark: SparkSession, root: str, registry: DataFrame, as_of: datetime, mode: str = "daily", rules: Rules = DEFAULT, send: Send | None = None) -> Outcome | None:
    """``run`` over what the sources of the registry landed.

    A source is blocked where its own status says so or its listings can't be read as a whole; the others run.  Of a source whose
    details can't be read as a whole no posting is resolved, and all are tried again.
    """
    listings, scanned = sources.scan_sources(spark, registry)
    details, _ = sources.scan_sources(spark, registry, "details", schemas.DETAILS)
    return run(spark, root, registry, listings, details, sources.worse_status(scanned, sources.scan_status(spark, registry)), as_of, mode, rules, send)


def delta(store: StateStore, gated: DataFrame, scanned: DataFrame, stored: DataFrame, sets: DataFrame | None, status: DataFrame, name: str, baseline: bool) -> dict[str, DataFrame]:
    """What a run adds to the state.  Sources that failed are in no listing, so nothing is said of their identities."""
    resolved = stored.select("job_id", F.lit(gate.RESOLVED).alias("_status")).distinct()
    met = discovery.met(gated.select("job_id", "source"), store.lookup("seen_source_jobs", gated), store.load()["source_status"])
    tried = met.join(resolved, "job_id", "left")
    tried = tried.select("job_id", "source", F.coalesce("_status", F.lit(gate.UNRESOLVED)).alias("status"), F.lit(1).alias("attempts"), F.lit(name).alias("first_seen_run"), F.lit(name).alias("last_seen_run"), F.lit(baseline).alias("baseline"), "late")
    again = _one_per_job(identified(scanned), ["scanned_at"]).join(gated.select("job_id"), "job_id", "left_anti")
    again = again.select("job_id", "source", F.lit(gate.RESOLVED).alias("status"), F.lit(0).alias("attempts"), F.lit(name).alias("first_seen_run"), F.lit(name).alias("last_seen_run"), F.lit(False).alias("baseline"), F.lit(False).alias("late"))
    jobs = stored.where("qualifies and not duplicate")
    # the state alone keeps runs
    jobs = jobs.withColumn("runs", F.lit(None).cast("array<long>")) if sets is None else jobs.join(sets, "job_id")
    jobs = jobs.select(*KNOWN, "tier", F.lit(name).alias("first_seen_run"), "discovery_type", "rules_version")
    return {"seen_source_jobs": tried.unionByName(again), "seen_jobs": jobs, "source_status": status.select("source", "status", F.lit(name).alias("run_id"))}


def reclassified(old: DataFrame, store: StateStore, rules: Rules, run_name: str) -> tuple[DataFrame, DataFrame]:
    """(postings, seen_jobs): stored postings under other rules, with old_tier, and what follows for the state.

    Known jobs get their new tier; a job that newly qualifies enters the state as processed, so that the same job from
    another source is a duplicate later.  One that no longer qualifies stays known.
    """
    inputs = ["job_id", "source", "url", "url_key", "location", "title", "department", "text", "posted_at"]
    found = classify.classify(old.select(*inputs, F.col("tier").alias("old_tier"), "discovery_type"), rules)
    kind = F.coalesce("discovery_type", F.lit("previously_processed"))
    sets, marks = likeness.links(found.where("qualifies"), store.whole("seen_jobs").select(KNOWN))
    good = _ranked(found.withColumn("discovery_type", F.when(F.col("qualifies"), kind).otherwise(F.col("discovery_type"))), found.where("qualifies").select("job_id", "source", "tier", "fit_score").join(marks, "job_id"))
    rest = found.where(~F.col("qualifies")).withColumn("canonical_id", F.col("job_id"))
    every = written(good.unionByName(rest, allowMissingColumns=True), "reclassified")
    known = written(store.lookup("seen_jobs", every), "known")
    moved = known.drop("tier", "rules_version").join(every.where("tier is not null").select("job_id", "tier", "rules_version"), "job_id")
    fresh = every.where("qualifies and not duplicate").join(known.select("job_id"), "job_id", "left_anti")
    fresh = fresh.join(sets, "job_id").select(*KNOWN, "tier", F.lit(run_name).alias("first_seen_run"), F.lit("previously_processed").alias("discovery_type"), "rules_version")
    return every, moved.unionByName(fresh)


def reclassify(spark: SparkSession, root: str, run_name: str, rules: Rules, suffix: str = "reclassified") -> tuple[str, DataFrame]:
    """Stored postings of a run under other rules: a new folder, the state corrected, nobody notified.

    Returns the new folder's run id and (job_id, old_tier, new_tier) of the postings whose tier differs.  The same
    reclassification a second time raises before anything is written.
    """
    root = root.rstrip("/")
    name, store = f"{run_name}-{suffix}", StateStore(spark, f"{root}/state")
    if name == store.current() or name in store.manifest()["deltas"]:
        raise ValueError(f"{name} is current")
    every, jobs = reclassified(read_run(spark, root, run_name), store, rules, run_name)
    write_run(every, root, name)
    folder = f"{root}/runs/{name}"
    listed = every.where("qualifies")
    reports.write_report(spark, f"{folder}/{reports.REPORT}", f"Qualifying roles, {name}", listed)
    reports.write_report(spark, f"{folder}/{reports.SHORTLIST}", f"Priority 1 and 2, {name}", listed.where("tier IN (1, 2)"))
    reports.write_report(spark, f"{folder}/{reports.NEW_JOBS}", f"New jobs, {name}", listed.limit(0))
    reports.write_json(spark, f"{folder}/{reports.DECISION}", reports.decision_document(name, 0, None))
    store.append(name, {"seen_jobs": jobs})
    store.commit(name)
    reports.deliver(spark, folder, None)
    return name, every.where(~F.col("old_tier").eqNullSafe(F.col("tier"))).select("job_id", "old_tier", F.col("tier").alias("new_tier"))


def read_back(spark: SparkSession, root: str, run_name: str, kind: str = "report") -> DataFrame:
    """A stored run's ``report``, ``shortlist`` or ``new`` postings in order."""
    good = read_run(spark, root.rstrip("/"), run_name).where("qualifies")
    gate_of = {"report": F.lit(True), "shortlist": F.col("tier").isin(1, 2), "new": F.col("discovery_type") == discovery.NEW}
    return good.where(gate_of[kind]).orderBy("rank")
