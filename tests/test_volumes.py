"""What a run moves and writes of its texts and sets."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

from jobsieve import schemas
from jobsieve.operators import classify
from jobsieve.plans import daily
from jobsieve.rules import DEFAULT
from jobsieve.sources.state import StateStore
from jobsieve.tables import written_by

AT = datetime(2026, 3, 2, 15, tzinfo=UTC)


def test_texts_are_shuffled_once_and_runs_are_kept_by_the_state_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = [(s, str(i), f"https://{s}.com/{i}", "CUDA Intern", "NY", AT, "Engineering", f"CUDA kernels in {s}. " + " ".join(f"w{i}x{k}" for k in range(20)), AT, "ok") for s in ("a", "b") for i in range(6)]
    every = spark.createDataFrame(rows, "source string, native_id string, url string, title string, location string, scanned_at timestamp, department string, text string, posted_at timestamp, fetch_status string")
    listings, details = every.select(schemas.LISTINGS.names), every.select(schemas.DETAILS.names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gated, postings, sets = daily.evaluate(listings, details, StateStore(spark, f"{tmp_path}/none"), DEFAULT, True)
        plan = postings._jdf.queryExecution().executedPlan().toString().split("\n")
        moved = [below for line, below in zip(plan, plan[1:]) if "Exchange hashpartitioning" in line and " text#" in below.split("Scan")[0]]
        assert postings.where("qualifies").count() == sets.count() == 12 and not moved
        known = spark.createDataFrame([(s, True, None) for s in ("a", "b")], schemas.SOURCES)
        status = spark.createDataFrame([(s, "ok", None) for s in ("a", "b")], schemas.SOURCE_STATUS)
        done = daily.run(spark, str(tmp_path), known, listings, details, status, AT, "baseline")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    stored = spark.read.parquet(f"{tmp_path}/data")
    assert stored.count() == 12 and "runs" not in stored.columns and stored.where(F.col("own_text").isNull()).isEmpty()
    jobs = StateStore(spark, f"{tmp_path}/state").load()["seen_jobs"]
    assert done.gated == 12 and jobs.where(F.size("runs") > 10).count() == jobs.count() == 12 - stored.where("duplicate").count() > 0


def test_known_runs_are_shuffled_for_keys_of_several_parts_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    store = StateStore(spark, f"{tmp_path}/state")
    job = lambda i, tier, run: ("c", f"j{i}", "s", tier, run, "new_posting", "1", f"u{i}", [i, i + 1])
    for name, rows in (("r1", [job(i, 1, "r1") for i in range(8)]), ("r2", [job(7, 3, "r2"), job(8, 2, "r2")])):
        store.append(name, {"seen_jobs": spark.createDataFrame(rows, schemas.SEEN_JOBS)})
        store.commit(name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = store.whole("seen_jobs")
        plan = whole.where("job_id <> 'j7'")._jdf.queryExecution().executedPlan().toString().split("\n")
        assert sum("Exchange hashpartitioning" in x for x in plan) == 1 and "BroadcastHashJoin" in "".join(plan)
        assert sorted(whole.collect()) == sorted(store.load()["seen_jobs"].collect()) and whole.count() == 9
        assert whole.where("job_id = 'j7'").first()[3:5] == (3, "r1")
        assert StateStore(spark, f"{tmp_path}/none").whole("seen_jobs").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_verdicts_are_written_without_texts(spark, monkeypatch):
    """In buckets of job_id the rules' results meet the texts that are there already."""
    rows = [(f"j{i}", "s", "CUDA Intern", "Engineering", f"CUDA kernels {i}\nour shared line") for i in range(6)]
    plain = spark.createDataFrame(rows, "job_id string, source string, title string, department string, text string")
    full = classify.written_by(plain.repartition("job_id"), "job_id", "fetched")
    names = []
    monkeypatch.setattr(classify, "written_by", lambda df, key, name: names.append(df.columns) or written_by(df, key, name))
    got, want = classify.classify(full, DEFAULT, by_job=True), classify.classify(plain, DEFAULT)
    assert names and not {"text", "own_text", "title"} & set(names[0])
    order = sorted(want.columns)
    assert sorted(got.select(order).collect()) == sorted(want.select(order).collect()) and got.where("qualifies").count() == 6
