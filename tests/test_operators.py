import random

import pytest
from pyspark.sql import functions as F

from jobsieve.operators import classify, discovery, gate, health, merge, rank
from jobsieve.rules import DEFAULT


def posting(spark, *rows):
    return spark.createDataFrame([(f"j{i}", "s", *r) for i, r in enumerate(rows)], "job_id string, source string, title string, department string, text string")


def reasons(spark, *rows):
    got = classify.classify(posting(spark, *rows)).select("job_id", "reject_reason", "tier").collect()
    return [(r["reject_reason"], r["tier"]) for r in sorted(got, key=lambda r: int(r["job_id"][1:]))]


def test_tiers_and_first_match(spark):
    got = reasons(spark, ("Intern, TensorRT-LLM", None, ""), ("Intern, TensorRT", None, ""), ("Intern, CUDA and vLLM", None, ""), ("Intern, MLOps", None, ""), ("Intern, deep learning", None, ""))
    assert got == [(None, 1), (None, 2), (None, 1), (None, 3), (None, 4)]


def test_exclusions(spark):
    got = reasons(
        spark,
        ("Senior ML Engineer", None, "new grad"),
        ("ML Intern", None, "work with senior engineers"),
        ("Sales Intern, AI", None, ""),
        ("AI Intern", "Marketing", ""),
        ("Intern", None, "maintain email systems"),
        ("Network Engineer Intern", None, "for the deep learning team"),
        ("ML Engineer", None, "10 years of experience"),
        ("Statistical analyst intern", None, "ai inference"),
    )
    assert [r for r, _ in got] == ["senior", None, "sales", "marketing", "relevance", "infrastructure", "experience", None]
    assert got[-1][1] == 1


def test_boilerplate(spark):
    common = "We are an AI company."
    got = reasons(spark, *[("Payroll intern", None, f"{common}\nWork {i} on payroll.") for i in range(4)], ("Payroll intern", None, common), ("CUDA intern", None, f"{common}\nKernels."))
    assert [r for r, _ in got] == ["boilerplate"] * 5 + [None]


def test_nulls_keep_rows(spark):
    got = reasons(spark, (None, None, None), ("", "", ""))
    assert [r for r, _ in got] == ["experience", "experience"]


def test_gate(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "job_id string")
    seen = spark.createDataFrame([("a", "resolved"), ("b", "unresolved")], "job_id string, status string")
    assert {r[0] for r in gate.gated(listed, seen).collect()} == {"b", "c"}
    assert {r[0] for r in gate.unseen(listed, seen).collect()} == {"c"}
    assert {(r[0], r[1]) for r in gate.with_reason(listed, seen).collect()} == {("b", "unresolved"), ("c", "unseen")}


def test_gate_is_an_anti_join(spark):
    listed = spark.createDataFrame([("a",)], "job_id string")
    seen = spark.createDataFrame([("a", "resolved")], "job_id string, status string")
    assert "LeftAnti" in gate.gated(listed, seen)._jdf.queryExecution().optimizedPlan().toString()


def test_duplicates_do_not_depend_on_order(spark):
    rows = [(f"k{i % 3}", i) for i in range(12)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = sorted(tuple(r) for r in rank.keep_first(spark.createDataFrame(rows, "k string, i int"), "k", ["i"]).collect())
        assert want in (None, got)
        want = got
    assert want == [("k0", 0), ("k1", 1), ("k2", 2)]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_global_rank(spark, n):
    values = list(range(n))
    random.Random(1).shuffle(values)
    got = rank.global_rank(spark.createDataFrame([(v,) for v in values], "v int").repartition(5), [F.col("v").desc()]).collect()
    assert {(r["v"], r["rank"]) for r in got} == {(v, n - v) for v in values}


def test_discovery_order(spark):
    t, f = True, False
    rows = [(t, t, t, t), (f, t, t, t), (f, f, t, t), (f, f, f, t), (f, f, f, f), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean, d boolean")
    got = [r[0] for r in df.select(discovery.discovery_type(*map(F.col, "abcd"))).collect()]
    assert got == ["duplicate_posting", "previously_processed", "historical_baseline", "catch_up", "new_posting", "new_posting"]


def test_decision_of_nothing(spark):
    got = discovery.decision(spark.createDataFrame([], "discovery_type string")).collect()
    assert [tuple(r) for r in got] == [(0, False)]


def test_merged_state(spark):
    rows = [("a", "S", "resolved", 1, "r1", "r1", True, False, 0), ("a", "S", "unresolved", 1, "r2", "r2", False, False, 1), ("b", "S", "unresolved", 1, "r1", "r1", False, True, 0), ("b", "S", "unresolved", 2, "r3", "r3", False, False, 2)]
    df = spark.createDataFrame(rows, "job_id string, source string, status string, attempts int, first_seen_run string, last_seen_run string, baseline boolean, late boolean, _part int")
    assert {tuple(r) for r in merge.merged_seen(df).collect()} == {("a", "S", "resolved", 2, "r1", "r2", True, False), ("b", "S", "unresolved", 3, "r1", "r3", False, True)}
    jobs = spark.createDataFrame([("a", 2, "r1", "1", 0), ("a", 4, "r9", "2", 3)], "job_id string, tier int, first_seen_run string, rules_version string, _part int")
    assert [r.asDict() for r in merge.merged_jobs(jobs).collect()] == [{"job_id": "a", "first_seen_run": "r1", "tier": 4, "rules_version": "2"}]


def test_failed_is_not_empty(spark):
    registry = spark.createDataFrame([("a",), ("b",), ("c",)], "source string")
    status = spark.createDataFrame([("a", "ok", None), ("b", "blocked", "403")], "source string, status string, error string")
    counts = spark.createDataFrame([("b", 7)], "source string, n long")
    assert {tuple(r) for r in health.source_health(registry, status, counts).collect()} == {("a", "ok", 0, None), ("b", "blocked", None, "403"), ("c", "not_run", None, None)}


def test_rules_are_data():
    assert DEFAULT.with_version("2", most_years=3).version == "2" and DEFAULT.most_years == 5
