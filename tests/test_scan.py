"""Sources that fail alone: torn, foreign, unreadable and absent ones beside those that can be read."""

import gzip
import json
from datetime import UTC, datetime, timedelta

import pytest

from jobsieve import schemas
from jobsieve.plans import daily
from jobsieve.sources import registry
from jobsieve.sources.state import StateStore

AT = datetime(2026, 1, 5, 15, tzinfo=UTC)


def land(folder, rows, name="listings", at="a"):
    (folder / name).mkdir(parents=True, exist_ok=True)
    (folder / name / f"{at}.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in rows))


def known(spark, **paths):
    return spark.createDataFrame([(s, True, None if p is None else f"file://{p}") for s, p in paths.items()], schemas.SOURCES)


def job(source, i, **more):
    return {"source": source, "native_id": str(i), "title": "ML intern", **more}


@pytest.fixture
def landed(spark, tmp_path):
    root = tmp_path / "with space"
    land(root / "A", [job("A", 1), job("A", 1), job("A", 2)])
    land(root / "B", [job("B", 1), '{"source": "B", "nat'])
    land(root / "C", [job("C", 1), job("A", 9)])
    land(root / "D", [job("D", 1), {"source": "D", "native_id": " ", "title": "x"}])
    land(root / "E", [])
    land(root / "F", [job("F", 1)])
    whole = gzip.compress("\n".join(json.dumps(job("F", i)) for i in range(5000)).encode())
    (root / "F" / "listings" / "b.json.gz").write_bytes(whole[: len(whole) // 2])
    land(root / "shared", [job("G", 1), job("H", 1)])
    return root, known(spark, **{s: root / s for s in "ABCDEF"}, G=root / "shared", H=root / "shared", I=root / "none", J=None)


def test_each_source_fails_alone(spark, landed):
    rows, status = registry.scan_sources(spark, landed[1])
    assert rows.schema == schemas.LISTINGS
    assert sorted((r["source"], r["native_id"]) for r in rows.collect()) == [("A", "1"), ("A", "1"), ("A", "2"), ("G", "1"), ("H", "1")]
    got = {r["source"]: (r["status"], r["error"]) for r in status.collect()}
    assert {s: v[0] for s, v in got.items()} == {"A": "ok", "B": "blocked", "C": "blocked", "D": "blocked", "E": "ok", "F": "blocked", "G": "ok", "H": "ok", "I": "unavailable", "J": "unavailable"}
    assert got["B"][1].startswith("a line is no record") and got["C"][1].startswith("a record of another source")
    assert got["D"][1].startswith("a record without an identity") and got["F"][1].startswith("unreadable")


def test_no_source_at_all(spark):
    rows, status = registry.scan_sources(spark, known(spark, A=None))
    assert rows.schema == schemas.LISTINGS and not rows.count()
    assert [tuple(r) for r in status.collect()] == [("A", "unavailable", "no landed folder")]


def test_worse_status(spark):
    own = lambda *rows: spark.createDataFrame(list(rows), schemas.SOURCE_STATUS)
    got = registry.worse_status(own(("a", "ok", None), ("b", "blocked", "x"), ("c", "ok", None)), own(("a", "ok", None), ("b", "ok", None), ("c", "unavailable", "y")))
    assert sorted(map(tuple, got.collect())) == [("a", "ok", None), ("b", "blocked", "x"), ("c", "unavailable", "y")]


def test_a_run_goes_on_without_broken_sources(spark, landed, tmp_path):
    root, sources = landed
    for s in "AB":
        land(root / s, [job(s, i, text="CUDA", fetch_status="ok") for i in (1, 2)], "details")
    land(root / "G", [], "details")
    land(root / "shared", [job("G", 1, text="CUDA"), "{"], "details")
    at = f"file://{tmp_path}/root"
    daily.run_landed(spark, at, sources, AT, send=lambda _: "sent")
    state = StateStore(spark, f"{at}/state").load()
    assert sorted((r["source"], r["status"]) for r in state["seen_source_jobs"].collect()) == [("A", "resolved"), ("A", "resolved"), ("G", "unresolved"), ("H", "unresolved")]
    health = {r["source"]: r["status"] for r in state["source_status"].collect()}
    assert health["B"] == "blocked" and health["A"] == "ok" and health["I"] == "unavailable"
    # the next day B is mended: its jobs may be old, and those of A that weren't there are new
    land(root / "A", [job("A", i) for i in (1, 2, 3)])
    land(root / "A", [job("A", 3, text="GPU", fetch_status="ok")], "details", "b")
    land(root / "B", [job("B", 1)])
    later = daily.run_landed(spark, at, sources, AT + timedelta(days=1), send=lambda _: "sent")
    found = {r["source"]: r["discovery_type"] for r in daily.read_back(spark, at, later.run_id).collect()}
    assert found == {"A": "new_posting", "B": "catch_up"} and later.decision["n_new"] == 1
