import json

from jobsieve import schemas
from jobsieve.sources import registry
from jobsieve.streaming import intake


def land(folder, name, rows, at="a"):
    (folder / name).mkdir(parents=True, exist_ok=True)
    (folder / name / f"{at}.json").write_text("\n".join(json.dumps(r) for r in rows))


def test_registry_and_landed_files(spark, tmp_path):
    land(tmp_path / "a", "listings", [{"source": "A", "native_id": "1", "title": "x"}, {"source": "A", "native_id": "2"}])
    (tmp_path / "sources.json").write_text(json.dumps([{"source": "A", "enabled": True, "path": f"file://{tmp_path}/a"}, {"source": "B", "enabled": True, "path": f"file://{tmp_path}/none"}, {"source": "C", "enabled": False}]))
    own = registry.load_registry(spark, f"file://{tmp_path}/sources.json")
    assert {r["source"] for r in own.collect()} == {"A", "B"}
    found = registry.scan_listings(spark, own)
    assert found.schema == schemas.LISTINGS and found.count() == 2
    assert registry.scan_details(spark, own).count() == 0 and registry.scan_status(spark, own).count() == 0
    assert registry.default_registry(spark, "/landing").count() == 9


def test_stream_hands_on_once(spark, tmp_path):
    rows = [{"source": "A", "native_id": str(i), "scanned_at": f"2026-01-0{1 + i}T00:00:00Z"} for i in range(4)]
    land(tmp_path, "in", rows + rows[:2])
    for extra in ([], rows[:1] + [{"source": "A", "native_id": "9", "scanned_at": "2026-01-09T00:00:00Z"}]):
        if extra:
            land(tmp_path, "in", extra, "b")
        intake.intake(intake.listing_stream(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/out", f"file://{tmp_path}/check").awaitTermination()
    ids = [r["native_id"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect()]
    assert sorted(ids) == ["0", "1", "2", "3", "9"]


def test_stream_equals_batch_on_closed_days(spark, tmp_path):
    rows = [{"source": "A", "native_id": str(i), "scanned_at": f"2026-01-{1 + i % 6:02d}T0{i % 9}:00:00Z"} for i in range(30)]
    land(tmp_path, "in", rows)
    query = intake.daily_counts(intake.listing_stream(spark, f"file://{tmp_path}/in")).writeStream.format("memory").queryName("daily_counts").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = {(r["day"].strftime("%d"), r["n"]) for r in spark.table("daily_counts").collect()}
    assert got and got <= {(f"{d:02d}", 5) for d in range(1, 7)}
