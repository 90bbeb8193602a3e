"""Runs over several days: idempotence, failed sources, catch-up, duplicates, unresolved postings, reclassification."""

import json
from datetime import UTC, datetime, timedelta

import pytest

from jobsieve import schemas
from jobsieve.operators import discovery
from jobsieve.plans import daily
from jobsieve.rules import DEFAULT
from jobsieve.sinks import reports
from jobsieve.sources.state import StateStore, read_json_state
from jobsieve.streaming.intake import gated_runs, listing_stream

START = datetime(2026, 1, 5, 15, tzinfo=UTC)
TEXT = "CUDA kernels. 0-2 years."


class World:
    """A root folder, and runs a day apart with the listings given by (source, id)."""

    def __init__(self, spark, folder):
        self.spark, self.root, self.day, self.sent = spark, f"file://{folder}", 0, []
        self.registry = spark.createDataFrame([(s, True, None) for s in ("A", "B")], schemas.SOURCES)

    def run(self, jobs, status=None, mode="daily", send=True, details=None):
        at = START + timedelta(days=self.day)
        self.day += 1
        rows = [(s, i, url, title, "NY", at) for s, i, url, title, _ in jobs]
        listings = self.spark.createDataFrame(rows, schemas.LISTINGS)
        found = details if details is not None else [(s, i, url, title, "Eng", text, at, "ok") for s, i, url, title, text in jobs if text is not None]
        known = status or {"A": "ok", "B": "ok"}
        state = self.spark.createDataFrame([(s, x, None) for s, x in known.items()], schemas.SOURCE_STATUS)
        return daily.run(self.spark, self.root, self.registry, listings, self.spark.createDataFrame(found, schemas.DETAILS), state, at, mode, send=(lambda d: self.sent.append(d) or "sent") if send else None)

    def kinds(self, outcome):
        return {r["job_id"]: r["discovery_type"] for r in daily.read_back(self.spark, self.root, outcome.run_id).collect()}

    def text(self, outcome, name):
        with open(f"{outcome.folder.removeprefix('file://')}/{name}") as file:
            return file.read()


def job(source, i, title="CUDA Intern", text=TEXT, url=None):
    return (source, str(i), url or f"https://{source.lower()}.example.com/{i}", title, text)


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def test_baseline_then_new_then_nothing(world):
    first = world.run([job("A", 1), job("B", 2)], mode="baseline")
    assert not first.decision["should_notify"] and set(world.kinds(first).values()) == {"historical_baseline"}
    second = world.run([job("A", 1), job("B", 2), job("A", 3)])
    assert second.gated == 1 and second.decision["n_new"] == 1 and second.delivery["status"] == "sent"
    assert list(world.kinds(second).values()) == [discovery.NEW]
    third = world.run([job("A", 1), job("B", 2), job("A", 3)])
    assert third.gated == 0 and third.decision["n_new"] == 0 and third.delivery["status"] == "not_needed"
    assert json.loads(world.text(third, reports.DECISION))["should_notify"] is False
    assert "None." in world.text(third, reports.REPORT)
    assert len(world.sent) == 1


def test_blocked_source_then_catch_up(world, spark):
    world.run([job("A", 1), job("B", 2)], mode="baseline")
    before = {tuple(r) for r in StateStore(spark, f"{world.root}/state").load()["seen_source_jobs"].where("source = 'B'").collect()}
    blocked = world.run([job("A", 1), job("B", 9)], status={"A": "ok", "B": "blocked"})
    assert blocked.gated == 0 and "**B: blocked**" in world.text(blocked, reports.REPORT)
    assert {tuple(r) for r in StateStore(spark, f"{world.root}/state").load()["seen_source_jobs"].where("source = 'B'").collect()} == before
    back = world.run([job("A", 1), job("B", 2), job("B", 9)])
    assert list(world.kinds(back).values()) == ["catch_up"] and not back.decision["should_notify"]
    assert list(world.kinds(world.run([job("B", 10)])).values()) == [discovery.NEW]


def test_duplicates_alert_once(world):
    world.run([], mode="baseline")
    both = world.run([job("A", 1, url="https://x.example.com/j?utm=1"), job("B", 2, url="http://www.x.example.com/j")])
    assert sorted(world.kinds(both).values()) == ["duplicate_posting", discovery.NEW] and both.decision["n_new"] == 1
    later = world.run([job("B", 3, url="https://x.example.com/j")])
    assert later.decision["n_new"] == 0 and list(world.kinds(later).values()) == ["duplicate_posting"]


def test_jobs_that_the_query_or_fragment_tells_apart_all_alert(world):
    world.run([], mode="baseline")
    pages = ["https://careers.a.com/job?pid=1", "https://careers.a.com/job?pid=2", "https://careers.a.com/#/job/3", "https://careers.a.com/#/job/4"]
    out = world.run([job("A", i, url=u, text=f"CUDA kernels for team {i}. 0-2 years. Work on part {i} of it.") for i, u in enumerate(pages, 1)])
    assert out.decision["n_new"] == 4 and list(world.kinds(out).values()) == [discovery.NEW] * 4


def test_the_same_text_on_another_page_alerts_once(world):
    world.run([], mode="baseline")
    long = "CUDA kernels for inference at scale. 0-2 years of experience. " + " ".join(f"word{i}" for i in range(60))
    both = world.run([job("A", 1, text=long), job("B", 2, text=long.replace("word59", "other"))])
    assert sorted(world.kinds(both).values()) == ["duplicate_posting", discovery.NEW] and both.decision["n_new"] == 1
    later = world.run([job("B", 3, text=long.replace("word1 ", "some "))])
    assert list(world.kinds(later).values()) == ["duplicate_posting"]
    own = world.run([job("A", 4, text=long)])
    assert list(world.kinds(own).values()) == [discovery.NEW]  # two jobs of one source are two jobs


def test_state_is_a_log_of_deltas(world, spark, tmp_path):
    """What a run writes follows the run; a compaction changes no row; a death in it changes nothing."""
    store = StateStore(spark, f"{world.root}/state")
    pool = [job("AB"[i % 2], i, text=f"CUDA kernels {i}. 0-2 years. " + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(60)]
    world.run(pool, mode="baseline")
    size = lambda v: sum(f.stat().st_size for f in (tmp_path / "state/versions" / v).rglob("*.parquet") if f.stat().st_size)
    first = size(store.current())
    rows = lambda: {n: sorted(map(str, t.collect())) for n, t in store.load().items()}
    world.run(pool[:2])
    assert size(store.current()) < first / 2 and len(store.manifest()["deltas"]) == 2
    before = rows()
    few = StateStore(spark, f"{world.root}/state", compact_after=2, buckets=3)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(StateStore, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            few.compact()
    assert len(store.manifest()["deltas"]) == 2 and rows() == before
    assert few.compact() and store.manifest()["deltas"] == [] and rows() == before
    assert not few.compact()
    after = world.run([*pool[:2], job("A", 99)])
    assert after.gated == 1 and len(store.manifest()["deltas"]) == 1
    found = store.lookup("seen_source_jobs", store.load()["seen_source_jobs"].limit(5)).count()
    assert found == 5 and store.load()["seen_source_jobs"].count() == 61


def test_the_base_of_the_state_is_not_shuffled(world, spark):
    world.run([job("A", i) for i in range(20)], mode="baseline")
    store = StateStore(spark, f"{world.root}/state", compact_after=1, buckets=4)
    assert store.compact()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        listed = spark.createDataFrame([(f"x{i}",) for i in range(50)], "job_id string").repartition(3)
        for df in (store.without("seen_source_jobs", listed, "status = 'resolved'"), store.lookup("seen_source_jobs", listed)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            scan = plan[: plan.index("Bucketed: true")].splitlines()
            assert "SelectedBucketsCount: 4 out of 4" in plan
            join = max(i for i, line in enumerate(scan) if "Join" in line)
            assert not any("Exchange" in line for line in scan[join + 1 :] if "listed" in line) and sum("Exchange" in line for line in scan[join:]) <= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_stream_of_runs_equals_the_runs(world, spark, tmp_path, monkeypatch):
    """Batches killed between their rows and the commit, or after it, and replayed."""
    days = [[job("A", 1), job("B", 2)], [job("A", 1), job("B", 2), job("A", 3), job("B", 4, "Senior Cook", "no")], [job("B", 5, text=None), job("A", 3)]]
    registry = spark.createDataFrame([("A", True, f"file://{tmp_path}/land/a"), ("B", True, f"file://{tmp_path}/land/b")], schemas.SOURCES)
    root, sent = f"file://{tmp_path}/streamed", []

    def land(day, name, rows):
        for s, own in rows.items():
            folder = tmp_path / "land" / s.lower() / name
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{day}.json").write_text("\n".join(json.dumps(r) for r in own))

    def take(mode):
        stream = listing_stream(spark, f"file://{tmp_path}/land/*/listings")
        query = gated_runs(spark, stream, root, lambda: registry, f"file://{tmp_path}/checkpoint", mode=mode, send=lambda d: sent.append(d) or "sent")
        query.awaitTermination()

    for day, jobs in enumerate(days):
        at = (START + timedelta(days=day)).isoformat().replace("+00:00", "Z")
        of = lambda rows: {s: [x for x in rows if x["source"] == s] for s in "AB"}
        land(day, "listings", of([{"source": s, "native_id": i, "url": u, "title": t, "location": "NY", "scanned_at": at} for s, i, u, t, _ in jobs]))
        land(day, "details", of([{"source": s, "native_id": i, "url": u, "title": t, "department": "Eng", "text": x, "posted_at": at, "fetch_status": "ok"} for s, i, u, t, x in jobs if x is not None]))
        land(0, "status", {s: [{"source": s, "status": "ok"}] for s in "AB"})
        mode = "daily" if day else "baseline"
        want = world.run(jobs, mode=mode)
        for dies in (["commit"] if day == 1 else ["deliver"] if day == 2 else []):
            with monkeypatch.context() as m:
                gone = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed"))
                m.setattr(StateStore, "commit", gone) if dies == "commit" else m.setattr(StateStore, "compact", gone)
                with pytest.raises(Exception, match="killed"):
                    take(mode)
        take(mode)
        take(mode)  # nothing new has landed
        store = StateStore(spark, f"{root}/state")
        assert store.committed_batch("s") == day
        stored = daily.read_run(spark, root, f"{want.run_id}-s{day}").select("job_id", "qualifies", "tier", "rank", "discovery_type").collect()
        batch = daily.read_run(spark, world.root, want.run_id).select("job_id", "qualifies", "tier", "rank", "discovery_type").collect()
        assert sorted(map(str, stored)) == sorted(map(str, batch))
        plain = lambda s: sorted((r["job_id"], r["status"], r["attempts"], r["baseline"], r["late"]) for r in s.load()["seen_source_jobs"].collect())
        assert plain(store) == plain(StateStore(spark, f"{world.root}/state"))
    assert len(sent) == len(world.sent) == 1


def test_unresolved_is_tried_again_and_alerts_once(world, spark):
    world.run([], mode="baseline")
    assert world.run([job("A", 1, text=None)]).gated == 1
    assert StateStore(spark, f"{world.root}/state").load()["seen_source_jobs"].first()["status"] == "unresolved"
    found = world.run([job("A", 1)])
    assert found.gated == 1 and found.decision["n_new"] == 1
    row = StateStore(spark, f"{world.root}/state").load()["seen_source_jobs"].first()
    assert (row["status"], row["attempts"]) == ("resolved", 2)
    assert world.run([job("A", 1)]).gated == 0


def test_rejected_jobs_are_not_opened_again(world):
    world.run([], mode="baseline")
    assert world.run([job("A", 1, "Senior Cook", "no")]).decision["n_new"] == 0
    assert world.run([job("A", 1, "Senior Cook", "no")]).gated == 0


def test_reports_trace_to_listings_in_order(world):
    world.run([], mode="baseline")
    out = world.run([job("A", 1, "ML Intern"), job("B", 2, "vLLM Intern [x](y)|"), job("A", 3, "CUDA Intern"), job("A", 3, "CUDA Intern")])
    lines = [x for x in world.text(out, reports.REPORT).splitlines() if x.startswith("- **P")]
    assert [x[:7] for x in lines] == ["- **P1*", "- **P2*", "- **P2*"] and "vLLM Intern \\[x\\]\\(y\\)\\|" in lines[0]
    assert len([x for x in world.text(out, reports.SHORTLIST).splitlines() if x.startswith("- **P")]) == 3
    ranks = [r["rank"] for r in daily.read_back(world.spark, world.root, out.run_id).collect()]
    assert ranks == [1, 2, 3]


def test_reclassify_moves_tiers_and_never_alerts(world, spark):
    world.run([], mode="baseline")
    out = world.run([job("A", 1), job("B", 2, "ML Intern", "MLOps. 1 year.")])
    sent = len(world.sent)
    name, diff = daily.reclassify(spark, world.root, out.run_id, DEFAULT.with_version("2", demoted=("cuda",)))
    assert name == f"{out.run_id}-reclassified" and [(r["old_tier"], r["new_tier"]) for r in diff.collect()] == [(2, 4)]
    assert len(world.sent) == sent and not reports.read_json(spark, f"{world.root}/runs/{name}/{reports.DECISION}")["should_notify"]
    assert {r["tier"] for r in StateStore(spark, f"{world.root}/state").load()["seen_jobs"].collect()} == {3, 4}
    assert world.run([job("A", 1), job("B", 2, "ML Intern", "MLOps. 1 year.")]).gated == 0


def test_crash_before_commit_leaves_the_old_state(world, monkeypatch):
    world.run([], mode="baseline")
    with monkeypatch.context() as m:
        m.setattr(StateStore, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            world.run([job("A", 1)])
    assert not world.sent
    assert world.run([job("A", 1)]).decision["n_new"] == 1 and len(world.sent) == 1


def test_delivery_is_at_most_once(world, spark):
    world.run([], mode="baseline")
    out = world.run([job("A", 1)])
    assert reports.deliver(spark, out.folder, lambda d: world.sent.append(d))["status"] == "sent" and len(world.sent) == 1
    started = out.delivery | {"status": "started"}
    reports.write_json(spark, f"{out.folder}/{reports.DELIVERY}", started)
    assert reports.deliver(spark, out.folder, lambda d: world.sent.append(d))["status"] == "unknown" and len(world.sent) == 1

    def broken(_):
        raise OSError("no route")

    other = world.run([job("A", 2)], send=False)
    assert other.delivery["status"] == "no_channel"
    reports.write_json(spark, f"{other.folder}/{reports.DELIVERY}", other.delivery | {"status": "unsent"})


@pytest.mark.parametrize(
    ("text", "want"),
    [(None, 0), ("", 0), ('[{"job_id":"a","status":"resolved"}]', 1), ('{"a":{"status":"resolved"},"b":{"status":"unresolved"}}', 2)],
)
def test_json_state(spark, tmp_path, text, want):
    if text is not None:
        (tmp_path / "s.json").write_text(text)
    rows = read_json_state(spark, f"file://{tmp_path}/s.json", schemas.SEEN_SOURCE_JOBS, "job_id").collect()
    assert len(rows) == want and all(r["job_id"] in ("a", "b") for r in rows)


def test_truncated_json_state_raises(spark, tmp_path):
    (tmp_path / "s.json").write_text('[{"job_id":"a","status":"resol')
    with pytest.raises(Exception):
        read_json_state(spark, f"file://{tmp_path}/s.json", schemas.SEEN_SOURCE_JOBS, "job_id").collect()


def test_bad_mode(world):
    with pytest.raises(ValueError):
        world.run([], mode="weekly")


def test_random_days(world, spark):
    """Each job alerts at most once, known identities never vanish, all that is reported was listed, in any order."""
    import random

    r = random.Random(8)
    pool = [job(r.choice("AB"), i, r.choice(["CUDA Intern", "ML Intern", "Senior Cook"]), r.choice([TEXT, None])) for i in range(14)]
    listed, known, alerted = set(), set(), []
    for day in range(4):
        today = r.sample(pool, 9)
        status = {"A": "ok", "B": r.choice(["ok", "blocked"])}
        out = world.run(today, status=status, mode="daily" if day else "baseline")
        listed |= {(s, i) for s, i, *_ in today if status[s] == "ok"}
        stored = daily.read_back(spark, world.root, out.run_id).collect()
        assert {(x["source"], x["url"].rsplit("/", 1)[1]) for x in stored} <= listed
        now = {x["job_id"] for x in StateStore(spark, f"{world.root}/state").load()["seen_source_jobs"].collect()}
        assert known <= now and len(now) == len(listed)
        known = now
        fresh = [x["job_id"] for x in stored if x["discovery_type"] == discovery.NEW]
        assert out.decision["n_new"] == len(fresh)
        alerted += fresh
    assert len(alerted) == len(set(alerted))


def test_order_of_rows_does_not_matter(spark, tmp_path_factory):
    jobs = [job("A", 1, url="https://x.example.com/1"), job("B", 2, url="https://x.example.com/1"), job("A", 3, "ML Intern"), job("B", 4, "vLLM Intern")]
    seen = []
    for rows in (jobs, jobs[::-1]):
        w = World(spark, tmp_path_factory.mktemp("order"))
        w.run([], mode="baseline")
        seen.append(w.text(w.run(rows), reports.REPORT))
    assert seen[0] == seen[1]


def test_a_catch_up_stays_one_when_its_details_fail_first(world, spark):
    world.run([job("A", 1), job("B", 2)], mode="baseline")
    world.run([job("A", 1)], status={"A": "ok", "B": "blocked"})
    assert world.run([job("B", 9, text=None)]).gated == 1
    back = world.run([job("B", 9)])
    assert list(world.kinds(back).values()) == ["catch_up"] and not back.decision["should_notify"] and not world.sent


def test_a_newly_qualifying_job_is_known_from_then_on(world, spark):
    world.run([], mode="baseline")
    out = world.run([job("A", 1, "Rust Intern", "Rust. 1 year.", url="https://x.example.com/j")])
    assert not out.decision["should_notify"]
    wider = DEFAULT.with_version("2", relevance=(*DEFAULT.relevance, "rust"))
    _, diff = daily.reclassify(spark, world.root, out.run_id, wider)
    assert [(r["old_tier"], r["new_tier"]) for r in diff.collect()] == [(None, 4)]
    with pytest.raises(ValueError):
        daily.reclassify(spark, world.root, out.run_id, wider)
    later = world.run([job("B", 7, "CUDA Intern", url="https://x.example.com/j")])
    assert list(world.kinds(later).values()) == ["duplicate_posting"] and not later.decision["should_notify"] and not world.sent
