"""Reports in Markdown, and the notification documents in JSON."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import markdown
from .files import read_text, write_lines, write_text

REPORT, SHORTLIST, NEW_JOBS = "report.md", "priority_shortlist.md", "new_jobs.md"
DECISION, DELIVERY = "notification.json", "notification_delivery.json"


def rendered(found: DataFrame) -> DataFrame:
    """(rank, line): a list item per posting, its title and fields as literal text."""
    where = F.concat_ws(", ", F.col("source"), F.nullif(F.coalesce(F.col("location"), F.lit("")), F.lit("")))
    line = F.concat(F.lit("- **P"), F.col("tier"), F.lit("** "), markdown(F.col("title")), F.lit(" ("), markdown(where), F.lit("), "), F.col("discovery_type"), F.lit(" `"), F.col("job_id"), F.lit("`"))
    return found.select("rank", line.alias("line"))


def _sources(health: list) -> Iterator[str]:
    yield "\n## Sources\n\n"
    bad = [h for h in health if h["status"] != "ok"]
    for h in bad:
        yield f"- **{h['source']}: {h['status']}**, not scanned; its postings are unknown{': ' + h['error'] if h['error'] else ''}\n"
    for h in health:
        if h["status"] == "ok":
            yield f"- {h['source']}: ok, {h['n']} listings\n"


def write_report(spark: SparkSession, path: str, title: str, found: DataFrame, health: list | None = None, counts: list | None = None) -> None:
    """Writes the postings in the order of rank, a partition at a time, and the state of the sources."""

    def lines() -> Iterator[str]:
        yield f"# {title}\n\n"
        n = 0
        for row in rendered(found).orderBy("rank").toLocalIterator():
            n += 1
            yield row["line"] + "\n"
        if not n:
            yield "None.\n"
        if counts:
            yield "\n## Counts\n\n| source | tier | n |\n| --- | --- | --- |\n"
            yield from (f"| {c['source']} | {c['tier']} | {c['n']} |\n" for c in counts)
        if health is not None:
            yield from _sources(health)

    write_lines(spark, path, lines())


def decision_document(run_id: str, n_new: int, digest: str | None) -> dict:
    """The decision of a run: how many new jobs it has, and where they are listed; the notification's id follows the run and a
    digest of the new jobs' ids."""
    return {"notification_id": hashlib.md5(f"{run_id}|{n_new}|{digest or ''}".encode()).hexdigest(), "run_id": run_id, "should_notify": n_new > 0, "n_new": n_new, "listed_in": NEW_JOBS}


def write_json(spark: SparkSession, path: str, document: dict) -> None:
    write_text(spark, path, json.dumps(document, indent=2, sort_keys=True) + "\n")  # nulls are kept


def read_json(spark: SparkSession, path: str) -> dict | None:
    found = read_text(spark, path)
    return None if found is None else json.loads(found)


def deliver(spark: SparkSession, folder: str, send, now: datetime | None = None) -> dict:
    """Sends the decision in folder at most once and records what became of it.

    ``send`` gets the decision and returns a status.  That an attempt began is written before it is made, so after a
    crash between the two the status is ``unknown`` and nothing is sent again.
    """
    known, decision = read_json(spark, f"{folder}/{DELIVERY}"), read_json(spark, f"{folder}/{DECISION}")
    record = {"notification_id": decision["notification_id"], "status": None, "attempted_at": None, "error": None}
    if known and known["status"] != "started":
        return known
    if known:
        record = known | {"status": "unknown"}
    elif not decision["should_notify"] or send is None:
        record["status"] = "not_needed" if not decision["should_notify"] else "no_channel"
    else:
        record |= {"status": "started", "attempted_at": (now or datetime.now(UTC)).isoformat()}
        write_json(spark, f"{folder}/{DELIVERY}", record)
        try:
            record["status"] = str(send(decision) or "sent")
        except Exception as failed:  # whatever the channel raises is the delivery's status
            record |= {"status": "failed", "error": str(failed)}
    write_json(spark, f"{folder}/{DELIVERY}", record)
    return record
