"""Postings derived from the driver's documents, and runs over them from landed files, for queries with SQL.

This belongs to the catalogue: the driver's tables hold no postings.  A document is a posting: its id picks a title, a department and a
line of requirements, every posting of a source has one paragraph in common, and some share a page with others.  The
first run is a baseline over a third of them with one source blocked, the second a daily run over all with another one blocked;
some details fail in each.  Every company lands in a folder of its own.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.time import run_id
from ..sinks.files import write_text
from ..sources import registry as R
from ..tables import new_path, table, written
from ..streaming.intake import gated_runs, listing_stream
from . import daily

TITLES = ("CUDA Intern", "Senior ML Engineer", "ML Intern", "vLLM New Grad", "Sales Intern, AI", "Marketing Intern", "Account Clerk", "IT Support Intern", "TensorRT-LLM Engineer", "HPC Engineer", "Kitchen Intern", "Data Scientist", "Junior MLOps [remote]|x", "Model Serving Engineer")
NEEDS = ("0-2 years of experience", "3+ years", "10 years of experience", "for 30 years we have built", "2 to 4 yrs", "more than 2 years of experience", "over 3 years of experience with CUDA", "a minimum of seven years experience", "up to 8 years", "entry level role, no CUDA needed", "AI inference on GPU systems. 1 year", "deep learning lab, 1 year", "robots and deep learning, graduate")
SHARED = "Join our AI company."
#: A source whose common paragraph doesn't name AI, and that paragraph.
PLAIN = ("src6", "Join our company.")
#: A paragraph that names one of some places.
EDITED = ("Our team in ", " builds AI systems that people all over the world trust with the work of every day.")
PLACES = ("Austin", "Boston", "Berlin", "Raleigh, North Carolina", "Zurich")
DAYS = (datetime(2026, 1, 5, 15, tzinfo=UTC), datetime(2026, 1, 6, 15, tzinfo=UTC))
RUNS = tuple(map(run_id, DAYS))
#: Of each day: the source that is blocked, and the divisor of ids whose details fail.
BLOCKED, FAILED = ("src7", "src9"), (11, 13)
_worlds: dict[tuple, str] = {}


def _pick(values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.col("doc_id") % len(values)).cast("int") + 1)


def listed(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, source, native_id, url, title, location, department, text) of every document."""
    i, site = F.col("doc_id"), F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.com/"))
    url = (
        F.when(i % 10 == 1, F.concat(F.lit("https://jobs.example.com/g"), F.floor(i / 40), F.lit("?utm_source=x")))  # a page of several sources
        .when(i % 10 == 2, F.concat(site, F.lit("job?lang=en&pid="), i, F.lit("&gclid=q")))  # jobs that the query tells apart
        .when(i % 10 == 3, F.concat(site, F.lit("#/job/"), i))  # or the fragment
        .when(i % 10 == 4, F.concat(site, F.lit("apply")))  # one page for all of a source
        .otherwise(F.concat(site, i, F.lit("?utm=1#top")))
    )
    title = F.when(F.col("doc_id") % 19 != 5, _pick(TITLES))
    department = F.when(F.col("doc_id") % 17 == 0, "Sales Operations").otherwise("Engineering")
    text = F.concat_ws("\n", "text", _pick(NEEDS), F.when(F.col("source") == PLAIN[0], PLAIN[1]).otherwise(SHARED))
    return table(spark, d, "documents").select("doc_id", "source", i.cast("string").alias("native_id"), url.alias("url"), title.alias("title"), F.lit("NY").alias("location"), department.alias("department"), text.alias("text"))


def with_edited(every: DataFrame) -> DataFrame:
    """every with a paragraph more in six of seven postings, which differs by place."""
    said = F.concat(F.lit(EDITED[0]), F.element_at(F.array(*map(F.lit, PLACES)), (F.col("doc_id") % len(PLACES)).cast("int") + 1), F.lit(EDITED[1]))
    return every.withColumn("text", F.concat_ws("\n", "text", F.when(F.col("doc_id") % 7 > 0, said)))


def postings(spark: SparkSession, d: str) -> DataFrame:
    """Written, so that identities are found once."""
    return written(R.identified(listed(spark, d)).withColumn("posted_at", F.lit(None).cast("timestamp")), "postings")


def land(spark: SparkSession, every: DataFrame, companies: list[str], root: str, k: int) -> None:
    """Day k's listings, details and status, each company's in its own folder, and the day's registry."""
    day, at = f"{root}/landing/day{k + 1}", DAYS[k]
    now = every.withColumn("scanned_at", F.lit(at)).where(F.lit(k == 1) | (F.col("doc_id") % 3 == 0))
    fetched = F.when(F.col("doc_id") % FAILED[k] == 0, "failed").otherwise("ok")
    now = now.withColumns({"fetch_status": fetched, "posted_at": F.col("scanned_at"), "of": F.col("source")})
    for name, schema in (("listings", schemas.LISTINGS), ("details", schemas.DETAILS)):
        now.select("of", *[f.name for f in schema]).write.option("compression", "gzip").partitionBy("of").json(f"{day}/{name}")
    state = [(c, c, "blocked" if c == BLOCKED[k] else "ok", None) for c in companies]
    spark.createDataFrame(state, "of string, source string, status string, error string").coalesce(1).write.partitionBy("of").json(f"{day}/status")
    write_text(spark, f"{root}/sources{k + 1}.json", json.dumps([{"source": c, "enabled": True, "path": f"{day}/{{name}}/of={c}"} for c in companies] + [{"source": "closed", "enabled": False, "path": day}]))
    write_text(spark, f"{root}/status{k + 1}.json", json.dumps({c: {"status": s, "run_id": RUNS[k]} for c, _, s, _ in state}))


#: Sources that land a line that is no record, a record of another source, and nothing.
TORN, FOREIGN, ABSENT = "src1", "src2", "src3"


def break_sources(spark: SparkSession, every: DataFrame) -> str:
    """The registry of sources that landed the listings of every, each in its own folder, some of them broken."""
    root = new_path(spark, "broken")
    now = every.withColumns({"scanned_at": F.lit(DAYS[0]), "of": F.col("source")}).select("of", *schemas.LISTINGS.names)
    now.where(F.col("source") != ABSENT).write.partitionBy("of").json(f"{root}/listings")
    write_text(spark, f"{root}/listings/of={TORN}/torn.json", '{"source": "src1", "native_id": "1')
    write_text(spark, f"{root}/listings/of={FOREIGN}/foreign.json", json.dumps({"source": "elsewhere", "native_id": "1"}))
    companies = sorted(r[0] for r in every.select("source").distinct().collect())  # a row per company
    write_text(spark, f"{root}/sources.json", json.dumps([{"source": c, "enabled": True, "path": f"{root}/{{name}}/of={c}"} for c in companies]))
    return f"{root}/sources.json"


def world(spark: SparkSession, d: str, days: int = 2, stream: bool = False) -> str:
    """The root folder of the first runs, made once in a session; as runs of a stream's batches if asked for."""
    key = (spark.sparkContext.applicationId, d, days, stream)
    if key in _worlds:
        return _worlds[key]
    root = new_path(spark, "runs")
    every = listed(spark, d)
    companies = sorted(r[0] for r in every.select("source").distinct().collect())  # a row per company
    for k, at in enumerate(DAYS[:days]):
        land(spark, every, companies, root, k)
        mode = "daily" if k else "baseline"
        known = R.load_registry(spark, f"{root}/sources{k + 1}.json")
        if stream:
            taken = listing_stream(spark, f"{root}/landing/*/listings/*")
            gated_runs(spark, taken, root, lambda known=known: known, f"{root}/checkpoint", mode=mode, send=lambda _: "sent").awaitTermination()
        else:
            daily.run(spark, root, known, R.scan_listings(spark, known), R.scan_details(spark, known), R.scan_status(spark, known), at, mode, send=lambda _: "sent")
    _worlds[key] = root
    return root
