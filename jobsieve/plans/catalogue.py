"""The query catalogue: each operation of the engine over the driver's tables, and SQL that gives the same rows.

The driver's tables hold no postings.  Some queries are stand-ins of the same plan: documents for postings, their
source for the company, labels for state, pages for links, events for sightings.  The others run the engine's own rules,
runs and files over postings derived from documents (``postings``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import time as S
from ..operators import classify, discovery, gate, health, likeness, merge, rank
from ..rules import DEFAULT
from ..sinks import files, reports
from ..sources import registry
from ..sources.state import StateStore, read_json_state, read_run
from ..streaming.intake import intake, listing_stream
from ..tables import new_path, table, written
from .. import schemas
from . import daily, postings

#: Stand-in terms of the tiers, frequent in the invented prose.
STAND_IN = DEFAULT.with_version("catalogue", tiers={1: ("that", "thereof", "der"), 2: ("with", "nicht"), 3: ("the", "la", "sch")})
REPORT = 3  # tiers that a report has


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def _tier() -> Column:
    return classify.tier(F.col("text"), STAND_IN).cast("int")


def _status() -> Column:
    return F.when(F.col("quality") == 1, gate.RESOLVED).otherwise(gate.UNRESOLVED).alias("status")


def _state(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select("doc_id", _status())


def source_registry(spark, d):
    return _docs(spark, d).groupBy("source").agg(F.count("*").alias("n"))


def listing_scan(spark, d):
    return _docs(spark, d).select("doc_id", "source", "lang", "n_chars")


def job_identity(spark, d):
    host = X.host(F.col("url"))
    return table(spark, d, "pages").select("page_id", host.alias("host"), F.md5(F.concat_ws("|", host, X.canonical_url(F.col("url")))).alias("job_id"))


def unseen_anti_join(spark, d):
    return gate.unseen(_docs(spark, d).select("doc_id", "source"), _state(spark, d), "doc_id")


def unseen_or_unresolved(spark, d):
    return gate.with_reason(_docs(spark, d).select("doc_id", "source"), _state(spark, d), "doc_id")


def detail_fetch(spark, d):
    docs = _docs(spark, d)
    gated = gate.gated(docs.select("doc_id"), _state(spark, d), "doc_id")
    return gate.fetch(gated, docs, "doc_id").select("doc_id", "n_chars", F.md5("text").alias("text_md5"))


def _classified(spark, d) -> DataFrame:
    return classify.classify(postings.postings(spark, d))


def posting_identity(spark, d):
    return postings.postings(spark, d).select("doc_id", "job_id", "url_key")


def years_asked(spark, d):
    years = X.years_asked(F.concat_ws("\n", "title", "text"))
    return postings.listed(spark, d).select("doc_id", years.alias("asked")).select("doc_id", F.col("asked.least").alias("years"), F.col("asked.most").alias("most_years"))


def experience_filter(spark, d):
    return postings.listed(spark, d).where(classify.early_career(F.col("title"), F.col("text"))).select("doc_id", "source")


def relevance_filter(spark, d):
    return postings.listed(spark, d).where(classify.relevant(F.concat_ws("\n", "title", "text"))).select("doc_id", "source")


def alike_postings(spark, d):
    """Pairs of different texts that are alike, each by its first posting."""
    own = postings.listed(spark, d).select("doc_id", likeness.runs_of(F.concat_ws("\n", "title", "text")).alias("runs"))
    own = written(own.withColumn("class", likeness.class_of(F.col("runs"))), "runs")
    first = own.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    pairs = likeness.alike(likeness.classes(own))
    one, two = (first.select(F.col("class").alias(x), F.col("doc_id").alias(f"doc_{x}")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b")
    return both.select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"))


def duplicate_jobs(spark, d):
    """Jobs that another source lists too, on the same page or with a text that is alike."""
    known = spark.createDataFrame([], schemas.SEEN_JOBS).select(daily.KNOWN)
    return likeness.mark_duplicates(_classified(spark, d).where("qualifies"), known).select("job_id", "source", "canonical_id", "duplicate")


def own_text(spark, d):
    return classify.without_boilerplate(postings.postings(spark, d)).select("doc_id", F.md5("own_text").alias("own_md5"))


def classified(spark, d):
    return _classified(spark, d).select("doc_id", "qualifies", "reject_reason", "tier", "fit_score", "rules_version")


#: Rules that see through edits of boilerplate.
EDITS = DEFAULT.with_version("edits", boilerplate_percent=60)


def edited_boilerplate(spark, d):
    """Postings with a paragraph that names a place, another one in each fifth of them, classified by rules that see through it."""
    own = registry.identified(postings.with_edited(postings.listed(spark, d)))
    return classify.classify(own, EDITS).select("doc_id", F.md5("own_text").alias("own_md5"), "reject_reason", "tier", "fit_score")


def exclusion_filter(spark, d):
    return _classified(spark, d).where(F.col("reject_reason").isin("senior", "sales", "marketing", "infrastructure", "boilerplate")).select("doc_id", "reject_reason")


def boilerplate_strip(spark, d):
    docs = _docs(spark, d)
    lines = docs.select("doc_id", "source", F.explode(F.split(X.text(F.col("text")), "\n")).alias("para")).withColumn("para_id", F.md5("para"))
    left = classify.without_common(lines, classify.common_paragraphs(lines, "doc_id", "source", 3), "source")
    kept = left.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("para")).alias("n_left"))
    zero = F.lit(0)
    return docs.select("doc_id").join(kept, "doc_id", "left").select("doc_id", F.coalesce("n_lines", zero).cast("long").alias("n_lines"), F.coalesce("n_left", zero).cast("long").alias("n_left"))


def priority_tier(spark, d):
    return _docs(spark, d).groupBy(_tier().alias("tier")).agg(F.count("*").alias("n"))


def _tiered(spark, d) -> DataFrame:
    return _docs(spark, d).select("doc_id", "source", "lang", "n_chars", _tier().alias("tier"))



def _order() -> list[Column]:
    return [F.col("tier").asc(), F.col("n_chars").desc(), F.col("doc_id").asc()]


def rank_by_fit(spark, d):
    good = _classified(spark, d).where("qualifies").select("doc_id", "tier", "fit_score", "job_id")
    return rank.global_rank(good, [F.col("tier").asc(), F.col("fit_score").desc(), F.col("job_id").asc()]).select("doc_id", "tier", "fit_score", "rank")


def top_per_source(spark, d):
    return rank.top_per_group(_tiered(spark, d).select("doc_id", "source", "tier", "n_chars"), "source", _order(), 3)


def _keyed(spark, d) -> DataFrame:
    return _docs(spark, d).select("doc_id", "source", F.md5(F.lower("text")).alias("text_key"))


def dedup_keep_first(spark, d):
    return rank.keep_first(_keyed(spark, d).select("doc_id", "text_key"), "text_key", ["doc_id"])


def duplicate_groups(spark, d):
    return rank.duplicate_groups(_keyed(spark, d), "text_key")


def _discovered(spark, d) -> DataFrame:
    docs = _docs(spark, d).select("doc_id", "source", _tier().alias("tier"), F.md5(F.lower("text")).alias("text_key"))
    known = table(spark, d, "labels").select("doc_id", F.lit(True).alias("known"))
    marked = rank.mark_duplicates(docs, "text_key", ["doc_id"]).join(known, "doc_id", "left")
    kind = discovery.discovery_type(F.col("duplicate"), F.col("known"), F.col("doc_id") < 100, F.lit(False))
    return marked.select("doc_id", "source", "tier", kind.alias("discovery_type"))


def discovery_type(spark, d):
    return _discovered(spark, d).groupBy("discovery_type").agg(F.count("*").alias("n"))


def notify_decision(spark, d):
    return discovery.decision(_discovered(spark, d))


def report(spark, d):
    return _tiered(spark, d).where(F.col("tier") <= REPORT).groupBy("source", "tier").agg(F.count("*").alias("n"))


def priority_shortlist(spark, d):
    return _tiered(spark, d).where(F.col("tier") <= 2).select("doc_id", "source", "tier")


def new_jobs(spark, d):
    return _discovered(spark, d).where((F.col("tier") <= REPORT) & (F.col("discovery_type") == discovery.NEW)).select("doc_id", "source", "tier")


def source_health(spark, d):
    docs = _docs(spark, d)
    per = table(spark, d, "labels").join(docs.select("doc_id", "source"), "doc_id").where("source <> 'src7'").groupBy("source").agg(F.count("*").alias("n"), (F.sum("toxic") * 100 >= 15 * F.count("*")).alias("bad"))
    status = per.select("source", F.when(F.col("bad"), "blocked").otherwise("ok").alias("status"), F.lit(None).cast("string").alias("error"))
    return health.source_health(docs, status, per).select("source", "status", "n")


def state_merge(spark, d):
    job, no = F.col("doc_id").cast("string").alias("job_id"), F.lit(False)
    old = table(spark, d, "labels").select(job, F.lit("old").alias("source"), _status(), F.lit(1).alias("attempts"), F.lit("r1").alias("first_seen_run"), F.lit("r1").alias("last_seen_run"), F.lit(True).alias("baseline"), no.alias("late"))
    new = _docs(spark, d).where("n_chars < 2000").select(job, "source", F.lit(gate.UNRESOLVED).alias("status"), F.lit(1).alias("attempts"), F.lit("r2").alias("first_seen_run"), F.lit("r2").alias("last_seen_run"), no.alias("baseline"), (F.col("source") == "src7").alias("late"))
    return merge.merged_seen(old.unionByName(new))


def first_last_seen(spark, d):
    return merge.first_last(table(spark, d, "events"), "user_id", "ts")


def run_buckets(spark, d):
    return table(spark, d, "events").groupBy(S.run_day(F.col("ts")).alias("run_day")).agg(F.count("*").alias("n"))


#: Rules of a reclassification: one term demoted, another relevant.
WIDER = DEFAULT.with_version("2", demoted=("cuda",), relevance=(*DEFAULT.relevance, "scientist"))


_reclassified: dict[tuple, str] = {}


def _reclassification(spark, d) -> str:
    """The root of a first run that was reclassified."""
    root = postings.world(spark, d, days=1)
    if root not in _reclassified.values():
        daily.reclassify(spark, root, postings.RUNS[0], WIDER)
        _reclassified[spark.sparkContext.applicationId, d] = root
    return root


def reclassify_diff(spark, d):
    root = _reclassification(spark, d)
    before, after = (read_run(spark, root, name).select("job_id", F.col("tier").alias(f"{k}_tier")) for k, name in (("old", postings.RUNS[0]), ("new", f"{postings.RUNS[0]}-reclassified")))
    return before.join(after, "job_id").where(~F.col("old_tier").eqNullSafe(F.col("new_tier")))


def reclassified_jobs(spark, d):
    """The state after the reclassification."""
    return StateStore(spark, f"{_reclassification(spark, d)}/state").load()["seen_jobs"].select("job_id", "canonical_id", "tier", "first_seen_run", "discovery_type", "rules_version")


def landed_sources(spark, d):
    """Listings by source, as the registry of the second day leads to them."""
    known = registry.load_registry(spark, f"{postings.world(spark, d)}/sources2.json")
    return known.select("source").join(registry.scan_listings(spark, known).groupBy("source").agg(F.count("*").alias("n")), "source", "left")


_broken: dict[tuple, str] = {}


def broken_sources(spark, d):
    """Health of the first day's sources after some broke: one landed a line that is no record, one a record of another source, one no
    folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _broken:
        _broken[key] = postings.break_sources(spark, postings.listed(spark, d))
    known = registry.load_registry(spark, _broken[key])
    rows, status = registry.scan_sources(spark, known)
    return health.source_health(known, status, rows.groupBy("source").agg(F.count("*").alias("n"))).select("source", "status", "n", "error")


def json_state(spark, d):
    return read_json_state(spark, f"{postings.world(spark, d)}/status1.json", schemas.STATUS_HISTORY, "source")


def run_postings(spark, d):
    names = ["job_id", "canonical_id", "source", "qualifies", "reject_reason", "tier", "fit_score", "rank", "duplicate", "discovery_type"]
    return read_run(spark, postings.world(spark, d), postings.RUNS[1]).select(names)


def run_state(spark, d):
    return StateStore(spark, f"{postings.world(spark, d)}/state").load()["seen_source_jobs"]


def run_seen_jobs(spark, d):
    return StateStore(spark, f"{postings.world(spark, d)}/state").load()["seen_jobs"].select("canonical_id", "job_id", "source", "tier", "first_seen_run", "discovery_type", "rules_version")


def run_health(spark, d):
    return StateStore(spark, f"{postings.world(spark, d)}/state").load()["source_status"]


def run_documents(spark, d):
    """Of each file of the second run how many postings it has, and a flag: blocked sources named, notified, sent."""
    folder = f"{postings.world(spark, d)}/runs/{postings.RUNS[1]}"
    rows = []
    for name in (reports.REPORT, reports.SHORTLIST, reports.NEW_JOBS):
        lines = files.read_text(spark, f"{folder}/{name}").splitlines()
        rows.append((name, sum(x.startswith("- **P") for x in lines), any(": blocked**" in x for x in lines)))
    decision, delivery = (reports.read_json(spark, f"{folder}/{x}") for x in (reports.DECISION, reports.DELIVERY))
    rows += [(reports.DECISION, decision["n_new"], decision["should_notify"]), (reports.DELIVERY, int(delivery["notification_id"] == decision["notification_id"]), delivery["status"] == "sent")]
    return spark.createDataFrame(rows, "document string, n long, flag boolean")


def traced_postings(spark, d):
    """How many postings the second run reports, and how many of them no landed listing has."""
    root = postings.world(spark, d)
    found = read_run(spark, root, postings.RUNS[1]).where("qualifies").select("job_id")
    known = registry.load_registry(spark, f"{root}/sources2.json")
    listed = registry.identified(registry.scan_listings(spark, known)).select("job_id", F.lit(1).alias("listed"))
    return found.join(listed.distinct(), "job_id", "left").agg(F.count("*").alias("n_reported"), F.count_if(F.col("listed").isNull()).alias("n_untraced"))


def gated_stream(spark, d):
    """The postings of the second batch of a stream of landed listings, each batch a run."""
    names = ["job_id", "canonical_id", "source", "qualifies", "reject_reason", "tier", "fit_score", "rank", "duplicate", "discovery_type"]
    return read_run(spark, postings.world(spark, d, stream=True), f"{postings.RUNS[1]}-s1").select(names)


def report_lines(spark, d):
    return reports.rendered(daily.read_back(spark, postings.world(spark, d), postings.RUNS[1]))


def shortlist_lines(spark, d):
    return reports.rendered(daily.read_back(spark, postings.world(spark, d), postings.RUNS[1], "shortlist"))


def new_job_lines(spark, d):
    return reports.rendered(daily.read_back(spark, postings.world(spark, d), postings.RUNS[1], "new"))


def intake_stream(spark, d):
    """Landed listings through the file stream, each identity once."""
    target = new_path(spark, "intake")
    intake(listing_stream(spark, f"{postings.world(spark, d)}/landing/*/listings/*"), target, f"{target}-checkpoint").awaitTermination()
    return spark.read.parquet(target).select("job_id", "url_key", "source")


def run_ids(spark, d):
    """The id of the run due on each day that has events."""
    return table(spark, d, "events").select(F.to_date("ts").alias("day")).distinct().select("day", S.run_id_of(S.due_utc(F.col("day"))).alias("run_id"))


def schedule_utc(spark, d):
    due = S.due_utc(F.col("o_orderdate"))
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year"), F.hour(due).alias("utc_hour")).agg(F.count("*").alias("n"))


_NAMES = """source_registry listing_scan job_identity unseen_anti_join unseen_or_unresolved detail_fetch experience_filter
exclusion_filter relevance_filter boilerplate_strip priority_tier rank_by_fit top_per_source dedup_keep_first duplicate_groups
discovery_type notify_decision report priority_shortlist new_jobs source_health state_merge first_last_seen run_buckets
reclassify_diff schedule_utc posting_identity years_asked own_text classified landed_sources json_state run_postings
run_state run_seen_jobs run_health run_documents report_lines shortlist_lines new_job_lines intake_stream run_ids
alike_postings duplicate_jobs reclassified_jobs traced_postings gated_stream edited_boilerplate broken_sources""".split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: globals()[name] for name in _NAMES}


# --- the same in SQL ---------------------------------------------------------------------------------------------


def _has(*tokens: str) -> str:
    return f"regexp_matches(lower(coalesce(text, '')), '(^|[^a-z0-9])({'|'.join(tokens)})([^a-z0-9]|$)')"


_TIER = f"(CASE WHEN {_has('that', 'thereof', 'der')} THEN 1 WHEN {_has('with', 'nicht')} THEN 2 WHEN {_has('the', 'la', 'sch')} THEN 3 ELSE 4 END)"
_FOUND = f"""WITH k AS (SELECT doc_id, source, {_TIER} AS tier, row_number() OVER (PARTITION BY md5(lower(text)) ORDER BY doc_id) AS r FROM documents),
f AS (SELECT k.doc_id, k.source, k.tier, CASE WHEN r > 1 THEN 'duplicate_posting' WHEN l.doc_id IS NOT NULL THEN 'previously_processed'
      WHEN k.doc_id < 100 THEN 'historical_baseline' ELSE 'new_posting' END AS discovery_type FROM k LEFT JOIN labels l USING (doc_id))"""
_URL = r"lower(regexp_replace(regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), '[?#].*$', ''), '^([wW]{3}|[mM])\.', ''))"

def _sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return f"[{', '.join(map(_sql, values))}]"


def _any_of(column: str, tokens) -> str:
    return f"regexp_matches({column}, {_sql('(^|[^a-z0-9])(' + '|'.join(t.replace('.', '[.]').replace('+', '[+]') for t in tokens) + ')([^a-z0-9]|$)')})"


_JOB = "md5(source || '|' || doc_id)"
_POSTINGS = rf"""SELECT doc_id, source, {_JOB} AS job_id,
    CASE doc_id % 10 WHEN 1 THEN 'jobs.example.com/g' || (doc_id // 40) WHEN 2 THEN source || '.example.com/job?lang=en&pid=' || doc_id
        WHEN 3 THEN source || '.example.com#/job/' || doc_id WHEN 4 THEN source || '.example.com/apply' ELSE source || '.example.com/' || doc_id END AS url_key,
    CASE WHEN doc_id % 19 <> 5 THEN {_list(postings.TITLES)}[doc_id % {len(postings.TITLES)} + 1] END AS title,
    CASE WHEN doc_id % 17 = 0 THEN 'Sales Operations' ELSE 'Engineering' END AS department,
    concat_ws(chr(10), text, {_list(postings.NEEDS)}[doc_id % {len(postings.NEEDS)} + 1], CASE WHEN source = {_sql(postings.PLAIN[0])} THEN {_sql(postings.PLAIN[1])} ELSE {_sql(postings.SHARED)} END) AS text FROM documents"""
# Mentions of years, written again for the other dialect: the engine's patterns aren't used.
_N = "([0-9]{1,2}|zero|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|fifteen|twenty)"
_BOUND = "((up to|less than|fewer than|no more than|at most|under|below|within|maximum of|max)\\s+)?"
_SAID = _BOUND + _N + "(\\.[0-9])?\\s*\\+?\\s*(\\([0-9]{1,2}\\+?\\)\\s*)?(([-–—]|to|or)\\s*" + _N + "\\s*)?\\+?(or more\\s*)?\\s*(years|year|yrs|yr)([^a-z0-9]|$)"
_MENTIONED = _sql("(^|[^a-z0-9.])" + _SAID)
_AGE = _sql("(^|[^a-z])(for|over|past|last|than)\\s+(the\\s+)?(past\\s+|last\\s+|more\\s+than\\s+|about\\s+|nearly\\s+)?" + _SAID)
_CLAUSES = r"list_filter(regexp_split_to_array(lower(concat_ws(chr(10), title, text)), '[;\n]+|\.(\s+|$)'), lambda x: contains(x, 'year') OR contains(x, 'yr'))"
_NEAR = f"""list_filter(list_transform({_CLAUSES}, lambda x: CASE WHEN contains(x, 'experience') THEN coalesce(
    regexp_extract_all(x[1:strpos(x, 'experience') - 1], {_MENTIONED})[-1], regexp_extract_all(x[strpos(x, 'experience') + 10:], {_MENTIONED})[1]) END), lambda x: x IS NOT NULL)[1]"""
_OTHER = f"list_filter(list_transform({_CLAUSES}, lambda x: regexp_extract_all(regexp_replace(x, {_AGE}, ' ', 'g'), {_MENTIONED})[1]), lambda x: x IS NOT NULL)[1]"


def _number(part: int) -> str:
    said = f"regexp_extract(coalesce({_NEAR}, {_OTHER}), {_MENTIONED}, {part})"
    words = "['zero', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten', 'eleven', 'twelve', '', '', 'fifteen', '', '', '', '', 'twenty']"
    return f"coalesce(try_cast(nullif({said}, '') AS INT), list_position({words}, nullif({said}, ''))::INT - 1)"


_BOUNDED = f"coalesce(regexp_extract(coalesce({_NEAR}, {_OTHER}), {_MENTIONED}, 3), '') <> ''"
_YEARS = f"CASE WHEN {_BOUNDED} THEN 0 ELSE {_number(4)} END"
_MOST = f"CASE WHEN {_BOUNDED} THEN coalesce({_number(9)}, {_number(4)}) ELSE {_number(9)} END"
_EARLY = f"({_any_of('lower(coalesce(title, chr(32)))', DEFAULT.early)} OR coalesce({_YEARS} <= {DEFAULT.most_years}, {_any_of('lower(text)', DEFAULT.early)}))"


def _relevant(column: str, rules=DEFAULT) -> str:
    return _any_of(column, dict.fromkeys([*rules.relevance, *(t for own in rules.tiers.values() for t in own)]))


def _own_texts(name: str, rules) -> str:
    """Common table expressions that end in ``{name}_o``: of each job the paragraphs that aren't boilerplate."""
    often = f"HAVING count(DISTINCT job_id) >= {rules.boilerplate_postings} AND count(DISTINCT job_id) >= {rules.boilerplate_share} * n"
    if rules.boilerplate_percent is None:
        return rf"""{name}_c AS (SELECT source, trim(para) AS para FROM {name}_p JOIN {name}_n USING (source) GROUP BY source, trim(para), n {often}),
    {name}_o AS (SELECT job_id, string_agg(para, chr(10) ORDER BY place) AS own_text FROM {name}_p p
        WHERE NOT EXISTS (SELECT 1 FROM {name}_c c WHERE c.source = p.source AND c.para = trim(p.para)) GROUP BY job_id)"""
    return rf"""{name}_g AS (SELECT *, list_filter(regexp_split_to_array(lower(para), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM {name}_p),
    {name}_u AS (SELECT job_id, source, place, unnest(list_distinct(list_transform(range(1, greatest(len(ws) - 1, 2)), lambda i: array_to_string(ws[i:i + 2], ' ')))) AS run FROM {name}_g WHERE len(ws) > 0),
    {name}_c AS (SELECT source, run FROM {name}_u JOIN {name}_n USING (source) GROUP BY source, run, n {often}),
    {name}_b AS (SELECT job_id, place FROM {name}_u u LEFT JOIN {name}_c c ON c.source = u.source AND c.run = u.run GROUP BY job_id, place HAVING 100 * count(c.run) >= {rules.boilerplate_percent} * count(*)),
    {name}_o AS (SELECT job_id, string_agg(para, chr(10) ORDER BY place) AS own_text FROM {name}_p p ANTI JOIN {name}_b USING (job_id, place) GROUP BY job_id)"""


def _with_classified(name: str, source: str, rules=DEFAULT) -> str:
    """Common table expressions that end in ``name``: the rows of ``source`` classified."""
    terms = [t for n in sorted(rules.tiers) for t in rules.tiers[n]]
    fit = " + ".join(f"CASE WHEN {_any_of('own', [t])} THEN {10.0 ** (3 - n)}::DOUBLE ELSE 0 END" for n in sorted(rules.tiers) for t in rules.tiers[n])
    tier = " ".join(f"WHEN {_any_of('own', rules.tiers[n])} THEN {n}" for n in sorted(rules.tiers))
    demoted = f"WHEN {_any_of('own', rules.demoted)} THEN 4" if rules.demoted else ""
    paragraphs = f"{name}_p AS (SELECT * FROM (SELECT job_id, source, unnest(string_split(text, chr(10))) AS para, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM {source}) WHERE trim(para) <> '')"
    return rf"""{paragraphs},
    {name}_n AS (SELECT source, count(*) AS n FROM {source} GROUP BY source),
    {_own_texts(name, rules)},
    {name}_l AS (SELECT s.*, coalesce(own_text, '') AS own_text, lower(concat_ws(chr(10), title, coalesce(own_text, ''))) AS own, lower(concat_ws(chr(10), title, text)) AS whole,
        lower(coalesce(title, '')) AS head, lower(concat_ws(' ', title, department)) AS spot FROM {source} s LEFT JOIN {name}_o USING (job_id)),
    {name}_r AS (SELECT *, CASE WHEN {_any_of('head', rules.senior)} THEN 'senior' WHEN {_any_of('spot', rules.sales)} THEN 'sales' WHEN {_any_of('spot', rules.marketing)} THEN 'marketing'
        WHEN NOT {_EARLY} THEN 'experience' WHEN NOT {_relevant('own', rules)} AND {_relevant('whole', rules)} THEN 'boilerplate'
        WHEN {_any_of('own', rules.infrastructure)} AND NOT {_any_of('own', terms)} THEN 'infrastructure' WHEN NOT {_relevant('own', rules)} THEN 'relevance' END AS reject_reason FROM {name}_l),
    {name} AS (SELECT *, reject_reason IS NULL AS qualifies, CASE WHEN reject_reason IS NULL THEN CASE {demoted} {tier} ELSE 4 END END AS tier,
        CASE WHEN reject_reason IS NULL THEN {fit} END AS fit_score FROM {name}_r)"""


def _with_duplicates(name: str, new: str, known: str = "") -> str:
    """Common table expressions that end in ``name``: the rows of ``new`` against all pairs of them and of ``known``."""
    columns = "job_id, source, url_key, title, own_text"
    older = f"UNION ALL SELECT {columns}, canonical_id, 0 AS fresh FROM {known}" if known else ""
    return rf"""{name}_w AS (SELECT *, list_filter(regexp_split_to_array(lower(concat_ws(chr(10), title, own_text)), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
        FROM (SELECT {columns}, job_id AS canonical_id, 1 AS fresh FROM {new} {older})),
    {name}_t AS (SELECT *, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS runs FROM {name}_w),
    {name}_s AS (SELECT job_id, fresh, len(runs) AS n, unnest(runs) AS run FROM {name}_t WHERE len(runs) >= 10),
    {name}_e AS (SELECT a.job_id AS a, b.job_id AS b, b.fresh FROM {name}_s a JOIN {name}_s b ON a.run = b.run AND a.fresh = 1 AND a.job_id <> b.job_id
            GROUP BY a.job_id, b.job_id, b.fresh, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        UNION SELECT x.job_id, y.job_id, y.fresh FROM {name}_w x JOIN {name}_w y ON x.url_key = y.url_key AND x.fresh = 1 AND x.job_id <> y.job_id
            WHERE x.url_key NOT IN (SELECT url_key FROM {name}_w GROUP BY url_key, source HAVING count(DISTINCT job_id) > 1)),
    {name}_f AS (SELECT x.job_id, min({{'fresh': y.fresh, 'source': y.source, 'job_id': y.job_id, 'canonical_id': y.canonical_id}}) AS first FROM {name}_e
        JOIN {name}_w x ON x.job_id = a AND x.fresh = 1 JOIN {name}_w y ON y.job_id = b AND y.fresh = {name}_e.fresh
        WHERE y.source <> x.source AND (y.fresh = 0 OR y.source < x.source) GROUP BY x.job_id),
    {name} AS (SELECT n.*, first IS NOT NULL AS duplicate, coalesce(first.canonical_id, job_id) AS canonical_id FROM {new} n LEFT JOIN {name}_f USING (job_id))"""


_CLASSIFIED = f"WITH p AS ({_POSTINGS}), {_with_classified('c', 'p')}"
_FIRST_RUN = f"""WITH p AS ({_POSTINGS}),
d1 AS (SELECT * FROM p WHERE doc_id % 3 = 0 AND source <> 'src7'), r1 AS (SELECT * FROM d1 WHERE doc_id % 11 <> 0 AND title IS NOT NULL),
{_with_classified('c1', 'r1')}, o1 AS (SELECT * FROM c1 WHERE qualifies), {_with_duplicates('q1', 'o1')}, k1 AS (SELECT * FROM q1 WHERE NOT duplicate)"""
_WORLD = f"""{_FIRST_RUN},
d2 AS (SELECT * FROM p WHERE source <> 'src9'), g2 AS (SELECT * FROM d2 WHERE job_id NOT IN (SELECT job_id FROM r1)),
r2 AS (SELECT * FROM g2 WHERE doc_id % 13 <> 0 AND title IS NOT NULL),
{_with_classified('c2', 'r2')}, o2 AS (SELECT * FROM c2 WHERE qualifies), {_with_duplicates('q2', 'o2', 'k1')},
f2 AS (SELECT *, row_number() OVER (ORDER BY tier, fit_score DESC, job_id) AS rank, CASE WHEN duplicate THEN 'duplicate_posting'
       WHEN job_id IN (SELECT job_id FROM d1) THEN 'historical_baseline' WHEN source = 'src7' THEN 'catch_up' ELSE 'new_posting' END AS discovery_type FROM q2)"""
_RUN = f"{_WORLD} SELECT c.job_id, coalesce(f.canonical_id, c.job_id) AS canonical_id, c.source, c.qualifies, c.reject_reason, c.tier, c.fit_score, f.rank, f.duplicate, f.discovery_type FROM c2 c LEFT JOIN f2 f USING (job_id)"


def _literal(column: str) -> str:
    return rf"regexp_replace({column}, '([\`*_{{}}\[\]()#+!|<>~-])', '\\\1', 'g')"


_LINES = rf"{_WORLD} SELECT rank, '- **P' || tier || '** ' || {_literal('title')} || ' (' || {_literal("source || ', NY'")} || '), ' || discovery_type || ' `' || job_id || '`' AS line FROM f2"

ORACLE_SQL: dict[str, str] = {
    "posting_identity": f"SELECT doc_id, job_id, url_key FROM ({_POSTINGS})",
    "years_asked": f"SELECT doc_id, {_YEARS} AS years, {_MOST} AS most_years FROM ({_POSTINGS})",
    "alike_postings": rf"""WITH p AS ({_POSTINGS}),
        w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(concat_ws(chr(10), title, text)), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM p),
        t AS (SELECT doc_id, list_sort(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS runs FROM w WHERE len(ws) > 0),
        f AS (SELECT min(doc_id) AS doc_id, runs FROM t GROUP BY runs), s AS (SELECT doc_id, len(runs) AS n, unnest(runs) AS run FROM f)
        SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM s a JOIN s b ON a.run = b.run AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))""",
    "duplicate_jobs": f"{_CLASSIFIED}, o AS (SELECT * FROM c WHERE qualifies), {_with_duplicates('q', 'o')} SELECT job_id, source, canonical_id, duplicate FROM q",
    "traced_postings": f"{_WORLD} SELECT count(*) AS n_reported, 0::BIGINT AS n_untraced FROM f2",
    "gated_stream": _RUN,
    "reclassified_jobs": f"""{_FIRST_RUN}, {_with_classified('w', 'r1', WIDER)}, ow AS (SELECT * FROM w WHERE qualifies), {_with_duplicates('qw', 'ow', 'k1')}
        SELECT job_id, k1.canonical_id, coalesce(w.tier, k1.tier) AS tier, '{postings.RUNS[0]}' AS first_seen_run, 'historical_baseline' AS discovery_type, CASE WHEN w.tier IS NULL THEN '1' ELSE '2' END AS rules_version FROM k1 JOIN w USING (job_id)
        UNION ALL SELECT job_id, canonical_id, tier, '{postings.RUNS[0]}', 'previously_processed', '2' FROM qw WHERE NOT duplicate AND job_id NOT IN (SELECT job_id FROM k1)""",
    "own_text": f"{_CLASSIFIED} SELECT doc_id, md5(own_text) AS own_md5 FROM c",
    "classified": f"{_CLASSIFIED} SELECT doc_id, qualifies, reject_reason, tier, fit_score, '1' AS rules_version FROM c",
    "edited_boilerplate": f"""WITH p AS (SELECT * REPLACE (concat_ws(chr(10), text, CASE WHEN doc_id % 7 > 0 THEN '{postings.EDITED[0]}' || {_list(postings.PLACES)}[doc_id % {len(postings.PLACES)} + 1] || '{postings.EDITED[1]}' END) AS text) FROM ({_POSTINGS})),
        {_with_classified('c', 'p', EDITS)} SELECT doc_id, md5(own_text) AS own_md5, reject_reason, tier, fit_score FROM c""",
    "broken_sources": """WITH h AS (SELECT source, count(*) AS n, CASE source WHEN 'src1' THEN 'a line is no record (1 in all)' WHEN 'src2' THEN 'a record of another source (1 in all)' WHEN 'src3' THEN 'no landed folder' END AS error FROM documents GROUP BY source)
        SELECT source, CASE WHEN error IS NULL THEN 'ok' WHEN source = 'src3' THEN 'unavailable' ELSE 'blocked' END AS status, CASE WHEN error IS NULL THEN n END AS n, error FROM h""",
    "landed_sources": "SELECT source, count(*) AS n FROM documents GROUP BY source",
    "json_state": f"SELECT DISTINCT source, CASE WHEN source = 'src7' THEN 'blocked' ELSE 'ok' END AS status, '{postings.RUNS[0]}' AS run_id FROM documents",
    "run_postings": _RUN,
    "run_state": f"""{_WORLD}, e AS (SELECT job_id, source, job_id IN (SELECT job_id FROM d1) AS one, job_id IN (SELECT job_id FROM d2) AS two, job_id IN (SELECT job_id FROM g2) AS gated FROM p)
        SELECT job_id, source, CASE WHEN job_id IN (SELECT job_id FROM r1) OR job_id IN (SELECT job_id FROM r2) THEN 'resolved' ELSE 'unresolved' END AS status, one::INT + gated::INT AS attempts,
        CASE WHEN one THEN '{postings.RUNS[0]}' ELSE '{postings.RUNS[1]}' END AS first_seen_run, CASE WHEN two THEN '{postings.RUNS[1]}' ELSE '{postings.RUNS[0]}' END AS last_seen_run,
        one AS baseline, one OR source = 'src7' AS late FROM e WHERE one OR two""",
    "run_seen_jobs": f"""{_WORLD} SELECT canonical_id, job_id, source, tier, '{postings.RUNS[0]}' AS first_seen_run, 'historical_baseline' AS discovery_type, '1' AS rules_version FROM k1
        UNION ALL SELECT canonical_id, job_id, source, tier, '{postings.RUNS[1]}', discovery_type, '1' FROM f2 WHERE NOT duplicate""",
    "run_health": f"SELECT DISTINCT source, CASE WHEN source = 'src9' THEN 'blocked' ELSE 'ok' END AS status, '{postings.RUNS[1]}' AS run_id FROM documents",
    "run_documents": f"""{_WORLD} SELECT 'report.md' AS document, count(*) AS n, true AS flag FROM f2 UNION ALL SELECT 'priority_shortlist.md', count(*), false FROM f2 WHERE tier <= 2
        UNION ALL SELECT 'new_jobs.md', count(*), false FROM f2 WHERE discovery_type = 'new_posting' UNION ALL SELECT 'notification.json', count(*), count(*) > 0 FROM f2 WHERE discovery_type = 'new_posting'
        UNION ALL SELECT 'notification_delivery.json', 1, count(*) > 0 FROM f2 WHERE discovery_type = 'new_posting'""",
    "report_lines": _LINES,
    "shortlist_lines": f"{_LINES} WHERE tier <= 2",
    "new_job_lines": f"{_LINES} WHERE discovery_type = 'new_posting'",
    "intake_stream": f"SELECT job_id, url_key, source FROM ({_POSTINGS})",
    "run_ids": "SELECT DISTINCT ts::DATE AS day, strftime(((ts::DATE + INTERVAL 10 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC', '%Y%m%dT%H%M%SZ') AS run_id FROM events",
    "source_registry": "SELECT source, count(*) AS n FROM documents GROUP BY source",
    "listing_scan": "SELECT doc_id, source, lang, n_chars FROM documents",
    "job_identity": rf"SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) AS host, md5(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) || '|' || regexp_replace({_URL}, '/+$', '')) AS job_id FROM pages",
    "unseen_anti_join": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "unseen_or_unresolved": "SELECT d.doc_id, d.source, CASE WHEN l.doc_id IS NULL THEN 'unseen' ELSE 'unresolved' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR l.quality = 0",
    "detail_fetch": "SELECT d.doc_id, d.n_chars, md5(d.text) AS text_md5 FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR l.quality = 0",
    "experience_filter": f"SELECT doc_id, source FROM ({_POSTINGS}) WHERE {_EARLY}",
    "exclusion_filter": f"{_CLASSIFIED} SELECT doc_id, reject_reason FROM c WHERE reject_reason IN ('senior', 'sales', 'marketing', 'infrastructure', 'boilerplate')",
    "relevance_filter": f"SELECT doc_id, source FROM ({_POSTINGS}) WHERE {_relevant('lower(concat_ws(chr(10), title, text))')}",
    "boilerplate_strip": """WITH p AS (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS para FROM documents),
        c AS (SELECT source, para FROM p GROUP BY source, para HAVING count(DISTINCT doc_id) >= 3),
        k AS (SELECT doc_id, count(*) AS n_lines, sum(length(para))::BIGINT AS n_left FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source = p.source AND c.para = p.para) GROUP BY doc_id)
        SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_left, 0) AS n_left FROM documents LEFT JOIN k USING (doc_id)""",
    "priority_tier": f"SELECT {_TIER} AS tier, count(*) AS n FROM documents GROUP BY 1",
    "rank_by_fit": f"{_CLASSIFIED} SELECT doc_id, tier, fit_score, row_number() OVER (ORDER BY tier, fit_score DESC, job_id) AS rank FROM c WHERE qualifies",
    "top_per_source": f"SELECT doc_id, source, tier, n_chars, row_number() OVER (PARTITION BY source ORDER BY tier, n_chars DESC, doc_id)::INT AS rank FROM (SELECT doc_id, source, n_chars, {_TIER} AS tier FROM documents) QUALIFY rank <= 3",
    "dedup_keep_first": "SELECT min(doc_id) AS doc_id, md5(lower(text)) AS text_key FROM documents GROUP BY 2",
    "duplicate_groups": "SELECT md5(lower(text)) AS text_key, count(*) AS n, count(DISTINCT source) AS n_sources FROM documents GROUP BY 1 HAVING count(*) > 1",
    "discovery_type": f"{_FOUND} SELECT discovery_type, count(*) AS n FROM f GROUP BY 1",
    "notify_decision": f"{_FOUND} SELECT count(*) FILTER (discovery_type = 'new_posting') AS n_new, count(*) FILTER (discovery_type = 'new_posting') > 0 AS should_notify FROM f",
    "report": f"SELECT source, tier, count(*) AS n FROM (SELECT source, {_TIER} AS tier FROM documents) WHERE tier <= 3 GROUP BY 1, 2",
    "priority_shortlist": f"SELECT doc_id, source, {_TIER} AS tier FROM documents WHERE {_TIER} <= 2",
    "new_jobs": f"{_FOUND} SELECT doc_id, source, tier FROM f WHERE tier <= 3 AND discovery_type = 'new_posting'",
    "source_health": """WITH p AS (SELECT source, count(*) AS n, sum(toxic) * 100 >= 15 * count(*) AS bad FROM labels JOIN documents USING (doc_id) WHERE source <> 'src7' GROUP BY source)
        SELECT source, CASE WHEN bad THEN 'blocked' WHEN n IS NOT NULL THEN 'ok' ELSE 'not_run' END AS status, CASE WHEN NOT bad THEN n END AS n FROM (SELECT DISTINCT source FROM documents) LEFT JOIN p USING (source)""",
    "state_merge": """WITH s AS (SELECT doc_id::VARCHAR AS job_id, 'old' AS source, CASE WHEN quality = 1 THEN 'resolved' ELSE 'unresolved' END AS status, 'r1' AS run, true AS baseline, false AS late FROM labels
        UNION ALL SELECT doc_id::VARCHAR, source, 'unresolved', 'r2', false, source = 'src7' FROM documents WHERE n_chars < 2000)
        SELECT job_id, arg_min(source, run) AS source, CASE WHEN bool_or(status = 'resolved') THEN 'resolved' ELSE 'unresolved' END AS status, count(*)::INT AS attempts,
        min(run) AS first_seen_run, max(run) AS last_seen_run, bool_or(baseline) AS baseline, bool_or(late) AS late FROM s GROUP BY job_id""",
    "first_last_seen": "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM events GROUP BY user_id",
    "run_buckets": "SELECT (((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') - INTERVAL 10 HOUR)::DATE AS run_day, count(*) AS n FROM events GROUP BY 1",
    "reclassify_diff": f"{_FIRST_RUN}, {_with_classified('w', 'r1', WIDER)} SELECT c1.job_id, c1.tier AS old_tier, w.tier AS new_tier FROM c1 JOIN w USING (job_id) WHERE c1.tier IS DISTINCT FROM w.tier",
    "schedule_utc": "SELECT year(o_orderdate)::INT AS year, hour(((o_orderdate::DATE + INTERVAL 10 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC')::INT AS utc_hour, count(*) AS n FROM orders GROUP BY 1, 2",
}
