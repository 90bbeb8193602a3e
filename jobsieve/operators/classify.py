"""Early-career, relevance and exclusion rules, boilerplate, and priority tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import known_words, least_years, mentions, terms_in, text
from ..rules import BACKUP_TIER, DEFAULT, Rules
from ..tables import written, written_by
from .boilerplate import without_edited

#: Rows of common paragraphs that are broadcast at most.
COMMON = 200_000
#: Common paragraphs of all sources that are broadcast as lists to look in.
LISTED = 1_000


def paragraphs(postings: DataFrame, key: str, source: str, body: str) -> DataFrame:
    """One row per non-blank paragraph: (key, source, at, para, para_id)."""
    lines = postings.select(key, source, F.posexplode(F.split(text(F.col(body)), "\n")).alias("at", "para"))
    return lines.where(F.trim("para") != "").withColumn("para_id", F.md5(F.trim("para")))


def common_paragraphs(paras: DataFrame, key: str, source: str, least: int, share: float = 0.0, sizes: DataFrame | None = None) -> DataFrame:
    """(source, para_id) of paragraphs in at least ``least`` postings of a source, and that share of them."""
    found = paras.select(source, "para_id", key).distinct().groupBy(source, "para_id").agg(F.count("*").alias("postings")).where(F.col("postings") >= least)
    if sizes is not None:
        found = found.join(sizes, source).where(F.col("postings") >= F.lit(share) * F.col("n"))
    return found.select(source, "para_id")


def without_common(paras: DataFrame, common: DataFrame, source: str) -> DataFrame:
    """paras without the common ones, which are counted and broadcast if few, so that rows of a very common paragraph
    never meet in one task."""
    return _met(paras, written(common, "common"), source, "left_anti")


def _met(paras: DataFrame, common: DataFrame, source: str, how: str) -> DataFrame:
    return paras.join(F.broadcast(common) if common.count() <= COMMON else common, [source, "para_id"], how)


def without_boilerplate(postings: DataFrame, rules: Rules = DEFAULT, key: str = "job_id", source: str = "source", body: str = "text") -> DataFrame:
    """postings with ``own_text``: body without the paragraphs that most postings of the source share.

    Every posting keeps its row; one that is all boilerplate has an empty own_text.
    """
    return without(postings, boilerplate(postings, rules, key, source, body), key, source, body)


def boilerplate(postings: DataFrame, rules: Rules = DEFAULT, key: str = "job_id", source: str = "source", body: str = "text") -> DataFrame:
    """(source, para_id) of the paragraphs that most postings of the source share, written."""
    paras = paragraphs(postings, key, source, body).drop("para")
    sizes = postings.groupBy(source).agg(F.count("*").alias("n"))
    return written(common_paragraphs(paras, key, source, rules.boilerplate_postings, rules.boilerplate_share, sizes), "common")


def without(postings: DataFrame, common: DataFrame, key: str = "job_id", source: str = "source", body: str = "text", gone: str | None = None) -> DataFrame:
    """postings with ``own_text``: body without the paragraphs of ``boilerplate``, which the column gone has, if it is named."""
    if common.count() <= LISTED:
        own = postings.join(F.broadcast(common.groupBy(source).agg(F.collect_set("para_id").alias("_common"))), source, "left")
    else:  # of each posting its own common paragraphs; a very common one is met by broadcast
        held = _met(paragraphs(postings, key, source, body).drop("para"), common, source, "left_semi").groupBy(key).agg(F.collect_set("para_id").alias("_common"))
        own = postings.join(held, key, "left")
    shared = lambda x: F.coalesce(F.array_contains("_common", F.md5(F.trim(x))), F.lit(False))
    lines = lambda of: F.array_join(F.filter(F.split(text(F.col(body)), "\n"), lambda x: (F.trim(x) != "") & of(x)), "\n")
    return own.withColumns({"own_text": lines(lambda x: ~shared(x))} | ({gone: lines(shared)} if gone else {})).drop("_common")


def tier(body: Column, rules: Rules = DEFAULT) -> Column:
    """The lowest tier whose terms the text has, else the last."""
    out = F.when(mentions(body, rules.demoted), BACKUP_TIER) if rules.demoted else None
    for number in sorted(rules.tiers):
        hit = mentions(body, rules.tiers[number])
        out = F.when(hit, number) if out is None else out.when(hit, number)
    return out.otherwise(BACKUP_TIER)


def early_career(title: Column, body: Column, rules: Rules = DEFAULT) -> Column:
    years = least_years(F.concat_ws("\n", title, body))
    return mentions(title, rules.early) | F.coalesce(years <= rules.most_years, F.size(terms_in(body, rules.early)) > 0)


def relevant(body: Column, rules: Rules = DEFAULT) -> Column:
    return F.size(terms_in(body, [*rules.relevance, *(t for own in rules.tiers.values() for t in own)])) > 0


def tier_terms(rules: Rules = DEFAULT) -> dict[str, int]:
    """Each term of the tiers and its best tier."""
    return {t: number for number in sorted(rules.tiers, reverse=True) for t in rules.tiers[number]}


def every_term(rules: Rules = DEFAULT) -> list[str]:
    return list(dict.fromkeys([*tier_terms(rules), *rules.relevance, *rules.demoted, *rules.infrastructure, *rules.early]))


def _any(found: Column, terms) -> Column:
    return F.arrays_overlap(found, F.array(*map(F.lit, terms))) if terms else F.lit(False)


def reject_reason(rules: Rules, found: Column, whole: Column) -> Column:
    """The first rule that a posting (title, department, text) fails; null if it qualifies.

    found: the terms of title and own_text, whole: those of title and text, both of ``every_term``.
    """
    title, place = F.col("title"), F.concat_ws(" ", "title", "department")
    tiers = list(tier_terms(rules))
    near, all_of = [*rules.relevance, *tiers], F.concat_ws("\n", "title", "text")
    early = mentions(title, rules.early) | F.coalesce(least_years(all_of) <= rules.most_years, _any(whole, rules.early))
    return (
        F.when(mentions(title, rules.senior), "senior")
        .when(mentions(place, rules.sales), "sales")
        .when(mentions(place, rules.marketing), "marketing")
        .when(~early, "experience")
        .when(~_any(found, near) & _any(whole, near), "boilerplate")
        .when(_any(found, rules.infrastructure) & ~_any(found, tiers), "infrastructure")
        .when(~_any(found, near), "relevance")
    )


def fit_score(found: Column, rules: Rules = DEFAULT) -> Column:
    """How many of the tiers' terms are among those found, those of a better tier counting more."""
    terms = [t for own in rules.tiers.values() for t in own]
    worth = {t: sum(10.0 ** (3 - number) for number in rules.tiers if t in rules.tiers[number]) for t in terms}
    table = F.create_map(*[F.lit(x) for kv in worth.items() for x in kv])
    return F.aggregate(found, F.lit(0.0), lambda total, t: total + F.coalesce(F.element_at(table, t), F.lit(0.0)))


def best_tier(found: Column, rules: Rules = DEFAULT) -> Column:
    """``tier`` from the terms found."""
    table = F.create_map(*[F.lit(x) for kv in tier_terms(rules).items() for x in kv])
    best = F.coalesce(F.array_min(F.transform(found, lambda t: F.element_at(table, t))), F.lit(BACKUP_TIER))
    return F.when(_any(found, rules.demoted), BACKUP_TIER).otherwise(best).cast("int")


def classify(postings: DataFrame, rules: Rules = DEFAULT, by_job: bool = False) -> DataFrame:
    """postings with qualifies, reject_reason, tier (null unless it qualifies), fit_score and rules_version.

    The words of a posting's own text and of its common paragraphs are looked up in the dictionary of the rules' terms once.  The
    result is written, so that filters and ranks on it don't evaluate the rules again; where few paragraphs are common it holds the text alone, and
    own_text is made of it where it is read.  by_job: postings are in buckets of job_id, and so is the result, which then holds no text
    again but what the rules say of it.  The one place where another classifier could stand, as a function from DataFrame to DataFrame.
    """
    terms = every_term(rules)
    common = boilerplate(postings, rules) if rules.boilerplate_percent is None else None
    own = without_edited(postings, rules) if common is None else without(postings, common, gone="_gone")
    again = common is not None and common.count() <= LISTED
    texts = {"_own": F.concat_ws("\n", "title", "own_text"), "_whole": F.concat_ws("\n", "title", "text")}
    own = own.withColumn("_own_words", known_words(texts["_own"], terms))
    # the words of a text are those of its own paragraphs and of the others
    own = own.withColumn("_whole_words", known_words(texts["_whole"], terms) if common is None else F.array_union("_own_words", known_words(F.col("_gone"), terms)))
    own = own.withColumns({f"{k}_terms": terms_in(x, terms, F.col(f"{k}_words")) for k, x in texts.items()})
    own = own.withColumn("reject_reason", reject_reason(rules, F.col("_own_terms"), F.col("_whole_terms")))
    good, found = F.col("reject_reason").isNull(), F.col("_own_terms")
    own = own.withColumns({"qualifies": good, "tier": F.when(good, best_tier(found, rules)), "fit_score": F.when(good, fit_score(found, rules)), "rules_version": F.lit(rules.version)})
    if again and by_job:  # buckets of both meet, and nothing is shuffled or sorted
        told = written_by(own.select("job_id", "qualifies", "reject_reason", "tier", "fit_score", "rules_version"), "job_id", "classified")
        return without(postings.join(told.hint("shuffle_hash"), "job_id"), common)
    own = own.drop("_own_words", "_whole_words", "_own_terms", "_whole_terms", "_gone", *(["own_text"] if again else []))
    found = written_by(own, "job_id", "classified") if by_job else written(own, "classified")
    return without(found, common) if again else found
