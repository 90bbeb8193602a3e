"""Boilerplate that was edited: paragraphs made mostly of runs of words that most postings of their source share.

A paragraph's fingerprints are its runs of words.  Runs that most postings of a source have are its heavy hitters, and a
source has few of them: with a share s of its postings they are at most 1/s of the distinct runs of a mean posting.  They are
found in two passes over the runs of each posting.  The first counts buckets of a hash (one row of a count-min sketch,
made by partial aggregation), which can only overcount; the second counts exactly, but only runs whose bucket is full
enough, so that rare runs are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text
from ..rules import Rules
from ..tables import join_counted, written
from .likeness import BETWEEN

#: Words of a run.
WIDTH = 3
#: Buckets of the first pass, for each source.  A bucket's mean load is the runs of a mean posting divided by this, times the
#: postings: far below the share that makes boilerplate, however many postings there are.  A task sends no more rows than it
#: has sources times this.
BUCKETS = 1 << 12
#: Common runs of all sources that are broadcast as lists to look in.
LISTED = 10_000


def lines_of(body: str) -> Column:
    """The non-blank paragraphs of a text."""
    return F.filter(F.split(text(F.col(body)), "\n"), lambda x: F.trim(x) != "")


def runs_of(line: Column) -> Column:
    """The distinct hashes of the runs of words of a lower-cased line; of fewer words the whole as one; empty without.

    A run's words are hashed one after another where they are: no run is made as an array or a string, which took half of the time.
    """

    def of(words: Column) -> Column:
        starts = F.when(F.size(words) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(F.size(words) - WIDTH, F.lit(0))))
        # a word beyond the end is null, which changes no hash
        return F.array_distinct(F.transform(starts, lambda at: F.xxhash64(*[F.get(words, at + k) for k in range(WIDTH)])))

    # as a variable the words are found once, and not again for every run
    words = F.filter(F.split(F.lower(line), BETWEEN), lambda w: w != "")
    return F.get(F.transform(F.array(words), of), F.lit(0))


def with_runs(postings: DataFrame, body: str = "text") -> DataFrame:
    """postings with ``_lines``, the non-blank paragraphs, and ``_runs``, the distinct hashes of each one's runs of words."""
    return postings.withColumn("_lines", lines_of(body)).withColumn("_runs", F.transform("_lines", runs_of))


def common_runs(rows: DataFrame, source: str, least: int, share: float, buckets: int = BUCKETS) -> DataFrame:
    """(source, run, n): the runs that so many postings of a source have, and that share of them; n: how many.

    rows: the result of ``with_runs``, written.
    """
    sizes = rows.groupBy(source).agg(F.count("*").alias("_size"))
    limits = written(sizes.select(source, "_size", F.greatest(F.lit(least), F.ceil(F.lit(share) * F.col("_size"))).alias("_least")), "limits")
    every = rows.select(source, F.explode(F.array_distinct(F.flatten("_runs"))).alias("run"))
    keyed = every.withColumn("_bucket", F.pmod("run", F.lit(buckets)).cast("int"))
    full = keyed.groupBy(source, "_bucket").agg(F.count("*").alias("_n"))
    full = written(full.join(limits, source).where("_n >= _least").select(source, "_bucket", "_n"), "full")
    total = full.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    # a full bucket is met by many rows: those that very many rows share are broadcast, and nearly always all of them
    likely = join_counted(keyed, full, [source, "_bucket"], "_n", total, "inner")
    counted = likely.groupBy(source, "run").agg(F.count("*").alias("n"))
    return counted.join(limits, source).where("n >= _least").select(source, "run", "n")


def _boilerplate(shared: Column, runs: Column, percent: int) -> Column:
    """A paragraph without words is none."""
    return (F.size(runs) > 0) & (100 * shared >= percent * F.size(runs))


def without_edited(postings: DataFrame, rules: Rules, key: str = "job_id", source: str = "source", body: str = "text", listed: int = LISTED) -> DataFrame:
    """postings with ``own_text``: body without the paragraphs of which ``rules.boilerplate_percent`` of 100 runs are common.

    Paragraphs that postings share word for word are dropped as by the rule of equal paragraphs, since all their runs are common.
    Every posting keeps its row; blank lines go.  A null text is an empty one, and postings without a source keep all.
    """
    rows = written(with_runs(postings, body).select(key, source, "_runs"), "paragraph_runs")
    common = written(common_runs(rows, source, rules.boilerplate_postings, rules.boilerplate_share), "common_runs")
    if common.count() <= listed:
        # of a posting's own lines the runs are found again: texts aren't written beside their runs
        own = with_runs(postings, body).join(F.broadcast(common.groupBy(source).agg(F.collect_list("run").alias("_common"))), source, "left")
        shared = lambda runs: F.coalesce(F.size(F.array_intersect(runs, F.col("_common"))), F.lit(0))
        kept = F.filter(F.arrays_zip("_lines", "_runs"), lambda x: ~_boilerplate(shared(x["_runs"]), x["_runs"], rules.boilerplate_percent))
        return own.withColumn("own_text", F.array_join(F.transform(kept, lambda x: x["_lines"]), "\n")).drop("_lines", "_runs", "_common")
    each = rows.select(key, source, F.posexplode("_runs").alias("_at", "_own"))
    each = each.select(key, source, "_at", F.size("_own").alias("_of"), F.explode("_own").alias("run"))
    total = common.agg(F.sum("n")).first()[0]
    met = join_counted(each, common, [source, "run"], "n", total, "inner")
    gone = met.groupBy(key, "_at", "_of").agg(F.count("*").alias("_n")).where(100 * F.col("_n") >= rules.boilerplate_percent * F.col("_of"))
    own = postings.join(gone.groupBy(key).agg(F.collect_list("_at").alias("_gone")), key, "left")
    kept = F.filter(lines_of(body), lambda x, at: ~F.coalesce(F.array_contains("_gone", at), F.lit(False)))
    return own.withColumn("own_text", F.array_join(kept, "\n")).drop("_gone")
