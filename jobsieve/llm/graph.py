"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import join_counted
from .store import removed, written


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "u"))
    # a node with very many edges is joined by broadcast
    return join_counted(both, least, ["u"], "n", 2 * count, "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of the edges (u, v): component is the smallest node that can be reached.

    Edges and labels stay distributed.  Each round writes its edges to the shared folder; the smallest neighbours are
    pre-aggregated, so a node with very many edges is no task of its own.  Edges with a null end or equal ends are
    ignored; a table without edges gives no rows.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state, count = None, now.count()
    for _ in range(most_rounds):
        after = written(_small_star(_large_star(now, count)), "edges")
        removed(now.sparkSession, now)
        now = after
        r = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (r[0], r[1]) == state:
            break
        state, count = (r[0], r[1]), r[0]
    else:
        raise RuntimeError("the components did not settle")
    root = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return root.union(root.select(F.col("component").alias("node"), "component").distinct())
