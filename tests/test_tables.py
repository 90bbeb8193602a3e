"""Joins that no frequent key holds up."""

from pyspark.sql import functions as F

from jobsieve.tables import join_counted


def test_counted_joins_equal_plain_ones(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 200).alias("k"), "id")
    keyed = rows.where("k < 150").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    for how in ("left", "inner"):
        want = sorted(map(str, rows.join(keyed, "k", how).select("k", "id", "n", "first").collect()))
        for most in (1_000, 100, 2):
            got = join_counted(rows, keyed, ["k"], "n", 3000, how, 1, most).select("k", "id", "n", "first")
            assert sorted(map(str, got.collect())) == want
    plan = join_counted(rows, keyed, ["k"], "n", 3000, "left", 1, 100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Union" in plan
