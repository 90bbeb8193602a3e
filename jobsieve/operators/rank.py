"""Deduplication, ranks and reports' order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..tables import join_counted, written


def mark_duplicates(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """df with ``duplicate``: whether another row of the key comes first; order must tell all rows apart.  A row without a
    key is no duplicate.

    Only keys of several rows are joined back, those that very many rows share by broadcast.
    """
    shared = written(df.groupBy(key).agg(F.min(F.struct(*order)).alias("keeper"), F.count("*").alias("_n")).where(F.col("_n") > 1), "keepers")
    total = shared.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    marked = join_counted(df, shared, [key], "_n", total)
    return marked.withColumn("duplicate", F.coalesce(F.struct(*order) != F.col("keeper"), F.lit(False))).drop("keeper", "_n")


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return mark_duplicates(df, key, order).where(~F.col("duplicate")).drop("duplicate")


def duplicate_groups(df: DataFrame, key: str, source: str = "source") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(source).alias("n_sources")).where("n > 1")


def top_per_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group with their rank; Spark limits each group before the shuffle too."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)


def global_rank(df: DataFrame, order: list[Column]) -> DataFrame:
    """df with ``rank`` from 1 in the total order.  Rows are range-partitioned and sorted; a rank is the place in its
    partition plus the sizes of those before it, so no task sees all rows."""
    names = df.columns
    low = F.lit((1 << 33) - 1)
    placed = written(df.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(low)}), "ranked")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row per partition
    return placed.join(F.broadcast(before), "_part").select(*names, (F.col("_before") + F.col("_place") + 1).alias("rank"))
