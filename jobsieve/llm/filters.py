"""An audit of how filters interact, from counts of masks by a subset-zeta transform.

Every document gets a mask of the filters that it fails.  Documents are counted by part and mask where they are read, so a
part of any size is at most 2^n rows after that.  Summing a part's counts over subsets (one pass per filter) gives, for
every set of filters at once, how many documents fail none outside of it: the survivors of the rest.  What a step of
any order removes is then the difference between two neighbouring subsets, and likewise for labelled documents.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import join_counted
from .store import written

# White space between words, the symbols of the fourth filter.
WHITE, SYMBOLS = r"[\x20\x09-\x0D]+", "[#$%&*|]"
#: Filters at most: the result has a row for each step of each of their orders.
MOST = 6


def text_filters(text: Column) -> dict[str, Column]:
    """What a text fails for: A few words, B repeated words, C capitals, D symbols."""
    words = F.filter(F.split(text, WHITE), lambda w: w != "")
    n = F.size(words)
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * 100 < n * 65,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * 5,
        "D": text.rlike(SYMBOLS),
    }


def repeats(docs: DataFrame, key: str, id_col: str) -> DataFrame:
    """docs with ``repeat``: whether a smaller id has the same key; null ids have no smaller ones and are none.

    A key that very many rows share is counted before any shuffle and joined back by broadcast.
    """
    first = docs.groupBy(key).agg(F.min(id_col).alias("_first"), F.count("*").alias("_n")).where(F.col("_n") > 1)
    first = written(first, "first")
    total = first.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    own = join_counted(docs, first, [key], "_n", total)
    return own.withColumn("repeat", F.coalesce(F.col(id_col) > F.col("_first"), F.lit(False))).drop("_first", "_n")


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, mask) of every row: bit k is set where it fails the k-th of the filters A to E."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    bits = [F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(text_filters(F.col("text")).values())]
    # texts are told apart by SHA-256: they stay where they are read
    light = written(own.select("doc_id", "part", sum(bits[1:], bits[0]).alias("_bits"), F.sha2("text", 256).alias("_key")), "masks")
    mask = F.col("_bits") + F.when(F.col("repeat"), 1 << len(bits)).otherwise(0)
    return repeats(light, "_key", "doc_id").select("doc_id", "part", mask.cast("int").alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): rows, and those whose id has a label row with quality 1, or with toxic 1.

    Rows without an id have no label; several label rows of an id count as one.
    """
    flag = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    marked = labels.where(flag["good"] | flag["toxic"]).where(F.col(id_col).isNotNull())
    marked = marked.groupBy(F.col(id_col).alias("doc_id")).agg(*[F.bool_or(F.coalesce(x, F.lit(False))).cast("int").alias(k) for k, x in flag.items()])
    every = masks.groupBy("part", "mask").agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    labelled = masks.join(marked, "doc_id").groupBy("part", "mask").agg(F.lit(0).cast("long").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return every.unionByName(labelled).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _zeta_pass(f: Column, n: int, bit: int) -> Column:
    """One pass of the transform: what a mask without the bit has is added to the mask with it."""
    without = lambda m: F.when(m.bitwiseAND(bit) != 0, F.get(f, m - bit)).otherwise(0)
    return F.transform(F.sequence(F.lit(0), F.lit((1 << n) - 1)), lambda m: F.get(f, m) + without(m))


def survivors(counts: DataFrame, n: int) -> DataFrame:
    """(part, alone, kept, good, toxic) of counts (part, mask, n, good, toxic): arrays by subset of the n filters.

    kept[s] is how many rows the filters of s let pass, good[s] and toxic[s] how many of the labelled; alone[k] how many
    fail the k-th filter only.
    """
    full = (1 << n) - 1
    # at most 2^n rows of a part, and as many elements of its arrays
    own = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("x"))
    every = F.sequence(F.lit(0), F.lit(full))
    zero = F.lit(0).cast("long")

    def by_mask(c: str) -> Column:
        return F.transform(every, lambda m: F.coalesce(F.try_element_at("x", m)[c], zero))

    def outside(c: str) -> Column:
        """The filters of s let pass what fails none of them: the subsets of the others."""
        return F.transform(every, lambda s: F.get(c, F.lit(full) - s))

    own = own.select("part", *[by_mask(c).alias(c) for c in ("n", "good", "toxic")])
    own = own.withColumn("alone", F.array(*[F.get("n", F.lit(1 << k)) for k in range(n)]))
    for k in range(n):
        own = own.withColumns({c: _zeta_pass(F.col(c), n, 1 << k) for c in ("n", "good", "toxic")})
    return own.select("part", "alone", outside("n").alias("kept"), outside("good").alias("good"), outside("toxic").alias("toxic"))


def orders(letters: str) -> list[tuple[str, int, int, int, int]]:
    """(filter_order, step, place of its filter, mask before, mask after) of every step of every order of the letters."""
    out = []
    for order in permutations(range(len(letters))):
        before = 0
        for step, k in enumerate(order, 1):
            out.append(("".join(letters[x] for x in order), step, k, before, before | 1 << k))
            before |= 1 << k
    return out


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step of it, zeros included, from counts of masks (see ``survivors``).

    Rows have kept and removed, redundant (failing the step's filter but removed earlier), unique_fails (failing that filter
    only), good_lost and toxic_lost, and shapley: what the filter removes, summed over all orders.
    """
    n = len(letters)
    if not 0 < n <= MOST or len(set(letters)) < n:
        raise ValueError(f"from one to {MOST} different letters")

    def share(k: int) -> Column:
        """What the k-th filter removes, over the orders that have each subset of the others in front of it."""
        terms = [(F.get("kept", F.lit(s)) - F.get("kept", F.lit(s | 1 << k))) * (factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())) for s in range(1 << n) if not s >> k & 1]
        return reduce(Column.__add__, terms)

    own = survivors(counts, n).withColumn("shapley", F.array(*map(share, range(n))))
    steps = dict(zip(("filter_order", "step", "k", "before", "after"), map(list, zip(*orders(letters)))))
    row = own.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(steps["k"]) - 1))))
    row = row.withColumns({name: F.get(F.lit(values), F.col("at")) for name, values in steps.items()})
    failing = F.get("kept", F.lit(0)) - F.get("kept", F.col("after") - F.col("before"))
    gone = F.get("kept", F.col("before")) - F.get("kept", F.col("after"))
    return row.select(
        "part",
        "filter_order",
        "step",
        F.get("kept", F.col("after")).alias("kept"),
        gone.alias("removed"),
        (failing - gone).alias("redundant"),
        F.get("alone", F.col("k")).alias("unique_fails"),
        (F.get("good", F.col("before")) - F.get("good", F.col("after"))).alias("good_lost"),
        (F.get("toxic", F.col("before")) - F.get("toxic", F.col("after"))).alias("toxic_lost"),
        F.get("shapley", F.col("k")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """The interactions of the filters A to E over whole documents, by source.

    A null text counts as empty, a null source is the part of the empty string.  Rows that repeat an id are documents
    each and share its labels; E fails where a smaller id has an identical text, so neither rows of one id nor rows without an
    id repeat each other.  Null labels are none.  An empty table gives no rows; other columns are ignored.
    """
    return interactions(written(mask_counts(masked(docs, id_col, text_col, part_col), labels, id_col), "counts"), "ABCDE")
