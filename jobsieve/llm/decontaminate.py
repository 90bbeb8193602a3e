"""Benchmark decontamination: short test items found inside long documents, with DataFrame functions alone.

An item is far shorter than the documents that may hold it, so similarity says little and containment decides: the
share of the item's word shingles that the document has.  Items are partitioned by size, and each gets a MinHash
sketch, the ``sketch`` smallest of its shingle hashes, and the number of matches that a document must reach for its
partition.  Documents look up all their shingles in the sketches; candidates are then verified on the shingles
themselves.  A document costs its length, however many items there are; items of fewer words than a shingle are
partitions of their own with shorter shingles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import broadcast_if_small, written

WORDS = 5
CONTAINMENT = 0.75
SKETCH = 32
#: Chance that an item at the threshold has too few sketch matches, at most.
MISS = 1e-6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_array(text: Column) -> Column:
    """The words between white space, with A-Z in lower case; none for null."""
    folded = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(folded, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _runs(words: Column, k: int, join) -> Column:
    """join(list of k columns) for each run of k words; none for fewer words."""
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: join([F.get(words, i + j) for j in range(k)]))
    return F.when(F.size(words) >= k, runs).otherwise(F.slice(F.array(join([F.lit("")] * k)), 1, 0))


def shingle_hashes(words: Column, k: int) -> Column:
    return F.array_distinct(_runs(words, k, lambda w: F.xxhash64(*w)))


def shingles(words: Column, k: int) -> Column:
    return F.array_distinct(_runs(words, k, lambda w: F.concat_ws(" ", *w)))


def _of_size(words: Column, size: Column, sizes: list[int], of) -> Column:
    """of(words, size), where size is one of sizes."""
    out = F.when(size == sizes[0], of(words, sizes[0]))
    for k in sizes[1:]:
        out = out.when(size == k, of(words, k))
    return out


def needed_matches(drawn: int, threshold: float = CONTAINMENT, miss: float = MISS) -> int:
    """The most matches among ``drawn`` shingles of a larger item that one at the threshold misses with chance <= miss."""
    total = 0.0
    for c in range(drawn + 1):
        total += math.comb(drawn, c) * threshold**c * (1 - threshold) ** (drawn - c)
        if total > miss:
            return max(1, c)
    return drawn


def contaminated(docs: DataFrame, items: DataFrame, k: int = WORDS, threshold: float = CONTAINMENT, sketch: int = SKETCH, miss: float = MISS, least_words: int = 1, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of all pairs with containment >= threshold.

    n_item counts the item's distinct shingles, n_shared those that the document has.  Shingles are runs of k words; the
    partitions of items with fewer words have runs of as many words as the item has, so such an item is one shingle and
    is found wherever its words stand in a row; items of fewer than least_words are left out.  Null or empty
    texts hold and match nothing; rows with a null id are left out; equal rows count once, of different texts under
    one id that with the most shared shingles counts; empty tables give no rows; other columns are ignored.
    """
    own = items.select(F.col(item_id).cast("long").alias("item_id"), word_array(F.col(item_text)).alias("words")).where((F.size("words") >= max(1, least_words)) & F.col("item_id").isNotNull())
    own = own.withColumn("run", F.least(F.size("words"), F.lit(k)))
    every = list(range(1, k + 1))
    own = own.select("item_id", "run", F.array_sort(_of_size(F.col("words"), F.col("run"), every, shingle_hashes)).alias("hashes"), _of_size(F.col("words"), F.col("run"), every, shingles).alias("grams"))
    # partitions of item sizes: the run, and (2^(p-1), 2^p] shingles
    own = written(own.withColumn("n_item", F.size("grams")).withColumn("part", F.ceil(F.log2("n_item")).cast("int")), "items")
    known = own.groupBy("run").agg(F.count("*").alias("n"), F.sum(F.octet_length(F.concat_ws("", "grams"))).alias("bytes"), F.sum(F.least("n_item", F.lit(sketch))).alias("hashes")).collect()  # at most k rows
    runs = sorted(r["run"] for r in known) or [k]
    item_bytes = sum(r["bytes"] + 64 * r["n"] for r in known)
    drawn = F.least(F.col("n_item"), F.lit(sketch))
    # the same need for a whole partition: that of its smallest item; an item that is all in its sketch has its own
    whole = F.ceil(F.col("n_item") * threshold - 1e-9)
    need = F.when(F.col("n_item") <= sketch, whole).otherwise(F.lit(needed_matches(sketch, threshold, miss)))
    sketches = own.select("item_id", F.col("run").alias("item_run"), need.cast("int").alias("need"), F.ceil(F.lit(threshold) * F.pow(F.lit(2.0), F.col("part") - 1)).alias("least_size"), F.explode(F.slice("hashes", 1, sketch)).alias("hash"))

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    worded = texts.select("doc_id", word_array(F.col("text")).alias("words"))
    by_run = [F.struct(F.lit(n).alias("run"), shingle_hashes(F.col("words"), n).alias("hashes")) for n in runs]
    if len(runs) == 1:
        looked = worded.select("doc_id", by_run[0].alias("own"))
    else:
        looked = worded.select("doc_id", F.explode(F.array(*by_run)).alias("own"))
    looked = looked.select("doc_id", "own.run", "own.hashes")
    # explode() would have the optimizer filter on the array's size first, and build every array inside that filter again
    looked = looked.select("doc_id", "run", F.size("hashes").alias("size"), F.explode_outer("hashes").alias("hash"))
    hits = looked.join(broadcast_if_small(sketches, sum(r["hashes"] for r in known)), "hash").where("size >= least_size and run = item_run")
    found = hits.groupBy("doc_id", "item_id").agg(F.count("*").alias("matches"), F.first("need").alias("need")).where("matches >= need").select("doc_id", "item_id")
    found = written(found, "candidates")

    # candidates' texts are split and compared in the task that reads them, if the lists of pairs and items are small
    n_found = found.count()
    items_of = found.groupBy("doc_id").agg(F.collect_list("item_id").alias("items")) if n_found else found.select("doc_id", F.array("item_id").alias("items"))
    held = texts.join(broadcast_if_small(items_of, n_found), "doc_id").select("doc_id", word_array(F.col("text")).alias("words"), F.explode("items").alias("item_id"))
    pairs = held.join(broadcast_if_small(own.select("item_id", "run", "grams", "n_item"), item_bytes, 1), "item_id")
    same = F.size(F.array_intersect("grams", _of_size(F.col("words"), F.col("run"), runs, shingles)))
    shared = pairs.select("doc_id", "item_id", F.col("n_item").cast("long").alias("n_item"), same.cast("long").alias("n_shared"))
    best = shared.groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared"))
    return best.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("containment") >= threshold)
