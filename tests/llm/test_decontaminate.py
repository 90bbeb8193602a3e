import random

from jobsieve.llm import decontaminate
from jobsieve.llm.decontaminate import contaminated, needed_matches


def grams(text, k=5):
    """All runs of k words."""
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def held(item, text):
    """(shingles of an item, those that a text has); an item of fewer than five words is one shingle."""
    k = min(5, len((item or "").split()))
    own = grams(item, k) if k else set()
    return len(own), len(own & grams(text, k))


def test_equals_brute_force(spark):
    r = random.Random(2)
    word = lambda: f"w{r.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(r.choice([1, 2, 3, 4, 5, 9, 30, 60, 150])))) for i in range(40)] + [(900, None), (901, ""), (None, "a b c d e f")]
    items.append((41, items[3][1]))
    docs = []
    for i in range(120):
        text = [word() for _ in range(r.choice([0, 3, 50, 400]))]
        if i % 2:
            part = items[r.randrange(40)][1].split()
            part = part[: max(1, int(len(part) * r.choice([0.6, 0.8, 0.9, 1.0, 1.0])))]
            at = r.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((i, " ".join(text)))
    docs += [(500, None), (501, items[5][1].upper()), (501, items[5][1]), (None, items[5][1])]
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = {(d, i, *held(x, t)) for d, t in docs if d is not None for i, x in items if i is not None and held(x, t)[0] and held(x, t)[1] >= 0.75 * held(x, t)[0]}
    assert {tuple(x)[:4] for x in got.collect()} == want and len(want) > 20
    assert got.count() == len(want)


def test_is_native(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = contaminated(df, df.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_odd_texts(spark, odd_docs, no_docs):
    items = odd_docs.withColumnRenamed("doc_id", "item_id")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(odd_docs, items).collect()}
    assert (100, 100) in got and (4, 4) in got and (101, 101) in got and not any(0 in p or 1 in p for p in got)
    assert contaminated(no_docs, items).count() == 0 and contaminated(odd_docs, items.limit(0)).count() == 0


def test_needed_matches_miss_little():
    assert needed_matches(1) == 1 and 8 <= needed_matches(32) <= 14


def test_short_items_in_long_texts(spark):
    docs = spark.createDataFrame([(1, "if two plus two is " + "more or less " * 4000 + "four then so be it"), (2, "two  PLUS\ttwo"), (3, "two plus one plus two"), (4, "plus")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Two plus two"), (2, "plus"), (3, "four then"), (4, "four then so be"), (5, "plus two"), (6, "two plus two is more or")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in contaminated(docs, items).collect()}
    assert got == {(1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 1, 1), (1, 4, 1, 1), (1, 5, 1, 1), (1, 6, 2, 2), (2, 1, 1, 1), (2, 2, 1, 1), (2, 5, 1, 1), (3, 2, 1, 1), (3, 5, 1, 1), (4, 2, 1, 1)}
    assert {r["item_id"] for r in contaminated(docs, items, least_words=3).collect()} == {1, 4, 6}
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items, k=3).collect()} >= {(1, 1), (1, 6), (2, 1)}


def test_joins_beyond_the_bound_of_broadcasts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c d e f g{i % 3}") for i in range(30)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"b c d e f g{i}") for i in range(3)] + [(9, "e f")], "item_id long, text string")
    want = sorted(map(tuple, contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "broadcast_if_small", lambda df, *_: df)
    assert sorted(map(tuple, contaminated(docs, items).collect())) == want and len(want) == 60
