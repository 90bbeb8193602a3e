import itertools
import random

import numpy as np
import pytest

from jobsieve.llm import near_dedup as N
from jobsieve.llm.graph import components


def shingles(text):
    w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = [x for x in __import__("re").split("[ \t-\r]+", w) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def run(spark, docs, **how):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_duplicates(df, **how).collect()}


def edited(words, r, rate):
    return " ".join(w if r.random() > rate else f"x{r.randrange(10**6)}" for w in words)


def groups(seed):
    r = random.Random(seed)
    docs = []
    for g in range(6):
        base = [f"w{r.randrange(500)}" for _ in range(r.choice([4, 6, 30, 120]))]
        docs += [" ".join(base)] * 2 + [edited(base, r, rate) for rate in (0.01, 0.02, 0.03, 0.05, 0.1)]
    r.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [2, 2048])
def test_equals_brute_force(spark, seed, block):
    docs = groups(seed)
    assert run(spark, docs, block=block) == brute(docs)


def test_a_large_group_with_members_at_all_distances(spark):
    r = random.Random(5)
    base = [f"w{r.randrange(500)}" for _ in range(100)]
    docs = list(enumerate(edited(base, r, r.uniform(0, 0.06)) for _ in range(120)))
    assert run(spark, docs, block=16) == brute(docs)


def test_large_buckets_are_dealt_by_a_second_band(spark):
    """Texts that share a long passage, in groups of near copies: few bands tell all of them apart."""
    r = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for _ in range(25):
        own = [f"w{r.randrange(10**6)}" for _ in range(20)]
        docs += [edited(own, r, rate) + " " + " ".join(passage) for rate in (0, 0.05, 0.1)]
    docs = list(enumerate(docs))
    want = brute(docs)
    assert 3 < len({c for _, c, _ in want.values()})
    assert run(spark, docs, block=8, large=4) == run(spark, docs, block=8, large=10**9) == want


def test_rows_that_repeat_an_id_are_judged_by_their_texts(spark):
    a, q = " ".join(f"a{i}" for i in range(30)), " ".join(f"q{i}" for i in range(30))
    rows = [(1, a), (1, q), (2, a), (3, q + " more"), (4, q), (5, "other text that is like none of them"), (5, a + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in N.near_duplicates(df).collect())
    assert got == sorted([(1, 26, 1, True), (1, 26, 1, True), (2, 26, 1, False), (3, 27, 1, False), (4, 26, 1, False), (5, 4, 5, True), (5, 27, 1, False)])


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_BYTES", 1 << 12)
    rows = [(1, i, 3000, 300) for i in range(2, 3000)] + [(5000, 5001, 1, 1 << 20), (5002, 5003, 1, 1 << 20)]
    dealt = N.star_blocks(spark.createDataFrame(rows, "a long, b long, n long, bytes long")).collect()
    sizes = {}
    for r in dealt:
        sizes.setdefault(r["blk"], []).append(r["a"][0])
    assert len(dealt) == len(rows) and max(map(len, sizes.values())) < 40
    assert sorted(map(len, (v for v in sizes.values() if v[0] >= 5000))) in ([1, 1], [2])
    r = random.Random(1)
    docs = list(enumerate(edited([f"w{r.randrange(10**6)}" for _ in range(n)], r, 0) for n in (50, 50, 3000, 3000)))
    docs += [(i + 10, t + " end") for i, t in docs]
    assert run(spark, docs) == brute(docs)


def test_odd_texts(spark, odd_docs, no_docs):
    assert N.near_duplicates(no_docs).count() == 0
    rows = N.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert (by[0]["n_shingles"], by[0]["component_id"], by[0]["kept"]) == (0, 0, True) and by[2]["n_shingles"] == 0
    assert by[9]["n_shingles"] == 1 and by[10]["component_id"] == 9 and by[None]["component_id"] is None and by[None]["kept"]
    assert [r["component_id"] for r in rows if r["doc_id"] == 100] == [100, 100]


def test_posterior_bound():
    least = N.least_matches(320)
    r = np.random.default_rng(1)
    at = r.random((4000, 320)) < 0.75
    sums = np.cumsum(at, axis=1)[:, 31::32]
    assert (sums >= least).all() and least[-1] > 160


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 500)] + [(None, 1), (7, None)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    assert got == {x: find(x) for x in list(root) if any(x in e and e[0] != e[1] for e in edges if None not in e)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
