import numpy as np
import pytest

from jobsieve.llm import ann as A


def brute(rows, queries, k=5):
    x = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            a = np.array(v, float)
            x.setdefault(i, []).append(a / np.sqrt(a @ a))
    out = {}
    for q in queries:
        own = x[q][0]
        cand = [(-float(own @ v), i) for i, vs in x.items() if i != q for v in vs if len(v) == len(own)]
        out[q] = sorted(cand)[:k]
    return out


def search(spark, rows, where, **how):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, shard int")
    got = {}
    for r in A.search(A.build_index(df, **how), df.where(where)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [x[1:] for x in sorted(v)] for q, v in got.items()}


@pytest.mark.parametrize("shard", [64, 5000])
def test_recall(spark, shard):
    r = np.random.default_rng(1)
    rows = [(i, (r.standard_normal(16) + 3 * np.eye(16)[i % 16]).tolist()) for i in range(900)]
    got = search(spark, rows, "vec_id % 20 = 0", shard_vectors=shard)
    want = brute(rows, range(0, 900, 20))
    hit = sum(len({i for i, _ in got[q]} & {i for _, i in w}) for q, w in want.items())
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values()) and hit >= 0.95 * 5 * len(want)
    for q, v in got.items():
        sims = {i: -s for s, i in brute(rows, [q], 899)[q]}
        assert all(abs(sims[i] - s) < 1e-12 for i, s in v) and [s for _, s in v] == sorted((s for _, s in v), reverse=True)


def test_many_copies_ties_and_unsound_vectors(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal(8).tolist()
    rows = [(i, base) for i in range(200)] + [(1000 + i, r.standard_normal(8).tolist()) for i in range(40)]
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [1.0, None] + [0.0] * 6), (2003, [float("nan")] + [1.0] * 7), (2004, [float("inf")] + [1.0] * 7), (2005, []), (None, base), (2006, [1.0, 2.0]), (2007, [2.0, 1.0])]
    got = search(spark, rows, "vec_id in (0, 3, 150, 1000, 2000, 2001, 2002, 2003, 2004, 2005, 2006)")
    want = brute(rows, [0, 3, 150, 1000, 2006])
    assert set(got) == set(want)
    for q in (0, 3, 150):
        assert [i for i, _ in got[q]] == [i for _, i in want[q]] == [i for i in range(6) if i != q][:5]
    assert [i for i, _ in got[1000]] == [i for _, i in want[1000]] and [i for i, _ in got[2006]] == [2007]


def test_no_vectors(spark):
    assert search(spark, [], "true") == {} and search(spark, [(1, [1.0])], "true") == {}
