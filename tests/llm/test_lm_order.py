import math
import random
from collections import Counter, defaultdict

import pytest

from jobsieve.llm import lm, queries
from .test_lm import tokens


class Brute:
    """The model of any order by its formulas, with plain dictionaries."""

    def __init__(self, texts, order):
        self.order, rows = order, [tokens(t) for t in texts]
        self.c = Counter(w for r in rows for w in r)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.counts = {order: Counter(g for r in rows for g in self.grams(r))}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d, self.total, self.kinds = {}, Counter(), defaultdict(lambda: [0, 0, 0])
        for counts in self.counts.values():
            of = Counter(counts.values())
            self.d[len(next(iter(counts)))] = lm.discounts(*(of[i] for i in (1, 2, 3, 4)))
            for g, c in counts.items():
                self.total[g[:-1]] += c
                self.kinds[g[:-1]][min(c, 3) - 1] += 1

    def grams(self, row):
        padded = [0] * (self.order - 1) + row
        return [tuple(padded[i : i + self.order]) for i in range(len(row))]

    def p(self, g):
        if not g:
            return 1 / (self.v + 1)
        low, u, d = self.p(g[1:]), g[:-1], self.d[len(g)]
        if not self.total[u]:
            return low
        c = self.counts[len(g)][g]
        return (max(c - (0, *d)[min(c, 3)], 0) + sum(a * b for a, b in zip(self.kinds[u], d)) * low) / self.total[u]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_equals_the_formulas_of_the_order(spark, order):
    r = random.Random(1)
    word = lambda: f"W{int(r.paretovariate(0.6)) % 400}"
    texts = [" \n".join(word() for _ in range(r.randrange(80))) for _ in range(120)] + ["a b c"] * 300 + [None, "", "a b d a b", "é É W1 w1"]
    train = texts[::2] + [None]
    brute = Brute(train, order)
    model = lm.fit(spark.createDataFrame([(t,) for t in train], "text string"), shard_bytes=2000, order=order)
    assert (model.n, model.v) == (brute.n, brute.v) and len(model.hot) > 1
    for r in lm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect():
        t = tokens(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"]) == (len(t), sum(w in brute.c for w in t))
        assert r["score"] == pytest.approx(sum(math.log10(brute.p(g)) for g in brute.grams(t)), rel=1e-9, abs=1e-12)
    for u in ((b"w1", b"w2", b"w1"), (0, b"a", b"b"), (b"unseen", b"w1", b"w2")):
        assert sum(brute.p((*u[4 - order :], w)) for w in [*brute.c, b"never seen"]) == pytest.approx(1)


def test_the_query_looks_further_back_than_a_word(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c" if i % 2 else "d b e") for i in range(60)] + [(90, "a b c"), (91, "d b c")], "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    score = {r["doc_id"]: r["score"] for r in queries.op3_lm_scoring(spark, "").collect()}
    assert score[90] > score[91] + 1


def test_no_texts_and_odd_ones(spark, odd_docs, no_docs):
    model = lm.fit(odd_docs, order=3)
    assert all(math.isfinite(r["score"]) for r in lm.score(odd_docs, model).collect())
    assert all(r["score"] == 0 for r in lm.score(odd_docs, lm.fit(no_docs, order=3)).collect())
