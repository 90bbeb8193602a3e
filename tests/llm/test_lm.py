import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from jobsieve.llm import lm


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), None]


class Brute:
    """The model by its formulas, with plain dictionaries."""

    def __init__(self, texts):
        rows = [tokens(t) for t in texts]
        self.c = Counter(w for r in rows for w in r)
        self.pairs = Counter(p for r in rows for p in zip([0, *r], r))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.total, self.kinds, self.follows = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
        for (u, w), c in self.pairs.items():
            self.total[u] += c
            self.kinds[u][min(c, 3) - 1] += 1
            self.follows[w] += 1
        of, ff = Counter(self.pairs.values()), Counter(self.follows.values())
        self.d2 = (0, *lm.discounts(*(of[i] for i in (1, 2, 3, 4))))
        self.d1 = (0, *lm.discounts(*(ff[i] for i in (1, 2, 3, 4))))
        more = sum(n for k, n in ff.items() if k > 2)
        self.spare = (self.d1[1] * ff[1] + self.d1[2] * ff[2] + self.d1[3] * more) / len(self.pairs) if self.pairs else 1

    def p(self, u, w):
        n = self.follows[w]
        low = (max(n - self.d1[min(n, 3)], 0) / len(self.pairs) if self.pairs else 0) + self.spare / (self.v + 1)
        if not self.total[u]:
            return low
        c = self.pairs[u, w]
        return (max(c - self.d2[min(c, 3)], 0) + sum(a * b for a, b in zip(self.kinds[u], self.d2[1:])) * low) / self.total[u]

    def row(self, text):
        t = tokens(text)
        base = sum(math.log10((self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in t)
        return len(t), sum(self.c[w] > 0 for w in t), base, sum(math.log10(self.p(u, w)) for u, w in zip([0, *t], t))


def compare(spark, train, texts):
    brute = Brute(train)
    model = lm.fit(spark.createDataFrame([(t,) for t in train], "text string"), shard_bytes=2000)
    assert (model.n, model.v) == (brute.n, brute.v)
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(texts):
        n, known, base, score = brute.row(t)
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (n, known)
        assert r["base_score"] == pytest.approx(base, rel=1e-12, abs=1e-12) and r["score"] == pytest.approx(score, rel=1e-9, abs=1e-12)
    return brute


def test_equals_the_formulas(spark):
    r = random.Random(1)
    word = lambda: f"W{int(r.paretovariate(0.6)) % 400}"
    texts = [" \n".join(word() for _ in range(r.randrange(80))) for _ in range(150)] + [None, "", " ", "é É W1 w1"]
    brute = compare(spark, texts[::2] + [None], texts)
    for u in (b"w1", 0, b"unseen"):
        assert sum(brute.p(u, w) for w in brute.c) + brute.p(u, b"never seen") == pytest.approx(1)


def test_counts_above_a_byte_and_a_frequent_word(spark):
    compare(spark, ["a b"] * 300 + ["a c a d"] * 5, ["a b", "b a", "a", ""])


def test_odd_texts(spark, odd_docs, no_docs):
    model = lm.fit(odd_docs)
    rows = lm.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(math.isfinite(r["score"]) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2)} == {1}
    none = lm.fit(no_docs)
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in lm.score(odd_docs, none).collect())
    assert lm.score(no_docs, model).count() == 0


def test_discounts():
    assert lm.discounts(0, 0, 0, 0) == lm.FALLBACK and all(0 <= d <= 3 for d in lm.discounts(100, 40, 20, 10))


def test_mapped_arrays_hold_no_descriptors(tmp_path):
    """A model of some GB has tens of thousands of arrays, more than a process may have files open."""
    for i in range(200):
        lm.put(str(tmp_path), f"{i}.x", np.arange(i, dtype="<u4"))
    lm.mapped.cache_clear()
    before = len(os.listdir("/proc/self/fd"))
    arrays = [lm.mapped(str(tmp_path), f"{i}.x", "<u4") for i in range(200)]
    assert len(os.listdir("/proc/self/fd")) - before < 20
    assert all((a == np.arange(i)).all() and len(a) == i for i, a in enumerate(arrays))
