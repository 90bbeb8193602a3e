import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .conftest import prose
from jobsieve.llm import quality as Q


def bad(i):
    r = random.Random(i)
    words = prose(i, 60).split()
    return [" ".join(w + "%%%" for w in words), " | ".join(words), " ".join(w for w in words[:8] for _ in range(9)), " ".join(w.upper() + "!!" for w in words)][r.randrange(4)]


def test_held_out(spark):
    rows = [(i, prose(i, 60) if i % 3 else bad(i), int(bool(i % 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = Q.fit(df.select("doc_id", "text"), df.where("doc_id < 200").select("doc_id", "quality"))
    got = df.where("doc_id >= 200").select("quality", Q.quality(F.col("text"), model, spark).alias("s")).collect()
    assert sum((r["s"] >= Q.THRESHOLD) == r["quality"] for r in got) >= 0.97 * len(got)
    assert Q.kept_quality(df, model).columns == df.columns


def test_votes_equal_brute_force():
    r = np.random.default_rng(2)
    counts = r.poisson(0.3, (60, Q.TERMS))
    model = Q.train(counts[:40], r.integers(0, 2, 40), 0.5, 8)
    x = Q._unit(Q._weighted(counts[40:], model.idf) @ model.basis)
    want = []
    for v in x:
        sims = sorted(((float(v @ w), float(y)) for w, y in zip(model.vectors, model.labels)), reverse=True)[:5]
        weights = [max(s, 0) ** Q.SHARPNESS for s, _ in sims]
        want.append(sum(w * y for w, (_, y) in zip(weights, sims)) / sum(weights) if sum(weights) > 1e-9 else 0.5)
    assert np.allclose(Q.vote(model, counts[40:], 5), want, atol=1e-5)


def test_counts_do_not_depend_on_spans():
    texts = [prose(1, 300), None, "", "aB9 \n|", prose(2, 3)]
    (_, whole), = list(Q.term_counts(pa.array(texts)))
    assert (whole == np.concatenate([c for t in texts for _, c in Q.term_counts(pa.array([t], pa.string()))])).all()
    assert whole[0].sum() == 2 * 300 + len(texts[0]) - 2 and not whole[1].any() and not whole[2].any()


def test_odd_texts(spark, odd_docs, no_docs):
    labels = odd_docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality", "text as score")
    model = Q.fit(odd_docs, labels)
    got = odd_docs.select("doc_id", Q.quality(F.col("text"), model, spark).alias("s")).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["s"] <= 1 for r in got)
    assert {r["s"] for r in got if r["doc_id"] in (0, 1)} == {model.prior}
    none = Q.fit(no_docs, labels)
    assert all(r[0] == none.prior for r in odd_docs.select(Q.quality(F.col("text"), none, spark)).collect())
    assert Q.fit(odd_docs, labels.limit(0)).prior == 0.5 and Q.kept_quality(no_docs, model).count() == 0


def test_ties_do_not_depend_on_order_or_batch():
    r = np.random.default_rng(3)
    counts = r.poisson(0.3, (30, Q.TERMS))
    labelled = np.concatenate((counts[:20], counts[:1], counts[:1], counts[:1]))  # the first vector four times, with both labels
    labels = np.array([0, 1] * 10 + [1, 1, 0])
    model = Q.train(labelled, labels, 0.5, 8)
    turned = Q.Model(model.idf, model.basis, model.vectors[::-1], model.labels[::-1], 0.5)
    asked = np.concatenate((counts[20:], counts[:1]))
    assert np.allclose(Q.vote(model, asked, 3), Q.vote(turned, asked, 3), atol=1e-12)
    assert np.allclose(Q.vote(model, asked, 3), [Q.vote(model, x[None], 3)[0] for x in asked], atol=1e-12)
    assert abs(Q.vote(model, counts[:1], 3)[0] - 0.5) < 1e-6  # the four share three places, two of them with label 1


def test_counts_of_long_texts_and_repeated_labels(spark):
    docs = spark.createDataFrame([(1, "word " * 70_000), (1, "word " * 70_000), (2, "%% " * 9), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 5 + [(2, 0), (2, 0), (3, 1), (None, 1)], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    assert len(model.labels) == 2 and model.prior == 2 / 3
    (_, counts), = Q.term_counts(pa.array(["word " * 70_000]))
    assert counts.max() > 65535 and Q.vote(model, counts, 1)[0] > 0.99
    assert np.allclose(Q._unit(Q._weighted(counts, model.idf) @ model.basis), model.vectors[0], atol=1e-5)
