import itertools
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from .conftest import DE, WORDS, prose
from jobsieve.llm import language as L
from jobsieve.llm import words

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def voc():
    return L.vocabulary(PATH)


def segmentations(word, pieces):
    """Total probability over all segmentations, one by one."""
    total = 0.0
    for n in range(len(word)):
        for cuts in itertools.combinations(range(1, len(word)), n):
            ends = [0, *cuts, len(word)]
            parts = [word[a:b] for a, b in itertools.pairwise(ends)]
            if all(p in pieces for p in parts):
                total += math.prod(pieces[p] for p in parts)
    return total


def test_every_piece_is_found(voc):
    hashes = []
    with np.errstate(over="ignore"):
        for p in voc.pieces:
            h = np.uint64(len(p)) * L._M
            for j, b in enumerate(p):
                h += L._letters[j][b]
            hashes.append(h)
    assert (voc.find(np.array(hashes, np.uint64)) == np.arange(voc.size)).all()
    assert (voc.find(np.arange(1000, dtype=np.uint64)) == voc.size).all()


@pytest.mark.parametrize("word", [" the", " xqz", " ß", " nation"])
def test_forward_sums_all_segmentations(voc, word):
    r = np.random.default_rng(3)
    probs = r.random((voc.size + 1, 2)) / voc.size
    probs[-1] = 0
    raw = word.encode()
    got = L.forward(voc, np.frombuffer(raw, np.uint8)[None, :], probs)[0]
    for lang in range(2):
        want = segmentations(raw, dict(zip(voc.pieces, probs[:, lang])))
        assert got[lang] == pytest.approx(math.log(want), rel=1e-12)


def test_expected_counts_cover_the_words(voc):
    p = np.append(np.full(voc.size, 1 / voc.size), 0.0)
    letters = np.frombuffer(b" the and", np.uint8).reshape(2, 4)
    counts = L.expected_counts(voc, letters, np.array([2.0, 3.0]), p)
    lengths = np.array([len(x) for x in voc.pieces])
    assert (counts[:-1] * lengths).sum() == pytest.approx(4 * 5)


def test_long_words_are_scored_in_parts(voc):
    probs = np.append(np.full((voc.size, 1), 1 / voc.size), [[0.0]], axis=0)
    chunk = next(words.chunks(pa.array(["x" * 1000 + " a"]), words.SPACED))
    assert L._scores(chunk, voc, probs)[0, 0] < -100


def test_held_out_accuracy(spark):
    rows = [(i, prose(i, 40, WORDS if i % 2 else DE), "en" if i % 2 else "de") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(df.where("doc_id < 100"), PATH)
    got = df.where("doc_id >= 100").select("lang", L.identify(F.col("text"), model, spark).alias("f")).select("lang", "f.*").collect()
    assert all(r["lang"] == r["lang_pred"] and 0.5 <= r["score"] <= 1 for r in got)


def test_odd_texts(spark, odd_docs, no_docs):
    model = L.fit(odd_docs, PATH)
    rows = {r["doc_id"]: r["f"] for r in odd_docs.select("doc_id", L.identify(F.col("text"), model, spark).alias("f")).collect()}
    assert [rows[i]["lang_pred"] for i in range(6)] == ["und"] * 4 + ["en"] * 2 and rows[0]["score"] == 0
    kept = L.kept_languages(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 4
    none = L.fit(no_docs, PATH)
    assert none.langs == [] and {r[0]["lang_pred"] for r in odd_docs.select(L.identify(F.col("text"), none, spark)).collect()} == {"und"}
    assert L.kept_languages(no_docs, model).count() == 0
