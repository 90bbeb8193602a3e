import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from jobsieve.llm import language as L

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_languages_of_repeated_texts_stay_and_copies_come_once(spark):
    rows = [(f"only {k} word", f"l{k}") for k in range(12) for _ in range(40)] + [(f"text {i % 200} is here", "en") for i in range(2000)] + [(" \t\n", "no"), (None, "no"), ("x", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = L.drawn(df.where("lang is not null and text is not null"), 4).collect()
    own = {}
    for r in got:
        own.setdefault(r["lang"], []).append(r["times"])
    assert set(own) == {"en", *(f"l{k}" for k in range(12))}
    assert all(own[f"l{k}"] == [40] for k in range(12)) and set(own["en"]) == {10} and len(own["en"]) < 20
    assert L.fit(df, PATH, sample_texts=4, rounds=1).langs == sorted(own)


def test_times_are_copies():
    voc = L.vocabulary(PATH)
    texts = ["the word and the rest", "another internationalorganizationrelationship text"]
    weighed = L.fit_pieces(voc, pa.array(texts), times=np.array([3.0, 2.0]))
    assert weighed == pytest.approx(L.fit_pieces(voc, pa.array([texts[0]] * 3 + [texts[1]] * 2)), rel=1e-9)
