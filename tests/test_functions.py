import random
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from jobsieve.functions import text as X
from jobsieve.functions import time as S


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("said", "least", "most"),
    [
        ("0–5 years", 0, 5),
        ("1-3 years", 1, 3),
        ("2 to 4 yrs", 2, 4),
        ("3+ years", 3, None),
        ("3 or more years", 3, None),
        ("10 years", 10, None),
        ("new grad", None, None),
        ("for 30 years we have built", None, None),
        ("For over 20 years we lead. 2+ years of experience", 2, None),
        ("more than 2 years of experience", 2, None),
        ("over 3 years of experience with CUDA", 3, None),
        ("for 3 years of experience", 3, None),
        ("minimum of two years experience", 2, None),
        ("up to 5 years of experience", 0, 5),
        ("less than three years experience", 0, 3),
        ("experience: at least 4 years", 4, None),
        ("5 years of experience, of which 2 years with CUDA experience", 5, None),
        ("five (5) years of experience", 5, None),
        ("2.5 years of experience", 2, None),
        ("over the past 12 years we grew; maximum of 2 years", 0, 2),
        ("experienced yearly, in 2024", None, None),
        (None, None, None),
        ("", None, None),
    ],
)
def test_years_asked(spark, said, least, most):
    found = one(spark, said, X.years_asked)
    assert (found and tuple(found)) == (None if least is None else (least, most)) and one(spark, said, X.least_years) == least


TERMS = ["ai", "ml", "machine learning", "tensorrt", "tensorrt-llm", "c++", "entry level", "entry-level", "ai inference"]


def test_terms_in_finds_what_mentions_finds(spark):
    r = random.Random(2)
    bits = ["ai", "AI", "machine", "learning", " ", "-", "\n", "tensorrt", "llm", "c++", "c", "entry", "level", "inference", "é", "x", "  "]
    said = ["".join(r.choice(bits) + r.choice(["", " ", "-"]) for _ in range(r.randint(0, 9))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(s,) for s in said], "x string")
    for row in df.select("x", X.terms_in(F.col("x"), TERMS).alias("found"), *[X.mentions(F.col("x"), [t]).alias(f"t{k}") for k, t in enumerate(TERMS)]).collect():
        assert set(row["found"]) == {t for k, t in enumerate(TERMS) if row[f"t{k}"]}, row["x"]
    assert one(spark, "ai", lambda c: X.terms_in(c, [])) == []


@pytest.mark.parametrize(("said", "tokens", "hit"), [("maintain email systems", ["ai"], False), ("AI systems", ["ai"], True), ("TensorRT-LLM", ["tensorrt-llm"], True), ("c++ (ai)", ["ai"], True), (None, ["ai"], False), ("ai", [], False)])
def test_mentions(spark, said, tokens, hit):
    assert one(spark, said, lambda c: X.mentions(c, tokens)) is hit


@pytest.mark.parametrize(("url", "want"), [("https://www.Example.com/a/?utm=1#x", "example.com/a"), ("http://m.example.com/a", "example.com/a"), ("", None), (None, None)])
def test_canonical_url(spark, url, want):
    assert one(spark, url, X.canonical_url) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [("https://careers.a.com/job?pid=1", "careers.a.com/job?pid=1"), ("https://careers.a.com/#/job/3", "careers.a.com#/job/3"), ("http://www.A.com/x/?utm_source=1&b=2&A=1#top", "a.com/x?a=1&b=2"), ("http://a.com/x?utm=1", "a.com/x"), ("", None), (None, None)],
)
def test_url_key(spark, url, want):
    assert one(spark, url, X.url_key) == want


def test_identity(spark):
    pages = ["job?pid=1", "job?pid=2", "#/job/3", "#/job/4", "job?pid=1&utm_source=x"]
    rows = [("s", None, f"https://careers.a.com/{p}") for p in pages] + [("s", "1", "https://careers.a.com/job"), ("s", "2", "https://careers.a.com/job"), ("t", "1", "https://careers.a.com/job")]
    df = spark.createDataFrame(rows, "source string, native_id string, url string")
    ids = [r[0] for r in df.select(X.job_id(F.col("source"), F.col("native_id"), F.col("url"))).collect()]
    assert ids[0] == ids[4] and len(set(ids)) == 7
    with pytest.raises(Exception, match="a listing needs"):
        spark.createDataFrame([("s", None, None)], df.schema).select(X.job_id(F.col("source"), F.col("native_id"), F.col("url"))).collect()


def test_markdown(spark):
    assert one(spark, "a|b [x](y)\nc", X.markdown) == "a\\|b \\[x\\]\\(y\\) c"


def test_schedule():
    for day, hour in ((date(2026, 1, 15), 15), (date(2026, 3, 8), 14), (date(2026, 7, 15), 14), (date(2026, 11, 1), 15)):
        assert S.due(day) == datetime(day.year, day.month, day.day, hour, tzinfo=UTC)
    assert S.next_due(datetime(2026, 1, 15, 15, tzinfo=UTC)) == datetime(2026, 1, 16, 15, tzinfo=UTC)


def test_run_id():
    at = datetime(2026, 8, 5, 18, 36, 43, tzinfo=UTC)
    assert S.run_id(at, "reclassified") == "20260805T183643Z-reclassified"
    assert S.parse_run_id("20260805T183643Z-reclassified") == (at, "reclassified")
    with pytest.raises(ValueError):
        S.run_id(datetime(2026, 1, 1))


def test_a_text_is_split_once_for_all_terms(spark):
    df = spark.createDataFrame([("deep learning, CUDA",), ("new grad",), (None,)], "t string")
    terms = ["deep learning", "cuda", "new grad", "ml compiler"]
    found = df.where(F.size(X.terms_in(F.col("t"), terms)) > 0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and sorted(r["t"] for r in found.collect()) == ["deep learning, CUDA", "new grad"]


def test_years_are_found_once(spark):
    """The clauses of a text, and the mention that decides, aren't found again for every part of the interval."""
    df = spark.createDataFrame([("2 to 4 yrs; up to 3 years",)], "text string").repartition(1).select(X.years_asked(F.col("text")).alias("y"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and df.select("y.*").first()[:] == (2, 4)
