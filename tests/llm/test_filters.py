from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from jobsieve.llm import filters

from .conftest import prose

WHITE = " \t\n\v\f\r"


def fails(text, repeated):
    words = [w for w in "".join(" " if c in WHITE else c for c in text).split(" ") if w]
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": repeated,
    }


def brute(docs, labels):
    """Walks every order over every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        repeated = i is not None and any(j is not None and j < i and (u or "") == (text or "") for j, u, _ in docs)
        rows.append((i, source or "", fails(text or "", repeated)))
    out = {}
    for part in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [r for r in left if r[2][name]]
                shapley[name] += len(gone)
                left = [r for r in left if not r[2][name]]
                alone = [r for r in own if r[2][name] and sum(r[2].values()) == 1]
                early = [r for r in own if r[2][name]]
                out[part, "".join(order), step] = [len(left), len(gone), len(early) - len(gone), len(alone), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), name]
        for key in out:
            if key[0] == part:
                out[key][-1] = shapley[key[1][key[2] - 1]]
    return {k: tuple(v) for k, v in out.items()}


TEXTS = [None, "", " \n\t", prose(1, 60), prose(1, 60), prose(2, 60) + " # x", "word " * 80, "ß🎉 " * 60, "A" * 300, prose(3, 30), prose(4, 5000), "A b c d", "#", "\u0000 a"]


def test_audit_equals_all_orders_walked(spark):
    docs = [(i, t, ("s", None, "", "t")[i % 4]) for i, t in enumerate(TEXTS * 2)] + [(3, TEXTS[3], "s"), (None, TEXTS[3], "s"), (None, prose(7, 70), "s"), (2, "fresh", "t")]
    labels = [(i, i % 3, i % 2) for i in range(0, 30, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (3, None, 1), (5, 1, None)]
    frame = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "doc_id long, text string, source string, mask long, n long, part string")
    got = filters.audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.columns == ["part", "filter_order", "step", *names]
    have = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in got.collect()}
    assert have == brute(docs, labels) and len(have) == 3 * 600


def test_audit_of_nothing(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filters.audit(no_docs, labels).count() == 0


def test_audit_of_odd_documents_without_labels(spark, odd_docs):
    got = filters.audit(odd_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    rows = got.collect()
    assert len(rows) == 600 and {r["kept"] + r["removed"] for r in rows if r["step"] == 1} == {odd_docs.count()}
    assert {r["good_lost"] + r["toxic_lost"] for r in rows} == {0}


@pytest.mark.parametrize("letters", ["A", "AB", "XYZ"])
def test_any_number_of_filters(spark, letters):
    n = len(letters)
    counts = [("p", m, m + 1, m % 2, 0) for m in range(1 << n)]
    got = filters.interactions(spark.createDataFrame(counts, "part string, mask int, n long, good long, toxic long"), letters)
    first = {r["filter_order"]: r["removed"] for r in got.where("step = 1").collect()}
    for order, removed in first.items():
        bit = 1 << letters.index(order[0])
        assert removed == sum(m + 1 for m in range(1 << n) if m & bit)
    last = {r["kept"] for r in got.where(F.col("step") == n).collect()}
    assert last == {1}


def test_too_many_filters(spark):
    with pytest.raises(ValueError):
        filters.interactions(spark.createDataFrame([], "part string, mask int, n long, good long, toxic long"), "ABCDEFG")
