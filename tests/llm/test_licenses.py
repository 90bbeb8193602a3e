import random
import re

import pytest

from .conftest import prose
from jobsieve.llm import licenses as S

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def base(text):
    w = words(text)
    places = [(i, label) for phrase, label in S.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, label string")
    return {r["doc_id"]: r for r in S.scan(df).collect()}


def test_base_equals_brute_force(spark):
    r = random.Random(4)
    bits = ["MIT License", "the Apache license", "CC-BY", "cc by-sa", "GNU General Public License", "gnu general", "license mit", "É", "word", "Licensed under", "MIT\x00license", "mit licensed", "CC.BY"]
    texts = [" ".join(r.choice(bits) for _ in range(r.randrange(30))) for _ in range(200)]
    got = run(spark, texts)
    for i, t in enumerate(texts):
        x = got[i]
        assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == base(t)
        assert set(filter(None, x["base_labels"].split(","))) <= set(x["labels"].split(",")) and 0 <= x["score"] <= 1
        assert (x["score"] == 1) or not x["n_base"]


MIT = next(t for t, label in S.MORE if label == "mit" and len(t) > 200)


@pytest.mark.parametrize("edit", [0, 1, 3])
def test_edited_notice_is_found(spark, edit):
    r = random.Random(edit)
    w = MIT.split()
    for _ in range(edit):
        at = r.randrange(5, len(w) - 5)
        w[at:at] = ["inserted"] * r.randrange(1, 4) if r.random() < 0.5 else []
        del w[at + 8 : at + 9]
    got = run(spark, [prose(1, 500) + " " + " ".join(w).upper() + " " + prose(2, 500), prose(3, 800), " ".join(reversed(MIT.split()))])
    assert got[0]["labels"] == "mit" and got[0]["score"] >= S.COVERAGE and got[0]["n_base"] == 0
    assert got[1]["labels"] == got[2]["labels"] == ""


def pieces(seed, n=8):
    w = MIT.split()
    own = [w[i : i + n] for i in range(0, len(w), n)]
    random.Random(seed).shuffle(own)
    return own


def test_shuffled_notices_are_not_found(spark):
    place = {tuple(p): k for k, p in enumerate(pieces_in_order())}
    shuffled = [p for p in map(pieces, range(60)) if chain([(i, place[tuple(x)]) for i, x in enumerate(p)]) <= 3]
    texts = [prose(1, 30) + " " + " ".join(x for p in own for x in p) + " " + prose(2, 30) for own in shuffled]
    texts += [" ".join(" ".join(p) + " " + prose(i, 200) for i, p in enumerate(pieces_in_order()))]  # in order, but far apart
    texts += [" ".join([" ".join(pieces_in_order()[0])] * 50)]
    got = run(spark, texts)
    assert len(got) > 30 and all(r["labels"] == "" and r["score"] < S.COVERAGE for r in got.values())


def pieces_in_order(n=8):
    w = MIT.split()
    return [w[i : i + n] for i in range(0, len(w), n)]


def chain(hits):
    """The longest chain of hits by trying all ends."""
    best = {}
    for at, place in sorted(hits):
        best[at, place] = 1 + max((v for (a, p), v in best.items() if a < at and p < place), default=0)
    return max(best.values(), default=0)


def test_aligned_equals_brute_force():
    r = random.Random(1)
    for _ in range(300):
        hits = list({(r.randrange(12), r.randrange(12)) for _ in range(r.randrange(1, 14))})
        n, first, last = S.aligned(hits)
        assert n == chain(hits) and first <= last


def test_labels_equal_brute_force(spark):
    """Labels of long templates against all hits of a document in windows of diagonals."""
    r = random.Random(9)
    w = MIT.split()
    texts = []
    for i in range(60):
        own = list(w)
        for _ in range(r.randrange(12)):
            at = r.randrange(len(own))
            kind = r.randrange(4)
            if kind == 0:
                own[at] = "other"
            elif kind == 1:
                own[at:at] = ["more"] * r.randrange(1, 12)
            elif kind == 2:
                del own[at : at + r.randrange(1, 4)]
            else:
                to = r.randrange(len(own))
                own = own[:at] + own[to : to + 6] + own[at:]
        texts.append(" ".join(["x"] * r.randrange(5) + own))
    got = run(spark, texts)
    runs = [tuple(w[j : j + S.LONG_RUN]) for j in range(len(w) - S.LONG_RUN + 1)]
    kinds = set()
    for i, t in enumerate(texts):
        x = words(t)
        hits = [(a, p) for a in range(len(x)) for p, run_ in enumerate(runs) if tuple(x[a : a + S.LONG_RUN]) == run_]
        widest = max((chain([h for h in hits if d <= h[0] - h[1] <= d + 2 * S.DRIFT]) for d in {a - p for a, p in hits}), default=0)
        near = [sorted({a - p for a, p in hits})]
        narrow = chain(hits) if near[0] and near[0][-1] - near[0][0] <= S.SLACK else 0
        labelled = got[i]["labels"] == "mit"
        kinds.add(labelled)
        assert not labelled or widest >= S.COVERAGE * len(runs)
        assert labelled or narrow < S.COVERAGE * len(runs)
    assert kinds == {True, False}


def test_spans_say_where(spark):
    found = S.templates()
    df = spark.createDataFrame([(1, "one two " + MIT + " three")], "doc_id long, text string")
    rows = [r for r in S.spans(S.matched(S.rolling_runs(df, found), found), found).collect() if r["coverage"] == 1]
    assert [(r["label"], r["start"], r["stop"]) for r in rows] == [("mit", 2, 2 + len(MIT.split()))]


def test_odd_texts(spark, odd_docs, no_docs):
    got = S.scan(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["labels"] == "" and r["n_base"] == 0 and r["first_word"] is None for r in got)
    assert sorted(r["n_words"] for r in got if r["doc_id"] in (0, 1, 2)) == [0, 0, 0] and sum(r["doc_id"] is None for r in got) == 1
    assert S.scan(no_docs).count() == 0
