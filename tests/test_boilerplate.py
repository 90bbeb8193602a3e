"""Edited boilerplate against counting all runs of words with sets."""

import random
import re
from collections import defaultdict

import pytest

from jobsieve.operators import boilerplate, classify
from jobsieve.rules import DEFAULT

RULES = DEFAULT.with_version("edits", boilerplate_percent=60)
SHAPE = "job_id string, source string, text string"


def runs(line):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.lower()) if w]
    return {" ".join(words[i : i + boilerplate.WIDTH]) for i in range(max(1, len(words) - boilerplate.WIDTH + 1))} if words else set()


def brute(rows, rules=RULES):
    lines = {j: [x for x in (t or "").split("\n") if x.strip(" ")] for j, _, t in rows}
    size, count = defaultdict(int), defaultdict(int)
    for j, s, _ in rows:
        size[s] += 1
        for run in set().union(*map(runs, lines[j])):
            count[s, run] += 1
    common = {k for k, n in count.items() if n >= rules.boilerplate_postings and n >= rules.boilerplate_share * size[k[0]] and k[0] is not None}
    gone = lambda s, x: bool(runs(x)) and 100 * sum((s, r) in common for r in runs(x)) >= rules.boilerplate_percent * len(runs(x))
    return {j: "\n".join(x for x in lines[j] if not gone(s, x)) for j, s, _ in rows}


def own(spark, rows, **more):
    found = boilerplate.without_edited(spark.createDataFrame(rows, SHAPE), RULES, **more)
    return {r["job_id"]: r["own_text"] for r in found.collect()}


def some_rows(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    base = {s: [r.choice(words) for _ in range(16)] for s in "abc"}
    rows = []
    for i in range(90):
        s, lines = "abc"[i % 3] if i % 10 else "a", []
        for _ in range(r.randrange(4)):
            lines.append(" ".join(r.choices(words, k=r.randrange(1, 12))))
        edited = list(base[s])
        edited[r.randrange(16)] = f"x{i}"
        lines.insert(r.randrange(len(lines) + 1), r.choice([" ".join(edited), " ".join(edited[:9]), "  ", "--", " ".join(base[s])]))
        rows.append((f"j{i}", s, "\n".join(lines)))
    return rows + [("n", "a", None), ("e", "a", ""), ("s", None, "no source here"), ("long", "b", "\n".join([" ".join(base["b"])] * 50 + ["z" * 5000]))]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("listed", [boilerplate.LISTED, 0])
def test_equals_brute_force(spark, seed, listed):
    rows = some_rows(seed)
    assert own(spark, rows, listed=listed) == brute(rows)


def test_few_buckets_change_nothing(spark):
    rows = boilerplate.with_runs(spark.createDataFrame(some_rows(3), SHAPE))
    found = [sorted(map(tuple, boilerplate.common_runs(rows, "source", 3, 0.5, n).collect())) for n in (1, 7, boilerplate.BUCKETS)]
    assert found[0] == found[1] == found[2] and found[0]


def test_one_word_changed(spark):
    line = "our team in {} builds ai systems that people everywhere trust with their work"
    rows = [(f"j{i}", "s", f"{line.format(f'town{i}')}\nown words {i}") for i in range(8)]
    assert set(own(spark, rows).values()) == {f"own words {i}" for i in range(8)}
    plain = classify.without_boilerplate(spark.createDataFrame(rows, SHAPE)).collect()
    assert all("builds ai" in r["own_text"] for r in plain)


def test_edited_boilerplate_is_no_relevance(spark):
    line = "our team in {} builds ai systems that people everywhere trust with their work"
    rows = spark.createDataFrame([(f"j{i}", "s", "Payroll intern", None, f"{line.format(f'town{i}')}\nWork {i} on payroll.") for i in range(6)], "job_id string, source string, title string, department string, text string")
    assert {r["reject_reason"] for r in classify.classify(rows, RULES).collect()} == {"boilerplate"}
    assert {r["reject_reason"] for r in classify.classify(rows).collect()} == {None}


def test_empty_table(spark):
    assert own(spark, []) == {}


def test_texts_are_not_shuffled(spark):
    rows = spark.createDataFrame(some_rows(0), SHAPE)
    plan = boilerplate.without_edited(rows, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_runs_are_hashed_where_their_words_are(spark):
    """No run is made as an array or a string; lines of few, equal and no words have the runs that sets of words give."""
    lines = ["", " ", ".,;", "One", "one TWO", "one two three", "a b c d e f", "a a a a a", "ab c d", "a bc d", "x " * 5000, "ä ß 東 x1 ä ß 東"]
    df = spark.createDataFrame([(k, "S", x) for k, x in enumerate(lines)], "job_id int, source string, text string")
    found = df.select("job_id", boilerplate.runs_of(df["text"]).alias("got"))
    assert not {"slice", "array_join"} & set(re.findall(r"\w+", found._jdf.queryExecution().optimizedPlan().toString()))
    got = {r["job_id"]: r["got"] for r in found.collect()}
    for k, x in enumerate(lines):
        assert len(got[k]) == len(set(got[k])) == len(runs(x))
    for k, x in enumerate(lines):
        for j, y in enumerate(lines):
            assert len(set(got[k]) & set(got[j])) == len(runs(x) & runs(y))
