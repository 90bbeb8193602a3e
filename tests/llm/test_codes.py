import hashlib
import math
import random

import numpy as np
import pytest

from jobsieve.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code long, q string"


def brute(rows, parts, entries, rounds):
    """Lloyd's rounds over all distances, in Python's integers."""
    sound = [(i, v, k) for i, v, k in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    q = [[math.floor(float(np.float32(x)) * 256) for x in v] for _, v, _ in sound]
    width = len(q[0]) // parts if q else 0
    cut = lambda v, p: v[p * width : (p + 1) * width]
    order = sorted(range(len(q)), key=lambda n: (sound[n][0] is None, sound[n][0] or 0, q[n]))[:entries]
    books = [[cut(q[n], p) for n in order] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min(range(len(books[p])), key=lambda e: (distance(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        found = [[nearest(v, p) for p in range(parts)] for v in q]
        for p in range(parts):
            new = list(books[p])
            for e in range(len(new)):
                own = [cut(v, p) for v, f in zip(q, found) if f[p] == e]
                if own:
                    new[e] = [sum(x) // len(own) for x in zip(*own)]
            books[p] = new
    found = [[nearest(v, p) for p in range(parts)] for v in q]
    error = [sum(distance(cut(v, p), books[p][f[p]]) for p in range(parts)) for v, f in zip(q, found)]
    label = {}
    for (_, _, k), x in zip(sound, error):
        label[k] = label.get(k, 0) + x
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((str(i), "".join(f"{e:02x}" for e in f), x, label[k], sha) for (i, _, k), f, x in zip(sound, found, error)), key=str)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = codes.codes(frame, **options).collect()
    return sorted(((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got), key=str)


def vectors(n, width=8, seed=1, scale=1.0):
    r = random.Random(seed)
    centres = [[r.gauss(0, scale) for _ in range(width)] for _ in range(7)]
    return [(i, [x + r.gauss(0, scale / 6) for x in r.choice(centres)], r.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("rounds", [0, 1, 2, 5])
def test_equals_all_distances(spark, rounds, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK_ROWS", 37)
    rows = vectors(300)
    assert run(spark, rows, parts=4, entries=9, rounds=rounds) == brute(rows, 4, 9, rounds)


def test_ties_repeats_and_unsound_vectors(spark):
    grid = [(i % 40, [float(x) / 256 for x in (i % 3, i % 2, i % 5, 0)], i % 4 or None) for i in range(200)]
    odd = [(900, None, 1), (901, [0.1, None, 0.2, 0.3], 1), (902, [float("nan"), 0.0, 0.0, 0.0], 1), (903, [0.0, float("inf"), 0.0, 0.0], None), (904, [], 1), (None, [-0.001, -1.0, 0.5, 2.0], 77)]
    rows = grid + odd
    got = run(spark, rows, parts=2, entries=8, rounds=3)
    assert got == brute(rows, 2, 8, 3) and len(got) == 201


def test_few_or_no_vectors(spark):
    rows = vectors(3)
    assert run(spark, rows, parts=4, entries=9, rounds=2) == brute(rows, 4, 9, 2)
    assert run(spark, rows[:1], parts=4, entries=9, rounds=2) == brute(rows[:1], 4, 9, 2)
    assert run(spark, [], parts=4, entries=9, rounds=2) == [] and run(spark, [(1, None, 1)], parts=4) == []


def test_large_components_and_wrong_lengths(spark):
    rows = [(i, [x * 1e4 for x in v], k) for i, v, k in vectors(80)]
    assert run(spark, rows, parts=2, entries=5, rounds=2) == brute(rows, 2, 5, 2)
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e30] * 4, 1), (2, [0.0] * 4, 1)], parts=2)
    with pytest.raises(Exception, match="length"):
        run(spark, [(1, [1.0] * 4, 1), (2, [0.0] * 8, 1)], parts=2)


def test_heaps_pop_all_that_drift_has_passed_and_no_more():
    r = np.random.default_rng(4)
    code, slack = r.integers(0, 5, (60, 3)), r.random((60, 3))
    heaps = codes.Heaps.of(code, slack, 5)
    opened, slots, rows = heaps.pop(np.full(15, 0.3))
    assert set(zip(rows.tolist(), (slots // 5).tolist())) == {(i, p) for i in range(60) for p in range(3) if slack[i, p] <= 0.3}
    again = heaps.pushed(opened, slots, np.full(len(slots), 9.0), rows)
    assert len(again.keys) == 180 and again.pop(np.full(15, 0.3))[1].size == 0
    at = np.concatenate(([0], np.cumsum(again.sizes)))
    for s in range(15):
        own = again.keys[at[s] : at[s + 1]]
        assert all(own[(k - 1) // 2] <= own[k] for k in range(1, len(own)))


def test_unviolated_bounds_are_not_scanned(monkeypatch):
    """With entries that stay, no part is looked at again."""
    heaps = codes.Heaps.of(np.zeros((4, 1), np.int64), np.ones((4, 1)), 2)
    assert heaps.pop(np.zeros(2))[1].size == 0
    old = np.array([[[0, 0], [10, 0], [20, 0]]])
    assert (codes._drift(old, old) == 0).all()
    moved = codes._drift(old, np.array([[[0, 0], [13, 4], [20, 0]]]))[0]
    assert moved[0] >= 5 and moved[1] >= 5 and moved[2] >= 5 and moved.max() < 5.01
