import itertools
import random

import pytest

from jobsieve.llm import chat as C

LEGAL = {0: {1, 2}, 1: {2}, 2: {3}, 3: {2}}
NAMES = {0: "tool", 1: "system", 2: "user", 3: "assistant"}


def brute(roles):
    """The least cost over all relabels, merges and insertions, one by one."""
    best = 1 << 40
    for new in itertools.product((1, 2, 3), repeat=len(roles)):
        change = sum(C.NAME if r == 0 else 0 if r == a else C.RELABEL for r, a in zip(roles, new))
        for merge in itertools.product((False, True), repeat=len(roles)):
            cost, state = change, 0
            for a, m in zip(new, merge):
                if m:
                    cost += C.MERGE if state == a else 1 << 40
                elif a not in LEGAL[state]:
                    cost += C.INSERT if any(b in LEGAL[state] and a in LEGAL[b] for b in (2, 3)) else 1 << 40
                state = a
            best = min(best, cost + (0, 2 * C.INSERT, C.INSERT, 0)[state])
    return best


def legal(text):
    turns = [t.split("\n", 1)[0] for t in text.split(C.OPEN)[1:]]
    if turns[:1] == ["system"]:
        turns = turns[1:]
    return turns and all(t == ("user", "assistant")[i % 2] for i, t in enumerate(turns)) and turns[-1] == "assistant" and text.count(C.CLOSE) == text.count(C.OPEN)


def frame(spark, convs):
    rows = [(c, i, NAMES[r], f"c{c}t{i}", "x") for c, roles in convs.items() for i, r in enumerate(roles)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string")


@pytest.mark.parametrize("block", [3, 1000])
def test_least_cost_and_legal(spark, block):
    r = random.Random(7)
    convs = {c: [r.randrange(4) for _ in range(r.randrange(1, 6))] for c in range(60)}
    got = {}
    for x in C.repair(frame(spark, convs), block_turns=block).collect():
        got.setdefault(x["conv_id"], []).append(x)
    for c, roles in convs.items():
        own = sorted(got[c], key=lambda x: x["seq"])
        assert [x["seq"] for x in own] == [x["turn"] for x in own] == list(range(len(roles)))
        assert sum(x["cost"] for x in own) == brute(roles)
        text = "".join(x["rendered"] for x in own)
        assert legal(text) and [text.index(f"c{c}t{i}") for i in range(len(roles))] == sorted(text.index(f"c{c}t{i}") for i in range(len(roles)))


def test_one_conversation_over_many_blocks(spark):
    r = random.Random(3)
    df = frame(spark, {5: [r.randrange(4) for _ in range(400)], 6: [2, 3]})
    one, many = (sorted(C.repair(df, block_turns=n).collect(), key=lambda x: (x["conv_id"], x["seq"])) for n in (10_000, 17))
    assert sum(x["cost"] for x in one) == sum(x["cost"] for x in many)  # of equally cheap repairs either may be chosen
    for got in (one, many):
        own = [x for x in got if x["conv_id"] == 5]
        assert [x["seq"] for x in own] == list(range(400)) and legal("".join(x["rendered"] for x in own))
        turns = [x["out_turn"] for x in own]
        assert turns == sorted(turns) and turns[-1] + 1 + own[-1]["inserted"].count("...") == "".join(x["rendered"] for x in own).count(C.OPEN)


def test_clean_conversations_stay(spark):
    got = C.repair(frame(spark, {1: [1, 2, 3, 2, 3], 2: [2, 3]})).collect()
    assert all(x["action"] == "keep" and x["cost"] == 0 and not x["inserted"] for x in got)


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, None, None, None), (1, 2, " Human ", ""), (1, 2, " Human ", ""), (None, 1, "gpt", "<|im_end|>x"), (2, 1, "", "y" * 200_000)]
    got = C.repair(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    by = {}
    for x in sorted(got, key=lambda x: x["seq"]):
        by[x["conv_id"]] = by.get(x["conv_id"], "") + x["rendered"]
    assert all(legal(t) for t in by.values()) and "<\\|im_end|>x" in by[None]
    assert C.repair(spark.createDataFrame([], schema)).count() == 0


def test_rows_without_a_conversation_stay_apart(spark):
    rows = [(None, i, "user", f"t{i}") for i in range(7)] + [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for block in (2, 3, 100):
        got = [r for r in C.repair(df, block_turns=block).collect() if r["conv_id"] is None]
        assert len(got) == 7 and all(r["seq"] == 0 and r["out_turn"] == 0 and r["inserted"] == "...assistant" for r in got)
        assert sorted(r["rendered"].split("\n")[1].removesuffix("<|im_end|>") for r in got) == [f"t{i}" for i in range(7)]
