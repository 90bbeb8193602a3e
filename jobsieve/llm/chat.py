"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn, ending with the assistant.  For
each conversation a shortest path through that automaton decides, turn by turn, whether it keeps or changes its role,
joins the turn before, or gets empty turns put before it.  Turns are dealt to blocks in order, so a conversation may
run through many blocks: each block sends the costs of its parts of such conversations, from each state to each
state, these small matrices give the states at the bounds, and each block then finds its own paths.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

MERGE, RELABEL, NAME, INSERT = 1, 3, 2, 2
BLOCK_TURNS = 20_000

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("start", "system", "user", "assistant")
UNKNOWN = 0
# Names that public chat data use for the roles.
ALIASES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}
FAR = 1 << 50
OPEN, CLOSE, JOINT = "<|im_start|>", "<|im_end|>\n", "\n\n"


class Costs:
    """The cheapest way from a state over a turn to a state, and what it does.

    cost[role][state][after], made[role][state][after] (turns that it adds), how[role][state][after]: (merged,
    relabelled, roles inserted before it).  A role that no name is known for costs ``name`` whatever it becomes.
    """

    def __init__(self, merge: int = MERGE, relabel: int = RELABEL, name: int = NAME, insert: int = INSERT):
        legal = {START: {SYSTEM, USER}, SYSTEM: {USER}, USER: {ASSISTANT}, ASSISTANT: {USER}}
        self.cost = [[[FAR] * 4 for _ in range(4)] for _ in range(4)]
        self.made = [[[0] * 4 for _ in range(4)] for _ in range(4)]
        self.how: list = [[[None] * 4 for _ in range(4)] for _ in range(4)]
        for role in range(4):
            for state in range(4):
                for after in (SYSTEM, USER, ASSISTANT):
                    change = name if role == UNKNOWN else 0 if role == after else relabel
                    ways = []
                    if state == after:
                        ways.append((merge + change, 0, (True, ())))
                    if after in legal[state]:
                        ways.append((change, 1, (False, ())))
                    for between in (USER, ASSISTANT):
                        if between in legal[state] and after in legal[between]:
                            ways.append((insert + change, 2, (False, (between,))))
                    if ways:
                        cost, made, (merged, put) = min(ways, key=lambda w: (w[0], w[1]))
                        self.cost[role][state][after], self.made[role][state][after] = cost, made
                        self.how[role][state][after] = (merged, role != after, put)
        #: What it costs to end in a state, and the turns that it adds.
        self.end = [0, 2 * insert, insert, 0]
        self.end_roles = ((), (USER, ASSISTANT), (ASSISTANT,), ())


def role_number(name: str | None) -> int:
    return ALIASES.get((name or "").strip().lower(), UNKNOWN)


def path(roles: list[int], costs: Costs, state: int = START, after: int | None = None) -> list[int]:
    """The states behind each turn on a cheapest path from state; to after, or else to the cheapest end."""
    at = [FAR] * 4
    at[state] = 0
    back = []
    for role in roles:
        table, new, come = costs.cost[role], [FAR] * 4, [0] * 4
        for s in range(4):
            if at[s] < FAR:
                row = table[s]
                for t in (USER, ASSISTANT, SYSTEM):
                    c = at[s] + row[t]
                    if c < new[t]:
                        new[t], come[t] = c, s
        back.append(come)
        at = new
    if after is None:
        after = min(range(4), key=lambda s: (at[s] + costs.end[s], s))
    out = []
    for come in reversed(back):
        out.append(after)
        after = come[after]
    return out[::-1]


def matrix(roles: list[int], costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Costs from each state to each over the turns, and the turns made on those paths."""
    cost, made = np.full((4, 4), FAR), np.zeros((4, 4), np.int64)
    for s in range(4):
        at, count = [FAR] * 4, [0] * 4
        at[s] = 0
        for role in roles:
            new, number = [FAR] * 4, [0] * 4
            for x in range(4):
                if at[x] < FAR:
                    for t in (USER, ASSISTANT, SYSTEM):
                        c = at[x] + costs.cost[role][x][t]
                        if c < new[t]:
                            new[t], number[t] = c, count[x] + costs.made[role][x][t]
            at, count = new, number
        cost[s], made[s] = at, count
    return cost, made


DECISIONS = "row long, seq long, out_turn long, new_role string, action string, inserted string, cost long, head string, tail string"


def _decide(rows: list[int], roles: list[int], costs: Costs, state: int, after: int | None, seq: int, turns: int, last: bool):
    """A decision for each turn of a part: its place, new role and what is rendered around its text."""
    states = path(roles, costs, state, after)
    before = state
    for k, (row, role, now) in enumerate(zip(rows, roles, states)):
        merged, changed, put = costs.how[role][before][now]
        turns += costs.made[role][before][now]
        cost = costs.cost[role][before][now]
        action = "+".join([*(["insert"] if put else []), *(["relabel"] if changed else []), *(["merge"] if merged else [])]) or "keep"
        blank = "".join(f"{OPEN}{ROLES[r]}\n{CLOSE}" for r in put)
        head = JOINT if merged else ("" if before == START else CLOSE) + blank + f"{OPEN}{ROLES[now]}\n"
        tail = ""
        inserted = [ROLES[r] for r in put]
        if last and k == len(rows) - 1:
            cost += costs.end[now]
            tail = CLOSE + "".join(f"{OPEN}{ROLES[r]}\n{CLOSE}" for r in costs.end_roles[now])
            inserted += ["..." + ROLES[r] for r in costs.end_roles[now]]
        yield row, seq + k, turns - 1, ROLES[now], action, ",".join(inserted), cost, head, tail
        before = now


def repair(turns: DataFrame, costs: Costs | None = None, block_turns: int = BLOCK_TURNS, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: (conv_id, seq, turn, role, out_turn, new_role, action, inserted, cost, rendered).

    seq numbers a conversation's turns from 0 in the order of turn (nulls first), role, text; out_turn numbers the
    turns of the repaired conversation.  The rendered pieces of a conversation in the order of seq, put together, are
    its text in the repaired form, so no conversation is ever one value in one task; inserted names the roles of empty turns
    before (after, with "...") a turn; the costs of a conversation add up to the least that a repair can cost.
    Unknown or null roles may become any; a null text is empty; a row with a null conv_id is a conversation of its own, as
    nothing says what it belongs to; equal rows are turns each; markers within texts are broken by a backslash; an empty table gives no rows.
    """
    costs = costs or Costs()
    named = F.lower(F.trim(F.coalesce(F.col(role_col).cast("string"), F.lit(""))))
    number = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv]), named), F.lit(UNKNOWN)).cast("int")
    own = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), number.alias("number"), F.monotonically_increasing_id().alias("row"))
    blocks = max(1, -(-turns.count() // block_turns))
    order = ["conv_id", "turn", "role", F.xxhash64("text"), "row"]
    dealt = own.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    held = written(dealt.withColumn("blk", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), "turns")
    thin = held.select("blk", "place", "row", "conv_id", "number")

    def parts(table):
        """(conversation, rows, roles) of a block in order; each row of a null id is one."""
        table = table.sort_by("place")
        conv = table.column("conv_id").to_pylist()
        rows, roles = table.column("row").to_pylist(), table.column("number").to_pylist()
        at = 0
        for k in range(1, len(conv) + 1):
            if k == len(conv) or conv[k] is None or conv[k] != conv[at]:
                yield conv[at], rows[at:k], roles[at:k]
                at = k

    edge = pa.schema([("blk", pa.int32()), ("conv", pa.int64()), ("turns", pa.int64()), ("cost", pa.list_(pa.int64())), ("made", pa.list_(pa.int64()))])

    def edges(key, table):
        own = list(parts(table))
        own = own if len(own) < 2 else (own[0], own[-1])
        out = [(key[0].as_py(), conv, len(rows), *(m.reshape(-1).tolist() for m in matrix(roles, costs))) for conv, rows, roles in own if conv is not None]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(edge), edge)], schema=edge)

    ends = thin.groupBy("blk").applyInArrow(edges, "blk int, conv long, turns long, cost array<bigint>, made array<bigint>")
    bound = pa.schema([("b", pa.int32()), ("conv", pa.int64()), ("state", pa.int32()), ("after", pa.int32()), ("seq", pa.int64()), ("made", pa.int64()), ("last", pa.bool_())])

    def states(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["blk"])
        at, back = [0, FAR, FAR, FAR], []
        for r in rows:
            m = r["cost"]
            new, come = [FAR] * 4, [0] * 4
            for s in range(4):
                for t in (USER, ASSISTANT, SYSTEM):
                    if at[s] < FAR and at[s] + m[4 * s + t] < new[t]:
                        new[t], come[t] = at[s] + m[4 * s + t], s
            at = new
            back.append(come)
        after = min(range(4), key=lambda s: (at[s] + costs.end[s], s))
        chosen = [after]
        for come in reversed(back):
            chosen.append(come[chosen[-1]])
        chosen.reverse()
        seq = made = 0
        out = []
        for k, r in enumerate(rows):
            out.append((r["blk"], r["conv"], chosen[k], chosen[k + 1], seq, made, k == len(rows) - 1))
            seq, made = seq + r["turns"], made + r["made"][4 * chosen[k] + chosen[k + 1]]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), bound)], schema=bound)

    # one row per block and conversation at its edges: a conversation has at most as many as there are blocks
    bounds = ends.groupBy("conv").applyInArrow(states, "b int, conv long, state int, after int, seq long, made long, last boolean")

    made = pa.schema([("row", pa.int64()), ("seq", pa.int64()), ("out_turn", pa.int64()), ("new_role", pa.string()), ("action", pa.string()), ("inserted", pa.string()), ("cost", pa.int64()), ("head", pa.string()), ("tail", pa.string())])

    def solve(key, table, known):
        at = {r["conv"]: r for r in known.to_pylist()}
        out = []
        for conv, rows, roles in parts(table):
            b = at.get(conv)
            out += _decide(rows, roles, costs, b["state"], b["after"], b["seq"], b["made"], b["last"]) if b else _decide(rows, roles, costs, START, None, 0, 0, True)
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(made), made)], schema=made)

    found = thin.groupBy("blk").cogroup(bounds.groupBy("b")).applyInArrow(solve, DECISIONS)
    safe = F.replace(F.col("text"), F.lit("<|im_"), F.lit("<\\|im_"))
    return held.join(found, "row").select("conv_id", "seq", "turn", "role", "out_turn", "new_role", "action", "inserted", "cost", F.concat("head", safe, "tail").alias("rendered"))
