"""Product codes of vectors by Lloyd's rounds with heaps of bounds.

Vectors become integers and are cut into equal parts; each part position has a codebook.  The tasks that read the vectors
put them into blocks.  A block keeps, per part position and codebook entry, a heap of the parts that the entry has, keyed by
the distance to the second nearest entry minus the distance to the nearest (lower minus upper bound), plus the drift of
the entry when the part entered.  When entries move, an entry's cumulative drift grows by its own way and the longest way
of any other; only parts whose key it has passed can have another nearest entry, so these alone are popped and scanned
again, exactly, in integers.  Blocks are written to the shared folder after every round, with what their moved
parts add to and take from the entries' sums; Spark sums these, and a codebook is all that the driver holds.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import broadcast_if_small, removed, written

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Vectors of a block, and bytes of its integers.
BLOCK_ROWS, BLOCK_BYTES = 4096, 32 << 20


@dataclass(frozen=True)
class Codebooks:
    """entries[p, e] is the e-th entry of part position p, in integers."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def distances(self, p: int, q: np.ndarray) -> np.ndarray:
        """Squared distances of parts to the entries of position p, exact."""
        c = self.entries[p]
        top = 2 * max(int(np.abs(q).max(initial=0)), int(np.abs(c).max(initial=0)))
        if top * top * max(1, q.shape[1]) < 1 << 52:  # all sums are whole numbers that a double holds
            a, b = q.astype(np.float64), c.astype(np.float64)
            return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        out = np.zeros((len(q), len(c)), np.int64)
        for k in range(q.shape[1]):
            out += (q[:, k, None] - c[None, :, k]) ** 2
        return out

    def nearest(self, p: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, slack): the nearest entry, the lower index on ties, and how much farther the second nearest is."""
        d = self.distances(p, q)
        best = d.argmin(1)
        at = np.arange(len(q))
        first = np.sqrt(d[at, best].astype(np.float64))
        if d.shape[1] == 1:
            return best, np.full(len(q), np.inf)
        rest = d.astype(np.float64)
        rest[at, best] = np.inf
        return best, np.sqrt(rest.min(1)) - first

    def error(self, codes: np.ndarray, q: np.ndarray) -> np.ndarray:
        parts = q.reshape(len(q), self.entries.shape[0], -1)
        diff = parts - self.entries[np.arange(self.entries.shape[0]), codes]
        return (diff * diff).sum((1, 2))


class Heaps:
    """The parts of a block, by position and entry, in binary heaps of keys."""

    def __init__(self, shape: tuple[int, int], keys: np.ndarray, rows: np.ndarray, sizes: np.ndarray):
        self.shape, self.keys, self.rows, self.sizes = shape, keys, rows, sizes

    @classmethod
    def of(cls, codes: np.ndarray, slack: np.ndarray, entries: int) -> Heaps:
        """codes and slack (rows, positions): sorted runs, which are heaps."""
        n, parts = codes.shape
        slot = (codes.astype(np.int64) + np.arange(parts) * entries).T.ravel()
        order = np.lexsort((slack.T.ravel(), slot))
        return cls((parts, entries), slack.T.ravel()[order], np.tile(np.arange(n, dtype=np.int32), parts)[order], np.bincount(slot, minlength=parts * entries).astype(np.int32))

    def pop(self, drift: np.ndarray) -> tuple[dict[int, list], np.ndarray, np.ndarray]:
        """(opened, slots, rows): the heaps that had keys up to their entry's drift, without those, and what they were."""
        at = np.concatenate(([0], np.cumsum(self.sizes)))
        held = np.flatnonzero(self.sizes)
        due = held[self.keys[at[held]] <= drift[held]]  # a heap's least key is its first
        opened, slots, rows = {}, [], []
        for s in due.tolist():
            heap = list(zip(self.keys[at[s] : at[s + 1]].tolist(), self.rows[at[s] : at[s + 1]].tolist()))
            while heap and heap[0][0] <= drift[s]:
                rows.append(heapq.heappop(heap)[1])
                slots.append(s)
            opened[s] = heap
        return opened, np.array(slots, np.int64), np.array(rows, np.int64)

    def pushed(self, opened: dict[int, list], slots: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> Heaps:
        """The heaps after what was popped has gone to the heaps of its entries."""
        at = np.concatenate(([0], np.cumsum(self.sizes)))
        for s, key, row in zip(slots.tolist(), keys.tolist(), rows.tolist()):
            if s not in opened:  # a part of another entry may go to a heap that none left
                opened[s] = list(zip(self.keys[at[s] : at[s + 1]].tolist(), self.rows[at[s] : at[s + 1]].tolist()))
            heapq.heappush(opened[s], (key, row))
        own_keys, own_rows, sizes = [], [], self.sizes.copy()
        for s in range(len(sizes)):
            if s in opened:
                own_keys.append(np.array([k for k, _ in opened[s]]))
                own_rows.append(np.array([r for _, r in opened[s]], np.int32))
                sizes[s] = len(opened[s])
            else:
                own_keys.append(self.keys[at[s] : at[s + 1]])
                own_rows.append(self.rows[at[s] : at[s + 1]])
        return Heaps(self.shape, np.concatenate(own_keys), np.concatenate(own_rows), sizes)


def _moved(parts: int, entries: int, q: np.ndarray, position: np.ndarray, row: np.ndarray, now: np.ndarray, was: np.ndarray | None) -> tuple[list, list, list]:
    """(slots, counts, sums): what parts that went from entry ``was`` to ``now`` change."""
    cut = q.reshape(len(q), parts, -1)[row, position]
    sums, counts = np.zeros((parts * entries, cut.shape[1]), np.int64), np.zeros(parts * entries, np.int64)
    np.add.at(sums, position * entries + now, cut)
    np.add.at(counts, position * entries + now, 1)
    if was is not None:
        np.subtract.at(sums, position * entries + was, cut)
        np.subtract.at(counts, position * entries + was, 1)
    changed = np.flatnonzero(counts.astype(bool) | sums.any(1))
    return changed.tolist(), counts[changed].tolist(), sums[changed].ravel().tolist()


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, q): rows whose vector has components, none of them null or not finite, times SCALE and rounded down."""
    x = F.col(vec_col)
    sound = F.coalesce(F.size(x) > 0, F.lit(False)) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    own = vectors.where(sound).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), x.alias("x"))
    return own.select("vec_id", "label", F.transform("x", lambda v: F.floor(v.cast("double") * SCALE)).alias("q"))


def _first(kept: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The codebooks of the vectors with the smallest ids, by components where ids repeat, null ids last."""
    rows = [r["q"] for r in kept.orderBy(F.asc_nulls_last("vec_id"), "q").limit(entries).select("q").collect()]  # at most ``entries`` vectors
    if not rows:
        return None
    if len(rows[0]) % parts or len({len(r) for r in rows}) > 1:
        raise ValueError(f"vectors need one length, a multiple of {parts}")
    q = np.array(rows, np.int64)
    return Codebooks(np.ascontiguousarray(q.reshape(len(q), parts, -1).transpose(1, 0, 2)))


def _check(q: np.ndarray, width: int) -> None:
    """Sums over all parts must fit into 64 bits."""
    top = 2 * int(max(q.max(initial=0), -q.min(initial=0))) + 1
    if top * top * width >= 1 << 62:
        raise ValueError("components are too large for exact squared distances")


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """(ids, labels, q) of some thousand rows at a time."""
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))
    held, n = [], 0

    def block():
        q = pa.concat_arrays([b.column(2) for b in held])
        if (np.diff(q.offsets.to_numpy()) != width).any():
            raise ValueError("vectors need one length")
        flat = q.values.to_numpy()[q.offsets[0].as_py() : q.offsets[-1].as_py()].reshape(-1, width)
        _check(flat, width)
        return pa.concat_arrays([b.column(0) for b in held]), pa.concat_arrays([b.column(1) for b in held]), flat

    for batch in batches:
        at = 0
        while at < len(batch):
            held.append(batch.slice(at, most - n))
            n, at = n + len(held[-1]), at + len(held[-1])
            if n == most:
                yield block()
                held, n = [], 0
    if n:
        yield block()


def _row(ids, labels, q, codes, heaps: Heaps, moved) -> pa.RecordBatch:
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    slots, counts, sums = moved
    columns = [one(ids), one(labels), *(pa.array([x.tobytes()], pa.binary()) for x in (q.astype(np.int64), codes.astype(np.uint16), heaps.keys.astype(np.float64), heaps.rows.astype(np.int32), heaps.sizes.astype(np.int32)))]
    columns += [one(pa.array(slots, pa.int32())), one(pa.array(counts, pa.int64())), one(pa.array(sums, pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["vec_ids", "labels", "q", "codes", "keys", "rows", "sizes", "slots", "counts", "sums"])


def _schema(kept: DataFrame) -> str:
    kinds = {c: kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return f"vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, q binary, codes binary, keys binary, rows binary, sizes binary, slots array<int>, counts array<bigint>, sums array<bigint>"


def assigned(kept: DataFrame, books: Codebooks) -> DataFrame:
    """Blocks of all vectors, each part with its nearest entry, heaps and sums."""
    parts, entries, width = books.entries.shape

    def run(batches):
        for ids, labels, q in _blocks(batches, parts * width):
            found = [books.nearest(p, q[:, p * width : (p + 1) * width]) for p in range(parts)]
            codes, slack = (np.stack(x, 1) for x in zip(*found))
            every = np.repeat(np.arange(len(q)), parts), np.tile(np.arange(parts), len(q))
            yield _row(ids, labels, q, codes, Heaps.of(codes, slack, entries), _moved(parts, entries, q, every[1], every[0], codes.ravel(), None))

    return kept.mapInArrow(run, _schema(kept))


def reassigned(blocks: DataFrame, books: Codebooks, drift: np.ndarray) -> DataFrame:
    """The blocks after entries have moved to those of books: only parts whose key the drift has passed are looked at."""
    parts, entries, width = books.entries.shape

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                raw = {name: batch.column(name)[k].as_py() for name in ("q", "codes", "keys", "rows", "sizes")}
                ids, labels = (batch.column(name)[k].values for name in ("vec_ids", "labels"))
                q = np.frombuffer(raw["q"], np.int64).reshape(-1, parts * width)
                codes = np.frombuffer(raw["codes"], np.uint16).reshape(-1, parts).copy()
                heaps = Heaps((parts, entries), np.frombuffer(raw["keys"]), np.frombuffer(raw["rows"], np.int32), np.frombuffer(raw["sizes"], np.int32))
                opened, slots, rows = heaps.pop(drift.ravel())
                now, keys = np.zeros(len(rows), np.int64), np.zeros(len(rows))
                at = slots // entries
                for p in np.unique(at).tolist():
                    own = np.flatnonzero(at == p)
                    now[own], keys[own] = books.nearest(p, q[rows[own], p * width : (p + 1) * width])
                to = at * entries + now
                heaps = heaps.pushed(opened, to, keys + drift.ravel()[to], rows)
                gone = to != slots
                codes[rows, at] = now
                yield _row(ids, labels, q, codes, heaps, _moved(parts, entries, q, at[gone], rows[gone], now[gone], slots[gone] % entries))

    return blocks.mapInArrow(run, blocks.schema)


def _sums(blocks: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums) by slot: each block's changes, added up by Spark."""
    parts, entries, width = shape
    one = blocks.select(F.posexplode("slots").alias("at", "slot"), "counts", "sums")
    own = one.select("slot", F.posexplode(F.concat(F.array(F.get("counts", F.col("at"))), F.slice("sums", F.col("at") * width + 1, F.lit(width)))).alias("place", "x"))
    counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
    for r in own.groupBy("slot", "place").agg(F.sum("x").alias("x")).collect():  # at most a row for each component of the codebooks
        if r["place"]:
            sums[r["slot"], r["place"] - 1] = r["x"]
        else:
            counts[r["slot"]] = r["x"]
    return counts, sums


def _drift(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """By how much a part's slack may have shrunk: the way of its entry and the longest of any other, rounded up."""
    way = np.sqrt(((new - old).astype(np.float64) ** 2).sum(2))
    order = np.sort(way, 1)
    longest = np.where(way == order[:, -1:], order[:, -2:-1] if way.shape[1] > 1 else 0.0, order[:, -1:])
    tied = (way == order[:, -1:]).sum(1) > 1
    longest[tied] = order[tied, -1:]
    # entries that stay keep exact bounds; the rest allows for the rounding of square roots
    return np.where(way + longest > 0, (way + longest) * (1 + 1e-9) + 1e-6, 0.0)


def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every row with a sound vector.

    Rows whose vector is null or empty, or holds null or non-finite components, are dropped; of the others each counts, also
    those that repeat an id, have none or repeat a vector.  Codebooks begin with the vectors of the smallest ids (null ids last,
    repeated ones by components); fewer vectors than entries make fewer entries.  Vectors of other lengths, and components whose
    squared distances no 64-bit sum holds, raise.  Null labels are a label of their own.  An empty table gives no rows.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits a part")
    kept = quantised(vectors, id_col, vec_col, label_col)
    books = _first(kept, parts, entries)
    names = "vec_id", "label", "code", "error"
    kinds = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in names[:2])
    if books is None:
        empty = kept.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.withColumns({"label_error": F.col("error"), "codebooks_sha256": F.lit("")})
    shape = books.entries.shape
    blocks = written(assigned(kept, books), "blocks")
    counts, sums = np.zeros(shape[0] * shape[1], np.int64), np.zeros((shape[0] * shape[1], shape[2]), np.int64)
    drift = np.zeros(shape[:2])
    for _ in range(rounds):
        more = _sums(blocks, shape)
        counts, sums = counts + more[0], sums + more[1]
        used = counts > 0
        new = books.entries.reshape(-1, shape[2]).copy()
        new[used] = sums[used] // counts[used, None]
        old, books = books, Codebooks(new.reshape(shape))
        drift = drift + _drift(old.entries, books.entries)
        after = written(reassigned(blocks, books, drift), "blocks")
        removed(blocks.sparkSession, blocks)
        blocks = after

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                q = np.frombuffer(batch.column("q")[k].as_py(), np.int64).reshape(-1, shape[0] * shape[2])
                own = np.frombuffer(batch.column("codes")[k].as_py(), np.uint16).reshape(-1, shape[0])
                text = own.astype(np.uint8).tobytes().hex()
                digits = pa.array([text[i : i + 2 * shape[0]] for i in range(0, len(text), 2 * shape[0])], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("vec_ids")[k].values, batch.column("labels")[k].values, digits, pa.array(books.error(own.astype(np.int64), q))], list(names))

    coded = written(blocks.select("vec_ids", "labels", "q", "codes").mapInArrow(run, f"{kinds}, code string, error bigint"), "codes")
    removed(blocks.sparkSession, blocks)
    return with_label_error(coded).withColumn("codebooks_sha256", F.lit(books.sha256))


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded (label, error) with label_error, the sum over rows of the label; null labels are one."""
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    none = sums.where("label is null").first()
    known = sums.where("label is not null")
    own = coded.join(broadcast_if_small(known, known.count()), "label", "left")  # null labels find no row
    return own.withColumn("label_error", F.when(F.col("label").isNull(), F.lit(none["label_error"] if none else None).cast("long")).otherwise(F.col("label_error"))).select("vec_id", "label", "code", "error", "label_error")
