"""Approximate nearest neighbours: a hierarchical navigable small-world graph in each shard.

Vectors of one direction are indexed once.  They are dealt to shards of bounded size by a hash; each shard's graph is
built in a task of its own and stored as flat arrays (vectors, neighbours of the ground layer, neighbours of the layers
above).  Queries stream past each shard in batches, so a shard is moved and loaded once however many there are; hits are
scored exactly in double precision on the original vectors, and the shards' best are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import broadcast_if_small, written

SHARD_VECTORS = 4096
#: Neighbours of a vector in the layers above the ground; twice as many there.
LINKS = 16
#: Beam widths while building and while searching.
BUILD, SEARCH = 64, 96
SEED = 7
#: Unit vectors whose components are equal on a grid of this step are one direction.
GRID = 1e-12
#: Shards are placed in so many tasks at most, one in each up to there.
MOST_TASKS = 20_000


class Graph:
    """A navigable small-world graph of unit vectors, in flat arrays.

    ground: n x 2 links, -1 where there is none; upper: for each layer above, (members, their neighbours).
    """

    def __init__(self, x: np.ndarray, links: int = LINKS):
        self.x, self.links = x, links
        self.ground = np.full((len(x), 2 * links), -1, np.int32)
        self.upper: list[np.ndarray] = []
        self.entry = -1
        self.level = np.zeros(len(x), np.int8)

    # --- searching ---

    def _beam(self, q: np.ndarray, start: list[int], width: int, table: np.ndarray) -> list[tuple[float, int]]:
        """The width nearest that a best-first walk finds, as (similarity, place), nearest first."""
        seen = self._seen
        self._stamp += 1
        stamp = self._stamp
        sims = (self.x[start] @ q).tolist()
        for s in start:
            seen[s] = stamp
        ahead = [(-s, i) for s, i in zip(sims, start)]
        best = [(s, i) for s, i in zip(sims, start)]
        heapq.heapify(ahead)
        heapq.heapify(best)
        while len(best) > width:
            heapq.heappop(best)
        while ahead:
            s, i = heapq.heappop(ahead)
            if len(best) >= width and -s < best[0][0]:
                break
            near = table[i]
            near = near[near >= 0]
            near = near[seen[near] != stamp]
            if not len(near):
                continue
            seen[near] = stamp
            for s, j in zip((self.x[near] @ q).tolist(), near.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (s, j))
                    heapq.heappush(ahead, (-s, j))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, j))
                    heapq.heappush(ahead, (-s, j))
        return sorted(best, reverse=True)

    def ready(self) -> Graph:
        self._seen, self._stamp = np.zeros(len(self.x), np.int64), 0
        return self

    def search(self, q: np.ndarray, width: int) -> list[tuple[float, int]]:
        if self.entry < 0:
            return []
        at = [self.entry]
        for table in reversed(self.upper):
            at = [self._beam(q, at, 1, table)[0][1]]
        return self._beam(q, at, width, self.ground)

    # --- building ---

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Up to most neighbours, none nearer to a chosen one than to the vector itself; then the nearest others."""
        cand = np.array([i for _, i in found], np.int64)
        if len(cand) <= most:
            return cand.tolist()
        own = np.array([s for s, _ in found], self.x.dtype)
        among = self.x[cand] @ self.x[cand].T
        chosen, rest = [], []
        closest = np.full(len(cand), -np.inf)
        for k in range(len(cand)):
            if closest[k] < own[k]:
                chosen.append(k)
                if len(chosen) == most:
                    break
                np.maximum(closest, among[k], out=closest)
            else:
                rest.append(k)
        chosen += rest[: most - len(chosen)]
        return cand[chosen].tolist()

    def _link(self, table: np.ndarray, i: int, j: int) -> None:
        row = table[j]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = i
            return
        near = np.append(row, i)
        sims = self.x[near] @ self.x[j]
        order = np.argsort(-sims)
        kept = self._spread([(float(sims[o]), int(near[o])) for o in order], len(row))
        row[:] = -1
        row[: len(kept)] = kept

    def build(self, width: int = BUILD, seed: int = SEED) -> Graph:
        n = len(self.x)
        self.ready()
        draw = np.random.default_rng(seed).random(n)
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(self.links)).astype(np.int64), 8).astype(np.int8)
        self.upper = [np.full((n, self.links), -1, np.int32) for _ in range(int(self.level.max(initial=0)))]
        top = -1
        for i in range(n):
            own = int(self.level[i])
            q = self.x[i]
            if self.entry < 0:
                self.entry, top = i, own
                continue
            at = [self.entry]
            for layer in range(top, own, -1):
                at = [self._beam(q, at, 1, self.upper[layer - 1])[0][1]]
            for layer in range(min(own, top), -1, -1):
                table = self.upper[layer - 1] if layer else self.ground
                found = self._beam(q, at, width, table)
                chosen = self._spread(found, self.links)
                table[i, : len(chosen)] = chosen
                for j in chosen:
                    self._link(table, i, j)
                at = [j for _, j in found]
            if own > top:
                self.entry, top = i, own
        return self


def _valid(vector) -> F.Column:
    """Neither null nor zero, and no component null or not finite."""
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(sound, F.lit(False)) & F.coalesce(F.exists(vector, lambda v: v != 0), F.lit(False))


def _rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _direction(vec: F.Column) -> F.Column:
    """The unit vector on a grid, in whole numbers; equal for vectors that differ by a positive factor."""
    scaled = F.transform(vec, lambda v: v / F.array_max(F.transform(vec, F.abs)))  # no overflow in the squares
    norm = F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda a, v: a + v * v))
    return F.transform(F.arrays_zip(scaled.alias("v"), F.array_repeat(norm, F.size(vec)).alias("n")), lambda x: F.rint(x["v"] / x["n"] / GRID).cast("long"))


def distinct_vectors(vectors: DataFrame, k: int, id_col: str, vec_col: str) -> DataFrame:
    """(rep, dim, vec, ids): each direction once, with the vector of its smallest id; ids: its k + 1 smallest ids, all
    that can be among k nearest of any."""
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(F.col("id").isNotNull() & _valid(F.col("vec")))
    own = own.groupBy("id", _direction(F.col("vec")).alias("way")).agg(F.min("vec").alias("vec"))
    # the first k + 1 of each direction are also found before the shuffle, so many copies are no task of their own
    ranked = own.withColumn("rank", F.row_number().over(Window.partitionBy("way").orderBy("id"))).where(F.col("rank") <= k + 1)
    held = ranked.groupBy("way").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.min_by("vec", "id").alias("vec"))
    return held.select(F.col("ids")[0].alias("rep"), F.size("vec").alias("dim"), "vec", "ids")


INDEX = "shard long, dim int, n int, ids binary, reps binary, vectors binary, ground binary, layers int, upper binary, entry int"


def build_index(vectors: DataFrame, k: int = 5, shard_vectors: int = SHARD_VECTORS, links: int = LINKS, width: int = BUILD, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row of flat arrays per shard, written.  Vectors of different lengths are in different shards."""
    own = written(distinct_vectors(vectors, k, id_col, vec_col), "vectors")
    sizes = written(own.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(shard_vectors)).cast("long").alias("parts")), "sizes")
    known = sizes.agg(F.count("*").alias("dims"), F.coalesce(F.sum("parts"), F.lit(0)).alias("shards")).first()
    dealt = own.join(broadcast_if_small(sizes, known["dims"]), "dim").withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("parts")))

    def build(key, table):
        table = table.sort_by("rep")
        dim, shard = key[1].as_py(), key[2].as_py()
        original = _rows(table.column("vec"))
        g = Graph(_unit(original).astype(np.float32), links).build(width)
        ids = np.full((table.num_rows, k + 1), -1, np.int64)
        have = np.zeros((table.num_rows, k + 1), bool)
        for i, x in enumerate(table.column("ids").to_pylist()):
            ids[i, : len(x)] = x
            have[i, : len(x)] = True
        upper = np.stack(g.upper) if g.upper else np.zeros((0, table.num_rows, links), np.int32)
        row = {"shard": shard, "dim": dim, "n": table.num_rows, "ids": ids.tobytes(), "reps": have.tobytes(), "vectors": original.astype("<f8").tobytes(), "ground": g.ground.tobytes(), "layers": len(g.upper), "upper": upper.tobytes(), "entry": g.entry}
        return pa.Table.from_pylist([row], pa.schema([("shard", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("reps", pa.binary()), ("vectors", pa.binary()), ("ground", pa.binary()), ("layers", pa.int32()), ("upper", pa.binary()), ("entry", pa.int32())]))

    own = _placed(dealt.select("dim", "shard", "rep", "vec", "ids"), known["shards"])
    return written(own.groupBy("place", "dim", "shard").applyInArrow(build, INDEX), "index")


def _placed(rows: DataFrame, shards: int) -> DataFrame:
    """rows (dim, shard, ...), to be grouped by (place, dim, shard), with each shard in a partition of its own.

    A hash of the shard would put several shards in some partitions and none in others, so place is a number whose hash is
    known to lead to the shard's partition.
    """
    tasks = max(1, min(shards, MOST_TASKS))
    # a row per task: of so many numbers each task has one but for a chance of e^-64 a task, which falls back on its own number
    tried = rows.sparkSession.range(64 * tasks).groupBy(F.pmod(F.hash("id"), F.lit(tasks)).alias("task")).agg(F.min("id").alias("place"))
    dealt = rows.withColumn("task", F.pmod(F.col("dim") * F.lit(7919) + F.col("shard"), F.lit(tasks)).cast("int"))
    return dealt.join(F.broadcast(tried), "task", "left").withColumn("place", F.coalesce("place", F.col("task").cast("long"))).drop("task").repartition(tasks, "place")


def load(row: dict, links: int = LINKS) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """The graph of an index row, its double-precision unit vectors, their ids and which of these there are."""
    n, dim = row["n"], row["dim"]
    unit = _unit(np.frombuffer(row["vectors"], "<f8").reshape(n, dim))
    g = Graph(unit.astype(np.float32), links)
    g.ground = np.frombuffer(row["ground"], np.int32).reshape(n, -1)
    g.upper = list(np.frombuffer(row["upper"], np.int32).reshape(row["layers"], n, links)) if row["layers"] else []
    g.entry = row["entry"]
    ids = np.frombuffer(row["ids"], np.int64).reshape(n, -1)
    return g.ready(), unit, ids, np.frombuffer(row["reps"], bool).reshape(ids.shape)


def search(index: DataFrame, queries: DataFrame, k: int = 5, width: int = SEARCH, links: int = LINKS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, by cosine, ties to the smaller id.

    A query's own id is no candidate.  Scores are exact cosines in double precision.  Rows that repeat an id and its
    direction count once, among the vectors and among the queries; an id with several directions is a candidate with each, and
    as a query has the nearest of them all.  Queries with an unsound vector or a null id have no rows, and so have those whose
    length no indexed vector has.
    """
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("query")).where(F.col("query_id").isNotNull() & _valid(F.col("query")))
    asked = asked.groupBy("query_id", _direction(F.col("query")).alias("way")).agg(F.min("query").alias("query")).select(F.size("query").alias("dim"), "query_id", "query")
    count = index.count()
    shards = index.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    sent = asked.join(broadcast_if_small(shards, count), "dim").select("dim", F.explode("shards").alias("shard"), F.lit(1).alias("kind"), *[F.lit(None).cast(t).alias(n) for n, t in index.dtypes if n not in ("dim", "shard")], "query_id", "query")
    kept = index.select("dim", "shard", F.lit(0).alias("kind"), *[n for n in index.columns if n not in ("dim", "shard")], F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("array<double>").alias("query"))
    # a shard comes first in its group; should it not, queries wait for it
    rows = _placed(kept.unionByName(sent), count).sortWithinPartitions("place", "dim", "shard", "kind")
    names = [n for n in index.columns if n not in ("dim", "shard")]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, waiting = None, []
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            first = np.flatnonzero(kind == 0)
            if len(first):
                shard = load({n: batch.column(n)[int(first[0])].as_py() for n in ["dim", *names]}, links)
            own = batch.filter(pa.array(kind == 1)).select(["query_id", "query"])
            if own.num_rows:
                waiting.append(own)
            if shard:
                for part in waiting:
                    yield hits(shard, part)
                waiting = []

    def hits(shard, own: pa.RecordBatch) -> pa.RecordBatch:
        g, unit, names, have = shard
        ids, near, score = [], [], []
        q = _unit(_rows(own.column("query")))
        for name, exact, rough in zip(own.column("query_id").to_pylist(), q, q.astype(np.float32)):
            found = [i for _, i in g.search(rough, width)]
            sims = (unit[found] * exact).sum(axis=1)
            cand = [(-s, int(c), s) for i, s in zip(found, sims.tolist()) for c in names[i][have[i]] if c != name]
            for _, c, s in heapq.nsmallest(k, cand):
                ids.append(name), near.append(c), score.append(min(1.0, max(-1.0, s)))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(near, pa.int64()), pa.array(score, pa.float64())], ["query_id", "vec_id", "score"])

    found = rows.groupBy("place", "dim", "shard").applyInArrow(look, "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
