"""An interpolated modified Kneser-Ney n-gram model of any order from 2.

Spark counts words, then n-grams of the model's order, then the distinct predecessors of words.  Counts travel as packed
arrays in few rows, pre-aggregated in each task, and are merged by shard; a shard holds the n-grams whose last word but
one hash deals to it.  So it also holds all shorter n-grams that end them, with their distinct predecessors, and all
their contexts, and counts those without another shuffle.  N-grams with a very frequent last word but one are dealt by
the whole n-gram, so no shard grows with one word; their shorter n-grams and contexts are counted by further shuffles.
The shards are written to the shared folder as sorted hash arrays, which scoring workers map into memory: each looks up
only what its texts need, whatever the size of the model.

A text is preceded by as many marks as the order calls for, so all of its n-grams are of that order.  Shuffled n-grams
are what takes most disk, so they are counted in rounds, a share of the shards in each.
"""

from __future__ import annotations

import gc
import mmap
import os
import sys
import tempfile
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .store import new_path, removed, written

#: Bytes of text for a shard, about; of a model of pairs, less for a higher order.
SHARD_BYTES = 32 << 20
#: Tokens that a task counts before it hands on; likewise.
FLUSH = 1 << 22
#: Rounds in which longer n-grams than pairs are counted.
ROUNDS = 3

_U = np.uint64
END = words._splitmix(2, 4001)[0]
BEGIN = words._splitmix(2, 4001)[1]
_A, _B = (x | _U(1) for x in words._splitmix(2, 4003))


# --- files -------------------------------------------------------------------------------------------------------


def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri.split(":", 1)[1].lstrip("/")
    return uri if "://" not in uri else None


def put(folder: str, name: str, array: np.ndarray) -> None:
    """Writes an array; a task that runs twice replaces its file by an equal one."""
    local = _local(folder)
    if local:
        os.makedirs(local, exist_ok=True)
        handle, at = tempfile.mkstemp(dir=local)
        with os.fdopen(handle, "wb") as file:
            file.write(np.ascontiguousarray(array).tobytes())
        os.chmod(at, 0o644)
        os.replace(at, f"{local}/{name}")
        return
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as file:
        file.write(np.ascontiguousarray(array).tobytes())


#: An array keeps its map and not a descriptor, of which a process has few and a large model has files by the ten thousand.
_UNTRACKED = {"trackfd": False} if sys.version_info >= (3, 13) else {}


def _map(file, kind: str) -> np.ndarray:
    """The array of an open file, mapped into memory, which outlives the file's descriptor."""
    if not os.fstat(file.fileno()).st_size:
        return np.zeros(0, kind)
    return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, **_UNTRACKED), kind)


@lru_cache(maxsize=1 << 15)
def mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """An array of the shared folder, mapped into memory; from other stores than a file system, from an unlinked copy."""
    local = _local(folder)
    if local:
        with open(f"{local}/{name}", "rb") as file:
            return _map(file, kind)
    store, path = fs.FileSystem.from_uri(folder)
    with tempfile.TemporaryFile() as copy, store.open_input_stream(f"{path}/{name}") as file:
        while part := file.read(1 << 22):
            copy.write(part)
        copy.flush()
        return _map(copy, kind)


# --- arrays of a shard --------------------------------------------------------------------------------------------


def _put_keys(folder: str, name: str, keys: np.ndarray) -> None:
    """Sorted hashes, as where those with equal first bits start, and the next 32 bits of each: 48 of the 64 at full size."""
    bits = min(16, max(1, (len(keys) // 16).bit_length()))
    put(folder, f"{name}.starts", np.searchsorted(keys >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=_U)).astype("<u4"))
    put(folder, f"{name}.keys", ((keys >> _U(32 - bits)) & _U(0xFFFFFFFF)).astype("<u4"))


def _spots(folder: str, name: str, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where wanted hashes are among written ones, and which are there."""
    starts, keys = mapped(folder, f"{name}.starts", "<u4"), mapped(folder, f"{name}.keys", "<u4")
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    bits = (len(starts) - 1).bit_length() - 1
    bucket = (wanted >> _U(64 - bits)).astype(np.int64)
    key = ((wanted >> _U(32 - bits)) & _U(0xFFFFFFFF)).astype("<u4")
    lo, end = starts[bucket].astype(np.int64), starts[bucket + 1].astype(np.int64)
    hi = end
    while (active := lo < hi).any():
        mid = (lo + hi) >> 1
        less = keys[np.minimum(mid, len(keys) - 1)] < key
        lo, hi = np.where(active & less, mid + 1, lo), np.where(active & ~less, mid, hi)
    at = np.minimum(lo, len(keys) - 1)
    return at, (lo < end) & (keys[at] == key)


def _put_numbers(folder: str, name: str, x: np.ndarray) -> None:
    large = np.flatnonzero(x >= 255)
    put(folder, f"{name}.small", np.minimum(x, 255).astype(np.uint8))
    put(folder, f"{name}.large", large.astype("<u4"))
    put(folder, f"{name}.larger", x[large].astype("<u8"))


def _numbers(folder: str, name: str, spot) -> np.ndarray:
    out = mapped(folder, f"{name}.small", "<u1")[spot].astype(np.int64)
    large = np.flatnonzero(out == 255)
    if len(large):
        at = np.searchsorted(mapped(folder, f"{name}.large", "<u4"), large if isinstance(spot, slice) else spot[large])
        out[large] = mapped(folder, f"{name}.larger", "<u8")[at]
    return out


def _put_contexts(folder: str, name: str, keys: np.ndarray, x: np.ndarray) -> None:
    """Of each context: the sum of the counts behind it, and how many are 1, 2 and more.  A byte if all are 1 or it is
    one alone, else a row."""
    _put_keys(folder, name, keys)
    ones, alone = (x[:, 0] == x[:, 1]) & (x[:, 0] < 128), (x[:, 1:].sum(axis=1) == 1) & (x[:, 0] < 127)
    code = np.where(ones, x[:, 0], np.where(alone, 128 + x[:, 0], 255)).astype(np.uint8)
    other = np.flatnonzero(code == 255)
    put(folder, f"{name}.code", code)
    put(folder, f"{name}.other", other.astype("<u4"))
    put(folder, f"{name}.others", x[other].astype("<u8"))


def _contexts_at(folder: str, name: str, spot: np.ndarray) -> np.ndarray:
    code = mapped(folder, f"{name}.code", "<u1")[spot].astype(np.int64)
    out = np.zeros((len(spot), 4))
    out[:, 0] = np.where(code < 128, code, code - 128)
    out[np.arange(len(spot)), np.where(code < 128, 1, np.minimum(out[:, 0], 3).astype(np.int64))] = np.where(code < 128, code, 1)
    other = np.flatnonzero(code == 255)
    if len(other):
        at = np.searchsorted(mapped(folder, f"{name}.other", "<u4"), spot[other])
        out[other] = mapped(folder, f"{name}.others", "<u8").reshape(-1, 4)[at]
    return out


# --- tokens ------------------------------------------------------------------------------------------------------


def tokens(column: pa.Array):
    """(chunk, hashes, at): each text's words and one end; at has the bounds of texts."""
    for chunk in words.chunks(column, words.SPACED):
        n = len(chunk.at) - 1
        yield chunk, np.insert(chunk.h, chunk.at[1:], END), chunk.at + np.arange(n + 1)


def _before(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    u = np.empty_like(h)
    u[1:] = h[:-1]
    u[at[:-1]] = BEGIN
    return u


def _grams(h: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """The tokens, those before them, and so on."""
    out = [h]
    for _ in range(order - 1):
        out.append(_before(out[-1], at))
    return out


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> _U(40)) % _U(shards)).astype(np.int64)


def _short(h: np.ndarray) -> np.ndarray:
    """The 40 bits that stand for a word of an n-gram, but for the last but one."""
    return h >> _U(24)


def _kept(grams: list[np.ndarray]) -> list[np.ndarray]:
    return [x if i == 1 else _short(x) for i, x in enumerate(grams)]


def _with(x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The hash of an n-gram from that of its end and its first word."""
    with np.errstate(over="ignore"):
        return words.mix(x * _A + u * _B)


def _hash(grams: list[np.ndarray]) -> np.ndarray:
    if len(grams) == 1:  # by other bits than those that deal words
        return words.mix(grams[0])
    out = grams[0]
    for u in grams[1:]:
        out = _with(out, u)
    return out


def _spread(x: np.ndarray, shards: int) -> np.ndarray:
    """A shard by bits of a hash that arrays of full size don't hold."""
    return ((x & _U(0xFFFF)) % _U(shards)).astype(np.int64)


def _is_hot(v: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return hot[np.minimum(np.searchsorted(hot, v), len(hot) - 1)] == v if len(hot) else np.zeros(len(v), bool)


def _five(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unfive(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1], [True]))) if len(x) else np.zeros(1, np.int64)


def _flushed(batches, order: int):
    """The n-grams of about FLUSH tokens at a time, the last word first."""
    held, size = [], 0
    for batch in batches:
        for _, h, at in tokens(batch.column(0)):
            held.append(_grams(h, at, order))
            size += len(h)
            if size * max(order - 1, 1) >= FLUSH:
                yield [np.concatenate(x) for x in zip(*held)]
                held, size = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _blobs(table: pa.Table, name: str) -> list[bytes]:
    return [x.as_py() for c in table.column(name).chunks for x in c]


# --- counting ----------------------------------------------------------------------------------------------------


def _count_words(texts: DataFrame, shards: int, folder: str) -> DataFrame:
    """Writes each shard's word hashes and counts; (shard, types, tokens)."""
    schema = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def local(batches):
        for (h,) in _flushed(batches, 1):
            keys, counts = np.unique(h, return_counts=True)
            shard = _shard(keys, shards)
            order = np.argsort(shard, kind="stable")
            for k in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                yield pa.RecordBatch.from_arrays([pa.array([shard[k[0]]], pa.int32()), pa.array([keys[k].tobytes()]), pa.array([counts[k].astype("<u4").tobytes()])], schema=schema)

    def merge(key, table):
        shard = key[0].as_py()
        h = np.concatenate([np.frombuffer(b, "<u8") for b in _blobs(table, "keys")])
        c = np.concatenate([np.frombuffer(b, "<u4") for b in _blobs(table, "counts")]).astype(np.int64)
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        cut = _runs(h)
        c = np.add.reduceat(c, cut[:-1])
        put(folder, f"{shard}.words", h[cut[:-1]])
        _put_numbers(folder, f"{shard}.counts", c)
        return pa.table({"shard": pa.array([shard], pa.int32()), "types": [len(c)], "tokens": [int(c.sum())]})

    return texts.mapInArrow(local, "shard int, keys binary, counts binary").groupBy("shard").applyInArrow(merge, "shard int, types long, tokens long")


#: Rows by kind: ``stat`` (how many n-grams of a level have counts 1 to 4, 3 and more, and the sum of counts), ``gram``
#: (packed n-grams of a level, by their hash), ``context`` (hashes and numbers of contexts of a level, by their hash),
#: ``next`` (packed words and how many distinct ones precede them, for the word's shard).
ROW = pa.schema([("kind", pa.string()), ("level", pa.int32()), ("shard", pa.int32()), ("first", pa.binary()), ("runs", pa.binary()), ("rest", pa.binary()), ("counts", pa.binary()), ("numbers", pa.list_(pa.int64()))])
ROW_SQL = "kind string, level int, shard int, first binary, runs binary, rest binary, counts binary, numbers array<bigint>"


def _rows(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(x, f.type) for x, f in zip(zip(*rows), ROW)]


def _packed(grams: list[np.ndarray], counts: np.ndarray, shard: np.ndarray):
    """A ``gram`` row for each shard."""
    order = np.argsort((shard.astype(_U) << _U(44)) | (grams[1] >> _U(20)))
    for k in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else ():
        own = grams[1][k]
        cut = _runs(own)
        rest = b"".join(_five(x[k]) for i, x in enumerate(grams) if i != 1)
        yield "gram", len(grams), int(shard[k[0]]), own[cut[:-1]].tobytes(), np.diff(cut).astype("<u4").tobytes(), rest, counts[k].astype("<u4").tobytes(), None


def _unpacked(table: pa.Table, level: int) -> tuple[list[np.ndarray], np.ndarray]:
    v = np.concatenate([np.repeat(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u4")) for a, b in zip(_blobs(table, "first"), _blobs(table, "runs"))])
    rest = np.concatenate([_unfive(b).reshape(level - 1, -1) for b in _blobs(table, "rest")], axis=1)
    counts = np.concatenate([np.frombuffer(b, "<u4") for b in _blobs(table, "counts")]).astype(np.int64)
    return [rest[0], v, *rest[1:]], counts


def _merged(grams: list[np.ndarray], counts: np.ndarray | None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(hashes, n-grams, sums of counts) of distinct n-grams, by hash; without counts each counts as one."""
    x = _hash(grams)
    order = np.argsort(x)
    x = x[order]
    cut = _runs(x)
    first = order[cut[:-1]]
    sums = np.diff(cut) if counts is None else np.add.reduceat(counts[order], cut[:-1]) if len(first) else counts
    return x[cut[:-1]], [g[first] for g in grams], sums


def _contexts(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    cut = _runs(keys)
    return keys[cut[:-1]], np.add.reduceat(numbers[order], cut[:-1]) if len(keys) else numbers


def _behind(grams: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _contexts(_hash(grams[1:]), np.stack([counts, counts == 1, counts == 2, counts > 2], axis=1).astype(np.int64))


def _stat(level: int, c: np.ndarray) -> tuple:
    return "stat", level, None, None, None, None, None, [int((c == i).sum()) for i in (1, 2, 3, 4)] + [int((c > 2).sum()), int(c.sum())]


def _nexts(w: np.ndarray, shards: int):
    second, n = np.unique(w, return_counts=True)
    target = ((second >> _U(16)) % _U(shards)).astype(np.int64)
    for shard, k in _by_shard(target):
        yield "next", 1, shard, None, None, _five(second[k]), n[k].astype("<u4").tobytes(), None


def _count_grams(texts: DataFrame, shards: int, folder: str, hot: np.ndarray, order: int, turn: int, rounds: int) -> DataFrame:
    """Writes the n-grams of a round's shards, and all that end them or are their contexts but for hot ones; ROW."""

    def local(batches):
        for grams in _flushed(batches, order):
            grams = _kept(grams)
            x = _hash(grams)
            shard = np.where(_is_hot(grams[1], hot), _spread(x, shards), _shard(grams[1], shards))
            own = np.flatnonzero(shard % rounds == turn)
            if not len(own):
                continue
            x = x[own]
            at = np.argsort(x)
            cut = _runs(x[at])
            at = own[at[cut[:-1]]]
            for row in _packed([g[at] for g in grams], np.diff(cut), shard[at]):
                yield pa.RecordBatch.from_arrays(_rows([row]), schema=ROW)

    def merge(key, table):
        shard = key[0].as_py()
        grams, counts = _unpacked(table, order)
        x, grams, counts = _merged(grams, counts)
        _put_keys(folder, f"{shard}.g{order}", x)
        _put_numbers(folder, f"{shard}.g{order}", counts)
        rows, often = [_stat(order, counts)], _is_hot(grams[1], hot)
        if often.any():
            rows += _passed([g[often] for g in grams], counts[often], shards)
        del x
        grams, counts = [g[~often] for g in grams], counts[~often]
        for level in range(order, 1, -1):
            _put_contexts(folder, f"{shard}.c{level - 1}", *_behind(grams, counts))
            if level > 2:
                x, grams, counts = _merged(grams[:-1], None)
                _put_keys(folder, f"{shard}.g{level - 1}", x)
                _put_numbers(folder, f"{shard}.g{level - 1}", counts)
                rows.append(_stat(level - 1, counts))
        rows += _nexts(grams[0], shards)
        return pa.table(_rows(rows), schema=ROW)

    return texts.mapInArrow(local, ROW_SQL).groupBy("shard").applyInArrow(merge, ROW_SQL)


def _passed(grams: list[np.ndarray], counts: np.ndarray, shards: int) -> list[tuple]:
    """What other shards count of n-grams with hot words: contexts, and n-grams or words that end them."""
    keys, numbers = _behind(grams, counts)
    rows = [("context", len(grams) - 1, shard, keys[k].tobytes(), None, None, numbers[k].astype("<i8").tobytes(), None) for shard, k in _by_shard(_spread(keys, shards))]
    if len(grams) == 2:
        return rows + list(_nexts(grams[0], shards))
    x, grams, counts = _merged(grams[:-1], None)
    return rows + list(_packed(grams, counts, _spread(x, shards)))


def _count_hot(rows: DataFrame, shards: int, folder: str, level: int) -> DataFrame:
    """Writes the n-grams of a level with hot words; ROW."""

    def merge(key, table):
        shard = key[0].as_py()
        x, grams, counts = _merged(*_unpacked(table, level))
        _put_keys(folder, f"{shard}.h{level}", x)
        _put_numbers(folder, f"{shard}.h{level}", counts)
        return pa.table(_rows([_stat(level, counts), *_passed(grams, counts, shards)]), schema=ROW)

    return rows.where((F.col("kind") == "gram") & (F.col("level") == level)).groupBy("shard").applyInArrow(merge, ROW_SQL)


def _count_hot_contexts(rows: DataFrame, folder: str) -> DataFrame:
    """Writes the contexts with hot words; (n)."""

    def merge(key, table):
        level, shard = key[0].as_py(), key[1].as_py()
        keys = np.concatenate([np.frombuffer(b, "<u8") for b in _blobs(table, "first")])
        numbers = np.concatenate([np.frombuffer(b, "<i8").reshape(-1, 4) for b in _blobs(table, "counts")])
        keys, numbers = _contexts(keys, numbers)
        _put_contexts(folder, f"{shard}.d{level}", keys, numbers)
        return pa.table({"n": [len(keys)]})

    return rows.where("kind = 'context'").groupBy("level", "shard").applyInArrow(merge, "n long")


def _exists(folder: str, name: str) -> bool:
    local = _local(folder)
    if local:
        return os.path.exists(f"{local}/{name}")
    store, path = fs.FileSystem.from_uri(folder)
    return store.get_file_info(f"{path}/{name}").type != fs.FileType.NotFound


def _count_continuations(nexts: DataFrame, folder: str) -> DataFrame:
    """Writes how many distinct words precede each word of a shard; (numbers): of counts 1 to 4, and of 3 and more."""

    def merge(key, table):
        shard = key[0].as_py()
        w = np.concatenate([_unfive(b) for b in _blobs(table, "rest")])
        n = np.concatenate([np.frombuffer(b, "<u4") for b in _blobs(table, "counts")]).astype(np.int64)
        order = np.argsort(w, kind="stable")
        w, n = w[order], n[order]
        cut = _runs(w)
        w, n = w[cut[:-1]], np.add.reduceat(n, cut[:-1])
        known = _short(np.asarray(mapped(folder, f"{shard}.words", "<u8")))
        spot = np.searchsorted(w, known)
        spot = np.minimum(spot, len(w) - 1)
        _put_numbers(folder, f"{shard}.follows", np.where(w[spot] == known, n[spot], 0))
        return pa.table({"numbers": pa.array([[int((n == i).sum()) for i in (1, 2, 3, 4)] + [int((n > 2).sum()), int(n.sum())]], pa.list_(pa.int64()))})

    return nexts.groupBy("shard").applyInArrow(merge, "numbers array<bigint>")


#: Discounts where the counts of counts give none, as in very small or very regular texts.
FALLBACK = (0.5, 1.0, 1.5)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and more; each is over 0 and at most its count, so that unseen
    words always have a share."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = (1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 and n1 else 0.0, 3 - 4 * y * n4 / n3 if n3 and n1 else 0.0)
    return tuple(d if 0 < d <= top else f for d, top, f in zip(found, (1.0, 2.0, 3.0), FALLBACK))


class Model:
    """Where the arrays are, and the few numbers that hold for all shards."""

    def __init__(self, **x):
        self.__dict__ |= x


def _forgotten(spark: SparkSession) -> None:
    """Has Spark delete shuffled data that nothing refers to any more, which it does when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fit(docs: DataFrame, shard_bytes: int = SHARD_BYTES, text_col: str = "text", order: int = 2) -> Model:
    """A model of n-grams of order words of all texts of docs (null: empty, so its end alone is counted)."""
    if order < 2:
        raise ValueError("order must be at least 2")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    shards, folder = max(8, -(-size["bytes"] * (order - 1) // shard_bytes)), new_path(spark, "lm")
    held = _count_words(texts, shards, folder).collect()
    used = sorted(r["shard"] for r in held)
    n, v = sum(r["tokens"] for r in held), sum(r["types"] for r in held)

    def frequent(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                count = _numbers(folder, f"{shard}.counts", slice(None))
                often = np.flatnonzero(count > n / (4 * shards))
                yield pa.RecordBatch.from_arrays([pa.array(mapped(folder, f"{shard}.words", "<u8")[often].view(np.int64)), pa.array(count[often].astype(np.int64))], ["word", "n"])

    hot = {BEGIN} if size["n"] else set()  # at most 4 words a shard have a quarter of a shard's tokens
    if used:
        hot |= {np.int64(r["word"]).view(_U) for r in spark.createDataFrame([(s,) for s in used], "shard int").repartition(min(len(used), 64)).mapInArrow(frequent, "word long, n long").collect()}
    hot = np.array(sorted(hot), _U)
    rounds = ROUNDS if order > 2 else 1
    parts = []
    for turn in range(rounds):
        _forgotten(spark)
        parts.append(written(_count_grams(texts, shards, folder, hot, order, turn, rounds), "grams"))
    for level in range(order - 1, 1, -1):
        _forgotten(spark)
        parts.append(written(_count_hot(reduce(DataFrame.unionAll, parts), shards, folder, level), "grams"))
    rows = reduce(DataFrame.unionAll, parts)
    _count_hot_contexts(rows, folder).agg(F.sum("n")).collect()
    stats = np.zeros((order + 1, 6), np.int64)
    for r in rows.where("kind = 'stat'").select("level", "numbers").collect():
        stats[r["level"]] += r["numbers"]
    for r in _count_continuations(rows.where("kind = 'next'").select("shard", "rest", "counts"), folder).collect():
        stats[1] += r["numbers"]
    for part in parts:
        removed(spark, part)
    _forgotten(spark)
    d = np.array([(0, *discounts(*x[:4].tolist())) for x in stats])
    n1, n2, _, _, more, total = stats[1].tolist()
    spare = float(d[1, 1:] @ (n1, n2, more)) / total if total else 1.0
    return Model(folder=folder, shards=shards, used=frozenset(used), hot=hot, n=n, v=v, order=order, d=d, total=total, spare=spare)


# --- scoring -----------------------------------------------------------------------------------------------------


def _look(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted wanted values are in the sorted keys, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _by_shard(shard: np.ndarray):
    order = np.argsort(shard, kind="stable")
    return [(int(shard[k[0]]), k) for k in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1)] if len(shard) else []


def _found(m: Model, keys: np.ndarray, v: np.ndarray, cold: str, hot: str, width: int, spread: bool) -> np.ndarray:
    """The numbers of n-grams or contexts by their hashes, 0 of unknown ones; v: the words that deal them."""
    one, first, back = np.unique(keys, return_index=True, return_inverse=True)
    out, v = np.zeros((len(one), width)), v[first]
    often = _is_hot(v, m.hot)
    for kind, own, dealt in ((cold, np.flatnonzero(~often), _shard(v, m.shards)), (hot, np.flatnonzero(often), _spread(one, m.shards))):
        for shard, k in _by_shard(dealt[own]):
            name, k = f"{shard}.{kind}", own[k]
            if _has(m.folder, f"{name}.keys"):
                spot, there = _spots(m.folder, name, one[k])
                out[k[there]] = _contexts_at(m.folder, name, spot[there]) if spread else _numbers(m.folder, name, spot[there])[:, None]
    return out[back.reshape(-1)]


def lookups(m: Model, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each token: its count in training, and its log10 probability behind those before."""
    one, place = np.unique(h, return_inverse=True)
    place = place.reshape(-1)
    count, follows = np.zeros(len(one)), np.zeros(len(one))
    for shard, k in _by_shard(_shard(one, m.shards)):
        if shard in m.used:
            spot, there = _look(mapped(m.folder, f"{shard}.words", "<u8"), one[k])
            spot, k = spot[there], k[there]
            count[k] = _numbers(m.folder, f"{shard}.counts", spot)
            if _has(m.folder, f"{shard}.follows.small"):
                follows[k] = _numbers(m.folder, f"{shard}.follows", spot)
    n = follows[place]
    p = (n - m.d[1][np.minimum(n, 3).astype(np.int64)]) / m.total if m.total else np.zeros(len(n))
    p = np.maximum(p, 0) + m.spare / (m.v + 1)
    grams = _kept(_grams(h, at, m.order))
    for level in range(2, m.order + 1):
        v, d = grams[1], m.d[level]
        c = _found(m, _hash(grams[:level]), v, f"g{level}", f"g{level}" if level == m.order else f"h{level}", 1, False)[:, 0]
        behind = _found(m, _hash(grams[1:level]), v, f"c{level - 1}", f"d{level - 1}", 4, True)
        known, total = behind[:, 0] > 0, np.maximum(behind[:, 0], 1)
        found = (np.maximum(c - d[np.minimum(c, 3).astype(np.int64)], 0) + behind[:, 1:] @ d[1:] * p) / total
        p = np.where(known, found, p)
    return count[place], np.log10(p)


@lru_cache(maxsize=4096)
def _has(folder: str, name: str) -> bool:
    return _exists(folder, name)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, extra..., n_tokens, n_known, base_score, score, perplexity) of every text.

    base_score: log10 probability under additively smoothed single words; score: under the model; perplexity of the
    latter per token.  A null text is empty, which is one token, its end; null ids stay null, repeated rows are
    scored each; an untrained model gives every token the one probability that it has, 1.
    """
    m = docs.sparkSession.sparkContext.broadcast(model)
    extra = extra or {}
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(c.alias(k) for k, c in extra.items()))
    names = list(extra)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema if f.name in names)

    def scored(batches):
        x = m.value
        for batch in batches:
            for chunk, h, at in tokens(batch.column(1)):
                count, logs = lookups(x, h, at)
                base = np.log10((count + 0.1) / (x.n + 0.1 * (x.v + 1)))
                size = np.diff(at)
                doc = np.repeat(np.arange(len(size)), size)
                known, low, high = (np.bincount(doc, y, len(size)) for y in (count > 0, base, logs))
                part = batch.slice(chunk.lo, chunk.hi - chunk.lo)
                with np.errstate(over="ignore"):  # the perplexity may be infinite
                    arrays = [part.column(0), *part.columns[2:], pa.array(size), pa.array(known.astype(np.int64)), pa.array(low), pa.array(high), pa.array(10 ** (-high / size))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names, "n_tokens", "n_known", "base_score", "score", "perplexity"])

    return own.mapInArrow(scored, "doc_id long, " + (kinds + ", " if kinds else "") + "n_tokens long, n_known long, base_score double, score double, perplexity double")
