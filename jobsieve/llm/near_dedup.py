"""Near-duplicates: MinHash banding, sequential Bayesian verification of signatures, exact check of the survivors.

Texts with equal shingle sets are one class from the start, so copies never meet in a bucket.  In each bucket of a
band, all classes first meet its smallest one (a star); only buckets whose classes are still in several components
after that are compared in full, in blocks of bounded size, and there only across components.  Large ones of these, such
as a passage that very many documents share makes, are first dealt by a second band.  A pair leaves this
verification as soon as the posterior chance of its similarity reaching the threshold is under ``miss``; what is left
is confirmed on the full shingle sets, in blocks of bounded bytes of text.  So a group of m copies costs about m
comparisons, not m squared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import join_counted
from . import words
from .graph import components
from .store import broadcast_if_small, removed, written

WORDS = 5
PERCENT = 75
BANDS = 64
ROWS = 5
#: Chance that a pair at the threshold is pruned by its signature, at most about.
MISS = 1e-6
#: Signature values that are compared at a time.
BATCH = 32
#: Classes in a block of a bucket, and pairs in a block of the exact check, about.
BLOCK = 2048
PAIRS = 2048
#: Bytes of text in a block of the exact check, about: it has fewer pairs where texts are long.
BLOCK_BYTES = 32 << 20
#: Buckets of more classes in several components are dealt by a second band.
LARGE = 2 * BLOCK

_U = np.uint64
_seeds = words._splitmix(2 * BANDS * ROWS, 77)


def least_matches(n_values: int, batch: int = BATCH, percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """For each prefix of batch, 2 batch, ... values: the fewest equal ones with which a pair is kept.

    With a uniform prior, the posterior of the similarity s after m of n equal values is Beta(m + 1, n - m + 1);
    P(s >= t) is then the chance of at most m successes in n + 1 trials at t.
    """
    t, out = percent / 100, []
    for n in range(batch, n_values + 1, batch):
        total, m = 0.0, 0
        while True:
            total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(t) + (n + 1 - m) * math.log(1 - t)) if t < 1 else 0.0
            if total >= miss or m == n:
                break
            m += 1
        out.append(m)
    return out


def signature(shingles: np.ndarray, n_values: int) -> np.ndarray:
    """The low 16 bits of the n_values minima of permuted hashes (uint16)."""
    a = ((_seeds[:n_values] >> _U(32)).astype(np.uint32) | np.uint32(1))[:, None]
    b = (_seeds[n_values : 2 * n_values] >> _U(32)).astype(np.uint32)[:, None]
    low = (shingles >> _U(32)).astype(np.uint32)
    least = np.full(n_values, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 1024):
        x = low[None, at : at + 1024] * a
        x += b
        np.minimum(least, x.min(axis=1), out=least)
    return (words.mix(least.astype(_U)) & _U(0xFFFF)).astype(np.uint16)


def _sets(column: pa.Array, k: int):
    for chunk in words.chunks(column, words.SPACED):
        yield from words.shingle_sets(chunk, k)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, k: int, n_values: int) -> DataFrame:
    """(doc_id, hash, bytes, n_shingles, print, sig): the text's 64-bit hash and size, the 128-bit print of its shingle
    set, and the set's signature (print and signature are null if it is empty)."""
    schema = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("bytes", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("sig", pa.binary())])

    def sketch(batches):
        for batch in batches:
            n, prints, sigs, seen = [], [], [], {}
            for s in _sets(batch.column(3), k):
                with np.errstate(over="ignore"):
                    key = np.array([words.mix(s).sum(dtype=_U), words.mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) + _U(len(s))], _U).tobytes() if len(s) else None
                if key and key not in seen:
                    seen[key] = signature(s, n_values).tobytes()
                n.append(len(s)), prints.append(key), sigs.append(seen.get(key))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(sigs, pa.binary())], schema=schema)

    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"), text.alias("text"))
    return own.mapInArrow(sketch, "doc_id long, hash long, bytes long, n_shingles long, print binary, sig binary")


def band_keys(sigs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """n x bands hashes of a signature matrix (uint16)."""
    with np.errstate(over="ignore"):
        z = (sigs.astype(_U).reshape(len(sigs), bands, rows) * words._C[:rows]).sum(axis=2, dtype=_U)
        return words.mix(z + np.arange(1, bands + 1, dtype=_U) * _U(0xD6E8FEB86659FD93))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def in_buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, node, doc_id) for every band of every class."""

    def spread(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys = band_keys(_matrix(part.column(1)), bands, rows)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), *(pa.array(np.repeat(part.column(c).to_numpy(), bands)) for c in (0, 2))], ["key", "node", "doc_id"])

    return classes.select("node", "sig", "doc_id").mapInArrow(spread, "key long, node long, doc_id long")


def survivors(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, least: list[int], batch: int) -> np.ndarray:
    """Which of the pairs (a[i], b[j]) of signatures are kept by the sequential comparison: a boolean mask."""
    kept, equal = np.arange(len(i)), np.zeros(len(i), np.int32)
    for k, m in enumerate(least):
        part = slice(k * batch, (k + 1) * batch)
        x, y = a[:, part], b[:, part]
        for at in range(0, len(kept), 65536):
            own = kept[at : at + 65536]
            equal[own] += (x[i[own]] == y[j[own]]).sum(axis=1, dtype=np.int32)
        kept = kept[equal[kept] >= m]
    mask = np.zeros(len(i), bool)
    mask[kept] = True
    return mask


def star_survivors(pairs: DataFrame, classes: DataFrame, least: list[int], batch: int) -> DataFrame:
    """(a, b, n, bytes): the pairs (a, b) that their signatures leave, how many pairs a has, and the bytes of both texts."""
    count = pairs.count()
    sizes = pairs.groupBy("a").agg(F.count("*").alias("n"))
    left = written(sizes.join(classes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"), F.col("bytes").alias("bytes_a")), "a"), "centres")
    right = classes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"), F.col("bytes").alias("bytes_b"))

    def compare(batches):
        for got in batches:
            for at in range(0, got.num_rows, 4096):
                part = got.slice(at, 4096)
                i = np.arange(part.num_rows)
                mask = survivors(_matrix(part.column(4)), _matrix(part.column(5)), i, i, least, batch)
                yield pa.RecordBatch.from_arrays(part.columns[:4], ["a", "b", "n", "bytes"]).filter(pa.array(mask))

    # a centre's row has its signature, so fewer of them are broadcast
    met = join_counted(pairs, left, ["a"], "n", count, "inner", row_bytes=64 + 4 * BANDS * ROWS).join(right, "b")
    return met.select("a", "b", "n", (F.col("bytes_a") + F.col("bytes_b")).alias("bytes"), "sig_a", "sig_b").mapInArrow(compare, "a long, b long, n long, bytes long")


def star_blocks(stars: DataFrame) -> DataFrame:
    """Pairs (a, b, n, bytes) dealt to blocks for ``confirmed``, of at most PAIRS pairs and BLOCK_BYTES bytes, about.

    Pairs of like size share blocks, so long texts meet few others; pairs of a centre stay together up to a block's size.
    """
    own = stars.withColumn("size", F.ceil(F.log2(F.greatest("bytes", F.lit(1)))).cast("int"))
    counts = {r["size"]: r["n"] for r in own.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most 64 rows
    if not counts:
        return stars.select(F.col("a").alias("blk"), F.array("a", "b").alias("nodes"), F.array("a").alias("a"), F.array("b").alias("b"))
    per = {c: max(1, min(PAIRS, BLOCK_BYTES >> c)) for c in counts}
    lookup = lambda of: F.element_at(F.create_map(*[x for c in sorted(counts) for x in (F.lit(c), F.lit(of(c)))]), F.col("size"))
    tasks, parts = lookup(lambda c: -(-counts[c] // per[c])), F.ceil(F.col("n") / lookup(lambda c: per[c]))
    slot = F.xxhash64("size", F.pmod(F.xxhash64("a"), tasks), F.pmod(F.xxhash64("b"), parts))
    return own.select(slot.alias("blk"), F.array("a", "b").alias("nodes"), F.array("a").alias("a"), F.array("b").alias("b"))


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The links (u, v) among pairs (blk, nodes, a, b), exact on full sets; enough to connect what is linked.

    a and b: arrays of the pairs' ends, all of them among nodes.  All pairs of a block are checked together: a block
    gets each of its texts once, and a pair that links of the block connect already is left out.
    """
    ends = pairs.select(F.col("blk").alias("of"), F.explode("nodes").alias("node")).distinct().join(texts, "node").select("of", "node", "text")
    pairs = pairs.select("blk", "a", "b")

    def check(key, own, held):
        nodes = held.column("node").to_numpy()
        place = {n: i for i, n in enumerate(nodes.tolist())}
        sets = []
        for part in held.column("text").chunks:
            sets += _sets(part, k)
        root = list(range(len(sets)))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        u, v = [], []
        one, two = (np.concatenate([c.flatten().to_numpy() for c in own.column(x).chunks] or [np.zeros(0, np.int64)]).tolist() for x in ("a", "b"))
        for a, b in zip(one, two):
            i, j = place[a], place[b]
            p, q = find(i), find(j)
            if p == q:
                continue
            s, t = sets[i], sets[j]
            if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
                continue
            both = np.concatenate((s, t))
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            if 100 * shared >= percent * (len(s) + len(t) - shared):
                root[p] = q
                u.append(a), v.append(b)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return pairs.groupBy("blk").cogroup(ends.groupBy("of")).applyInArrow(check, "u long, v long")


def refined(members: DataFrame, classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """Large buckets (key, node, component) dealt by each other band: (key, node, component, n, band, own) of the smaller
    buckets whose classes have several components.

    own: the band of the large bucket, band: the second one.  A pair at the threshold that meets in a band meets in none
    of the others with chance (1 - t^rows)^(bands - 1), 4e-8 with the defaults.
    """

    def spread(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                every, key = band_keys(_matrix(part.column(3)), bands, rows), part.column(0).to_numpy().view(_U)
                own = (every == key[:, None]).argmax(axis=1)
                with np.errstate(over="ignore"):
                    second = words.mix(every ^ (key * words._C[0])[:, None]).view(np.int64)
                i, band = np.nonzero(np.arange(bands)[None, :] != own[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(second[i, band]), part.column(1).take(pa.array(i)), part.column(2).take(pa.array(i)), pa.array(band.astype(np.int32)), pa.array(own[i].astype(np.int32))], ["key", "node", "component", "band", "own"])

    own = members.join(classes.select("node", "sig"), "node").select("key", "node", "component", "sig")
    dealt = written(own.mapInArrow(spread, "key long, node long, component long, band int, own int"), "refined")
    mixed = written(dealt.groupBy("key").agg(F.count("*").alias("n"), (F.min("component") != F.max("component")).alias("mixed")).where("mixed").select("key", "n"), "mixed")
    return join_counted(dealt, mixed, ["key"], "n", dealt.count(), "inner").select("key", "node", "component", "n", "band", "own")


def mixed_survivors(members: DataFrame, classes: DataFrame, bands: int, rows: int, least: list[int], batch: int, block: int, groups: int) -> DataFrame:
    """Pairs across components within a bucket that their signatures leave, as (blk, nodes, a, b) with arrays of
    at most PAIRS pairs, whose texts have BLOCK_BYTES bytes, about: each row a block for the exact check.

    members: (key, node, component, n, band, own) of buckets with several components; band: -1 for that which the key is of.
    A bucket of n classes is cut into blocks; each pair of blocks is one group.  A pair that meets in several bands is
    compared in the first alone.
    """
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", "node", "component", "band", "own", "parts", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    # buckets of one part are dealt to groups of many, as many groups as the buckets' rows call for
    dealt = dealt.withColumn("blk", F.xxhash64(F.when(F.col("parts") > 1, F.col("key")).otherwise(F.pmod("key", F.lit(groups))), "parts", "lo", "hi"))
    dealt = dealt.join(classes.select("node", "sig", "bytes"), "node").select("blk", "key", "node", "component", "band", "own", "part", "lo", "hi", "bytes", "sig")

    def compare(key, rows_):
        rows_ = rows_.combine_chunks()
        keys = rows_.column("key").to_numpy()
        node, comp, part = (rows_.column(c).to_numpy() for c in ("node", "component", "part"))
        lo, hi, band_, own_, size = (rows_.column(c).to_numpy() for c in ("lo", "hi", "band", "own", "bytes"))
        sigs = _matrix(rows_.column("sig").chunk(0)) if rows_.num_rows else np.zeros((0, bands * rows), np.uint16)
        every = band_keys(sigs, bands, rows)
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1], [True])))
        out_a, out_b = [], []
        for x, y in zip(cuts[:-1], cuts[1:]):
            m = order[x:y]
            band, skip = int(band_[m[0]]), int(own_[m[0]])
            if band < 0:
                band = int(np.flatnonzero(every[m[0]].view(np.int64) == keys[m[0]])[0])
            before = [x for x in range(band) if x != skip]
            one, two = (m[part[m] == lo[m[0]]], m[part[m] == hi[m[0]]])
            for at in range(0, len(one), 64):
                rows_a = one[at : at + 64]
                across = comp[rows_a][:, None] != comp[two][None, :]
                if lo[m[0]] == hi[m[0]]:
                    across &= node[rows_a][:, None] < node[two][None, :]
                i, j = np.nonzero(across)
                if not len(i):
                    continue
                i, j = rows_a[i], two[j]
                good = survivors(sigs, sigs, i, j, least, batch)
                i, j = i[good], j[good]
                if before and len(i):
                    new = ~(every[i][:, before] == every[j][:, before]).any(axis=1)
                    i, j = i[new], j[new]
                out_a.append(node[i]), out_b.append(node[j])
        a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
        b = np.concatenate(out_b) if out_b else np.zeros(0, np.int64)
        order = np.lexsort((b, a))
        a, b = a[order].tolist(), b[order].tolist()
        bytes_of = dict(zip(node.tolist(), size.tolist()))
        packs, held, volume, start = [], set(), 0, 0
        for at in range(len(a) + 1):
            new = {a[at], b[at]} - held if at < len(a) else set()
            more = sum(bytes_of[x] for x in new)
            if at > start and (at == len(a) or at - start == PAIRS or volume + more > BLOCK_BYTES):
                packs.append((sorted(held), a[start:at], b[start:at]))
                new = {a[at], b[at]} if at < len(a) else set()
                held, volume, start, more = set(), 0, at, sum(bytes_of[x] for x in new)
            held |= new
            volume += more
        names = words.mix(np.arange(len(packs), dtype=_U) + np.array([key[0].as_py()], np.int64).view(_U) * _U(0x9E3779B97F4A7C15)).view(np.int64).tolist()
        many = pa.list_(pa.int64())
        rows_out = [(name, *pack) for name, pack in zip(names, packs)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows_out) if rows_out else [[]] * 4, (pa.int64(), many, many, many))], names=["blk", "nodes", "a", "b"])

    many = "array<bigint>"
    return dealt.groupBy("blk").applyInArrow(compare, f"blk long, nodes {many}, a {many}, b {many}")


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, miss: float = MISS, block: int = BLOCK, large: int = LARGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs.

    Documents are linked if the Jaccard similarity of their sets of k-word shingles is at least percent / 100; a
    component's id is its smallest doc_id, and that document is kept.  A text of fewer words is one shingle; one
    without words, or null, has none, is linked with nothing and kept.  A null doc_id takes part in nothing: its
    component is null and it is kept.  Every row is judged by its own text, so rows that repeat a doc_id with different texts
    are documents that happen to share an id: both are in the component of their own text.  An empty table gives no rows.

    A pair at the threshold misses all bands with chance (1 - t^rows)^bands, 3e-8 with the defaults, and is pruned
    with chance ``miss``; see ``refined`` for buckets of over ``large`` classes.
    """
    spark, values = docs.sparkSession, bands * rows
    least = least_matches(values - values % BATCH, percent=percent, miss=miss)
    prints = written(fingerprints(docs, id_col, text_col, k, values), "prints")
    known = F.col("print").isNotNull() & F.col("doc_id").isNotNull()
    # a class is a set of shingles; the row that stands for it has its smallest doc_id
    one = prints.where(known).groupBy("print").agg(F.min(F.struct("doc_id", "hash", "bytes")).alias("x"), F.count("*").alias("n"), F.first("sig").alias("sig"))
    classes = written(one.select(F.monotonically_increasing_id().alias("node"), "x.*", "n", "print", "sig"), "classes")
    rowed = written(in_buckets(classes, bands, rows), "keys")
    # the star's centre is the class of the smallest id, which copies are often made of
    shared = written(rowed.groupBy("key").agg(F.count("*").alias("n"), F.min_by("node", "doc_id").alias("rep")).where("n > 1"), "shared")
    buckets = written(join_counted(rowed.select("key", "node"), shared, ["key"], "n", classes.count() * bands, "inner"), "buckets")
    removed(spark, rowed)

    pairs = written(buckets.where("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    stars = written(star_survivors(pairs, classes, least, BATCH), "stars")
    texts = _texts(docs, classes, stars.select(F.array("a", "b").alias("nodes")), id_col, text_col)
    links = written(confirmed(star_blocks(stars), texts, k, percent), "links")
    linked = components(links)

    labelled = written(buckets.where("n > 2").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")), "labelled")
    mixed = written(labelled.groupBy("key").agg((F.min("component") != F.max("component")).alias("mixed"), F.max("n").alias("m")).where("mixed").select("key", "m"), "mixed")
    members = written(join_counted(labelled, mixed, ["key"], "m", labelled.count(), "inner").select("key", "node", "component", "n", F.lit(-1).alias("band"), F.lit(-1).alias("own")), "members")
    often = members.where(F.col("n") > large)
    if not often.isEmpty():
        members = written(members.where(F.col("n") <= large).unionByName(refined(often, classes, bands, rows)), "members")
    groups = max(1, members.count() // (2 * block))
    rest = written(mixed_survivors(members, classes, bands, rows, least, BATCH, block, groups), "rest")
    more = written(confirmed(rest, _texts(docs, classes, rest, id_col, text_col), k, percent), "links")
    final = written(components(links.union(more)), "components")

    own = written(final.join(classes.select("node", "doc_id"), "node"), "ids")
    ids = written(own.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size")), "least")
    named = join_counted(own, ids, ["component"], "size", own.count(), "inner").select("node", "component_id")
    named = classes.select("node", "print", "n", "doc_id").join(named, "node", "left").select("print", "n", F.coalesce("component_id", "doc_id").alias("component_id"))
    named = written(named, "named")
    removed(spark, shared, buckets, pairs, stars, texts, links, labelled, mixed, rest, more, final, own, ids, classes)
    found = join_counted(prints.where(known).select("doc_id", "n_shingles", "print"), named, ["print"], "n", prints.count(), "inner").select("doc_id", "n_shingles", "component_id")
    alone = prints.where(~known).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of the nodes of pairs, written: the text with the id and the hash of the class's row."""
    ends = pairs.select(F.explode("nodes").alias("node")).distinct()
    ends = written(classes.select("node", "doc_id", "hash").join(ends, "node", "left_semi"), "ends")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("doc_id is not null")
    own = own.withColumn("hash", F.xxhash64("text")).join(broadcast_if_small(ends, ends.count()), ["doc_id", "hash"])
    found = written(own.select("node", "text").dropDuplicates(["node"]), "texts")
    removed(docs.sparkSession, ends)
    return found
