"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public byte-level vocabulary.  The probability of a word
is the sum over all its segmentations into pieces (a forward recursion, vectorised over all words of a length); that
of a text is the product over its words.  The piece probabilities are fitted by expectation maximisation on expected
counts, from a bounded sample of each language's texts.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

#: From a start, spans of more bytes (with the blank before a word) are looked up only where a longer piece begins so.
PIECE = 12
#: Longer words, in bytes with their blank, are summed in logarithms, words of different lengths together.
WORD = 32
#: Bytes of longer words that are summed together.
LONG_BYTES = 1 << 18
#: Texts of each language that a model is fitted on, about: the bound of the training sample.
SAMPLE_TEXTS = 1500
ROUNDS = 4
#: Share of the uniform distribution in each language's.
UNIFORM = 1e-3
UNDETERMINED = "und"
#: The hash table of pieces has 2 to so many slots.
SLOT_BITS = 18

_U = np.uint64
_M = _U(0x9E3779B97F4A7C15)
_letters = [words._splitmix(256, 500 + i) for i in range(WORD + 1)]


class Vocabulary:
    """The pieces of a public vocabulary file, and a hash table from their bytes to a number.

    The file has a base64 piece and its rank in each line.  All 256 bytes are pieces, so every word has a
    segmentation.  A hash is the sum over positions of a random value of the byte there.  Pieces with a blank inside are
    left out, as no word has one.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            raw = (base64.b64decode(line.split()[0]) for line in file if line.strip())
            got = {p for p in raw if p and not p[1:].count(b" ")} | {bytes([b]) for b in range(256)}
        self.pieces = sorted(got)
        self.size = len(self.pieces)
        self.longest = max(map(len, self.pieces))
        _letters.extend(words._splitmix(256, 500 + i) for i in range(len(_letters), self.longest + 1))
        hashes, begins = np.zeros(self.size, _U), set()
        with np.errstate(over="ignore"):
            for i, p in enumerate(self.pieces):
                h = np.uint64(len(p)) * _M
                for j, b in enumerate(p):
                    h += _letters[j][b]
                    if j == PIECE - 1 and len(p) > PIECE:
                        begins.add(int(h - np.uint64(len(p)) * _M))
                hashes[i] = h
        self.begins = np.array(sorted(begins), _U)
        hashes = words.mix(hashes)
        slots = (hashes >> _U(64 - SLOT_BITS)).astype(np.int64)
        self.keys = np.zeros(1 << SLOT_BITS, _U)
        self.at = np.full(1 << SLOT_BITS, self.size, np.int32)
        _, first = np.unique(slots, return_index=True)
        self.keys[slots[first]] = hashes[first]
        self.at[slots[first]] = first
        # the few pieces whose slot was taken, sorted by hash
        rest = np.setdiff1d(np.arange(self.size), first)
        rest = rest[np.argsort(hashes[rest])]
        self.more, self.more_at = hashes[rest], rest.astype(np.int32)
        self.full = np.zeros(1 << SLOT_BITS, bool)
        self.full[slots[rest]] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """The numbers of hashes; ``size`` for those that are no piece's."""
        h = words.mix(h)
        slot = (h >> _U(64 - SLOT_BITS)).astype(np.int64)
        out = np.where(self.keys[slot] == h, self.at[slot], self.size)
        open_ = np.flatnonzero(self.full[slot] & (out == self.size))
        if len(open_):
            spot = np.minimum(np.searchsorted(self.more, h[open_]), len(self.more) - 1)
            hit = self.more[spot] == h[open_]
            out[open_[hit]] = self.more_at[spot[hit]]
        return out

    def goes_on(self, h: np.ndarray) -> np.ndarray:
        """Which hashes of PIECE bytes, without a length, begin a longer piece."""
        if not len(self.begins):
            return np.zeros(len(h), bool)
        return self.begins[np.minimum(np.searchsorted(self.begins, h), len(self.begins) - 1)] == h


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _spans(voc: Vocabulary, letters: np.ndarray, start: int, sizes: np.ndarray | None = None):
    """(end, rows, piece numbers) of all spans from a start of words, as rows of bytes; where these have different
    sizes, the longest first."""
    down = None if sizes is None else -sizes
    h, rows = np.zeros(len(letters), _U), slice(None)
    for j in range(min(voc.longest, letters.shape[1] - start)):
        if down is not None:
            live = int(np.searchsorted(down, -(start + j)))
            rows = slice(0, live) if j < PIECE else rows[: np.searchsorted(rows, live)]
            h = h[: live if j < PIECE else len(rows)]
        if not len(h):
            return
        with np.errstate(over="ignore"):
            h = h + _letters[j][letters[rows, start + j]]
            yield start + j + 1, rows, voc.find(h + _U(j + 1) * _M)
        if j == PIECE - 1:
            rows = np.flatnonzero(voc.goes_on(h))
            h = h[rows]


def _hits(voc: Vocabulary, rows, ids: np.ndarray):
    """The rows whose spans are pieces, and these; the rows as a slice where all are."""
    hit = np.flatnonzero(ids < voc.size)
    if len(hit) == len(ids):
        return rows, ids
    return (hit if isinstance(rows, slice) else rows[hit]), ids[hit]


def forward(voc: Vocabulary, letters: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Natural log of the total probability of all segmentations: words of one length x languages.

    probs: (size + 1) x languages, the last row 0.
    """
    n, length = letters.shape
    if length > WORD:
        return forward_long(voc, letters, np.full(n, length), probs)
    alpha = np.zeros((length + 1, n, probs.shape[1]))
    alpha[0] = 1.0
    for start in range(length):
        for end, rows, ids in _spans(voc, letters, start):
            rows, ids = _hits(voc, rows, ids)
            if len(ids):
                alpha[end][rows] += alpha[start][rows] * probs[ids]
    return np.log(np.maximum(alpha[length], 1e-300))


def forward_long(voc: Vocabulary, letters: np.ndarray, sizes: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """As forward, of words of any sizes, the longest first; holds as many positions as the longest piece has."""
    with np.errstate(divide="ignore"):
        logs = np.log(probs)
    ring = np.full((voc.longest + 1, *letters.shape[:1], probs.shape[1]), -np.inf)
    ring[0] = 0.0
    out = np.zeros(ring.shape[1:])
    for start in range(letters.shape[1] + 1):
        now = ring[start % len(ring)]
        done = sizes == start
        out[done] = now[done]
        for end, rows, ids in _spans(voc, letters, start, sizes):
            rows, ids = _hits(voc, rows, ids)
            if len(ids):
                then = ring[end % len(ring)]
                then[rows] = np.logaddexp(then[rows], now[rows] + logs[ids])
        now[:] = -np.inf
    return out


def expected_counts(voc: Vocabulary, letters: np.ndarray, weight: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected piece counts of weighted words of one length under the probabilities p (size + 1, the last 0)."""
    n, length = letters.shape
    if length > WORD:
        return expected_counts_long(voc, letters, np.full(n, length), weight, p)
    alpha, beta = np.zeros((length + 1, n)), np.zeros((length + 1, n))
    alpha[0] = beta[length] = 1.0
    spans = [list(_spans(voc, letters, start)) for start in range(length)]
    for start in range(length):
        for end, rows, ids in spans[start]:
            alpha[end][rows] += alpha[start][rows] * p[ids]
    for start in range(length - 1, -1, -1):
        for end, rows, ids in spans[start]:
            beta[start][rows] += beta[end][rows] * p[ids]
    scale = weight / np.maximum(alpha[length], 1e-300)
    counts = np.zeros(voc.size + 1)
    for start in range(length):
        for end, rows, ids in spans[start]:
            counts += np.bincount(ids, alpha[start][rows] * beta[end][rows] * p[ids] * scale[rows], voc.size + 1)
    counts[voc.size] = 0
    return counts


def expected_counts_long(voc: Vocabulary, letters: np.ndarray, sizes: np.ndarray, weight: np.ndarray, p: np.ndarray) -> np.ndarray:
    """As expected_counts, of words of any sizes, the longest first."""
    n, length = letters.shape
    with np.errstate(divide="ignore"):
        logs = np.log(p)
    alpha, beta = np.full((length + 1, n), -np.inf), np.full((length + 1, n), -np.inf)
    alpha[0] = beta[sizes, np.arange(n)] = 0.0
    for start in range(length):
        for end, rows, ids in _spans(voc, letters, start, sizes):
            rows, ids = _hits(voc, rows, ids)
            alpha[end][rows] = np.logaddexp(alpha[end][rows], alpha[start][rows] + logs[ids])
    total = alpha[sizes, np.arange(n)]
    counts = np.zeros(voc.size + 1)
    for start in range(length - 1, -1, -1):
        for end, rows, ids in _spans(voc, letters, start, sizes):
            rows, ids = _hits(voc, rows, ids)
            on = beta[end][rows] + logs[ids]
            beta[start][rows] = np.logaddexp(beta[start][rows], on)
            np.add.at(counts, ids, np.exp(alpha[start][rows] + on - total[rows]) * weight[rows])
    return counts


def by_length(chunk: words.Chunk):
    """(rows of bytes, words that they are) of a chunk's words of up to WORD bytes: each with a blank before it, A-Z in
    lower case."""
    buf, size = _FOLDED[chunk.buf], chunk.ends - chunk.starts + 1
    for length in np.unique(size[size <= WORD]).tolist():
        rows = np.flatnonzero(size == length)
        letters = buf[chunk.starts[rows][:, None] - 1 + np.arange(length)[None, :]]
        letters[:, 0] = 32
        yield letters, rows


def longer(chunk: words.Chunk):
    """(rows of bytes, their sizes, words that they are) of a chunk's longer words, some at a time, the longest first."""
    size = chunk.ends - chunk.starts + 1
    rest = np.flatnonzero(size > WORD)
    rest = rest[np.argsort(-size[rest], kind="stable")]
    while len(rest):
        rows = rest[: max(1, LONG_BYTES // int(size[rest[0]]))]
        rest = rest[len(rows) :]
        letters = np.zeros((len(rows), int(size[rows[0]])), np.uint8)
        for i, r in enumerate(rows.tolist()):
            letters[i, 0] = 32
            letters[i, 1 : size[r]] = _FOLDED[chunk.buf[chunk.starts[r] : chunk.ends[r]]]
        yield letters, size[rows], rows


_FOLDED = words._FOLD.astype(np.uint8)


def fit_pieces(voc: Vocabulary, texts: pa.Array, rounds: int = ROUNDS, uniform: float = UNIFORM, times: np.ndarray | None = None) -> np.ndarray:
    """Piece probabilities of texts, each of which occurs so many times: size values."""
    times = np.ones(len(texts)) if times is None else times
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    long = []
    for chunk in words.chunks(texts, words.SPACED):
        _, first, inverse = np.unique(chunk.h, return_index=True, return_inverse=True)
        count = np.bincount(inverse.reshape(-1), np.repeat(times[chunk.lo : chunk.hi], np.diff(chunk.at)), len(first))
        own = words.Chunk(0, 1, chunk.h[first], np.array([0, len(first)]), chunk.starts[first], chunk.ends[first], chunk.buf)
        for letters, rows in by_length(own):
            held.setdefault(letters.shape[1], []).append((letters, count[rows]))
        long += [(letters, sizes, count[rows]) for letters, sizes, rows in longer(own)]
    merged = []
    for own in held.values():
        letters, inverse = np.unique(np.concatenate([x[0] for x in own]), axis=0, return_inverse=True)
        merged.append((letters, np.bincount(inverse.reshape(-1), np.concatenate([x[1] for x in own]))))
    lengths = np.array([len(p) for p in voc.pieces], float)
    p = np.append(256.0 ** -np.minimum(lengths, 3), 0.0)
    p /= p.sum()
    for _ in range(rounds):
        counts = np.zeros(voc.size + 1)
        for letters, weight in merged:
            for at in range(0, len(letters), 20000):
                counts += expected_counts(voc, letters[at : at + 20000], weight[at : at + 20000], p)
        for part in long:
            counts += expected_counts_long(voc, *part, p)
        total = counts.sum()
        p = (1 - uniform) * counts / total + uniform / voc.size if total else np.full(voc.size + 1, 1 / voc.size)
        p[voc.size] = 0
    return p[: voc.size]


class Model:
    """langs, and the (size + 1) x langs piece probabilities (a broadcast value; its size is fixed by the vocabulary)."""

    def __init__(self, path: str, langs: list[str], probs: np.ndarray):
        self.path, self.langs, self.probs = path, langs, probs


def drawn(own: DataFrame, sample_texts: int) -> DataFrame | None:
    """(lang, text, times) of about sample_texts different texts of each language at most, and of one at least."""
    own = own.where(F.col("text").rlike(r"[^ \t-\r]")).withColumn("draw", F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 62)))
    counts = own.select("lang", "draw").distinct().groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).collect()
    if not counts:
        return None
    # at least the least, so that a language of few texts keeps one
    below = {r["lang"]: max(r["least"] + 1, int(min(1.0, sample_texts / r["n"]) * (1 << 62))) for r in counts}
    most = F.element_at(F.create_map(*[x for k, n in below.items() for x in (F.lit(k), F.lit(n))]), F.col("lang"))
    return own.where(F.col("draw") < most).groupBy("lang", "text").agg(F.count("*").alias("times"))


def fit(docs: DataFrame, vocabulary_path: str, sample_texts: int = SAMPLE_TEXTS, rounds: int = ROUNDS, uniform: float = UNIFORM, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the languages in lang_col, from about ``sample_texts`` different texts of each at most, drawn by hash.

    Each language is fitted in a task of its own.  Rows with a null or blank text or a null language teach nothing, and
    a language of only such rows is not in the model; equal rows count as often as they occur.
    """
    own = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    sample = drawn(own, sample_texts)
    if sample is None:
        return Model(vocabulary_path, [], np.zeros((1, 0)))

    def train(key, table):
        p = fit_pieces(vocabulary(vocabulary_path), table.column("text").combine_chunks(), rounds, uniform, table.column("times").to_numpy().astype(float))
        return pa.table({"lang": [key[0].as_py()], "probs": pa.array([p.astype("<f8").tobytes()], pa.binary())})

    got = sorted((r["lang"], r["probs"]) for r in sample.groupBy("lang").applyInArrow(train, "lang string, probs binary").collect())
    probs = np.stack([np.frombuffer(bytes(p), "<f8") for _, p in got], axis=1) if got else np.zeros((0, 0))
    return Model(vocabulary_path, [k for k, _ in got], np.concatenate((probs, np.zeros((1, len(got))))))


_LETTERS = r"\p{L}"


def _scores(chunk: words.Chunk, voc: Vocabulary, probs: np.ndarray) -> np.ndarray:
    """Log probabilities, texts of the chunk x languages."""
    n = len(chunk.at) - 1
    if not len(chunk.h):
        return np.zeros((n, probs.shape[1]))
    _, first, inverse = np.unique(chunk.h, return_index=True, return_inverse=True)
    own = words.Chunk(0, 1, chunk.h[first], np.array([0, len(first)]), chunk.starts[first], chunk.ends[first], chunk.buf)
    logs = np.zeros((len(first), probs.shape[1]))
    for letters, rows in by_length(own):
        for at in range(0, len(rows), 8192):
            logs[rows[at : at + 8192]] += forward(voc, letters[at : at + 8192], probs)
    for letters, sizes, rows in longer(own):
        logs[rows] = forward_long(voc, letters, sizes, probs)
    sums = np.concatenate((np.zeros((1, probs.shape[1])), np.cumsum(logs[inverse.reshape(-1)], axis=0)))
    return sums[chunk.at[1:]] - sums[chunk.at[:-1]]


def identify(text: Column, model: Model, spark) -> Column:
    """A struct (lang_pred, score) of a text: the likeliest language and its posterior under equal priors.

    ``und`` with score 0 for a null text, one without a letter, or a model without languages.  Whole texts are
    scored, in bounded memory; ties go to the language that is first by name.
    """
    shared = spark.sparkContext.broadcast(model)
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    # a text without a letter goes to the function as a null
    asked = F.when(text.cast("string").rlike(_LETTERS), text.cast("string"))

    @F.arrow_udf(kind)
    def scored(column: pa.Array) -> pa.Array:
        m = shared.value
        voc = vocabulary(m.path)
        known = np.asarray(column.is_valid())
        best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
        if m.langs:
            for chunk in words.chunks(column, words.SPACED):
                logs = _scores(chunk, voc, m.probs)
                top = logs.argmax(axis=1)
                best[chunk.lo : chunk.hi] = top
                score[chunk.lo : chunk.hi] = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        else:
            known[:] = False
        names = np.array([*m.langs, UNDETERMINED], object)
        return pa.StructArray.from_arrays([pa.array(names[np.where(known, best, len(m.langs))], pa.string()), pa.array(np.where(known, score, 0.0))], ["lang_pred", "score"])

    return scored(asked)


def kept_languages(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """docs without the rows whose text has no language: ``und``, or no language of at least posterior ``least``."""
    found = identify(F.col(text_col), model, docs.sparkSession)
    name = "_found"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, found).where((F.col(name)["lang_pred"] != UNDETERMINED) & (F.col(name)["score"] >= least)).drop(name)
