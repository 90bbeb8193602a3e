"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its words, the classes of its characters in runs of three, and how its words repeat; all are
hashed into fixed buckets.  A bounded labelled sample gives term weights, a truncated singular value decomposition
and the labelled vectors, which are broadcast.  Each document is projected, compared with every labelled vector in
exact blocked cosine products, and its nearest neighbours vote with weights by similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .store import broadcast_if_small

WORD_BUCKETS = 1024
CLASS_BUCKETS = 2048
#: Words equal to the one before, to one of the last four, and others.
REPEATS = 3
TERMS = WORD_BUCKETS + CLASS_BUCKETS + REPEATS
#: Weights of the three blocks of terms, each of unit length before.
BLOCKS = ((0, WORD_BUCKETS, 0.35), (WORD_BUCKETS, WORD_BUCKETS + CLASS_BUCKETS, 1.0), (WORD_BUCKETS + CLASS_BUCKETS, TERMS, 1.0))
DIMENSIONS = 48
#: Labelled texts of each label that are learned from, about: the bound of the training sample and of the broadcast.
SAMPLE_TEXTS = 2000
NEIGHBOURS = 25
SHARPNESS = 8
THRESHOLD = 0.3
#: Cosines that differ by less are ties.
TIE = 1e-6

_U = np.uint64


def _classes() -> np.ndarray:
    """Lower-case and non-ASCII letters 0, upper case 1, digits 2, blanks 3, line ends and controls 4, others their own."""
    out = np.zeros(256, np.int64)
    for b in range(128):
        c = chr(b)
        out[b] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c == " " else 4 if b < 32 or b == 127 else 5 + b - 33
    return out


_CLASS = _classes()
_SPOT = (words.mix(np.arange(128**3, dtype=_U)) % _U(CLASS_BUCKETS)).astype(np.int32)


def term_counts(column: pa.Array):
    """(chunk, texts x TERMS counts) of all texts, some at a time; a long text's counts are exact, from its spans."""
    for chunk in words.chunks(column, words.SPACED, 1 << 20, 512):
        n = len(chunk.at) - 1
        counts = np.zeros(n * TERMS, np.int64)
        doc = np.repeat(np.arange(n), np.diff(chunk.at))
        counts += np.bincount(doc * TERMS + (chunk.h % _U(WORD_BUCKETS)).astype(np.int64), minlength=n * TERMS)
        if len(chunk.h):
            same = np.zeros(len(doc), bool)
            near = np.zeros(len(doc), bool)
            for back in range(1, min(5, len(doc))):
                hit = (chunk.h[back:] == chunk.h[:-back]) & (doc[back:] == doc[:-back])
                (same if back == 1 else near)[back:] |= hit
            kind = np.where(same, 0, np.where(near, 1, 2))
            counts += np.bincount(doc * TERMS + WORD_BUCKETS + CLASS_BUCKETS + kind, minlength=n * TERMS)
        size = chunk.sizes
        owner = np.repeat(np.arange(n), size)
        for at in range(0, len(chunk.buf), 1 << 22):
            part = chunk.buf[at : at + (1 << 22) + 2]
            if len(part) < 3:
                break
            c = _CLASS[part]
            own = owner[at : at + len(part)]
            inside = own[2:] == own[:-2]
            spot = _SPOT[(c[:-2] * 128 + c[1:-1]) * 128 + c[2:]]
            counts += np.bincount((own[2:] * TERMS + WORD_BUCKETS + spot)[inside], minlength=n * TERMS)
        yield chunk, counts.reshape(n, TERMS)


class Model:
    """Everything that scoring needs; its size is bounded by TERMS, DIMENSIONS and the sample."""

    def __init__(self, idf, basis, vectors, labels, prior):
        self.idf, self.basis, self.vectors, self.labels, self.prior = idf, basis, vectors, labels, prior


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts, dtype=np.float32)
    x *= idf
    x[:, WORD_BUCKETS + CLASS_BUCKETS :] = np.sqrt(counts[:, WORD_BUCKETS + CLASS_BUCKETS :])  # shares, once of unit length
    for a, b, w in BLOCKS:
        norm = np.sqrt(np.einsum("ij,ij->i", x[:, a:b], x[:, a:b], dtype=np.float64))[:, None]
        x[:, a:b] *= (w / np.maximum(norm, 1e-12)).astype(np.float32)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-12)


def train(counts: np.ndarray, labels: np.ndarray, prior: float, dimensions: int = DIMENSIONS) -> Model:
    """A model of labelled count rows: a seeded randomised decomposition, so equal samples give equal models.

    counts in single precision are spent: their memory becomes that of the weighted rows, some rows at a time.
    """
    n = len(counts)
    idf = np.log((1 + n) / (1 + np.count_nonzero(counts, axis=0))).astype(np.float32) + np.float32(0.1)
    x = counts if counts.dtype == np.float32 else np.empty(counts.shape, np.float32)
    for at in range(0, n, 256):
        x[at : at + 256] = _weighted(counts[at : at + 256], idf)
    start = np.random.default_rng(5).standard_normal((x.shape[1], min(dimensions + 8, max(n, 1)))).astype(np.float32)
    q = start
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q)) if n else (start, None)
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False) if n else (None, None, np.eye(q.shape[1], dtype=np.float32))
    basis = (q @ vt.T)[:, :dimensions].astype(np.float32)
    return Model(idf, basis, _unit(x @ basis).astype(np.float32), labels.astype(np.float32), prior)


def vote(m: Model, counts: np.ndarray, neighbours: int = NEIGHBOURS, sharpness: int = SHARPNESS) -> np.ndarray:
    """The weighted share of label 1 among the nearest labelled vectors; the prior where nothing is similar.

    Products are in double precision and rounded to TIE; all that tie with the last neighbour vote like it, each with the
    same part of the places that are left, so a score depends neither on the order of the labelled texts nor on the batch.
    """
    if not len(m.labels):
        return np.full(len(counts), m.prior)
    v = _unit(_weighted(counts, m.idf) @ m.basis).astype(float)
    out = np.empty(len(v))
    k = min(neighbours, len(m.labels))
    vectors, labels = m.vectors.T.astype(float), m.labels.astype(float)
    for at in range(0, len(v), 256):
        cosine = np.rint(v[at : at + 256] @ vectors / TIE) * TIE
        n, last = len(cosine), np.partition(cosine, len(labels) - k, axis=1)[:, len(labels) - k]
        row, col = np.nonzero(cosine >= last[:, None])
        near = cosine[row, col]
        tied = near == last[row]
        left = (k - np.bincount(row, ~tied, n)) / np.bincount(row, tied, n)
        weight = np.maximum(near, 0) ** sharpness * np.where(tied, left[row], 1.0)
        total = np.bincount(row, weight, n)
        out[at : at + 256] = np.where(total > 1e-9, np.bincount(row, weight * labels[col], n) / np.maximum(total, 1e-9), m.prior)
    return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_texts: int = SAMPLE_TEXTS, dimensions: int = DIMENSIONS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from about ``sample_texts`` texts of each label, drawn by a hash of the id.

    Null ids, labels and texts teach nothing; a label other than 1 counts as 0.  Label rows that repeat an id and a label
    count once; an id with both labels teaches both.  Of rows of docs that repeat an id one teaches, that whose counts are
    first in order.  So the sample is bounded by the ids drawn, whatever repeats.
    """
    own = labels.select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) == 1).cast("int").alias("label")).where("id is not null and label is not null").distinct()
    sizes = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5
    draw = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = {y: min(1.0, sample_texts / max(1, sizes.get(y, 0))) for y in (0, 1)}
    drawn = own.where(draw < F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0])))

    def count(batches):
        for batch in batches:
            rows = [(np.flatnonzero(c), c) for _, part in term_counts(batch.column(2)) for c in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, pa.binary()) for x in ([at.astype(">u2").tobytes() for at, _ in rows], [c[at].astype(">u4").tobytes() for at, c in rows]))], ["id", "label", "terms", "counts"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    counted = texts.join(broadcast_if_small(drawn, drawn.count()), "id").select("id", "label", "text").mapInArrow(count, "id long, label int, terms binary, counts binary")
    # about two times sample_texts rows, of the terms that they have
    got = sorted(tuple(r) for r in counted.groupBy("id", "label").agg(F.min(F.struct("terms", "counts")).alias("x")).select("id", "label", "x.*").collect())
    counts = np.zeros((len(got), TERMS), np.float32)
    for row, (_, _, at, c) in zip(counts, got):
        row[np.frombuffer(at, ">u2").astype(np.int64)] = np.frombuffer(c, ">u4")
    labelled = np.array([y for _, y, *_ in got])
    del got
    model = train(counts, labelled, prior, dimensions)
    del counts
    words.tidy()
    return model


def quality(text: Column, model: Model, spark, neighbours: int = NEIGHBOURS, sharpness: int = SHARPNESS) -> Column:
    """The score of a text, 0 to 1, higher for likelier label 1.  Null and empty texts, and any under a model without
    labelled texts, get the share of label 1 in all labels; equal texts get equal scores; ties are as in ``vote``; whole texts are
    read, in bounded memory."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column))
        for chunk, counts in term_counts(column):
            out[chunk.lo : chunk.hi] = np.where(chunk.sizes > 0, vote(shared.value, counts, neighbours, sharpness), shared.value.prior)
        return pa.array(out)

    return scored(text.cast("string"))


def kept_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """docs whose score is at least threshold."""
    return docs.where(quality(F.col(text_col), model, docs.sparkSession) >= threshold)
