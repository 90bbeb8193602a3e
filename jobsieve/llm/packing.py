"""Best-fit packing planned on the length histogram.

Documents become token ids and are cut into pieces of at most ``capacity`` tokens.  Only the histogram of piece
lengths (at most ``capacity`` rows) reaches the driver: best-fit decreasing runs over counts, so equal bins move as
ranges and the plan has a few entries per length, whatever the number of documents.  Each piece then takes the slot
that the plan has for its rank within its length.  The task that makes a piece numbers it among its own of that length;
counts by (length, task) give what comes before, so no task ever holds all pieces of one length and no row is sorted.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import broadcast_if_small, written
from .words import tidy

CAPACITY = 2048
#: Words in a worker's cache before it starts anew.
CACHE_WORDS = 250_000
_SPACES = {chr(c) for c in (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}
_WHITE = "".join(sorted(_SPACES))
_UNIT = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, those of the ``tokenizers`` file at path.

    A byte-level BPE of this kind never merges across the start of a unit (a run of non-space with at most one
    leading space, or a run of white space), so units are encoded once and kept in a bounded cache.  New units go
    through ``tiktoken``, which runs the same merges several times faster, if the file's ids follow its merge order;
    otherwise through ``tokenizers`` itself.  Added tokens (such as one for the end of a text) are matched first where
    their strings stand in a text, and what is between them is encoded by itself, as ``tokenizers`` does; a file whose
    added tokens take in blanks or stand as whole words alone has texts with them encoded by ``tokenizers``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
        added = spec.get("added_tokens", [])
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.plain = not any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in added)
        self.fast = _ranked(path, spec)
        self.path, self.cache = path, {}

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _learn(self, units: list[str]) -> None:
        """Encodes new units: those with one leading space all in one text, cut where a token opens with it."""
        cache, spaced, other = self.cache, [], []
        for u in units:
            (spaced if len(u) > 1 and u[0] == " " and u[1] not in _SPACES else other).append(u)
        if spaced:
            ids = np.array(self._ids("".join(spaced)), "<u4")
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) == len(spaced) and cuts[0] == 0:
                raw, ends = ids.tobytes(), np.append(cuts[1:], len(ids)).tolist()
                for u, a, b in zip(spaced, cuts.tolist(), ends):
                    cache[u] = raw[4 * a : 4 * b]
            else:
                other += spaced
        for u in other:
            cache[u] = np.array(self._ids(u), "<u4").tobytes()

    def _ids(self, text: str) -> list[int]:
        return self.fast.encode_ordinary(text) if self.fast else self.tokenizer.encode(text, add_special_tokens=False).ids

    def _between(self, text: str) -> bytes:
        """The ids of a text without added tokens."""
        units = _UNIT.findall(text)
        new = [u for u in set(units) if u not in self.cache]
        if new:
            if len(self.cache) + len(new) > CACHE_WORDS:
                self.cache.clear()
                new = list(dict.fromkeys(units))
            self._learn(new)
        return b"".join(map(self.cache.__getitem__, units))

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if not any(mark in text for mark in self.added):
                yield self._between(text)
            elif self.plain:
                yield b"".join(self.added[part] if k % 2 else self._between(part) for k, part in enumerate(self.marks.split(text)))
            else:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _ranked(path: str, spec: dict):
    """A tiktoken encoding of a byte-level BPE file; None unless each merge makes the next id."""
    import tiktoken

    model, vocab = spec["model"], spec["model"]["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if spec.get("normalizer") or model.get("continuing_subword_prefix") or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]  # the bytes that stand for themselves
    letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letter[c] for c in token): i for token, i in vocab.items() if token not in added}
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: one, or pieces of capacity behind a first piece that may be shorter."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth) of every document; a null text is an empty one, and each ends
    in id 0.  nth numbers the pieces of one length of one task, from 0: once written, it's a place within the length."""
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())

    def encode(batches):
        ids_of, task, seen = encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [[] for _ in kinds]
                for doc, ids in zip(part.column(0).to_pylist(), ids_of(part.column(1).fill_null("").to_pylist())):
                    ids += b"\0\0\0\0"
                    for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        for column, x in zip(rows, (doc, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), task, seen[length])):
                            column.append(x)
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
            tidy()

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: entries (length, first rank, count, first sequence, pieces in each, offset).

    Piece ``rank`` of an entry goes to sequence first + (rank - first rank) // in_each, at offset
    offset + ((rank - first rank) % in_each) * length.  The result equals best-fit decreasing piece by piece:
    a bin with the least room that suffices keeps being the best fit until its room is under the length.
    """
    open_bins: dict[int, list[tuple[int, int]]] = {}  # room: ranges (first sequence, count)
    rooms: list[int] = []
    entries, sequences = [], 0

    def add(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in open_bins:
                insort(rooms, room)
                open_bins[room] = []
            open_bins[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, count = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(k)
            else:
                each = capacity // length
                room, first, count = capacity, sequences, -(-left // each)
                sequences += count
            each = room // length
            whole = min(count, left // each)
            if whole:
                entries.append((length, rank, whole * each, first, each, capacity - room))
                add(room - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
            if whole < count:
                if left and left < each:
                    entries.append((length, rank, left, first + whole, left, capacity - room))
                    add(room - left * length, first + whole, 1)
                    rank, left, whole = rank + left, 0, whole + 1
                add(room, first + whole, count - whole)
    return entries


def packed(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to written pieces (doc_id, piece, start, length, ids_crc32, task, nth)."""
    sizes = written(found.groupBy("length", "task").agg(F.count("*").alias("n")), "sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    entries = plan(counts, capacity)
    before = sizes.select("length", "task", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    # a row for each length of each task, far fewer than pieces; a key has no more pieces than one task made
    ranked = found.join(broadcast_if_small(before, sizes.count()), ["length", "task"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    table = np.array(sorted(entries), np.int64).reshape(-1, 6)
    span = int(table[:, 1:3].sum(1).max()) + 1 if len(table) else 1
    keys = table[:, 0] * span + table[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            e = table[np.searchsorted(keys, length * span + rank, "right") - 1]
            k = rank - e[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(e[:, 3] + k // e[:, 4]), pa.array(e[:, 5] + k % e[:, 4] * length)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def best_fit_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` tokens.

    Returns per piece (doc_id, piece, start, length, ids_crc32, sequence_id, offset); offsets in a sequence are
    gapless from 0.  Null texts count as empty (id 0 alone), null ids stay null, repeated rows are packed each,
    other columns are ignored, and an empty table gives no rows.
    """
    return packed(written(pieces(docs, tokenizer, capacity, id_col, text_col), "pieces"), capacity)
