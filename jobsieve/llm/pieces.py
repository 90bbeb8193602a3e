"""SentencePiece encoding and decoding with the original bytes of every piece.

A model file is read once per worker.  A text is normalised through the model's compiled character map (at each place
the longest key that the map's double array has, else the character itself) while the original byte where each
normalised character begins is written down.  Merges then run on the normalised text, and every piece is projected
through that record to the bytes of the original text that it stands for.

Where no piece of the vocabulary holds a space symbol behind another character, no merge can cross the start of a run of space
symbols, so the text is cut there.  Where the scores of pieces differ, ``tiktoken`` runs the same merges on bytes: characters are
put together first, then pieces in the order of their scores.  Other models, and segments of several spaces (whose pieces
have one score), are merged by ``Model.merged`` and kept in a bounded cache; the tests hold the two against each other.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import text_buffer, tidy

SPACE = "▁"
#: Segments in a worker's cache before it starts anew, and the longest that is kept.
CACHE_SEGMENTS, CACHE_LENGTH = 250_000, 64
#: Characters of a text that are encoded at a time (more where no cut is), and tokens of a returned batch.
SPAN, BATCH_TOKENS = 1 << 20, 1 << 21
# The kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a serialised message: an int, four or eight bytes, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class CharsMap:
    """The compiled character map: a double array of units over UTF-8 bytes, and the replacements that its leaves name."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = blob[4 + size :]
        self.may_start = self._openings()

    def _child(self, node: int, byte: int) -> int | None:
        """The place of the node's child along a byte."""
        at = node ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def _base(self, at: int) -> int:
        unit = self.units[at]
        return at ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _openings(self) -> re.Pattern | None:
        """A pattern of where a key may begin: a byte that is one, or two that begin one."""
        options = []
        for a in range(1, 256) if self.units else ():
            at = self._child(self._base(0), a)
            if at is None:
                continue
            if self.units[at] >> 8 & 1:
                options.append(re.escape(bytes([a])))
            else:
                inner = b"".join(re.escape(bytes([b])) for b in range(1, 256) if self._child(self._base(at), b) is not None)
                options.append(re.escape(bytes([a])) + b"[" + inner + b"]")
        return re.compile(b"|".join(options), re.DOTALL) if options else None

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest key at a place and that key's bytes; None if there is none."""
        found, node = None, self._base(0)
        for k in range(at, len(data)):
            child = self._child(node, data[k])
            if child is None:
                break
            node = self._base(child)
            if self.units[child] >> 8 & 1:
                where = self.units[node] & 0x7FFFFFFF
                found = self.replacements[where : self.replacements.index(b"\0", where)], k + 1 - at
        return found


def _widths(text: str) -> np.ndarray:
    """UTF-8 bytes of each character."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)


def _symbol(data: bytes, at: int) -> tuple[str, int]:
    """The character at a place and its bytes; U+FFFD for one byte that begins none."""
    for size in range(1, 5):
        try:
            return data[at : at + size].decode("utf-8"), size
        except UnicodeDecodeError:
            continue
    return "�", 1


class Model:
    """A BPE model file: normalisation, merges, and the way back."""

    def __init__(self, path: str):
        self.pieces, self.kinds, scores = [], [], []
        trainer, normalizer = {}, {}
        with open(path, "rb") as file:
            data = file.read()
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append(own.get(1, b"").decode("utf-8"))
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                trainer |= dict(_fields(value))
            elif number == 3:
                normalizer |= dict(_fields(value))
        if trainer.get(3, 1) != _BPE or trainer.get(24) or USER in self.kinds or not normalizer.get(5, 1):
            raise ValueError("only BPE models that escape spaces, with them in front of words and without symbols of the user's own")
        self.chars = CharsMap(normalizer.get(2, b""))
        self.prefix, self.squeeze = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_surface = trainer.get(44, " ⁇ ".encode()).decode("utf-8")
        self.score = {p: s for p, s, k in zip(self.pieces, scores, self.kinds) if k in (NORMAL, UNUSED)}
        self.ids = {p: i for i, p in enumerate(self.pieces)}
        self.controls = {i for i, k in enumerate(self.kinds) if k == CONTROL}
        self.unused = {p for p, k in zip(self.pieces, self.kinds) if k == UNUSED}
        bytes_of = {int(self.pieces[i][1:-1], 16): i for i, k in enumerate(self.kinds) if k == BYTE}
        self.bytes = [bytes_of[b] for b in range(256)] if trainer.get(35) else None
        self.raw = {i: b for b, i in bytes_of.items()}
        inner = re.compile(f"[^{SPACE}]{SPACE}")
        self.cuts = not any(inner.search(p) for p in self.score)
        self.segments = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.cut, self.runs = re.compile("(?<=[^ ]) "), re.compile("(  +[^ ]*)")
        self.cache: dict[str, tuple[bytes, bytes]] = {}
        self.merger = self._merger()

    def _merger(self) -> tiktoken.Encoding | None:
        """The merges over bytes, None where ties or unused pieces make the order of merges another; and of each of its tokens the id
        (-1 for parts of characters and for characters that are no piece) and its bytes."""
        long = sorted((p for p in self.score if len(p) > 1 and p.strip(SPACE)), key=self.score.get, reverse=True)
        if self.unused or not self.bytes or not self.cuts or len({self.score[p] for p in long}) < len(long):
            return None
        parts = {c.encode("utf-8")[:n] for p in self.score for c in p if c > "\x7f" and c != SPACE for n in range(2, 5)}
        tokens = dict.fromkeys([*(bytes([b]) for b in range(256)), *sorted(parts, key=len), *(p.replace(SPACE, " ").encode("utf-8") for p in long)])
        known = {p.replace(SPACE, " ").encode("utf-8"): self.ids[p] for p in self.score}
        known |= {bytes([b]): self.bytes[b] for b in range(128) if bytes([b]) not in known}
        self.id_of = np.array([known.get(t, -1) for t in tokens], np.int32)
        self.bytes_of = np.array([len(t) for t in tokens], np.int64)
        return tiktoken.Encoding("pieces", pat_str=" +[^ ]*|[^ ]+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})

    def _by_merger(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of a text without two spaces in a row: of each piece the characters of text up to its end."""
        tokens = np.array(self.merger.encode_ordinary(text), np.int64)
        ids, size = self.id_of[tokens], self.bytes_of[tokens]
        ends = np.cumsum(size)
        if text.isascii():
            return ids, ends
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        if (ids < 0).any():  # into single bytes
            n = np.where(ids < 0, size, 1)
            at = np.repeat(np.arange(len(ids)), n)
            within = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            ids, ends = ids[at], np.where(ids[at] < 0, (ends - size)[at] + within + 1, ends[at])
            ids[ids < 0] = np.array(self.bytes, np.int32)[raw[ends[ids < 0] - 1]]
        begins = np.append((raw & 0xC0) != 0x80, True)
        return ids, np.cumsum(begins)[ends] - 1

    # --- encoding ---

    def normalised(self, data: bytes) -> Iterator[tuple[str, np.ndarray]]:
        """Spans of the normalised text, with spaces for space symbols, and for each its characters' first bytes in the original, with one more for the end."""
        text = None
        if not self.squeeze and not (self.chars.may_start and self.chars.may_start.search(data)):
            try:
                text = data.decode("utf-8")
            except UnicodeDecodeError:
                pass
        if text is None:
            yield from self._spans(*self._mapped(data))
            return
        at, byte = 0, 0
        while at < len(text):
            to = len(text)
            if self.cuts and to - at > SPAN and (found := self.cut.search(text, at + SPAN)):
                to = found.start()
            part = text[at:to]
            first = np.arange(byte, byte + len(part) + 1) if part.isascii() else byte + np.concatenate(([0], np.cumsum(_widths(part))))
            shown = part.replace(SPACE, " ")
            if at == 0 and self.prefix:
                shown, first = " " + shown, np.concatenate(([0], first))
            yield shown, first
            at, byte = to, int(first[-1])

    def _spans(self, text: str, first: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
        at = 0
        while at < len(text):
            to = len(text)
            if self.cuts and to - at > SPAN and (found := self.cut.search(text, at + SPAN)):
                to = found.start()
            yield text[at:to], first[at : to + 1]
            at = to

    def _units(self, data: bytes) -> Iterator[tuple[str, int]]:
        """What each stretch of the original becomes, and its bytes: keys of the map, else characters."""
        at, ahead = 0, -1
        while at < len(data):
            if self.chars.may_start and ahead < at:
                found = self.chars.may_start.search(data, at)
                ahead = found.start() if found else len(data)
            hit = self.chars.longest(data, at) if ahead == at else None
            if hit is None:
                yield (step := _symbol(data, at))
                at += step[1]
            else:
                yield hit[0].decode("utf-8"), hit[1]
                at += hit[1]

    def _mapped(self, data: bytes) -> tuple[str, np.ndarray]:
        out, first, at = [], [], 0
        blank = self.squeeze  # whether a space is already there, so that another one goes
        for shown, size in self._units(data):
            for c in shown:
                if c == " " and blank:
                    continue
                out.append(c)
                first.append(at)
                blank = self.squeeze and c == " "
            at += size
        if self.squeeze:
            while out and out[-1] in (" ", SPACE):
                out.pop()
                at = first.pop()
        if not out:
            return "", np.zeros(1, np.int64)
        if self.prefix:
            head = first[0] if self.squeeze else 0
            out.insert(0, " ")
            first.insert(0, head)
        first.append(at)
        return "".join(out).replace(SPACE, " "), np.array(first, np.int64)

    def merged(self, segment: str) -> list[str]:
        """The symbols that stay when, of all neighbours that form a piece, the best scored are joined first, the left ones on ties."""
        symbols, score = list(segment), self.score
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        halves: dict[str, tuple[str, str]] = {}
        agenda = []

        def propose(left: int, right: int) -> None:
            own = symbols[left] + symbols[right]
            worth = score.get(own)
            if worth is not None:
                heapq.heappush(agenda, (-worth, left, right, len(own)))
                if own in self.unused:
                    halves[own] = symbols[left], symbols[right]

        for k in range(n - 1):
            propose(k, k + 1)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                propose(left, right)
            if before[left] >= 0:
                propose(before[left], left)
        whole = [s for s in symbols if s]
        while halves and any(s in halves for s in whole):
            whole = [x for s in whole for x in halves.get(s, (s,))]
        return whole

    def _encoded(self, segment: str) -> tuple[bytes, bytes]:
        """Ids and widths in characters of a segment's pieces; of the bytes of an unknown character the last one has its width."""
        ids, widths = [], []
        for symbol in self.merged(segment):
            known = self.ids.get(symbol, self.unknown)
            if known == self.unknown and self.bytes:
                raw = symbol.encode("utf-8")
                ids += [self.bytes[b] for b in raw]
                widths += [0] * (len(raw) - 1) + [len(symbol)]
            else:
                ids.append(known)
                widths.append(len(symbol))
        return np.array(ids, "<i4").tobytes(), np.array(widths, "<i4").tobytes()

    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends) of a text in UTF-8: pieces and the original bytes of each."""
        got = [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for text, first in self.normalised(data):
            for k, part in enumerate(self.runs.split(text)) if self.merger else [(1, text)]:
                if part:
                    ids, ends = self._by_merger(part) if k % 2 == 0 else self._by_segments(part)
                    got.append((ids, first[np.concatenate(([0], ends[:-1]))], first[ends]))
                    first = first[len(part) :]
        return tuple(np.concatenate(x) for x in zip(*got)) if len(got) != 2 else got[1]

    def _by_segments(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of any text."""
        text, parts, cache = text.replace(" ", SPACE), [], self.cache
        for segment in self.segments.findall(text) if self.cuts else [text]:
            known = cache.get(segment)
            if known is None:
                known = self._encoded(segment)
                if len(segment) <= CACHE_LENGTH:
                    if len(cache) >= CACHE_SEGMENTS:
                        cache.clear()
                    cache[segment] = known
            parts.append(known)
        ids = np.frombuffer(b"".join(p[0] for p in parts), "<i4")
        widths = np.frombuffer(b"".join(p[1] for p in parts), "<i4")
        if not self.bytes:
            ids, widths = self._one_unknown(ids, widths)
        return ids, np.cumsum(widths, dtype=np.int64)

    def _one_unknown(self, ids: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbouring unknown symbols are one."""
        opens = np.ones(len(ids), bool)
        opens[1:] = (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)
        at = np.flatnonzero(opens)
        return ids[at], np.add.reduceat(widths, at) if len(at) else widths

    # --- decoding ---

    @property
    def shown(self) -> list[bytes]:
        if not hasattr(self, "_shown"):
            table = []
            for i, (p, k) in enumerate(zip(self.pieces, self.kinds)):
                own = "" if k == CONTROL else self.unknown_surface if k == UNKNOWN else p.replace(SPACE, " ")
                table.append(bytes([self.raw[i]]) if k == BYTE else own.encode("utf-8"))
            self._shown = table
        return self._shown

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the space symbol of the start goes (all of them where extra spaces do), and runs of byte pieces become the characters that
        they spell, U+FFFD for a byte that spells none.  An id outside the model raises."""
        if ids and not 0 <= min(ids) <= max(ids) < len(self.pieces):
            raise ValueError("an id that is no piece's")
        at, head = 0, b""
        while at < len(ids) and (self.prefix or self.squeeze):
            i = ids[at]
            if self.kinds[i] == BYTE:
                break
            own, at = self.shown[i], at + 1
            dropped = self.kinds[i] not in (UNKNOWN, CONTROL) and own.startswith(b" ")
            head = own[1:] if dropped else own
            if head or (dropped and not self.squeeze):
                break
        if not self.controls.intersection(ids):  # which end a run of bytes without being seen
            try:
                return (head + b"".join(map(self.shown.__getitem__, ids[at:]))).decode("utf-8")
            except UnicodeDecodeError:
                pass
        out, k = [head.decode("utf-8")], at
        while k < len(ids):
            to = k
            while to < len(ids) and self.kinds[ids[to]] == BYTE:
                to += 1
            spelt, place = b"".join(map(self.shown.__getitem__, ids[k:to])), 0
            while place < len(spelt):
                c, size = _symbol(spelt, place)
                out.append(c)
                place += size
            k = to
            while k < len(ids) and self.kinds[ids[k]] != BYTE:
                out.append(self.shown[ids[k]].decode("utf-8"))
                k += 1
        return "".join(out)


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, starts, ends) of every row of docs: the pieces of its whole text by the model file at ``path`` (which
    every worker has), without begin or end ids, and the bytes of the text's UTF-8 from starts to ends that each stands for.

    A null text counts as empty and has no pieces; an id may be null or repeated, each row is encoded for itself, other
    columns are ignored and an empty table gives no rows.  The bytes of an unknown character have all of it on the last one.
    A space that was added in front stands for no bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            lo, got, tokens = 0, [], 0
            for k in range(len(batch)):
                got.append(own.encode(raw[offsets[k] : offsets[k + 1]].tobytes()))
                tokens += len(got[-1][0])
                if tokens >= BATCH_TOKENS or k == len(batch) - 1:
                    at = pa.array(np.cumsum([0, *(len(g[0]) for g in got)]), pa.int32())
                    lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x), kind)) for x, kind in zip(zip(*got), (pa.int32(), pa.int64(), pa.int64()))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(got)), *lists], ["doc_id", "ids", "starts", "ends"])
                    lo, got, tokens = k + 1, [], 0
        tidy()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, starts array<bigint>, ends array<bigint>")


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with ``out``, the text that the ids spell; null for null ids, empty for none."""
    at = rows.columns.index(ids_col)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_texts(own, batch.column(at)), pa.string())], [*batch.schema.names, out])
        tidy()

    return rows.mapInArrow(run, f"{types}, `{out}` string")


def _texts(own: Model, column: pa.ListArray) -> list[str | None]:
    offsets, values = column.offsets.to_pylist(), column.values
    return [own.decode(values[a:b].to_pylist()) if valid else None for a, b, valid in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist())]
