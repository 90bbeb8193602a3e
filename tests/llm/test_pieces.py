import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from jobsieve.llm import pieces, queries
from jobsieve.llm.queries import PIECE_BPE

from .conftest import ODD, prose

MORE = ["  a", "a  b ", " ", "▁", "▁▁x ▁y", "<s>", "<0x41>", "日本語テスト🎉🎉", "a\tb\r\n", "é é", " " * 100, " " * 33 + "word", "x" * 3000, "ＡＢ ㍿ ﬁne", " nbsp　wide", "İ ǆ"]
POOL = "abc ▁ABé日🎉\n\t́<s>0x1.,ﬁＡ "


def texts():
    r = random.Random(5)
    return [t for t in ODD if t] + MORE + ["".join(r.choice(POOL) for _ in range(r.randint(1, 50))) for _ in range(400)]


def spans(library, text):
    return [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def _message(number, data):
    n, size = len(data), b""
    while True:
        size += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return bytes([number << 3 | 2]) + size + data


def rewritten(path, normalizer=None, changes=lambda n, v: v):
    """The model file with another normaliser, or with other pieces."""
    with open(PIECE_BPE, "rb") as file:
        data = file.read()
    out = b""
    for number, value in pieces._fields(data):
        if number == 3 and normalizer is not None:
            value = normalizer
        out += _message(number, changes(number, value))
    path.write_bytes(out)
    return str(path)


def check(path):
    own, library = pieces.Model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for text in texts():
        ids, starts, ends = own.encode(text.encode())
        want = library.encode(text)
        assert ids.tolist() == want, text
        assert own.decode(want) == library.decode(want), text
        assert list(zip(starts.tolist(), ends.tolist())) == spans(library, text), text


def test_equals_the_library():
    check(PIECE_BPE)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_compiled_maps_equal_the_library(tmp_path, rule):
    proto = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = next(v for n, v in pieces._fields(proto) if n == 3)
    for flags in (b"\x18\x01\x20\x01", b"\x18\x01\x20\x00", b"\x18\x00\x20\x01"):
        check(rewritten(tmp_path / "m.model", spec + flags))


def test_own_merges_equal_those_by_bytes():
    own = pieces.Model(PIECE_BPE)
    assert own.merger
    for text in texts():
        plain = " ".join(text.replace("▁", " ").split(" ")).strip(" ")
        if plain and "  " not in plain:
            a, b = own._by_merger(plain), own._by_segments(plain)
            assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_unused_pieces_fall_apart(tmp_path):
    def unused(number, value):
        return value + b"\x18\x05" if number == 1 and dict(pieces._fields(value)).get(1) in (b"the", "▁the".encode(), b"ing") else value

    path = rewritten(tmp_path / "m.model", changes=unused)
    own, library = pieces.Model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for text in ("the thing is the other theing", "ing", prose(9, 80)):
        assert own.encode(text.encode())[0].tolist() == library.encode(text)


def test_any_ids_decode_as_in_the_library(library):
    own, r = pieces.model(PIECE_BPE), random.Random(3)
    for _ in range(1500):
        ids = [r.randrange(3, 259) if r.random() < 0.5 else r.choice([0, 1, 2, 29871, 259, r.randrange(32000)]) for _ in range(r.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids)
    with pytest.raises(ValueError):
        own.decode([32000])


def test_windows_of_long_texts(monkeypatch, library):
    monkeypatch.setattr(pieces, "SPAN", 50)
    own, text = pieces.Model(PIECE_BPE), prose(4, 900) + "  é  " + "y" * 300 + " 日本 " + prose(5, 90)
    ids, starts, ends = own.encode(text.encode())
    assert ids.tolist() == library.encode(text) and list(zip(starts.tolist(), ends.tolist())) == spans(library, text)


def test_bytes_that_are_no_characters():
    ids, starts, ends = pieces.model(PIECE_BPE).encode(b"a \xff\xc3 b")
    assert ends[-1] == 6 and starts.tolist() == sorted(starts.tolist()) and pieces.model(PIECE_BPE).decode(ids.tolist()) == "a �� b"


def test_rows(spark, odd_docs, no_docs, library):
    rows = pieces.decode(pieces.encode(odd_docs, PIECE_BPE), PIECE_BPE).collect()
    want = {}
    for r in odd_docs.collect():
        want.setdefault(r["doc_id"], []).append(r["text"] or "")
    assert len(rows) == odd_docs.count()
    for r in rows:
        text = want[r["doc_id"]][0]
        assert r["ids"] == library.encode(text) and r["decoded"] == library.decode(r["ids"])
        raw = text.encode()
        assert "".join(raw[a:b].decode() for a, b in zip(r["starts"], r["ends"])) == text
    assert pieces.encode(no_docs, PIECE_BPE).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in pieces.decode(nothing, PIECE_BPE).collect()} == {1: None, 2: ""}


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op13_sentencepiece(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"])
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
