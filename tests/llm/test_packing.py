import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from jobsieve.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t\x1c\x85 　aB'srdé1２.<|>endoftext日"), max_size=40), max_size=5))
def test_ids_equal_the_tokenizer(tokenizer, texts):
    got = [np.frombuffer(b, "<u4").tolist() for b in P.encoder(PATH)(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", " <|endoftext|><|endoftext|>", "a  <|endoftext|>  b", "<|endoftext|", "x<|endoftext|>y\n\n<|endoftext|>\n"])
def test_added_tokens_are_matched_in_texts(tokenizer, text):
    (got,) = P.encoder(PATH)([text])
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_that_take_in_blanks(tmp_path):
    spec = json.load(open(PATH))
    spec["added_tokens"][0]["rstrip"] = True
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec))
    (got,) = P.Encoder(str(path))(["a <|endoftext|>  b"])
    assert np.frombuffer(got, "<u4").tolist() == Tokenizer.from_file(str(path)).encode("a <|endoftext|>  b", add_special_tokens=False).ids


def test_cache_overflow(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "CACHE_WORDS", 5)
    texts = ["one two three four five six seven", "eight nine two", "<|endoftext|> it's"]
    got = [np.frombuffer(b, "<u4").tolist() for b in P.Encoder(PATH)(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def best_fit(histogram, capacity):
    room = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [(r, i) for i, r in enumerate(room) if r >= length]
            if fits:
                room[min(fits)[1]] -= length
            else:
                room.append(capacity - length)
    return sorted(room)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 15), max_size=8))))
def test_plan_equals_best_fit_of_single_pieces(case):
    capacity, histogram = case
    held, ranks = {}, {}
    for length, rank, n, first, each, offset in P.plan(histogram, capacity):
        for j in range(n):
            held.setdefault(first + j // each, []).append((offset + j % each * length, length))
            ranks.setdefault(length, []).append(rank + j)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(x for _, x in v) for v in held.values()) == best_fit(histogram, capacity)


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_round_trip(spark, tokenizer, odd_docs, capacity):
    r = random.Random(4)
    docs = [(d["doc_id"], d["text"]) for d in odd_docs.select("doc_id", "text").collect() if d["doc_id"] != 100] + [(200 + i, "hello " * r.randrange(40)) for i in range(60)]
    got = P.best_fit_pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH, capacity).collect()
    by = {}
    for x in got:
        by.setdefault(x["doc_id"], []).append(x)
    assert set(by) == {d for d, _ in docs}
    for d, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        own = sorted(by[d], key=lambda x: x["piece"])
        assert [x["piece"] for x in own] == list(range(len(own))) and sum(x["length"] for x in own) * 4 == len(ids)
        assert all(x["length"] == capacity for x in own[1:]) and (len(own) > 1 or len(ids) // 4 <= capacity)
        at = 0
        for x in own:
            assert x["start"] == at and x["ids_crc32"] == zlib.crc32(ids[4 * at : 4 * (at + x["length"])])
            at += x["length"]
    used = {}
    for x in got:
        used.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = {}
    for x in got:
        lengths[x["length"]] = lengths.get(x["length"], 0) + 1
    assert len(used) == len(best_fit(lengths, capacity))


def test_no_documents(no_docs):
    assert P.best_fit_pack(no_docs, PATH).count() == 0


def test_repeated_rows_are_packed_each(odd_docs):
    got = P.best_fit_pack(odd_docs.where("doc_id = 100"), PATH).collect()
    assert len(got) == 2 and len({(x["sequence_id"], x["offset"]) for x in got}) == 2


def test_many_equal_rows_share_no_task(spark):
    docs = spark.range(0, 400, 1, 8).selectExpr("7L AS doc_id", "'one two three' AS text")
    got = P.best_fit_pack(docs, PATH, 16).collect()
    assert len(got) == 400 and len({(x["sequence_id"], x["offset"]) for x in got}) == 400
    assert max(x["offset"] for x in got) + got[0]["length"] <= 16
