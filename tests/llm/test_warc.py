import base64
import gzip
import hashlib
import random

import pytest

from jobsieve.llm import warc as W


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGES = [(1, "http://a.example.com/x y", "<html>é</html>"), (2, "http://b", "WARC/1.1\r\n\r\nhttp://c 1 2 3 4\n\n"), (3, "http://c", "<html>é</html>"), (4, None, None), (5, "", ""), (7, "http://d", "x" * 300_000), (None, "http://e", "<html>é</html>"), (8, "http://f", "same"), (8, "http://f", "same")]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("file_bytes", [1, 1 << 24])
def test_round_trip(spark, version, file_bytes):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, record string")
    rows = W.archive_pages(df, version, file_bytes=file_bytes).collect()
    assert len(rows) == len(PAGES)
    first = {}
    for i, _, html in PAGES:
        body = (html or "").encode()
        if i is not None:
            first[body] = min(first.get(body, i), i)
    by = {}
    for r in rows:
        by.setdefault(r["key"], []).append(r)
    for i, _, html in PAGES:
        body = (html or "").encode()
        r = by[i][0]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), digest(body))
        response = first.get(body) == i
        assert r["record_type"] == ("response" if response else "revisit") and r["refers_to"] == (None if response else first[body])
        assert r["payload"] == (bytearray(body) if response else None)
    assert by[3][0]["refers_to_id"] == by[1][0]["record_id"] and len({r["record_id"] for r in rows}) == len(PAGES) - 1


def test_small_payloads_are_responses(spark):
    df = spark.createDataFrame([(i, "u", "abc") for i in range(3)] + [(9, "u", "abcdef"), (10, "u", "abcdef")], "page_id long, url string, html string")
    assert {r["key"]: r["record_type"] for r in W.archive_pages(df, min_revisit_bytes=4).collect()} == {0: "response", 1: "response", 2: "response", 9: "response", 10: "revisit"}


def test_no_pages(spark):
    assert W.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_many_copies_and_all_ids(spark):
    r = random.Random(2)
    rows = [(i, f"http://h/{i}", r.choice(["hot"] * 5 + [f"p{i}"])) for i in r.sample(range(1000), 300)]
    got = {x["key"]: x["refers_to"] for x in W.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), file_bytes=20_000).collect()}
    hot = min(i for i, _, h in rows if h == "hot")
    assert got == {i: hot if h == "hot" and i != hot else None for i, _, h in rows}


def test_joins_beyond_the_bound_of_broadcasts(spark, monkeypatch):
    plain = W.join_counted
    monkeypatch.setattr(W, "join_counted", lambda *a: plain(*a, most=2))
    monkeypatch.setattr(W, "broadcast_if_small", lambda df, *_: df)
    test_many_copies_and_all_ids(spark)


def test_files_are_filled_by_bytes():
    records = [b"x" * n for n in (10, 10, 500, 10, 80, 30)]
    files = [b.column(0)[0].as_py() for b in W._filled(iter(records), b"\n", 100, b"head")]
    assert files == [b"\n".join([b"head", *records[:2]]), b"head\n" + records[2], b"\n".join([b"head", *records[3:5]]), b"head\n" + records[5]]
    assert not list(W._filled(iter([]), b"\n", 100, b"head"))


def test_arc_by_declared_lengths():
    two = W.arc_heading(2, "f.arc") + b"\n" + W.arc_record(2, "5", "http://x/a b", b"one\nhttp://fake 1 2 t 9\n") + b"\n" + W.arc_record(2, "6", "http://y", b"") + b"\n"
    got = list(W.arc_records(two))
    assert [f["url"] for f, _ in got] == ["filedesc://f.arc", "http://x/a%20b", "http://y"] and W.split_http(got[1][1])[1] == b"one\nhttp://fake 1 2 t 9\n"
    old = b"http://x/with blank 1.2.3.4 19970101 text/html 3\nabc\n"
    assert [(f["url"], f["date"], b) for f, b in W.arc_records(b"filedesc://z 0.0.0.0 1997 text/plain 5\n1 0 x\n" + old)][1] == ("http://x/with blank", "19970101", b"abc")
    with pytest.raises(ValueError):
        list(W.arc_records(b"http://x 1.2.3.4 1997 text/html 99\nabc\n"))
    with pytest.raises(ValueError):
        list(W.arc_records(b"http://x 1.2.3.4 1997 text/html many\nabc\n"))


def test_times_and_members():
    assert W.iso_time("20240102030405") == "2024-01-02T03:04:05Z" and W.iso_time("19970101") == "1997-01-01T00:00:00Z" and W.iso_time("never") == "1970-01-01T00:00:00Z"
    assert W._unpacked(gzip.compress(b"a") + gzip.compress(b"b")) == b"ab" and W._unpacked(b"plain") == b"plain"


def test_broken_warc():
    whole = W.warc_record("response", "<urn:uuid:1>", "http://x", "2024-01-01T00:00:00Z", digest(b"abc"), b"", b"abc", {})
    assert [b for _, b in W.warc_records(whole + b"\r\n\r\n" + whole)] == [b"abc", b"abc"]
    for broken in (whole[:-1], whole[: len(whole) // 2], b"nothing"):
        with pytest.raises(ValueError):
            list(W.warc_records(broken))
