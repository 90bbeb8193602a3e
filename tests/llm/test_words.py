import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsieve.llm import words

SPACED, ALNUM = re.compile(rb"[^\x20\x09-\x0D]+"), re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def found(texts, table, **how):
    out = []
    for c in words.chunks(pa.array(texts, pa.string()), table, **how):
        for i in range(c.hi - c.lo):
            own = slice(c.at[i], c.at[i + 1])
            out.append(([c.buf[s:e].tobytes() for s, e in zip(c.starts[own], c.ends[own])], c.h[own].tolist()))
    return out


texts = st.lists(st.none() | st.text(alphabet=st.sampled_from("aAbZ é \n\t.-19"), max_size=40), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts, st.sampled_from([4, 16, 1 << 20]))
def test_words_are_those_of_the_pattern(some, span):
    for table, pattern in ((words.SPACED, SPACED), (words.ALNUM, ALNUM)):
        got = found(some, table, span=span)
        assert [w for w, _ in got] == [pattern.findall((t or "").encode()) for t in some]
        by = {}
        for own, hashes in got:
            for w, h in zip(own, hashes):
                assert by.setdefault(w.lower(), h) == h
        assert len(set(by.values())) == len(by)


def test_sliced_columns_and_long_words():
    column = pa.array(["x y", None, "a b c", "d" * 300 + " e"]).slice(1, 3)
    got = [c for c in words.chunks(column, words.SPACED, span=8)]
    assert [len(c.h) for c in got] and sum(len(c.h) for c in got) == 5


def test_shingles():
    c = next(words.chunks(pa.array(["a b c d e f a b c d e", "a b c", "", "a b c d e"]), words.SPACED))
    sets = list(words.shingle_sets(c))
    assert [len(s) for s in sets] == [6, 1, 0, 1] and np.isin(sets[3], sets[0]).all() and not np.isin(sets[1], sets[0]).any()
