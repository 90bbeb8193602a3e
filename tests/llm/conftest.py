import random

import pytest

WORDS = "the of and to in is that for it was on be with as by at from this have not are but had his they you we all one".split()
DE = "der die und den von das mit des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie".split()


def prose(seed, n, pool=WORDS):
    r = random.Random(seed)
    return " ".join(r.choice(pool) + r.choice(["", "", "", "er", "ing", "est"]) for _ in range(n))


#: Null, empty, blank, without letters, one word, a letter outside ASCII, separators that aren't ASCII white space.
ODD = [None, "", " \n\t ", "12 34 !!", "word", "ß", "a b c d", "퟿\u0000x", "A" * 5000, "a b c d", "A B\tC  d"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, a repeated row, a null id, and columns whose names operators might use themselves."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, prose(1, 60)), (100, prose(1, 60)), (None, prose(2, 60)), (101, prose(3, 30_000))]
    rows = [(i, t, "en", "s", 1, 2, 3, "x", 5, "y") for i, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node long, component long, hash string, score long, found string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
