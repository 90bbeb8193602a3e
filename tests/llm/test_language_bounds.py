import base64
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from jobsieve.llm import language as L
from jobsieve.llm import words

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def totals(word, pieces):
    """Total probability of the pieces of the whole file over all segmentations of a word."""
    sums = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        sums[end] = math.fsum(sums[start] * pieces.get(word[start:end], 0.0) for start in range(end))
    return sums[-1]


@pytest.fixture(scope="module")
def voc():
    return L.vocabulary(PATH)


def test_all_pieces_that_words_can_have_are_admitted(voc):
    with open(PATH, "rb") as file:
        raw = {base64.b64decode(x.split()[0]) for x in file if x.strip()}
    assert set(voc.pieces) == {p for p in raw if not p[1:].count(b" ")}
    assert {b" international", b" relationship", b" organization"} <= set(voc.pieces)


TEXTS = [" international", " organizationrelationshipinternational", " " + "日本語の文章" * 6, " " + "-" * 70, " https://example.org/representatives/a_b-c?x=internationalorganization", " short"]


def test_long_words_and_pieces_are_summed_exactly(voc):
    r = np.random.default_rng(5)
    probs = r.random((voc.size + 1, 2)) * 0.05
    probs[-1] = 0
    chunk = next(words.chunks(pa.array(TEXTS), words.SPACED))
    got = L._scores(chunk, voc, probs)
    for lang in range(2):
        pieces = dict(zip(voc.pieces, probs[:, lang]))
        for text, own in zip(TEXTS, got[:, lang]):
            assert own == pytest.approx(math.log(totals(text.encode(), pieces)), rel=1e-9)


def test_expected_counts_of_long_words_cover_them(voc):
    p = np.append(np.full(voc.size, 1 / voc.size), 0.0)
    chunk = next(words.chunks(pa.array(TEXTS), words.SPACED))
    lengths = np.array([len(x) for x in voc.pieces])
    for letters, sizes, rows in L.longer(chunk):
        counts = L.expected_counts_long(voc, letters, sizes, np.full(len(rows), 2.0), p)
        assert (counts[:-1] * lengths).sum() == pytest.approx(2 * sizes.sum())
    letters = np.frombuffer(b" internationally", np.uint8)[None, :]
    assert L.expected_counts_long(voc, letters, np.array([16]), np.ones(1), p) == pytest.approx(L.expected_counts(voc, letters, np.ones(1), p))
