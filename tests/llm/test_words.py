import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardvigil.llm import words as W

PATTERNS = [
    (W.SPACED, r"[^\x20\x09-\x0D]+", False),
    (W.SPACED_LOWER, r"[^\x20\x09-\x0D]+", True),
    (W.LETTERS_LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True),
]
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


@pytest.mark.parametrize("alphabet,pattern,lower", PATTERNS)
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ09 \t\n-É💧|", max_size=30)), min_size=1, max_size=8))
def test_words_are_the_pattern_matches(alphabet, pattern, lower, texts):
    data, offsets = W.texts(pa.array(texts, pa.string()))
    found = W.words(data, offsets, alphabet)
    got = [
        [found.read[a:b].tobytes().decode() for a, b in zip(found.starts[x:y], found.ends[x:y])]
        for x, y in zip(found.first[:-1], found.first[1:])
    ]
    assert got == [re.findall(pattern, (t or "").translate(UPPER) if lower else t or "") for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    texts = ["one two three", "three  two", "x" * (W.BLOCK + 10) + " two", None, "two"]
    data, offsets = W.texts(pa.array(texts))
    found = W.words(data, offsets, W.SPACED)
    hashes = dict()
    for a, b, h in zip(found.starts, found.ends, found.hashes()):
        assert hashes.setdefault(found.read[a:b].tobytes(), h) == h
    assert len(set(hashes.values())) == len(hashes) == 4


@pytest.mark.parametrize("letters", [32, 64, 128, 256, 512, 1024, 2048, 4096])
def test_words_made_to_collide_do_not(letters):
    """The Thue-Morse word and its complement are equal modulo 2**64 in every base, if long enough."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(letters))
    other = word.translate(str.maketrans("ab", "ba"))
    found = W.words(*W.texts(pa.array([f"{word} {other} {word}"])), W.SPACED).hashes().tolist()
    assert found[0] == found[2] != found[1]


def test_pieces_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "", "b" * 50, "c"], "n": list(range(5))})
    for limit in (1, 11, 1000):
        parts = list(W.pieces([batch], "text", limit))
        assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(5))


def test_windows_depend_on_their_words_only():
    hashes = np.array([1, 2, 3, 1, 2, 3], dtype=np.uint64)
    found = W.windows(hashes, 3)
    assert len(found) == 4 and found[0] == found[3] and len(set(found.tolist())) == 3
    assert len(W.windows(hashes, 7)) == 0
