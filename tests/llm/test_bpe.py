import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardvigil.llm import bpe

PATH = public_tokenizers.path(bpe.RANKS)


def own():
    return bpe.codec(PATH, public_tokenizers.PATTERN)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1 '\n\t  \x1c\x85.é💧s", max_size=60), st.integers(1, 9))
def test_parts_encode_like_the_whole(text, size):
    parts = list(bpe.parts(text, size))
    assert "".join(parts) == text
    ids = [i for part in parts for i in own().encode_ordinary(part)]
    assert ids == own().encode_ordinary(text)


def cutting():
    return bpe.Codec.of(PATH, public_tokenizers.PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.' \n\t\r\x0b\x1c\x85\xa0\u3000é", max_size=40), st.integers(2, 6))
def test_cut_out_runs_encode_like_the_whole(text, run):
    ids = [i for part in cutting().ids(text, run) for i in part]
    assert ids == own().encode_ordinary(text)


LONG = 1_000_000


@pytest.mark.parametrize("unit,n", [(" ", LONG), (" ", 5 * LONG), ("\n", LONG), ("\n", 5 * LONG), (" \n\t", LONG // 3), ("\u3000\x85", LONG // 2), ("\r\n", LONG)])
@pytest.mark.parametrize("before,after", [("", ""), ("", "b c"), ("a", "b c"), ("a ", ".b"), ("a", "")])
def test_long_white_space(unit, n, before, after):
    """The library alone gives up on these; by the pattern a run is one match but its last character."""
    run = unit * n
    got = [i for part in cutting().ids(before + run + after) for i in part]
    alone = before.rstrip()
    run = before[len(alone):] + run
    first, last = (run[:-1], run[-1]) if after else (run, "")
    whole = bpe.codec(PATH, "(?s:.+)")
    assert got == own().encode_ordinary(alone) + whole.encode_ordinary(first) + own().encode_ordinary(last + after)


def test_long_white_space_in_a_table(make_docs, rows):
    texts = [" " * LONG, "a" + "\n" * LONG + "b", "\t " * LONG]
    got = bpe.decode(bpe.encode(make_docs(list(enumerate(texts))))).select("doc_id", "n_tokens", "decoded").collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in got} == dict(enumerate(texts))
    assert all(r.n_tokens > 1000 for r in got)


def test_edge_documents(edge_docs, edge_rows, rows):
    encoded = bpe.encode(edge_docs)
    assert [c for c in edge_docs.columns if c != "text"] + ["n_tokens", "ids"] == encoded.columns
    got = rows(bpe.decode(encoded), "doc_id", "n_tokens", "ids", "decoded")
    want = []
    for doc, text in edge_rows:
        ids = own().encode_ordinary(text or "")
        want.append((doc, len(ids), bytearray(np.array(ids, dtype="<u4").tobytes()), bytearray((text or "").encode())))
    assert [(a, b, bytes(c), bytes(d)) for a, b, c, d in got] == [(a, b, bytes(c), bytes(d)) for a, b, c, d in sorted(want, key=repr)]


def test_decoding_is_by_raw_bytes(spark, rows):
    ids = own().encode_ordinary("💧💧")
    half = np.array(ids[:1], dtype="<u4").tobytes()
    got = bpe.decode(spark.createDataFrame([(1, bytearray(half)), (2, None)], "doc_id long, ids binary")).collect()
    found = {r.doc_id: r.decoded for r in got}
    assert bytes(found[1]) == own().decode_bytes(ids[:1]) and found[2] is None


def test_no_documents(no_docs):
    assert bpe.decode(bpe.encode(no_docs)).count() == 0
