"""Suffix-array and substring dedup against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cardvigil.llm import segments, substring_dedup, suffix_dedup

from .conftest import SENTENCE


def order_of(doc):
    return segments.NO_ID if doc is None else doc


def brute_bytes(rows):
    first = {}
    for doc, text in sorted(rows, key=lambda r: order_of(r[0])):
        data = (text or "").encode()
        for i in range(len(data) - 49):
            first.setdefault(data[i : i + 50], order_of(doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < order_of(doc):
                gone[i : i + 50] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(data) else 0
        out.append((doc, len(data), int(gone.sum()), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=repr)


def brute_words(rows):
    first, split = {}, [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for doc, words in split:
        for i in range(len(words) - 19):
            key, place = tuple(words[i : i + 20]), (order_of(doc), i)
            first[key] = min(first.get(key, place), place)
    out = []
    for doc, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            if first[tuple(words[i : i + 20])] < (order_of(doc), i):
                gone[i : i + 20] = [True] * 20
        out.append((doc, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=repr)


def got_bytes(frame):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes")
    return sorted(((*r[:4], bytes(r[4])) for r in map(tuple, frame.select(*names).collect())), key=repr)


#: One bucket for all, some buckets, and buckets so small that every bin is spread by window hashes.
LIMITS = [1 << 20, 300, 2]


@pytest.mark.parametrize("limit", LIMITS)
def test_bytes_of_edge_documents(edge_docs, edge_rows, limit):
    got = suffix_dedup.remove_repeats(edge_docs, limit)
    assert [c for c in edge_docs.columns if c not in ("text", "n_bytes")] == got.columns[:-4]
    assert got_bytes(got) == brute_bytes(edge_rows)


@pytest.mark.parametrize("limit", LIMITS)
def test_words_of_edge_documents(edge_docs, edge_rows, rows, limit):
    got = substring_dedup.remove_passages(edge_docs, limit)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_text") == brute_words(edge_rows)


def patchwork(seed, n=60):
    """Documents made of shared passages of many lengths, cut at random places, with periodic stretches."""
    rng = random.Random(seed)
    passages = [" ".join(rng.choice(("ab", "cd", "the", f"w{rng.randrange(40)}")) for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    passages += ["a b " * 40, "z" * 120, SENTENCE]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.append(rng.choice((p, p[a:], p[: a + 1], f"own{i}x{rng.randrange(99)}")))
        out.append((i, rng.choice((" ", "")).join(parts)))
    return out


@pytest.mark.parametrize("seed,limit", [(1, 1 << 20), (2, 500), (3, 40)])
def test_patchwork(make_docs, rows, seed, limit):
    given = patchwork(seed)
    docs = make_docs(given)
    assert got_bytes(suffix_dedup.remove_repeats(docs, limit)) == brute_bytes(given)
    got = substring_dedup.remove_passages(docs, limit)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_text") == brute_words(given)


def test_long_texts_in_several_steps(make_docs, monkeypatch):
    """Windows are the same whether keys are found all at once or a few at a time."""
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(400))
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    units = suffix_dedup.Bytes(np.array([0, 1000, 1000, len(data)]), data)

    def all_keys():
        found = list(segments._keys(units, suffix_dedup.BYTES))
        return np.concatenate([k for _, k, _ in found]).tolist(), np.concatenate([i for _, _, i in found]).tolist()

    whole = all_keys()
    assert sum(not x for x in whole[1]) == 49
    monkeypatch.setattr(segments, "STEP", 97)
    assert all_keys() == whole


def padded():
    return [
        (4, "own" + "-" * 3000 + "0.00, 0.0, " * 40 + "end"),
        (2, "-" * 2000 + " a b" * 200),
        (9, "x" + " a b" * 300 + "0.00, 0.0, " * 60 + SENTENCE + "-" * 60 + SENTENCE),
        (4, "-" * 70 + "y" * 200),
        (7, "y" * 900),
    ]


def test_equal_windows_of_a_document_are_sent_once():
    given = padded()
    to = segments.Plan(np.zeros(segments.BINS, dtype=np.int64), np.full(segments.BINS, 3))
    columns = [pa.array([d for d, _ in given], pa.int64()), pa.array([t for _, t in given])]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "text"])
    sent = pa.Table.from_batches(segments._sent(suffix_dedup.BYTES, to, False)(iter([batch]))).to_pylist()
    different = {t.encode()[i : i + 50] for _, t in given for i in range(len(t) - 49)}
    assert sum(r["n"] for r in sent if not r["covered"]) == len(different)


@pytest.mark.parametrize("limit", LIMITS)
def test_padding_takes_the_verdict_of_its_first_window(make_docs, limit):
    for given in (padded()[:3], padded()[2::-1]):
        assert got_bytes(suffix_dedup.remove_repeats(make_docs(given), limit)) == brute_bytes(given)


def test_no_documents(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert substring_dedup.remove_passages(no_docs).count() == 0


def test_suffixes_are_sorted_by_cover_ranks():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[1000:1400] = text[:400]
    blocks = suffix_dedup._blocks(np.concatenate([text, np.zeros(128, dtype=np.uint8)]))
    positions = np.arange(2900)
    raw = text.tobytes() + bytes(128)
    rank = suffix_dedup.ranks(blocks, positions, 7)
    by = sorted(positions.tolist(), key=lambda i: raw[i : i + 56])
    assert [raw[i : i + 56] for i in positions[np.argsort(rank, kind="stable")]] == [raw[i : i + 56] for i in by]


def test_backward_search_counts():
    rng = np.random.default_rng(4)
    tokens = np.append(rng.integers(1, 5, 500), 0)
    index = substring_dedup.FMIndex(tokens, 5, 6)
    for size in range(1, 6):
        for start in range(0, 400, 37):
            query = tokens[start : start + size]
            low, high = index.whole(query[-1:])
            for symbol in query[-2::-1]:
                low, high = index.step(np.array([symbol]), low, high)
            want = [i for i in range(501 - size) if (tokens[i : i + size] == query).all()]
            assert sorted(index.order[low[0] : high[0]].tolist()) == want


def test_merged_spans():
    blob = np.array([[5, 9], [0, 2], [2, 4], [8, 30]], dtype=np.int32).tobytes()
    starts, ends = segments.merged([blob], 20)
    assert (starts.tolist(), ends.tolist()) == ([0, 5], [4, 20])
    assert segments.merged(None, 4)[0].size == 0
