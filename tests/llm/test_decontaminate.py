import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardvigil.llm import decontaminate as D
from cardvigil.llm.suffixes import suffix_array

from .conftest import OTHER, SENTENCE

ITEMS = [(1, SENTENCE.upper()), (10, OTHER + " and more words that no document has"), (2, "Odd, word"), (3, None), (4, "..."), (None, SENTENCE), (1, SENTENCE), (30, "y y y")]
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(rows, items, size=13):
    out = []
    for doc, text in rows:
        w, hit, listed = words(text), set(), set()
        for item, spelled in items:
            x = words(spelled)
            k = min(size, len(x))
            for p in range(len(x) - k + 1 if x else 0):
                for q in range(len(w) - k + 1):
                    if w[q : q + k] == x[p : p + k]:
                        hit |= {*range(q, q + k)}
                        listed.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(listed)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(listed), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 120])
def test_edge_documents(spark, edge_docs, edge_rows, rows, block_bytes):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, n_words string")
    got = D.contamination(edge_docs, items, shard=400, block_bytes=block_bytes)
    want = brute(edge_rows, ITEMS)
    assert any(c for *_, c in want)
    assert rows(got, "doc_id", *D.RESULTS) == want
    clean = D.clean(edge_docs, items)
    assert clean.columns == edge_docs.columns
    assert rows(clean, "doc_id") == sorted(((d,) for d, *_, c in want if not c), key=repr)


def longest_hit(text, items, size=13):
    """The longest run of words that holds a window, and its first place."""
    w, best = words(text), (0, 0)
    for _, spelled in items:
        x = words(spelled)
        for p in range(len(x)):
            for q in range(len(w)):
                n = 0
                while p + n < len(x) and q + n < len(w) and x[p + n] == w[q + n]:
                    n += 1
                if n and n >= min(size, len(x)) and (n > best[0] or n == best[0] and q < best[1]):
                    best = n, q
    return best


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 120])
def test_longest_match_of_each_document(spark, edge_docs, edge_rows, rows, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = rows(D.contamination(edge_docs, items, shard=400, block_bytes=block_bytes), "doc_id", "longest_words", "longest_start")
    assert got == sorted(((d, *longest_hit(t, ITEMS)) for d, t in edge_rows), key=repr)
    assert max(n for _, n, _ in got) > 13


def test_a_common_preamble_makes_no_pairs():
    """A window that all items and all documents hold is one class: as many hits as places."""
    preamble = " ".join(f"w{i}" for i in range(14))
    n = 2000
    found = D.Windows.of(D.Queries.of([(i, f"{preamble} item{i}") for i in range(n)], 13))
    assert len(found.queries.starts) == 2 + n
    texts = [f"{preamble} document{i}" for i in range(n)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "text": texts})
    tracemalloc.start()
    out = list(D._search(["doc_id", "text"], found, 0, 1 << 22)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    items = out[0].column("_bench_items")
    assert len(items) == n and set(map(len, items.to_pylist()[:5])) == {n}
    assert set(map(str, out[0].column("_bench_spans").to_pylist())) == {"[{'start': 0, 'end': 14}]"}


def test_an_input_may_have_the_operators_own_columns(spark, edge_docs, rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    odd = edge_docs.withColumns({name: F.lit("x") for name in ("_bench_spans", "_bench_items", "_bench_words", "_bench_longest", "longest_words")})
    assert rows(D.contamination(odd, items), "doc_id", *D.RESULTS) == rows(D.contamination(edge_docs, items), "doc_id", *D.RESULTS)
    assert D.clean(odd, items).columns == odd.columns


def test_no_documents_or_no_items(spark, edge_docs, no_docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert D.clean(edge_docs, items).count() == edge_docs.count()
    assert D.contamination(no_docs, items).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=12))
def test_longest_matches(text, query):
    tokens = np.array([*text, 0], dtype=np.uint64)
    order = suffix_array(tokens, len(tokens))
    assert [tokens[i:].tolist() for i in order] == sorted(tokens[i:].tolist() for i in range(len(tokens)))
    starts = np.arange(len(query))
    queries = D.Queries(np.array([*query, 0], dtype=np.uint64), starts, np.ones(len(query), dtype=np.int64), [1], starts * 0)
    length, place = D.longest(tokens, order, queries)
    for s, n, p in zip(starts, length, place):
        want = max(k for k in range(len(query) - s + 1) if k == 0 or any(text[i : i + k] == query[s : s + k] for i in range(len(text) - k + 1)))
        assert n == want
        assert not n or text[p : p + n] == query[s : s + n]


def test_longest_match_of_each_item(make_docs, spark):
    rng = random.Random(4)
    given = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(30)))) for i in (5, 3, 9, 3, None, 7, -2, 8)] + [(4, None)]
    asked = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 25)))) for i in range(12)]
    asked += [(20, given[2][1] + " zz"), (21, "nowhere found"), (22, None), (None, "a b zz c a")]
    want = []
    for item, text in asked:
        words = (text or "").split()
        best = None
        for doc, other in given:
            theirs = (other or "").split()
            for i in range(len(words)):
                for j in range(len(theirs)):
                    n = 0
                    while i + n < len(words) and j + n < len(theirs) and words[i + n] == theirs[j + n]:
                        n += 1
                    new = (-n, (doc is not None, doc), j, i)
                    if n and (best is None or new < best):
                        best = new
        if best:
            want.append(("" if item is None else str(item), -best[0], best[1][1], *best[2:]))
    items = spark.createDataFrame(asked, "item_id long, text string")
    for shard, block in ((1 << 20, 1 << 20), (40, 60)):
        got = D.longest_matches(make_docs(given), items, shard, block)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
