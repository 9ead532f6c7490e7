import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cardvigil.llm import ranked_search as R
from cardvigil.llm.words import LETTERS_LOWER, texts, words

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return [t.translate(UPPER) for t in re.findall(R.TERM, text or "")]


def brute(docs, queries, top=R.TOP):
    counts = [(doc, Counter(terms(text))) for doc, text in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for (doc, c), size in zip(counts, sizes):
            if size:
                m = 100 - 50 + (50 * size * n) // total
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
                if score > 0:
                    found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


def hashed(found):
    return words(*texts(pa.array(found)), LETTERS_LOWER).hashes()


@pytest.fixture
def ask(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 5, "x") for r in rows], "item_id long, text string, score int, rank string")

    return make


QUERIES = [
    (1, "The QUICK brown fox; boats, and their owners"),
    (2, "the"),
    (3, "Ünïcödé 💧 été"),
    (4, ""),
    (5, None),
    (6, "nowhere found: zzyzx"),
    (1, "geese GEESE word"),
    (None, "lazy dog"),
    (7, " ".join(f"long{i}" for i in range(300))),
    (8, "y x"),
]


def test_edge_documents(edge_docs, edge_rows, ask, rows):
    got = rows(R.search(edge_docs, ask(QUERIES)), "item_id", "rank", "doc_id", "score")
    assert got == brute(edge_rows, QUERIES)
    assert {r[0] for r in got} == {1, 2, 3, None, 7, 8}


@pytest.mark.parametrize("top,first", [(1, 1), (3, 2), (5, 40)])
def test_short_lists_and_few_first_candidates(edge_docs, edge_rows, ask, rows, top, first):
    got = rows(R.search(edge_docs, ask(QUERIES), top, first), "item_id", "rank", "doc_id", "score")
    assert got == brute(edge_rows, QUERIES, top)


def test_queries_in_blocks(edge_docs, edge_rows, ask, rows):
    assert len(list(R.blocks(ask(QUERIES), 20))) > 1
    got = rows(R.search(edge_docs, ask(QUERIES), at_most=20), "item_id", "rank", "doc_id", "score")
    assert got == brute(edge_rows, QUERIES)


def test_many_copies_and_ties(make_docs, ask, rows):
    random = np.random.default_rng(1)
    vocabulary = [f"t{i}" for i in range(60)]
    given = [(i, " ".join(random.choice(vocabulary, 12))) for i in range(300)]
    given += [(1000 + i, "t1 t2 t3 t3") for i in range(400)] + [(2000 + i, f"t1 t2 t3 t3 own{i}") for i in range(200)]
    asked = [(1, "t1 t3"), (2, "t2 t59 own7"), (3, "t5 t6 t7 t8 t9")]
    got = rows(R.search(make_docs(given), ask(asked)), "item_id", "rank", "doc_id", "score")
    assert got == brute(given, asked)


def test_copies_that_only_seem_to_match_hide_nothing(make_docs, ask, rows, monkeypatch):
    """With far too few cells most bounds are wrong: many copies of texts without a match come first."""
    monkeypatch.setattr(R, "CELLS", 1)
    monkeypatch.setattr(R, "LEAST_CELLS", 2)
    given = [(i, " ".join(f"x{i % 3}{k}" for k in range(9)) + " x" * 90) for i in range(400)] + [(1000 + i, f"rare word number{i}") for i in range(70)]
    asked = [(1, "rare"), (2, "rare word number5 number6"), (3, "absent")]
    got = rows(R.search(make_docs(given), ask(asked), 50, 2), "item_id", "rank", "doc_id", "score")
    assert got == brute(given, asked)


def test_no_documents_or_no_queries(no_docs, edge_docs, make_docs, ask):
    assert R.search(no_docs, ask(QUERIES)).collect() == []
    assert R.search(make_docs([(1, None), (2, " ! ")]), ask(QUERIES)).collect() == []
    assert R.search(edge_docs, ask([])).collect() == []
    assert R.search(edge_docs, ask([(1, None), (2, "?")])).collect() == []


def test_a_sketch_bounds_every_term_from_above():
    random = np.random.default_rng(2)
    tokens = [f"w{i}" for i in random.zipf(1.3, 3000) % 900] + ["many"] * 700
    found = hashed(tokens)
    cells = R.sketch(found)
    counts = Counter(tokens)
    known = hashed(list(counts))
    least = cells[R.probes(known, len(cells))].min(axis=1)
    times = np.array(list(counts.values()))
    assert (least >= np.minimum(times, R.MOST)).all()
    assert (least == np.minimum(times, R.MOST)).mean() > 0.98
    absent = hashed([f"absent{i}" for i in range(20_000)])
    assert (cells[R.probes(absent, len(cells))].min(axis=1) > 0).mean() < 0.02
    assert len(cells) >= R.CELLS * len(counts)


def test_bounds_are_no_less_than_scores():
    random = np.random.default_rng(4)
    vocabulary = [f"v{i}" for i in range(400)]
    docs = [list(random.choice(vocabulary, 30)) for _ in range(200)] + [["v1"] * 300 + ["v2"]]
    pairs = [(q, str(t)) for q in range(20) for t in set(random.choice(vocabulary, 15))] + [(3, "v1"), (3, "none")]
    block = R.Block.of(sorted(set(pairs)), 20)
    df = Counter(t for d in docs for t in set(d))
    total = sum(map(len, docs))
    block = block.weighted({i: df[t.decode()] for i, t in enumerate(block.terms)}, len(docs), total)
    exact = equal = 0
    for doc in docs:
        cells = R.sketch(hashed(doc))
        bounds = block.bounds(cells[None, :], np.array([len(doc)]))[0]
        scores = block.scores(" ".join(doc), list(range(20)))
        for q in range(20):
            assert bounds[q] >= scores.get(q, 0)
            exact += 1
            equal += bounds[q] == scores.get(q, 0)
    assert equal > 0.9 * exact
