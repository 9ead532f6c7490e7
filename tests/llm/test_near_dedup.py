import itertools
import random
import re

import pytest

from cardvigil.llm import near_dedup
from cardvigil.llm.components import components

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Components of documents with different ids; equal ids here have equal texts."""
    sets = {d: shingle_set(t) for d, t in rows if d is not None}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sets, {d: find(d) for d in sets}


def test_edge_documents(edge_docs, edge_rows, rows):
    sets, found = brute(edge_rows)
    got = rows(near_dedup.near_duplicates(edge_docs), "doc_id", "n_shingles", "component_id", "kept")
    want = [(d, len(sets[d]), found[d], found[d] == d) for d, _ in edge_rows if d is not None]
    # Rows without an id belong to their text's class, or to none.
    want += [(None, len(shingle_set(edge_rows[3][1])), 4, False), (None, 0, None, True)]
    assert got == sorted(want, key=repr)
    kept = near_dedup.without_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert rows(kept, "doc_id") == sorted(((d,) for d, _, _, k in want if k), key=repr)


def mutated(base, rng, changes):
    words = list(base)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 7])
def test_groups_of_mutated_copies(make_docs, rows, monkeypatch, block):
    """Similarities on both sides of the threshold, so that buckets hold several components."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(100)]
    given = [(i, mutated(base, rng, rng.randrange(9))) for i in range(80)]
    given += [(100 + i, " ".join(f"u{i}x{k}" for k in range(30))) for i in range(5)]
    sets, found = brute(given)
    assert len(set(found.values())) > 7
    got = rows(near_dedup.near_duplicates(make_docs(given)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(((d, len(sets[d]), found[d], found[d] == d) for d, _ in given), key=repr)


def test_no_documents(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0
    assert near_dedup.without_near_duplicates(no_docs).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    links = [*chain, *star, (7, 7), (None, 3), (12, 11), (200, 201), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
