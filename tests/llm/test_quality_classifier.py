import zlib
from collections import Counter

import numpy as np
import pytest

from cardvigil.llm import quality_classifier as Q
from cardvigil.llm import queries

SPACES = " \t\n\x0b\x0c\r"


def spelled(text):
    """The features of a text by definition, as strings and word tuples."""
    found, word = [], ""
    words = []
    for c in text + " ":
        if c in SPACES:
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    for w in words:
        found.append(("word", w))
        edged = f"\0{w}\0"
        for n in range(Q.SHORTEST, Q.LONGEST + 1):
            found += [("gram", edged[i : i + n]) for i in range(len(edged) - n + 1)]
    found += [("pair", (a, b) if a != b else None) for a, b in zip(words, words[1:])]
    return Counter(found)


def counted(text):
    out = Counter()
    for bucket, valid, _ in Q.features([text]):
        out.update(bucket[valid].tolist())
    return out


@pytest.mark.parametrize("text", ["", " ", "a", "é", "aa aa aa b", "one two\tone\n\ntwo ünï", "💧 x", "word", "  lead and trail \r", "a b a b", "x" * 40])
def test_features_by_definition(text):
    want = spelled(text)
    got = counted(text)
    assert sum(got.values()) == sum(want.values())
    # Every feature has one bucket, wherever it stands; two features may share one.
    assert len(got) <= len(want) and len(got) >= 0.95 * len(want)
    assert sorted(got.values(), reverse=True)[:1] >= sorted(want.values(), reverse=True)[:1]


def test_a_text_has_the_same_features_beside_others(edge_rows):
    texts = [t or "" for _, t in edge_rows]
    alone = [counted(t) for t in texts]
    together = [Counter() for _ in texts]
    for bucket, valid, first in Q.features(texts):
        ends = np.append(first[1:], len(bucket))
        for i, (a, b) in enumerate(zip(first, ends)):
            together[i].update(bucket[a:b][valid[a:b]].tolist())
    assert together == alone


def test_parts_lose_only_pairs_over_a_cut():
    text = " ".join(f"w{i}" for i in range(500))
    whole, cut = counted(text), Counter()
    pieces = list(Q.parts(text, 100))
    assert "".join(pieces) == text and len(pieces) > 10
    for part in pieces:
        cut += counted(part)
    assert sum((whole - cut).values()) == len(pieces) - 1 and not cut - whole


def test_scores_are_averages_of_vectors_through_the_layer():
    random = np.random.default_rng(3)
    vectors, output = random.normal(size=(Q.BUCKETS, Q.DIMENSIONS)), random.normal(size=(2, Q.DIMENSIONS))
    texts = ["", "one two three two", "ünï 💧", "a" * 200, "x y " * 300]
    got = Q.Model.of(vectors, output).scores(texts)
    for text, score in zip(texts, got):
        times = counted(text) + Counter({0: 1})
        hidden = sum(n * vectors[b] for b, n in times.items()) / sum(times.values())
        assert abs(Q.softmax(output @ hidden)[1] - score) < 1e-5


def test_a_step_goes_down_the_gradient():
    """One step from a given place changes vectors and layer as finite differences say."""
    example = (np.array([3, 7]), np.array([1, 3]), 1)
    before, _ = Q.descend([example, (np.array([9]), np.array([1]), 0)], epochs=0)
    vectors, output = Q.descend([example, (np.array([9]), np.array([1]), 0)], epochs=1, step=1e-3)
    # The layer starts at zero, so the first step moves the layer only, by (y - p) * hidden.
    assert np.abs(output[0] + output[1]).max() < 1e-6
    moved = np.flatnonzero((vectors != before).any(axis=1))
    assert set(moved) <= {3, 7, 9}
    random = np.random.default_rng(5)
    layer, hidden = random.normal(size=(2, 4)), random.normal(size=4)
    loss = lambda w, h: -np.log(Q.softmax(w @ h)[1])
    error = Q.softmax(layer @ hidden) - np.array([0, 1])
    for i in range(4):
        h = np.eye(4)[i] * 1e-6
        assert abs((loss(layer, hidden + h) - loss(layer, hidden - h)) / 2e-6 - (error @ layer)[i]) < 1e-5


GOOD = "the river runs past the old mill and on to the harbour where boats wait for wind number"
BAD = "WIN!!! $$$ click click click ### FREE %%% now now now $$$"


@pytest.fixture(scope="module")
def known(spark):
    docs = [(i, f"{GOOD if i % 3 else BAD} {i}") for i in range(120)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(120)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_edge_documents(known, edge_docs, edge_rows):
    model = Q.train(*known)
    got = Q.classify(edge_docs, model).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((i for i, _ in edge_rows), key=repr)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    scores = {}
    text_of = {}
    for r in got:
        if r.doc_id in (4, 5):
            scores.setdefault("same", set()).add(round(r.score, 9))
        if r.doc_id in (1, 2, 3):
            scores.setdefault("none", set()).add(round(r.score, 9))
        text_of[r.doc_id] = r
    assert {k: len(v) for k, v in scores.items()} == {"same": 1, "none": 1}


def test_odd_labels_are_not_learned_from(spark, known):
    docs, labels = known
    odd = spark.createDataFrame([(None, 1, 1), (1, 7, 0), (2, None, 0), (999, 0, 0), (4, 0, 0)], labels.schema)
    more = spark.createDataFrame([(None, BAD), (5, None), (7, f"{GOOD} 7"), (7, f"{GOOD} seven")], docs.schema)
    sample = Q.training_sample(docs.unionByName(more), labels.unionByName(odd)).collect()
    learned = [i for i in range(120) if zlib.crc32(str(i).encode()) % 5]
    assert len(sample) == len(learned) and all((BAD in r.text) == (r.label == 0) for r in sample)
    few = Q.training_sample(docs, labels, 10).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in few} == {0: 10, 1: 10}


def test_nothing_to_learn_from(spark, known, no_docs, make_docs):
    docs, labels = known
    assert Q.train(docs, labels.where("quality = 1")) is None
    assert Q.train(docs, labels.limit(0)) is None
    got = Q.classify(make_docs([(1, "a"), (None, None)]), None).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.5, 1)] * 2
    assert Q.classify(no_docs, Q.train(docs, labels)).count() == 0


def test_same_model_whatever_the_partitions(known):
    docs, labels = known
    a, b = Q.train(docs, labels), Q.train(docs.repartition(7), labels.repartition(5))
    assert np.array_equal(a.weights, b.weights)


def test_held_out_accuracy(spark):
    """The registered query, on the documents it has not learned from."""
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op11_quality_classifier(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    asked = got.where("held_out").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    assert len(asked) > 50
    assert sum(r.predicted == r.quality for r in asked) >= 0.95 * len(asked)
    assert {r.predicted for r in asked if r.quality == 0} == {0} or sum(r.predicted for r in asked if r.quality == 0) <= 2
