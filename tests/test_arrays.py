"""JSON arrays of every shape, in files that are cut anywhere."""

from __future__ import annotations

import json
import os
import random
from contextlib import contextmanager

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardvigil.sources import arrays
from cardvigil.sources.raw import read_json


@contextmanager
def small_splits(spark, size):
    """Files are cut into splits of a few bytes."""
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def write(folder, texts):
    os.makedirs(folder, exist_ok=True)
    for i, text in enumerate(texts):
        with open(f"{folder}/{i:03}.json", "w") as f:
            f.write(text)
    return folder


def found(spark, path):
    return sorted(r[0] for r in arrays.elements(spark, path).collect())


FLAT = [{"id": i, "name": f"n{i}", "amount": i / 4, "note": None} for i in range(50)]
ODD = [{"id": 1, "name": "a}b"}, {"id": 2, "name": 'quote " and { and \\ }'}, {"id": 3, "inner": {"list": [1, {"x": "]"}, []]}}, {"id": 4}]


@pytest.mark.parametrize("size", [64, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_elements_of_arrays(spark, folder, size, indent):
    many = [{"id": i, "text": random.Random(i).choice(["plain", "a}b", "{", '"', "\\", "\\\"}", "é💧"])} for i in range(200)]
    lists = [FLAT, ODD, many, [], [{}], [{"id": 9}]]
    path = write(folder("in"), [json.dumps(x, indent=indent, ensure_ascii=bool(i % 2)) for i, x in enumerate(lists)])
    with small_splits(spark, size):
        got = [json.loads(x) for x in found(spark, path)]
    want = [x for part in lists for x in part]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))


def test_flat_files_need_no_order_and_odd_ones_are_told(spark, folder):
    texts = [json.dumps(FLAT), json.dumps(ODD), json.dumps(FLAT, indent=1), json.dumps(FLAT)[:-5], json.dumps([{"a": [1]}]), json.dumps(FLAT[0])]
    path = write(folder("in"), texts)
    with small_splits(spark, 100):
        odd = arrays.odd_files(arrays.pieces(spark, path)).collect()
    assert sorted((r["file"][-8:], r["is_cut"]) for r in odd) == [("001.json", False), ("003.json", False), ("004.json", False)]


def test_no_row_holds_more_than_an_element(spark, folder):
    path = write(folder("in"), [json.dumps(FLAT * 200)])
    longest = arrays.pieces(spark, path).selectExpr("max(length(value))").first()[0]
    assert longest <= max(len(json.dumps(x)) for x in FLAT) + 3
    with small_splits(spark, 20_000):
        assert arrays.pieces(spark, path).rdd.getNumPartitions() > 10
        assert len(found(spark, path)) == 10_000


def test_what_is_no_array_or_is_cut_short(spark, folder):
    whole = json.dumps(ODD[1])
    texts = ["", " \n", "[]", "no json at all", "[1, \"x, y\", null, {\"id\": 5}]", whole, f"{whole}\n{whole}", '[{"id": 6}, {"id": 7', '[{"id": 8},', "{\"id\": \"}"]
    got = found(spark, write(folder("in"), texts))
    want = ["no json at all", "1", '"x, y"', "null", '{"id": 5}', whole, whole, whole, '{"id": 6}', '{"id": 7', '{"id": 8}', '{"id": "}']
    assert got == sorted(want)


def test_a_broken_element_costs_only_itself(spark, folder):
    text = '[{"transaction_id": "a", "card_id": "c"}, {"transaction_id": "b", "card_id": }, {"transaction_id": "d", "card_id": "{}"}]'
    rows = read_json(spark, write(folder("in"), [text])).collect()
    assert sorted((r["transaction_id"] or "", bool(r["_corrupt_record"])) for r in rows) == [("", True), ("a", False), ("d", False)]


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text('ab"\\{}[], \n', max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text('a"}', max_size=3), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=300, deadline=None)
@given(st.lists(VALUES, max_size=5), st.sampled_from([None, 1]), st.integers(1, 7))
def test_the_reader_of_odd_files(values, indent, size):
    """Fed in pieces that end behind braces, as files are cut, or anywhere outside an escape."""
    text = json.dumps(values, indent=indent)
    for cuts in ([p + "}" for p in text.split("}")[:-1]] + [text.split("}")[-1]],):
        reader = arrays.Elements()
        got = [x for piece in cuts for x in reader.feed(piece)] + list(reader.rest())
        assert [json.loads(x) for x in got] == values
