import re
from fractions import Fraction
from itertools import permutations

import pytest

from cardvigil.llm import filter_audit as A

GOOD = " ".join(f"w{i}" for i in range(120))


def failures(docs):
    """(part, failed filters) of each row, by definition."""
    out = []
    for doc, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = ""
        if len(words) < 100:
            failed += "A"
        if 100 * len(set(words)) < 80 * len(words):
            failed += "B"
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            failed += "C"
        if any(c in "#$%&*|" for c in text):
            failed += "D"
        if doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in docs):
            failed += "E"
        out.append((part or "", failed))
    return out


def brute(docs, labels):
    """Every order run over every row."""
    found = failures(docs)
    marks = {}
    for doc, quality, toxic in labels:
        if doc is not None:
            good, bad = marks.get(doc, (False, False))
            marks[doc] = (good or quality == 1, bad or toxic == 1)
    own = [(part, failed, *marks.get(doc, (False, False))) for (part, failed), (doc, _, _) in zip(found, docs)]
    out = []
    for part in sorted({p for p, _ in found}):
        rows = [r[1:] for r in own if r[0] == part]
        removals, told = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                here = [r for r in left if name in r[0]]
                left = [r for r in left if name not in r[0]]
                removals[name] += len(here)
                told.append(
                    (
                        part, "".join(order), step, name, len(left), len(here), sum(name in f for f, _, _ in rows) - len(here),
                        sum(f == name for f, _, _ in rows), sum(g for _, g, _ in here), sum(t for _, _, t in here),
                    )
                )
        out += [(*r, removals[r[3]]) for r in told]
    return sorted(out, key=repr)


def given():
    texts = [
        GOOD, GOOD, GOOD.upper(), GOOD + " #", "short", "", None, " \t\n", "a " * 150, ("A " * 150).strip(), GOOD.upper() + " $ |",
        "SHORT & LOUD", GOOD + " É" * 5, "💧 " * 99, "💧" + " x" * 99, GOOD, "short", "A" * 10 + "b" * 90, "A" * 11 + "b" * 90,
    ]
    langs = ["en", "de", None, "", "en"]
    docs = [(i, t, langs[i % 5]) for i, t in enumerate(texts)]
    docs += [(None, GOOD, "en"), (None, None, "de"), (3, GOOD + " #", "en"), (3, "twice", "de"), (-5, "A" * 10 + "b" * 90, "fr"), (-6, "short", "en")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(12)] + [(0, 0, 1), (3, 0, 0), (None, 1, 1), (500, 1, 1), (4, None, None)]
    return docs, labels


@pytest.fixture
def frames(spark):
    def make(docs, labels):
        odd = "doc_id long, text string, lang string, part int, hash string, pattern string, words int, good string"
        return (
            spark.createDataFrame([(*d, 1, "x", "x", 2, "x") for d in docs], odd).repartition(3),
            spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, part string"),
        )

    return make


def test_every_order_over_edge_rows(frames, rows):
    docs, labels = given()
    got = rows(A.audit(*frames(docs, labels)), *A.COLUMNS)
    assert got == brute(docs, labels)
    assert len(got) == 600 * 4


def test_edge_documents(edge_docs, edge_rows, spark, rows):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = rows(A.audit(edge_docs, labels), *A.COLUMNS)
    assert got == brute([(i, t, "en") for i, t in edge_rows], [])


def test_no_documents(no_docs, frames):
    assert A.audit(no_docs, frames(*given())[1]).collect() == []


def test_least_squares_give_mean_removals():
    """Against the mean over all orders, for games that are not additive."""
    for n in range(1, 6):
        game = [0, *((37 * s * s + 11 * s) % 101 for s in range(1, 1 << n))]
        want = [Fraction(0)] * n
        orders = list(permutations(range(n)))
        for order in orders:
            before = 0
            for i in order:
                want[i] += Fraction(game[before | 1 << i] - game[before], len(orders))
                before |= 1 << i
        assert A.shapley(game, n) == want


def test_a_text_of_all_rows_is_no_hot_key(frames):
    """Rows look for the pair of their text's hash and their own id, so no key of a join is shared."""
    docs = [(i, GOOD, "en") for i in range(500)]
    counted = A.patterns(*frames(docs, []))
    assert sorted((r.pattern, r.n) for r in counted.collect()) == [(0, 1), (16, 499)]
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "is_first" in plan
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("doc_id" in line for line in joins)
