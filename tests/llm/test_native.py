"""Line dedup and quality rules, against plain Python."""

import re

from pyspark.sql import functions as F

from cardvigil.llm import line_dedup, quality_rules

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute_lines(rows):
    ids = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
            if len(key) >= 20:
                ids.setdefault(key, set()).add(doc)
    out = []
    for doc, text in rows:
        lines, left = (text or "").split("\n"), []
        for line in lines:
            holders = ids.get(line.strip(" \t\n\x0b\x0c\r").translate(UPPER), set())
            last = max((d for d in holders if d is not None), default=None)
            if len(holders) < 3 or doc == last:
                left.append(line)
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def test_lines_of_edge_documents(edge_docs, edge_rows, rows):
    got = line_dedup.drop_shared_lines(edge_docs)
    assert got.columns == edge_docs.columns
    want = brute_lines(edge_rows)
    assert any(dropped for _, _, dropped, _ in want)
    assert rows(got, "doc_id", "n_lines", "n_dropped", "text") == want


def test_bitmaps_reach_past_their_first_words(make_docs, rows):
    shared = "a line that is long enough to count"
    filler = [f"{i}" for i in range(200)]
    given = [(1, "\n".join([*filler, shared, *filler, shared])), (2, shared), (3, "\n".join([shared] * 130 + ["own"]))]
    got = rows(line_dedup.drop_shared_lines(make_docs(given)), "doc_id", "n_lines", "n_dropped", "text")
    assert got == brute_lines(given)
    assert line_dedup.keep_bitmaps(make_docs(given)).count() == 2


def test_no_lines(no_docs):
    assert line_dedup.drop_shared_lines(no_docs).count() == 0


def test_a_hot_key_is_spread_over_ranges(spark, make_docs, rows):
    given = [(i, f"{'the same line in all of them'}\n{i}") for i in range(300)]
    assert rows(line_dedup.drop_shared_lines(make_docs(given)), "doc_id", "n_lines", "n_dropped", "text") == brute_lines(given)
    hashed = line_dedup._hashed_lines(make_docs(given), 20)
    firsts = line_dedup.first_occurrences(hashed, 3)
    plan = firsts._jdf.queryExecution().toString()
    assert "rangepartitioning(h1" in plan and "slice" in plan
    shared = line_dedup.shared_keys(firsts, 3)
    slices = {r.slice for r in hashed.collect()}
    assert {r.slice for r in shared.collect()} == slices and len(slices) > 200
    assert hashed.join(shared, ["h1", "h2", "slice"]).groupBy("h1", "h2", "slice").count().agg(F.max("count")).first()[0] < 10


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(windows) < 3000 else set()
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_of_edge_documents(edge_docs, edge_rows, rows):
    got = rows(quality_rules.cascade(edge_docs), "doc_id", *quality_rules.MEASURES)
    assert got == sorted(((d, *brute_measures(t)) for d, t in edge_rows), key=repr)


def test_verdicts_do_not_depend_on_order_or_sample(spark, sf_dir, edge_docs, rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    once = rows(quality_rules.cascade(docs), "doc_id", "kept")
    turned = quality_rules.cascade(docs, quality_rules.RULES[::-1], rows=5)
    assert rows(turned, "doc_id", "kept") == once
    judged = {r.doc_id: r for r in quality_rules.cascade(docs).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert all(judged[x.doc_id].kept or judged[x.doc_id].base_failed for x in labels if x.quality == 1)
    assert not any(judged[x.doc_id].kept for x in labels if x.quality == 0)


def test_accepted_documents_are_those_the_cascade_keeps(spark, sf_dir, edge_docs, rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = edge_docs.withColumnsRenamed({"key": "_quality_text", "bucket": "_quality_failed", "node": "_Quality_words"})
    for frame in (docs, edge_docs, odd):
        got = quality_rules.accepted(frame, rows=50)
        assert got.dtypes == frame.dtypes
        assert rows(got, "doc_id", "text") == rows(quality_rules.cascade(frame).where("kept"), "doc_id", "text")


def test_a_cheap_rule_costs_less_than_a_dear_one(spark, sf_dir):
    """Comparing two counts is nothing beside a pattern over the whole text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = (quality_rules.Rule("nothing", lambda m: m["n_words"] < 0), quality_rules.RULES[-1])
    cheap, dear = (e.seconds for e in quality_rules.estimate(docs, rules))
    assert cheap < dear


def test_rules_are_asked_by_rejections_per_second():
    by = [quality_rules.Estimate(r, s, p) for r, s, p in zip(quality_rules.RULES, (1, 2, 0.5), (0.5, 0.1, 0.4))]
    assert [e.rule.name for e in sorted(by, key=lambda e: -e.worth)] == ["word_length", "symbols", "repeated_lines"]


def test_empty_table(no_docs):
    assert quality_rules.cascade(no_docs).count() == 0
    assert quality_rules.accepted(no_docs).count() == 0


def test_native_operators_use_no_python(edge_docs):
    for frame in (line_dedup.drop_shared_lines(edge_docs), quality_rules.cascade(edge_docs), quality_rules.accepted(edge_docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
