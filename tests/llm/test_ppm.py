import zlib
from collections import Counter
from math import log2

import numpy as np
import pyarrow as pa

from cardvigil.llm import ppm
from cardvigil.llm.words import texts

TRAINING = {"a": [b"banana bandana", b"an ananas"], "b": [b"b\xc3\xa9b\xc3\xa9 b", b"cc"]}


def model():
    rows = []
    for lang, given in TRAINING.items():
        seen = Counter((k, text[i - k : i], text[i]) for text in given for i in range(len(text)) for k in range(min(i, ppm.ORDER) + 1))
        for (k, context, byte), n in seen.items():
            rows.append((lang, k, int.from_bytes(context, "big") << 8 | byte, n))
    return ppm.Model.of(rows)


def slow_bits(lang, text):
    """The code length by definition, byte by byte."""
    seen, known = Counter(), set()
    for other, given in TRAINING.items():
        for t in given:
            for i in range(len(t)):
                for k in range(min(i, ppm.ORDER) + 1):
                    known.add(t[i - k : i])
                    if other == lang:
                        seen[t[i - k : i], t[i]] += 1
    bits = 0.0
    for i, byte in enumerate(text):
        longest = next(k for k in reversed(range(min(i, ppm.ORDER) + 1)) if all(text[i - j : i] in known for j in range(k + 1)))
        for k in reversed(range(longest + 1)):
            counts = {b: n for (c, b), n in seen.items() if c == text[i - k : i]}
            total, kinds = sum(counts.values()), len(counts)
            if byte in counts:
                bits -= log2(counts[byte] / (total + kinds))
                break
            if total:
                bits -= log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(monkeypatch):
    given = ["banana", "", "bébé cc \x00", None, "nanbéc" * 5]
    want = [[slow_bits(lang, (t or "").encode()) for lang in ("a", "b")] for t in given]
    for block in (3, 7, 1 << 18):
        monkeypatch.setattr(ppm, "BLOCK", block)
        got = model().code_lengths(*texts(pa.array(given)))
        assert np.allclose(got, want, rtol=1e-5)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = ppm.identify(docs, ppm.train(docs)).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    apart = [r for r in got if r.held_out]
    assert len(got) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in apart) >= 0.98 * len(apart)
    assert all(0 <= r.score <= 1 for r in got)


def test_training_ignores_held_out_rows_and_is_bounded(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sample = ppm.training_sample(docs, per_language=3).collect()
    assert max(Counter(r.lang for r in sample).values()) <= 3
    apart = {r.text for r in docs.where(ppm.held_out(docs.doc_id)).collect()}
    assert not apart & {r.text for r in ppm.training_sample(docs).collect()} - {r.text for r in docs.where(~ppm.held_out(docs.doc_id)).collect()}


def test_edge_documents(edge_docs, edge_rows, no_docs, rows):
    got = rows(ppm.identify(edge_docs, ppm.train(edge_docs)), "doc_id", "lang_pred")
    want = [(d, "en" if any(c.isalpha() for c in t or "") else "und") for d, t in edge_rows]
    assert got == sorted(want, key=repr)
    assert ppm.identify(edge_docs, None).where("lang_pred = 'und' and score = 0").count() == len(edge_rows)
    assert ppm.train(no_docs) is None and ppm.identify(no_docs, model()).count() == 0


def test_every_language_is_learned_however_many(spark):
    names = [f"{a}{b}" for a in "abcdefghijklmno" for b in "abcdefghijklmno"]
    rows = [(100 * i + k, " ".join([f"{name}q{name}"] * 12), name) for i, name in enumerate(names) for k in range(5 if i < 200 else 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {r.lang for r in ppm.training_sample(docs).select("lang").distinct().collect()}
    assert len(learned) > 200 and learned == {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    wrong = [(r.lang_pred, lang) for r, (_, _, lang) in zip(sorted(ppm.identify(docs, ppm.train(docs)).collect()), rows, strict=True) if r.lang_pred != lang]
    assert not [x for x in wrong if x[1] in learned]


def test_trees_hold_all_that_their_language_has(spark):
    # Next to a language with many long texts one with a single short text.
    words = " ".join(f"{a}{b}{c}" for a in "abcdefghijklmno" for b in "aeiou" for c in "pqrstuvwxyz")
    docs = spark.createDataFrame([*((i, words, "big") for i in range(40)), (1000, "zebu yak", "small")], "doc_id long, text string, lang string")
    assert not docs.where((docs.doc_id == 1000) & ppm.held_out(docs.doc_id)).count()
    model = ppm.train(docs)
    seen = {(k, b"zebu yak"[i - k : i + 1]) for i in range(8) for k in range(min(i, ppm.ORDER) + 1)}
    tree = model.trees[model.langs.index("small")]
    assert tree.grams.tolist() == sorted(k << 40 | int.from_bytes(gram, "big") for k, gram in seen)
