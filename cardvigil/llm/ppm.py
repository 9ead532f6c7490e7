"""Language identification by prediction by partial matching over bytes.

For each language the training texts give counts of bytes after contexts of up to four
bytes. A byte costs what its frequency says in the longest known context, an escape to
the next shorter one where it was never seen there (escape probability: distinct bytes
over distinct bytes plus occurrences), and eight bits after the last escape. Statistics
are frozen: a text's code length in a language is the sum over all its bytes, and the
language with the shortest code is predicted. Each language has its own context tree,
which holds only what was seen in it; the contexts of many texts are listed once, each
with its shorter one, and every tree gives the cost of all of them at once.

The model is trained on a bounded sample: at most ``TRAIN_DOCS`` documents of every
language there is, chosen by hash of the id, whole texts, counted on the cluster. A tree
keeps every context of its language's sample, however rare.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is
every text if there is nothing to learn from. Ties go to the first language by name.
Every row gives one row; repeated rows and null ids are predicted like others; a null
id is not held out. Other input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardvigil.llm.words import pieces, texts

ORDER = 4
TRAIN_DOCS = 300
#: Bytes that are coded at once.
BLOCK = 1 << 20
_HASHES = 1 << 30
#: A context and its next byte as one number: the order above five bytes.
_ORDER_BIT = 40


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = TRAIN_DOCS) -> DataFrame:
    """(lang, text) of at most ``per_language`` labelled documents of each language."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = labelled.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_rows"))
    place = F.xxhash64("doc_id")
    share = F.lit(2 * per_language * _HASHES) / F.col("_rows") + 1
    # One row for each language, whatever the number of documents.
    thin = labelled.join(F.broadcast(counts), F.col("lang") == F.col("_lang")).where(F.pmod(place, F.lit(_HASHES)) < share)
    order = Window.partitionBy("lang").orderBy(place, "doc_id", F.xxhash64("text"))
    return thin.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= per_language).select("lang", "text")


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each language, order and byte string of a context and its next byte: how often."""
    for batch in pieces(batches, "text"):
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            data, offsets = texts(batch.column("text").filter(pa.array(langs == lang)))
            age = _ages(offsets)
            code = np.zeros(len(data), dtype=np.int64)
            for order in range(ORDER + 1):
                code[order:] |= data[: len(data) - order].astype(np.int64) << (8 * order)
                found, n = np.unique(code[age >= order], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(np.full(len(found), order, dtype=np.int32)), pa.array(found), pa.array(n)],
                    ["lang", "order", "code", "n"],
                )


def _ages(offsets: np.ndarray) -> np.ndarray:
    """How many bytes of its text come before each byte."""
    return np.arange(offsets[-1], dtype=np.int64) - np.repeat(offsets[:-1], np.diff(offsets))


@dataclass(frozen=True)
class Tree:
    """What one language's texts hold: bits of each byte after each context, and of the escape from each context."""

    #: Numbers of contexts with their next bytes, in order, and of contexts.
    grams: np.ndarray
    cost: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray

    @classmethod
    def of(cls, grams: np.ndarray, n: np.ndarray) -> Tree:
        """From the numbers of contexts with their next bytes, in order, and how often each was seen."""
        contexts, first, kinds = np.unique(grams >> 8, return_index=True, return_counts=True)
        known = np.add.reduceat(n, first) + kinds
        cost = -np.log2(n / np.repeat(known, kinds))
        return cls(grams, cost.astype(np.float32), contexts, -np.log2(kinds / known).astype(np.float32))


@dataclass(frozen=True)
class Asked:
    """All contexts with their next bytes that some texts need, the shorter ones too, each once and in order."""

    grams: np.ndarray
    #: For each gram where the one with the next shorter context is.
    shorter: np.ndarray
    #: Where the grams of each order begin, one more at the end.
    edges: np.ndarray
    contexts: np.ndarray
    #: For each gram its context.
    context: np.ndarray

    @classmethod
    def of(cls, grams: np.ndarray) -> Asked:
        """From the grams of the longest contexts, each once and in order."""
        levels: list[np.ndarray] = []
        longer = grams[:0]
        for order in reversed(range(ORDER + 1)):
            low, high = np.searchsorted(grams, [order << _ORDER_BIT, (order + 1) << _ORDER_BIT])
            longer = np.unique(np.concatenate([grams[low:high], _shorter(longer, order)]))
            levels.insert(0, longer)
        every = np.concatenate(levels)
        edges = np.cumsum([0, *map(len, levels)])
        shorter = np.zeros(len(every), dtype=np.int64)
        for order in range(1, ORDER + 1):
            shorter[edges[order] : edges[order + 1]] = np.searchsorted(every, _shorter(levels[order], order - 1))
        contexts, context = np.unique(every >> 8, return_inverse=True)
        return cls(every, shorter, edges, contexts, context)

    def cost(self, tree: Tree) -> np.ndarray:
        """Bits of each gram's last byte."""
        at = np.minimum(np.searchsorted(tree.grams, self.grams), len(tree.grams) - 1)
        found, cost = tree.grams[at] == self.grams, tree.cost[at]
        at = np.minimum(np.searchsorted(tree.contexts, self.contexts), len(tree.contexts) - 1)
        escape = np.where(tree.contexts[at] == self.contexts, tree.escape[at], np.float32(0))[self.context]
        for order in range(ORDER + 1):
            part = slice(self.edges[order], self.edges[order + 1])
            shorter = cost[self.shorter[part]] if order else np.float32(8)
            cost[part] = np.where(found[part], cost[part], escape[part] + shorter)
        return cost


def _shorter(grams: np.ndarray, order: int) -> np.ndarray:
    """Numbers of grams with their contexts cut to ``order`` bytes."""
    return grams & ((1 << 8 * (order + 1)) - 1) | order << _ORDER_BIT


@dataclass(frozen=True)
class Model:
    """A tree for each language."""

    langs: list[str]
    trees: list[Tree]

    @classmethod
    def of(cls, rows: list[tuple[str, int, int, int]]) -> Model:
        """From counts (lang, order, context and next byte as a number, n)."""
        langs = sorted({lang for lang, *_ in rows})
        counts = {lang: [] for lang in langs}
        for lang, order, code, n in sorted(rows):
            counts[lang].append((order << _ORDER_BIT | code, n))
        return cls(langs, [Tree.of(*np.array(counts[lang], dtype=np.int64).T.copy()) for lang in langs])

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        bits = np.zeros((len(offsets) - 1, len(self.langs)))
        for low in range(0, len(data), BLOCK):
            high = min(len(data), low + BLOCK)
            back = min(low, ORDER)
            read = data[low - back : high].astype(np.int64)
            first = int(np.searchsorted(offsets, low, "right")) - 1
            last = int(np.searchsorted(offsets, high, "left"))
            edges = np.clip(offsets[first : last + 1], low, high)
            age = np.arange(low, high) - np.repeat(offsets[first:last], np.diff(edges))
            grams = np.minimum(age, ORDER) << _ORDER_BIT
            for order in range(ORDER + 1):
                start = max(0, order - back)
                part = read[back - order + start : max(0, len(read) - order)] << 8 * order
                grams[start:] |= np.where(age[start:] >= order, part, 0)
            kinds, place = np.unique(grams, return_inverse=True)
            asked = Asked.of(kinds)
            place = np.searchsorted(asked.grams, kinds)[place]
            sums = np.zeros(high - low + 1)
            for i, tree in enumerate(self.trees):
                np.cumsum(asked.cost(tree)[place], dtype=np.float64, out=sums[1:])
                bits[first:last, i] += sums[edges[1:] - low] - sums[edges[:-1] - low]
        return bits


def _packed(group: pa.Table) -> pa.Table:
    """One language's counts as one row (lang, n, blob)."""
    grams = group.column("order").to_numpy().astype(np.int64) << _ORDER_BIT | group.column("code").to_numpy()
    order = np.argsort(grams)
    blob = zstandard.compress(np.diff(grams[order], prepend=0).tobytes() + group.column("n").to_numpy()[order].tobytes())
    return pa.table({"lang": group.column("lang").slice(0, 1), "n": pa.array([len(grams)], pa.int64()), "blob": pa.array([blob], pa.binary())})


def _tree(n: int, blob: bytes) -> Tree:
    steps, counts = np.frombuffer(zstandard.decompress(blob), dtype=np.int64).reshape(2, n)
    return Tree.of(np.cumsum(steps), counts)


def train(docs: DataFrame, per_language: int = TRAIN_DOCS) -> Model | None:
    """A model of the documents that aren't held out; None if none of them has a language and a text."""
    counts = training_sample(docs, per_language).mapInArrow(_count, "lang string, order int, code long, n long")
    counts = counts.groupBy("lang", "order", "code").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").applyInArrow(_packed, "lang string, n long, blob binary")
    found = sorted((r.lang, r.n, r.blob) for r in packed.collect())
    return Model([lang for lang, *_ in found], [_tree(n, blob) for _, n, blob in found]) if found else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); the score is the language's share of all codes' probability."""
    asked = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(F.regexp_like("text", F.lit(r"\p{L}")), F.col("text")).alias("text"),
    )
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    if model is None:
        return asked.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in pieces(batches, "text"):
            bits = known.code_lengths(*texts(batch.column("text")))
            best = bits.argmin(axis=1)
            score = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
            spoken = batch.column("text").is_valid().to_numpy(zero_copy_only=False)
            names = [known.langs[i] if s else "und" for i, s in zip(best.tolist(), spoken.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(np.where(spoken, score, 0.0))],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return asked.mapInArrow(run, schema)
