"""Quality classifier: supervised subword embeddings, averaged per document, softmax output.

A text's features are its words, its pairs of neighbouring words (a word beside itself is one
feature, whatever the word) and the character n-grams of each word between its edges, all
hashed to ``BUCKETS`` vectors that are learned. The vectors of a text are averaged, and a
linear layer with a softmax tells the labels apart. Vectors and layer are trained together by
stochastic gradient descent in numpy, document by document, with a step that falls linearly
to nothing.

It learns from a bounded sample: of each label at most ``TRAIN_DOCS`` documents, chosen by
hash of the id, whole texts, in order of that hash as long as they have no more than
``TRAIN_FEATURES`` different features together. Features are counted on the cluster; one
task trains on the counts, whose size the two bounds fix. Labels weigh the same in the loss,
however often each occurs, so the score does not shift with the share of a label.

A trained model is linear in the features: the layer is multiplied into the vectors once,
and scoring a text looks up one number for each feature and averages them. All documents
are scored where they are read; nothing is shuffled, and what is broadcast has a fixed size.

Defined results: a null or empty text has one feature, the end of text, as every text has. If
one of the labels has no text to learn from, every score is 0.5. Only labels 0 and 1 of
documents with an id and a text are learned from; an id labelled more than once counts with
its greatest label, and of texts that share an id one is learned from. A null id is not held
out. Every row gives one row; repeated rows are scored alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardvigil.llm.words import give_back, pieces

BITS = 16
BUCKETS = 1 << BITS
DIMENSIONS = 16
#: Code points of the shortest and longest n-gram, the edges of a word included.
SHORTEST, LONGEST = 2, 5
EPOCHS, STEP = 5, 2.0
#: Documents of a label, and different features of all documents, that are learned from at most.
TRAIN_DOCS, TRAIN_FEATURES = 3_000, 1 << 25
#: Score from which label 1 is predicted.
THRESHOLD = 0.3
#: Code points that are read at once, but for longer words.
PART = 1 << 19

_SPACE = re.compile(r"[\x20\x09-\x0D]")
_HASHES = 1 << 30
_BASE = np.uint32(0x01000193)
_POWERS: list[np.ndarray] = []
#: The bucket of the feature that every text has.
_END = 0


def _power(n: int) -> np.ndarray:
    """The first powers of the base modulo 2**32, ``n`` at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        powers = np.full(max(n, PART + 2), _BASE, dtype=np.uint32)
        powers[0] = 1
        _POWERS[:] = [np.multiply.accumulate(powers)]
    return _POWERS[0]


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Buckets of 32-bit hashes; ``kind`` tells words, pairs and lengths of n-grams apart."""
    x = hashes ^ np.uint32(kind * 0x9E3779B1 & 0xFFFFFFFF)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x >>= np.uint32(32 - BITS)
    return x


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts cut at white space, so that no word is cut; no pair of words spans a cut."""
    at = 0
    while len(text) - at > size and (cut := _SPACE.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Kind by kind (buckets, whether each counts, where each text's features begin).

    A feature counts once for each place it stands in.
    """
    code = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le"), dtype=np.uint32)
    gap = (code == 32) | ((code >= 9) & (code <= 13))
    symbols = np.where(gap, np.uint32(0), code)
    begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])

    rolling = symbols
    inside = ~gap[:-1] | ~gap[1:]
    for n in range(2, LONGEST + 1):
        rolling = rolling[: len(code) - n + 1] * _BASE + symbols[n - 1 :]
        if n == 3:
            inside = ~gap[1:-1]
        elif n > 3:
            inside = inside[:-1] & ~gap[n - 2 : -1]
        if n >= SHORTEST and len(rolling):
            # A gap between two texts ends one and begins the next: its n-grams lie in either.
            yield _bucket(rolling, n), inside, np.minimum(begin, len(rolling) - 1)

    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    if len(starts):
        place = np.arange(len(code)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(code)]])))
        words = np.add.reduceat(symbols * _power(len(code))[place], starts, dtype=np.uint32)
        first = np.searchsorted(starts, begin)
        yield _bucket(words, 0), np.ones(len(words), dtype=bool), first
        pairs = words * _BASE
        pairs[:-1] += words[1:]
        pairs[:-1][words[:-1] == words[1:]] = 0
        last = np.ones(len(words), dtype=bool)
        last[np.append(first[1:], len(words))[np.append(first[1:], len(words)) > 0] - 1] = False
        yield _bucket(pairs, 1), last, first


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values from each text's first to the next one's."""
    running = np.zeros(len(values) + 1)
    np.cumsum(values, dtype=np.float64, out=running[1:])
    return np.diff(np.append(running[first], running[-1]))


@dataclass(frozen=True)
class Model:
    """The difference between the two labels' outputs that each bucket stands for."""

    weights: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, output: np.ndarray) -> Model:
        return cls((vectors @ (output[1] - output[0])).astype(np.float32))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 of each text."""
        total = np.full(len(texts), float(self.weights[_END]))
        count = np.ones(len(texts))
        held: list[str] = []
        owners: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            for part in parts(text):
                held.append(part)
                owners.append(i)
                size += len(part)
                if size >= PART:
                    self._add(held, owners, total, count)
                    held, owners, size = [], [], 0
        if held:
            self._add(held, owners, total, count)
        return 1 / (1 + np.exp(-np.clip(total / count, -500, 500)))

    def _add(self, held: list[str], owners: list[int], total: np.ndarray, count: np.ndarray) -> None:
        for bucket, valid, first in features(held):
            np.add.at(total, owners, _sums(np.where(valid, self.weights[bucket], np.float32(0)), first))
            np.add.at(count, owners, _sums(valid, first))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> DataFrame:
    """(place, label, text) of at most ``per_label`` documents of each label."""
    label = F.col("quality").cast("int")
    known = labels.where(label.isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max(label).alias("label"))
    place = F.xxhash64("_id")
    # One row for each of the two labels.
    counts = F.broadcast(known.groupBy(F.col("label").alias("_label")).agg(F.count("*").alias("_rows")))
    thin = known.join(counts, F.col("label") == F.col("_label")).where(
        F.pmod(place, F.lit(_HASHES)) < F.lit(2 * per_label * _HASHES) / F.col("_rows") + 1
    )
    order = Window.partitionBy("label").orderBy(place, "_id")
    chosen = thin.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= per_label).select("_id", "label")
    # At most 2 * per_label ids.
    found = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    one = found.groupBy("_id", "label").agg(F.min("text").alias("text"))
    return one.select(place.alias("place"), "label", "text")


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text its different features and how often it has each, packed."""
    for batch in pieces(batches, "text", 1 << 20):
        sizes, blobs = [], []
        for text in batch.column("text").to_pylist():
            times = np.zeros(BUCKETS, dtype=np.int64)
            times[_END] += 1
            for part in parts(text):
                for bucket, valid, _ in features([part]):
                    times += np.bincount(bucket[valid], minlength=BUCKETS)
            kinds = np.flatnonzero(times)
            sizes.append(len(kinds))
            blobs.append(zstandard.compress(kinds.astype("<u4").tobytes() + times[kinds].astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("label"), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
            ["place", "label", "n", "blob"],
        )


def descend(
    examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, step: float = STEP, seed: int = 11
) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and output layer after stochastic gradient descent over (buckets, times, label)."""
    random = np.random.Generator(np.random.PCG64(seed))
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((2, DIMENSIONS), dtype=np.float32)
    of_label = np.bincount([label for *_, label in examples], minlength=2)
    weight = len(examples) / (2 * of_label)
    total, done = epochs * len(examples), 0
    for _ in range(epochs):
        for i in random.permutation(len(examples)):
            buckets, times, label = examples[i]
            rate = step * (1 - done / total)
            done += 1
            share = (times / times.sum()).astype(np.float32)
            hidden = share @ vectors[buckets]
            loss = softmax(output @ hidden)
            loss[label] -= 1
            loss *= np.float32(rate * weight[label])
            back = loss @ output
            output -= np.outer(loss, hidden)
            vectors[buckets] -= share[:, None] * back
    return vectors, output


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def _descended(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the trained vectors and layer; none if a label is missing."""
    examples = []
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("n", "blob", "label")), strict=True)
        for n, blob, label in rows:
            kinds, times = np.frombuffer(zstandard.decompress(blob), dtype="<u4").reshape(2, n)
            examples.append((kinds.astype(np.int32), times, label))
    if {label for *_, label in examples} == {0, 1}:
        vectors, output = descend(examples)
        yield pa.RecordBatch.from_arrays(
            [pa.array([vectors.tobytes()], pa.binary()), pa.array([output.tobytes()], pa.binary())], ["vectors", "output"]
        )
    give_back()


def train(
    docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS, at_most: int = TRAIN_FEATURES
) -> Model | None:
    """A model of the labelled documents that aren't held out; None if one of the labels has none."""
    sample = training_sample(docs, labels, per_label)
    counted = sample.mapInArrow(_counted, "place long, label int, n long, blob binary")
    # Bounded by the sample: one partition of at most 2 * per_label rows and `at_most` features.
    so_far = F.sum("n").over(Window.orderBy("place", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bounded = counted.withColumn("_so_far", so_far).where(F.col("_so_far") <= at_most).select("n", "blob", "label")
    trained = bounded.mapInArrow(_descended, "vectors binary, output binary").collect()
    if not trained:
        return None
    vectors = np.frombuffer(trained[0].vectors, dtype=np.float32).reshape(BUCKETS, DIMENSIONS)
    return Model.of(vectors, np.frombuffer(trained[0].output, dtype=np.float32).reshape(2, DIMENSIONS))


def classify(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    asked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double"
    if model is None:
        scored = asked.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text", 1 << 20):
                scores = shared.value.scores([text or "" for text in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(scores)], ["doc_id", "held_out", "score"]
                )

        scored = asked.mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
