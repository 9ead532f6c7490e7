"""Near duplicates: MinHash signatures, banding, verified links, connected components.

Documents are sets of 5-word shingles; two are linked where the sets' Jaccard
similarity reaches the threshold. Exact copies (equal word sequences) are one class and
only its smallest document is compared further. A class's signature holds the minima of
many universal hash functions; bands of it are bucket keys.

In a bucket not all pairs are tried. First every member is compared with one, chosen by
hash, so that a member meets others in other buckets; links are joined to components.
Where a bucket still holds several components, the members outside its largest one are
compared with all members of other components, block by block, by the overlap of their
sets; only pairs that may be linked leave a block. So what is never compared is already
connected, and a bucket of near copies costs one comparison for each. A comparison is
first by signature, then, where the estimate is not far below the threshold, exact on
the full sets of both texts.

Defined results: words are `[^\\x20\\x09-\\x0D]+` after A-Z are lower-cased. Fewer words
than a shingle are one shingle; without words a document is empty and linked to nothing.
Ids are taken to be unique: rows that repeat an id are judged by their own texts, but
classes whose smallest ids are equal count as linked. Rows without an id belong to
their text's class; a class without any id is linked to nothing, and all its rows are
kept. Other input columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardvigil.llm.components import components
from cardvigil.llm.tables import staged
from cardvigil.llm.words import SPACED_LOWER, give_back, pieces, texts, windows, words

SHINGLE = 5
#: Similarity in percent from which documents are linked.
PERCENT = 75
BANDS, ROWS = 48, 4
#: Share of equal minima below which sets are not compared: 6 standard deviations under 0.75.
LEAST_EQUAL = 0.55
#: Members of a bucket that meet in one block, on either side, and shingles counted at once.
BLOCK, COLUMNS = 512, 4096
#: Bytes of text whose minima are taken at once.
PIECE = 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(5))
_FACTOR = _RANDOM.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSET = _RANDOM.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[list[np.ndarray], list[bytes | None]]:
    """Of each text the hashes of its shingles (repeated ones too), and a 128-bit key of its word sequence."""
    data, offsets = texts(column)
    found = words(data, offsets, SPACED_LOWER)
    hashes = found.hashes()
    all_windows = windows(hashes, size)
    sets, keys = [], []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(all_windows[a : b - size + 1])
        else:
            sets.append(windows(hashes[a:b], b - a) if b > a else hashes[:0])
        keys.append(hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None)
    return sets, keys


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Row by row, the least value of each hash function over a set that isn't empty."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    start = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), BANDS * ROWS), dtype=np.uint32)
    turned = np.empty_like(flat)
    for k in range(BANDS * ROWS):
        np.multiply(flat, _FACTOR[k], out=turned)
        turned += _OFFSET[k]
        out[:, k] = np.minimum.reduceat(turned, start)
    return out


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", PIECE):
        sets, keys = shingles(batch.column("text"))
        some = [i for i, s in enumerate(sets) if len(s)]
        signatures: list[bytes | None] = [None] * len(sets)
        if some:
            for i, row in zip(some, minima([sets[i] for i in some]), strict=True):
                signatures[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(keys, pa.binary()),
                pa.array([len(np.unique(s)) for s in sets], pa.int64()),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", "text_hash", "key", "n_shingles", "signature"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, key, n_shingles, signature) of every row; key and signature null without words."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _sketches, "doc_id long, text_hash long, key binary, n_shingles long, signature binary"
    )


def _bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            signature = np.frombuffer(b"".join(part.column("signature").to_pylist()), dtype=np.uint32)
            pairs = signature.reshape(part.num_rows, BANDS, ROWS).astype(np.uint64)
            keys = np.stack(
                [windows(pairs[:, k].ravel(), ROWS)[::ROWS] + np.uint64(k) for k in range(BANDS)], axis=1
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part.column("node").to_numpy(), BANDS)), pa.array(keys.ravel().view(np.int64))],
                ["node", "bucket"],
            )


def _alike(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            left, right = (
                np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=np.uint32).reshape(part.num_rows, -1) for c in ("sa", "sb")
            )
            near = (left == right).mean(axis=1) >= LEAST_EQUAL
            yield part.select(["a", "b"]).filter(pa.array(near))


def _confirmed(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(pieces(batches, "ta"), "tb"):
            sides = []
            for node, text in (("a", "ta"), ("b", "tb")):
                ids = batch.column(node).to_numpy()
                _, first, which = np.unique(ids, return_index=True, return_inverse=True)
                sets, _ = shingles(batch.column(text).take(pa.array(first)))
                sets = [np.unique(s) for s in sets]
                sides.append([sets[i] for i in which])
            linked = []
            for x, y in zip(*sides, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _with_key(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the word sequence of their class: ids may repeat with other texts."""
    for batch in pieces(batches, "text"):
        _, keys = shingles(batch.column("text"))
        same = [x == y for x, y in zip(keys, batch.column("key").to_pylist(), strict=True)]
        yield batch.select(["node", "text"]).filter(pa.array(same, pa.bool_()))


def _side(frame: DataFrame, node: str, value: str, name: str) -> DataFrame:
    return frame.select(F.col("node").alias(node), F.col(value).alias(name))


def _verified(pairs: DataFrame, classes: DataFrame, spelled: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold; ``spelled`` has the texts of their nodes."""
    near = (
        pairs.join(_side(classes, "a", "signature", "sa"), "a")
        .join(_side(classes, "b", "signature", "sb"), "b")
        .mapInArrow(_alike, "a long, b long")
    )
    full = near.join(_side(spelled, "a", "text", "ta"), "a").join(_side(spelled, "b", "text", "tb"), "b")
    return staged(full.mapInArrow(_confirmed(percent), "a long, b long"), "confirmed")


def _short_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted upper halves of the shingles' hashes: enough to find pairs that may be linked."""
    for batch in pieces(batches, "text"):
        sets, _ = shingles(batch.column("text"))
        halves = [np.unique((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(halves, pa.binary())], ["node", "shingles"])


def _blocks(members: DataFrame, labels: DataFrame, spelled: DataFrame) -> DataFrame:
    """Rows (bucket, i, j, stray, node, component, shingles): blocks of strays beside blocks of members.

    Strays are the members outside their bucket's largest component. A bucket's strays
    and members are cut in blocks; each block of strays meets each block of members.
    """
    labelled = members.join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    parts = labelled.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = (
        parts.groupBy("bucket")
        .agg(
            F.max_by("component", F.struct("n", "component")).alias("largest"),
            F.sum("n").alias("members"),
            F.max("n").alias("most"),
            F.count("*").alias("parts"),
        )
        .where("parts > 1")
        .select("bucket", "largest", *(F.ceil(n / BLOCK).cast("int").alias(name) for n, name in ((F.col("members") - F.col("most"), "is"), (F.col("members"), "js"))))
    )
    dealt = labelled.join(mixed, "bucket").withColumn("at", F.xxhash64("node"))
    number = lambda n: F.pmod(F.col("at"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    strays = dealt.where("component != largest").select("bucket", number("is").alias("i"), every("js").alias("j"), F.lit(True).alias("stray"), "node", "component")
    others = dealt.select("bucket", every("is").alias("i"), number("js").alias("j"), F.lit(False).alias("stray"), "node", "component")
    both = staged(strays.unionByName(others), "blocks")
    asked = spelled.join(both.select("node").distinct(), "node", "left_semi")
    return both.join(asked.mapInArrow(_short_sets, "node long, shingles binary"), "node")


def _crossing(percent: int):
    """Pairs of a stray and a member of another component that may be linked: the best for each stray and component."""

    def run(group: pa.Table) -> pa.Table:
        component = group.column("component").to_numpy()
        node = group.column("node").to_numpy()
        stray = group.column("stray").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(s, dtype=np.uint32) for s in group.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), size)
        # Only shingles of several rows can be common ones.
        named = np.cumsum(count > 1) - 1
        common = count[number] > 1
        owner, number = owner[common], named[number[common]]
        by = np.argsort(number, kind="stable")
        owner, number = owner[by], number[by]
        left, right = np.flatnonzero(stray), np.flatnonzero(~stray)
        row = np.empty(len(sets), dtype=np.int64)
        row[left], row[right] = np.arange(len(left)), np.arange(len(right))
        both = np.zeros((len(left), len(right)), dtype=np.float32)
        for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
            part = slice(*np.searchsorted(number, [low, low + COLUMNS]))
            own, column = owner[part], number[part] - low
            a, b = np.zeros((len(left), COLUMNS), dtype=np.float32), np.zeros((len(right), COLUMNS), dtype=np.float32)
            a[row[own[stray[own]]], column[stray[own]]] = 1
            b[row[own[~stray[own]]], column[~stray[own]]] = 1
            both += a @ b.T
        # Halves of hashes may meet where the hashes differ: two more count, and sets are compared in full later.
        total = size[left][:, None] + size[right][None, :] - both
        near = (100 * (both + 2) >= percent * (total - 2)) & (component[left][:, None] != component[right][None, :])
        x, y = np.nonzero(near)
        order = np.lexsort((-both[x, y] / total[x, y], component[right][y], x))
        x, y = x[order], y[order]
        new = np.ones(len(x), dtype=bool)
        new[1:] = (x[1:] != x[:-1]) | (component[right][y[1:]] != component[right][y[:-1]])
        # If the best pair is linked whatever the hashes were, the others say nothing new.
        sure = (100 * (both - 2) >= percent * (total + 2))[x, y]
        best = np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
        told = new | ~sure[best]
        x, y, new = x[told], y[told], new[told]
        pair = node[left][x], node[right][y]
        del both, total, near
        give_back()
        return pa.table([pa.array(np.minimum(*pair)), pa.array(np.maximum(*pair)), pa.array(~new)], ["a", "b", "more"])

    return run


def _links(classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Component labels (node, component) of the classes."""
    bands = staged(classes.select("node", "signature").mapInArrow(_bands, "node long, bucket long"), "bands")
    shared = (
        bands.groupBy("bucket")
        .agg(F.min(F.struct(F.xxhash64("node", "bucket").alias("h"), "node")).alias("first"), F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low < high")
        .select("bucket", F.col("first.node").alias("pivot"))
    )
    members = staged(bands.join(shared, "bucket").where("node != pivot"), "buckets")
    nodes = members.select("node").unionByName(members.select(F.col("pivot").alias("node"))).distinct()
    keys = classes.join(nodes, "node", "left_semi").select("node", "key")
    spelled = docs.join(keys, docs.doc_id == keys.node).select("node", "key", "text")
    spelled = staged(spelled.mapInArrow(_with_key, "node long, text string").dropDuplicates(["node"]), "near-texts")
    pairs = members.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    links = _verified(pairs, classes, spelled, percent)
    labels = components(links)
    blocks = _blocks(members.select("bucket", "node"), labels, spelled)
    crossing = staged(blocks.groupBy("bucket", "i", "j").applyInArrow(_crossing(percent), "a long, b long, more boolean"), "crossing")
    # The best pairs first; the others only where these did not join the components.
    for more in (False, True):
        left = crossing.where(F.col("more") == more).select("a", "b").distinct()
        for side in ("a", "b"):
            left = left.join(_side(labels, side, "component", f"c{side}"), side, "left")
        left = left.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
        found = _verified(left, classes, spelled, percent)
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
    return labels


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row of ``docs``."""
    texts_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(sketches(texts_), "sketches")
    keyed = rows.where(F.col("key").isNotNull())
    classes = staged(
        keyed.groupBy("key")
        .agg(F.min("doc_id").alias("node"), F.any_value("signature").alias("signature"))
        .where(F.col("node").isNotNull()),
        "classes",
    )
    labels = _links(classes, texts_, percent)
    names = classes.select("key", "node").join(labels, "node", "left")
    named = rows.join(names.select("key", F.coalesce("component", "node").alias("found")), "key", "left")
    component = F.coalesce("found", "doc_id")
    kept = F.col("doc_id").eqNullSafe(component)
    return named.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows whose document is the smallest of its component; rows without an id stay where no copy has one."""
    judged = near_duplicates(docs, percent).where("kept")
    chosen = judged.select(F.col("doc_id").alias("_near_doc"), F.col("text_hash").alias("_near_hash")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_near_doc")) & (F.xxhash64("text") == F.col("_near_hash"))
    return docs.join(chosen, same, "left_semi")
