"""Spreads all windows of all texts over buckets, so that equal windows meet in one.

A window is a fixed number of consecutive units (bytes or words) of one text. Its key is
the least hash of the shorter grams inside it, so that neighbouring windows mostly share
their key, equal windows always do, and a run of windows with one key travels as one
piece of text. Keys are counted first, over everything, in a fixed number of bins. Bins
with little are put together, up to the size of a bucket; a bin with more than a bucket
holds is spread by the windows' own hashes. So a passage that a third of all documents
holds fills no bucket by its different surroundings, and equal runs of text in one batch
travel once: the others are covered by it, which is known at once, or lie in its own
document and take its verdict, as spans that join where windows overlap.

Buckets arrive in a function of the operator, which tells covered windows; they come
back as spans of units, added up for each document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardvigil.llm.words import joined, pieces, span_hashes, texts

#: Bins that keys are counted in. For texts of more than ``BINS * BUCKET`` units take more.
BINS = 1 << 18
#: Bins whose counts travel in one row.
BLOCK = 256
#: Windows in a bucket.
BUCKET = 1 << 20
#: Bytes of text, about, that are cut into runs at once; equal runs in them travel once.
PIECE = 10 << 20
#: Windows whose keys are found at once, and windows that travel in one piece.
STEP, LONGEST = 1 << 20, 64
#: Compression of the texts that travel.
LEVEL = 3
#: Stands for a null id, below all others.
NO_ID = -(2**63)


class Units(Protocol):
    """Units of texts that lie one after the other."""

    #: Of each text the numbers of its units: ``first[i]`` to ``first[i + 1]``.
    first: np.ndarray
    data: np.ndarray

    def grams(self, low: int, high: int) -> np.ndarray:
        """Hashes of the grams inside units ``low`` to ``high``."""

    def window_hashes(self, starts: np.ndarray) -> np.ndarray:
        """Hashes of the windows at these units."""

    def bytes_of(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte spans of units ``start`` to ``end``."""


@dataclass(frozen=True)
class Kind:
    """What windows are made of: ``read`` finds the units of texts, a key covers ``spread`` grams."""

    window: int
    spread: int
    read: Callable[[np.ndarray, np.ndarray], Units]


@dataclass(frozen=True)
class Plan:
    """Where each bin's windows go: to a bucket, or to one of several by the window's hash."""

    bucket: np.ndarray
    several: np.ndarray

    @classmethod
    def of(cls, loads: np.ndarray, limit: int = BUCKET) -> Plan:
        bucket, several = np.zeros(BINS, dtype=np.int64), np.ones(BINS, dtype=np.int64)
        following, filled = 0, 0
        for bin_ in np.flatnonzero((loads > 0) & (loads <= limit)).tolist():
            load = int(loads[bin_])
            if filled + load > limit:
                following, filled = following + 1, 0
            bucket[bin_] = following
            filled += load
        for bin_ in np.flatnonzero(loads > limit).tolist():
            bucket[bin_], several[bin_] = following + 1, -(-2 * int(loads[bin_]) // limit)
            following += int(several[bin_])
        return cls(bucket, several)


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values."""
    n, done = len(values) - size + 1, 1
    if n <= 0:
        return values[:0]
    while 2 * done <= size:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:n], values[size - done : size - done + n])


def _keys(units: Units, kind: Kind) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first window, keys, which windows lie inside one text), some windows at a time."""
    total = int(units.first[-1])
    for low in range(0, total, STEP):
        keys = sliding_min(units.grams(low, min(total, low + STEP + kind.window - 1)), kind.spread)
        inside = np.ones(len(keys), dtype=bool)
        for text in range(np.searchsorted(units.first, low, "right") - 1, np.searchsorted(units.first, low + len(keys))):
            end = int(units.first[text + 1])
            inside[max(0, max(int(units.first[text]), end - kind.window + 1) - low) : max(0, end - low)] = False
        yield low, keys, inside


def _counted(kind: Kind):
    """Windows in each bin, as rows (block, loads) of ``BLOCK`` bins that aren't all empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros(BINS, dtype=np.int64)
        for batch in pieces(batches, "text"):
            for _, keys, inside in _keys(kind.read(*texts(batch.column("text"))), kind):
                loads += np.bincount((keys[inside] & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS)
        blocks = loads.reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([blocks[i].tobytes() for i in some], pa.binary())], ["block", "loads"])

    return run


def _added_up(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, dtype=np.int64) for x in group.column("loads").to_pylist())
    return pa.table({"block": group.column("block").slice(0, 1), "loads": pa.array([total.tobytes()], pa.binary())})


def plan(docs: DataFrame, kind: Kind, limit: int = BUCKET) -> Plan:
    """Counts all windows of all texts; ``BINS`` counts at most come to the driver."""
    counted = docs.select("text").mapInArrow(_counted(kind), "block long, loads binary")
    loads = np.zeros((BINS // BLOCK, BLOCK), dtype=np.int64)
    for row in counted.groupBy("block").applyInArrow(_added_up, "block long, loads binary").collect():
        loads[row.block] = np.frombuffer(row.loads, dtype=np.int64)
    return Plan.of(loads.ravel(), limit)


def _runs(low: int, keys: np.ndarray, inside: np.ndarray, units: Units, to: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one key: first window, number of windows, bucket. A spread key's windows run alone."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (inside[1:] != inside[:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(keys)))
    real = inside[starts]
    starts, lengths = starts[real], lengths[real]
    bins = (keys[starts] & np.uint64(BINS - 1)).astype(np.int64)
    several = to.several[bins]
    most = np.where(several > 1, 1, LONGEST)
    parts = -(-lengths // most)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    most = np.repeat(most, parts)
    lengths = np.minimum(most, np.repeat(lengths, parts) - nth * most)
    starts = low + np.repeat(starts, parts) + nth * most
    bucket = np.repeat(to.bucket[bins], parts)
    spread = np.flatnonzero(most == 1)
    if len(spread):
        own = units.window_hashes(starts[spread])
        bucket[spread] += (own % np.repeat(several, parts)[spread].astype(np.uint64)).astype(np.int64)
    return starts, lengths, bucket


def _packed(columns: tuple[np.ndarray, ...], text: bytes) -> bytes:
    """Differences of the columns, all lowest bytes first, then the text, compressed."""
    planes = [np.diff(c, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.compress(b"".join([*planes, text]), LEVEL)


def _unpacked(blob: bytes, n: int, columns: int) -> tuple[list[np.ndarray], bytes]:
    raw, size = zstandard.decompress(blob), 8 * n
    planes = (np.frombuffer(raw, dtype=np.uint8, count=size, offset=k * size).reshape(8, n) for k in range(columns))
    return [np.cumsum(np.ascontiguousarray(x.T).view("<i8").ravel()) for x in planes], raw[columns * size :]


def _repeated(content: np.ndarray, docs: np.ndarray, place: np.ndarray, same_document: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs whose text another run of a smaller document has, or with ``same_document`` an earlier one.

    Also the other runs whose text an earlier run of their document has, and that run; in order of text and place.
    """
    by = np.argsort(content)
    same = content[by][1:] == content[by][:-1]
    twin = np.zeros(len(by), dtype=bool)
    twin[1:] = same
    twin[:-1] |= same
    order = by[twin]
    order = order[np.lexsort((place[order], docs[order], content[order]))]
    head = np.ones(len(order), dtype=bool)
    head[1:] = content[order][1:] != content[order][:-1]
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))] if len(order) else order
    later = docs[order] > docs[first]
    if same_document:
        later |= place[order] > place[first]
    more = ~later & ~head
    return order[later], order[more], first[more]


def _united(of: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans in order of what they are of and begin, joined where the next begins inside or right after the one before."""
    if not len(of):
        return of, begin, end
    new = np.ones(len(of), dtype=bool)
    new[1:] = (of[1:] != of[:-1]) | (begin[1:] > end[:-1])
    edges = np.flatnonzero(new)
    return of[edges], begin[edges], np.maximum.reduceat(end, edges)


def _sent(kind: Kind, to: Plan, same_document: bool):
    """Rows of runs of windows with their texts, or of spans known to be covered.

    ``copies`` are ``n_copies`` spans of windows equal to a single window among the row's runs, in its document.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(joined(batches, "text", PIECE), "text", PIECE + PIECE // 2):
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            units = kind.read(*texts(batch.column("text")))
            found = [_runs(*part, units, to) for part in _keys(units, kind)]
            if not found or not sum(len(x[0]) for x in found):
                continue
            starts, lengths, bucket = (np.concatenate(x) for x in zip(*found, strict=True))
            row = np.searchsorted(units.first, starts, "right") - 1
            docs, place = ids[row], starts - units.first[row]
            begin, end = units.bytes_of(starts, starts + lengths + kind.window - 1)
            content = span_hashes(units.data, begin, end)
            dropped, again, of = _repeated(content, docs, place, same_document)
            alone = (lengths[again] == 1) & (not same_document)
            again, of = again[alone], of[alone]
            kept = np.ones(len(content), dtype=bool)
            kept[dropped] = False
            kept[again] = False
            kept = np.flatnonzero(kept)
            kept = kept[np.argsort(bucket[kept], kind="stable")]
            rows = []
            if len(dropped):
                to_bucket = int(bucket[dropped[0]])
                dropped = dropped[np.lexsort((place[dropped], docs[dropped]))]
                spans = _united(docs[dropped], place[dropped], place[dropped] + lengths[dropped] + kind.window - 1)
                rows.append((to_bucket, len(spans[0]), True, _packed(spans, b""), 0, b""))
            at = np.zeros(len(content), dtype=np.int64)
            at[kept] = np.arange(len(kept))
            copies = _united(at[of], place[again], place[again] + kind.window)
            by = np.argsort(copies[0], kind="stable")
            copies = [c[by] for c in copies]
            edges = np.flatnonzero(np.diff(bucket[kept], prepend=-1, append=-1))
            view = units.data.tobytes()
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                part = kept[low:high]
                text = b"".join(map(view.__getitem__, map(slice, begin[part].tolist(), end[part].tolist())))
                columns = (docs[part], place[part], lengths[part], end[part] - begin[part])
                first, last = np.searchsorted(copies[0], [low, high]).tolist()
                more = (copies[0][first:last] - low, copies[1][first:last], copies[2][first:last])
                rows.append((int(bucket[part[0]]), high - low, False, _packed(columns, text), last - first, _packed(more, b"") if last > first else b""))
            for low in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind_) for c, kind_ in zip(zip(*rows[low : low + 256], strict=True), _KINDS, strict=True)],
                    ["bucket", "n", "covered", "blob", "n_copies", "copies"],
                )

    return run


_KINDS = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.binary())


@dataclass(frozen=True)
class Runs:
    """What came to one bucket: runs of windows in order, and their texts one after the other."""

    docs: np.ndarray
    place: np.ndarray
    lengths: np.ndarray
    text: np.ndarray
    #: Byte offsets of the runs in ``text``, one more at the end.
    offsets: np.ndarray


#: Of a bucket's runs, whether each window is covered: one flag for each window, run by run.
Judge = Callable[[Runs], np.ndarray]


def _judged(kind: Kind, judge: Judge):
    def run(group: pa.Table) -> pa.Table:
        known, runs, texts_, like, n_runs = [], [], [], [], 0
        rows = (group.column(c).to_pylist() for c in ("n", "covered", "blob", "n_copies", "copies"))
        for n, covered, blob, n_copies, copies in zip(*rows, strict=True):
            columns, text = _unpacked(blob, n, 3 if covered else 4)
            if n_copies:
                (of, *span), _ = _unpacked(copies, n_copies, 3)
                like.append((of + n_runs, *span))
            n_runs += 0 if covered else n
            (known if covered else runs).append(columns)
            texts_.append(text)
        spans = [tuple(np.concatenate(x) for x in zip(*known, strict=True))] if known else []
        if runs:
            docs, place, lengths, size = (np.concatenate(x) for x in zip(*runs, strict=True))
            text = np.frombuffer(b"".join(texts_), dtype=np.uint8)
            flags = judge(Runs(docs, place, lengths, text, np.concatenate([[0], np.cumsum(size)])))
            spans.append(_covered_spans(flags, docs, place, lengths, kind.window))
            if like:
                of, begin, end = (np.concatenate(x) for x in zip(*like, strict=True))
                on = flags[(np.cumsum(lengths) - lengths)[of]]
                spans.append((docs[of[on]], begin[on], end[on]))
        return _by_document(spans)

    return run


def _covered_spans(flags: np.ndarray, docs: np.ndarray, place: np.ndarray, lengths: np.ndarray, window: int):
    """Flagged windows of a run that follow each other, as spans of units."""
    run = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(run)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    on = np.flatnonzero(flags)
    if not len(on):
        return docs[:0], place[:0], place[:0]
    new = np.ones(len(on), dtype=bool)
    new[1:] = (np.diff(on) != 1) | (np.diff(run[on]) != 0)
    first, last = on[new], on[np.append(np.flatnonzero(new)[1:] - 1, len(on) - 1)]
    begin = place[run[first]] + at[first]
    return docs[run[first]], begin, begin + (last - first) + window


def _by_document(spans: list[tuple]) -> pa.Table:
    """(doc_id, spans): int32 pairs of start and end, some for each document."""
    docs, begin, end = (np.concatenate(x) for x in zip(*spans, strict=True)) if spans else (np.zeros(0, dtype=np.int64),) * 3
    order = np.lexsort((begin, docs))
    pairs = np.stack([begin[order], end[order]], axis=1).astype(np.int32)
    ids = docs[order]
    edges = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else order
    blobs = [pairs[a:b].tobytes() for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(ids)], strict=False)]
    ids = ids[edges]
    return pa.table([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["doc_id", "spans"])


def merged(blobs: list[bytes] | None, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the union of spans, inside a text of ``length`` units."""
    none = np.zeros(0, dtype=np.int64)
    if not blobs:
        return none, none
    pairs = np.frombuffer(b"".join(blobs), dtype=np.int32).reshape(-1, 2).astype(np.int64)
    pairs = np.minimum(pairs[np.argsort(pairs[:, 0], kind="stable")], length)
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.ones(len(pairs), dtype=bool)
    new[1:] = pairs[1:, 0] > reach[:-1]
    starts = pairs[new, 0]
    ends = reach[np.append(np.flatnonzero(new)[1:] - 1, len(pairs) - 1)]
    real = ends > starts
    return starts[real], ends[real]


def covered(docs: DataFrame, kind: Kind, judge: Judge, same_document: bool, limit: int = BUCKET) -> DataFrame:
    """(doc_id, spans): for each document with covered windows a list of blobs for :func:`merged`; null ids are ``NO_ID``.

    ``same_document`` says that a window also covers later ones of its own document.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    to = plan(read, kind, limit)
    sent = read.mapInArrow(_sent(kind, to, same_document), "bucket long, n long, covered boolean, blob binary, n_copies long, copies binary")
    found = sent.groupBy("bucket").applyInArrow(_judged(kind, judge), "doc_id long, spans binary")
    return found.groupBy("doc_id").agg(F.collect_list("spans").alias("spans"))


def _zipped(columns: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(LEVEL).compress
        for batch in pieces(batches, "text"):
            texts_ = [None if t is None else zip_(t) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(texts_, pa.binary())], [*columns, "_text"])

    return run


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents with ``_spans``, null where nothing is covered; the text, as ``_text``, travels compressed."""
    kept = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("_text", T.BinaryType())])
    packed = docs.select(*kept, "text").mapInArrow(_zipped(kept), schema)
    named = spans.select(F.col("doc_id").alias("_span_doc"), F.col("spans").alias("_spans"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return packed.join(named, key == F.col("_span_doc"), "left").drop("_span_doc")


def unzipped(text: bytes | None) -> bytes:
    """The UTF-8 bytes of a ``_text``; null is empty."""
    return b"" if text is None else zstandard.decompress(text)
