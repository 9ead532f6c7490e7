"""Removes byte strings that occur in an earlier document, by blockwise suffix sorting.

All 50-byte windows are spread over buckets (:mod:`cardvigil.llm.segments`). A bucket's
suffixes are sorted by themselves, in the memory of one task: first by their leading
bytes; suffixes still tied are put in order with the ranks of a difference-cover sample.
The cover holds five of every 21 positions, so that for any two suffixes some shift of
less than 21 bytes takes both to sampled positions, whose ranks were found before and
tell their order. Equal windows then stand side by side.

A window is covered if an equal one starts in a document with a smaller id. Bytes in
covered windows are removed.

Defined results: a null or empty text has no bytes; texts shorter than a window lose
nothing. Ids are taken to be unique: rows that repeat an id don't cover each other, and
what one of them loses at a place, all of them lose there. A null id is smaller than all
others. Input columns with the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cardvigil.llm.segments import BUCKET, Kind, Runs, covered, merged, unzipped, with_spans
from cardvigil.llm.words import mixed, pieces, span_hashes

WINDOW, GRAM = 50, 10

# A perfect difference cover of the numbers modulo 21.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)

#: Leading bytes that suffixes are first sorted by; no shift to the cover goes beyond.
LEADING = 24

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The least shift that takes positions with these two remainders into the cover.
_SHIFT = np.array(
    [[next(d for d in range(PERIOD) if _IN_COVER[(a + d) % PERIOD] and _IN_COVER[(b + d) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)]
)


@dataclass(frozen=True)
class Bytes:
    first: np.ndarray
    data: np.ndarray

    def grams(self, low: int, high: int) -> np.ndarray:
        return _grams(_blocks(self.data[low:high])) if high - low >= GRAM else np.zeros(0, dtype=np.uint64)

    def window_hashes(self, starts: np.ndarray) -> np.ndarray:
        return span_hashes(self.data, starts, starts + WINDOW)

    def bytes_of(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return starts, ends


def _blocks(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a big-endian number; there are none of the last seven."""
    data = np.ascontiguousarray(data)
    return np.ndarray((len(data) - 7,), dtype=">u8", buffer=data, strides=(1,)).astype(np.uint64)


def _grams(blocks: np.ndarray) -> np.ndarray:
    """Hashes of the grams at all positions that have one."""
    return mixed(blocks[: 8 - GRAM] * _ODD + blocks[GRAM - 8 :])


BYTES = Kind(WINDOW, WINDOW - GRAM + 1, lambda data, offsets: Bytes(offsets, data))


def ranks(blocks: np.ndarray, positions: np.ndarray, levels: int) -> np.ndarray:
    """Order of the suffixes at these positions by their first ``8 * levels`` bytes; equal ones share a rank."""
    order = np.argsort(blocks[positions])
    key = blocks[positions[order]]
    head = np.ones(len(order), dtype=bool)
    head[1:] = key[1:] != key[:-1]
    for level in range(1, levels):
        alone = head.copy()
        alone[:-1] &= head[1:]
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        group = np.cumsum(head)[tied]
        key = blocks[positions[order[tied]] + 8 * level]
        by = np.lexsort((key, group))
        order[tied] = order[tied[by]]
        key = key[by]
        first = np.ones(len(tied), dtype=bool)
        first[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        head[tied] = first
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.cumsum(head)
    return rank


def _tied(blocks: np.ndarray, starts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows whose leading bytes are found in several documents, group by group, and their groups."""
    leading = mixed((blocks[starts] * _ODD + blocks[starts + 8]) * _ODD + blocks[starts + 16])
    mask = np.uint64((1 << max(1, int(len(starts)).bit_length())) - 1)
    packed = np.sort((leading & ~mask) | np.arange(len(starts), dtype=np.uint64))
    same = (packed[1:] ^ packed[:-1]) <= mask
    member = np.zeros(len(packed), dtype=bool)
    member[1:] |= same
    member[:-1] |= same
    number = (packed[member] & mask).astype(np.int64)
    head = np.ones(len(number), dtype=bool)
    head[1:] = ((packed[member][1:] ^ packed[member][:-1]) > mask)
    group = np.cumsum(head) - 1
    keys = [blocks[starts[number] + k] for k in (0, 8, 16)]
    if any(((k[1:] != k[:-1]) & ~head[1:]).any() for k in keys):
        # Different leading bytes met in a hash of fewer bits: sort by the bytes themselves.
        by = np.lexsort((*keys[::-1], group))
        number, group, keys = number[by], group[by], [k[by] for k in keys]
        head[1:] = (group[1:] != group[:-1]) | np.any([k[1:] != k[:-1] for k in keys], axis=0)
        group = np.cumsum(head) - 1
    if not len(number):
        return number, group
    edges = np.flatnonzero(head)
    several = np.minimum.reduceat(docs[number], edges) < np.maximum.reduceat(docs[number], edges)
    return number[several[group]], group[several[group]]


def _sorted_ties(starts: np.ndarray, group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The order of tied suffixes inside their groups, by cover ranks.

    All groups are split at once, each at its middle member, into suffixes before it, equal
    to it and after it, until the groups that are left have one member.
    """
    order = np.arange(len(starts))
    slots = order.copy()
    while len(slots):
        here = order[slots]
        edge = np.flatnonzero(np.diff(group[slots], prepend=-1))
        sizes = np.diff(np.append(edge, len(slots)))
        mine = starts[here]
        pivot = np.repeat(starts[here[edge + sizes // 2]], sizes)
        shift = _SHIFT[mine % PERIOD, pivot % PERIOD]
        side = np.sign(rank[mine + shift] - rank[pivot + shift]) + 1
        part = np.repeat(np.arange(len(edge)), sizes) * 3 + side
        by = np.argsort(part, kind="stable")
        order[slots] = here[by]
        part = part[by]
        new = np.concatenate([[True], part[1:] != part[:-1]])
        alone = new & np.append(new[1:], True)
        more = ~alone & (part % 3 != 1)
        group[slots] = np.cumsum(new)
        slots = slots[more]
    return order


def _shared(blocks: np.ndarray, runs: Runs) -> np.ndarray:
    """Runs whose key, the least gram of each of its windows, is found in several documents; others share no window."""
    start = runs.offsets[:-1]
    edges = np.stack([start, start + WINDOW - GRAM + 1], axis=1).ravel()
    key = np.minimum.reduceat(_grams(blocks), edges)[::2]
    by = np.argsort(key)
    head = np.flatnonzero(np.concatenate([[True], key[by][1:] != key[by][:-1]]))
    docs = runs.docs[by]
    several = np.minimum.reduceat(docs, head) < np.maximum.reduceat(docs, head)
    found = np.empty(len(by), dtype=bool)
    found[by] = np.repeat(several, np.diff(np.append(head, len(by))))
    return found


def judge(runs: Runs) -> np.ndarray:
    """Whether an equal window starts in a document with a smaller id."""
    padded = np.concatenate([runs.text, np.zeros(128, dtype=np.uint8)])
    blocks = _blocks(padded)
    flags = np.zeros(int(runs.lengths.sum()), dtype=bool)
    shared = _shared(blocks, runs)
    chosen = np.flatnonzero(np.repeat(shared, runs.lengths))
    lengths = runs.lengths[shared]
    starts = np.repeat(runs.offsets[:-1][shared] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    docs = np.repeat(runs.docs[shared], lengths)
    number, group = _tied(blocks, starts, docs)
    if not len(number):
        return flags
    at = starts[number]
    asked = np.zeros(len(padded), dtype=bool)
    asked[at] = True
    before = np.cumsum(asked, dtype=np.int32)
    before[PERIOD:] -= before[:-PERIOD].copy()
    reach = np.flatnonzero(before)
    sample = reach[_IN_COVER[reach % PERIOD]]
    rank = np.zeros(len(padded), dtype=np.int32)
    rank[sample] = ranks(blocks, sample, -(-WINDOW // 8))
    order = _sorted_ties(at, group, rank)
    number, at = number[order], at[order]
    new = np.zeros(len(at), dtype=bool)
    for k in (*range(0, WINDOW - 7, 8), WINDOW - 8):
        key = blocks[at + k]
        new[1:] |= key[1:] != key[:-1]
    new[0] = True
    earliest = np.minimum.reduceat(docs[number], np.flatnonzero(new))[np.cumsum(new) - 1]
    flags[chosen[number]] = docs[number] > earliest
    return flags


RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_bytes")


def remove_repeats(docs: DataFrame, limit: int = BUCKET) -> DataFrame:
    """The documents without ``text``, with n_bytes, n_removed, n_spans and kept_bytes (binary)."""
    kept = [c for c in docs.columns if c not in ("text", *RESULTS)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            rows = []
            for text, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
                data = unzipped(text)
                starts, ends = merged(spans, len(data))
                edges = zip([0, *ends.tolist()], [*starts.tolist(), len(data)], strict=True)
                rest = b"".join(data[a:b] for a, b in edges)
                rows.append((len(data), len(data) - len(rest), len(starts), rest))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            own = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *own], [*kept, *RESULTS])

    fields = [T.StructField(name, T.LongType()) for name in RESULTS[:3]] + [T.StructField(RESULTS[3], T.BinaryType())]
    schema = T.StructType([*(docs.schema[c] for c in kept), *fields])
    marked = with_spans(docs.select(*kept, "text"), covered(docs, BYTES, judge, same_document=False, limit=limit))
    return marked.select(*kept, "_text", "_spans").mapInArrow(run, schema)
