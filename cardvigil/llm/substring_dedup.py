"""Removes 20-word passages that occur earlier, by compressed FM-indexes.

All 20-word windows are spread over shards (:mod:`cardvigil.llm.segments`). A shard
indexes the runs of text whose rarest gram it holds more than once: suffix array,
Burrows-Wheeler transform, and a wavelet tree over its words with one bit and half a bit
of counts for each word and level. Then the same runs stream through backward search,
all at once, word by word from their ends. The interval of a match grows to the left;
at full length it is the set of all places of the window, and its earliest place tells
whether the window is covered. For the next word the interval is widened to the matches
of one word less. So each position gets its matching statistic, cut at the threshold,
for one step of search.

Defined results: words are `[^\\x20\\x09-\\x0D]+`, unchanged; a null text has none; texts
of fewer words than a window lose nothing. Ids are taken to be unique: for rows that
repeat an id, places are compared as in one document, and what one of them loses at a
place, all of them lose there. A null id is smaller than all others. Input columns with
the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cardvigil.llm.segments import Kind, Runs, covered, merged, unzipped, with_spans
from cardvigil.llm.suffixes import suffix_array
from cardvigil.llm.words import SPACED, Words, pieces, texts, windows, words

WINDOW, GRAM = 20, 5
#: Windows in a shard.
SHARD = 1 << 18


@dataclass(frozen=True)
class SpacedWords:
    first: np.ndarray
    data: np.ndarray
    found: Words
    hashes: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> SpacedWords:
        found = words(data, offsets, SPACED)
        return cls(found.first, data, found, found.hashes())

    def grams(self, low: int, high: int) -> np.ndarray:
        return windows(self.hashes[low:high], GRAM)

    def window_hashes(self, starts: np.ndarray) -> np.ndarray:
        return windows(self.hashes, WINDOW)[starts]

    def bytes_of(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.found.starts[starts], self.found.ends[ends - 1]


WORDS = Kind(WINDOW, WINDOW - GRAM + 1, SpacedWords.of)


class Bits:
    """A bit vector with counts of ones before each 64 bits."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.uint32)
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bits are ones."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletTree:
    """Ranks in a sequence of small numbers, one bit vector for each of their bits."""

    def __init__(self, sequence: np.ndarray, size: int):
        self.levels: list[Bits] = []
        self.depth = max(1, int(size - 1).bit_length())
        for level in reversed(range(self.depth)):
            bits = (sequence >> level) & 1
            self.levels.append(Bits(bits))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])
        symbols = np.arange(size)
        self.start = self._descend(symbols, np.zeros(size, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in zip(reversed(range(self.depth)), self.levels, strict=True):
            ones = bits.ones(at).astype(np.int64)
            at = np.where((symbol >> level) & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the first ``at`` places."""
        return self._descend(symbol, at) - self.start[symbol]


class FMIndex:
    """Backward search in a sequence of word numbers, where 0 separates texts and ends the last."""

    def __init__(self, tokens: np.ndarray, size: int, depth: int):
        self.order = suffix_array(tokens, depth + 1)
        self.tree = WaveletTree(tokens[self.order - 1], size)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(tokens, minlength=size))])

    def whole(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the suffixes that start with a word."""
        return self.smaller[symbol], self.smaller[symbol + 1]

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of a match with one more word before it."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        begin = self.smaller[symbol]
        return begin + both[: len(symbol)], begin + both[len(symbol) :]


def _edges(tokens: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Places in suffix order where the first ``depth`` words change, and the end."""
    padded = np.concatenate([tokens, np.zeros(depth, dtype=tokens.dtype)]).astype(np.uint64)
    key = windows(padded, depth)[order]
    return np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(order)]])


def covered_windows(tokens: np.ndarray, size: int, begin: np.ndarray, length: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each token whether the window that starts there is a run's and has an earlier place.

    Runs are ``tokens[begin:begin + length]``; ``place`` orders the tokens' places.
    """
    index = FMIndex(tokens, size, WINDOW)
    same = _edges(tokens, index.order, WINDOW)
    earliest = np.empty(len(tokens), dtype=np.int64)
    earliest[same[:-1]] = np.minimum.reduceat(place[index.order], same[:-1])
    wide = _edges(tokens, index.order, WINDOW - 1)
    flags = np.zeros(len(tokens), dtype=bool)
    by = np.argsort(-length, kind="stable")
    begin, length = begin[by], length[by]
    low, high = index.whole(tokens[begin + length - 1])
    for done in range(1, int(length.max())):
        active = int(np.searchsorted(-length, -done, "left"))
        at = begin[:active] + length[:active] - 1 - done
        low, high = low[:active], high[:active]
        if done >= WINDOW:
            group = np.searchsorted(wide, low, "right")
            low, high = wide[group - 1], wide[group]
        low, high = index.step(tokens[at], low, high)
        if done >= WINDOW - 1:
            flags[at] = earliest[low] < place[at]
    return flags


def judge(runs: Runs) -> np.ndarray:
    """Whether a window starts earlier, in a smaller document or at a smaller place of the same."""
    found = words(runs.text, runs.offsets, SPACED)
    hashes = found.hashes()
    count = np.diff(found.first)
    flags = np.zeros(int(runs.lengths.sum()), dtype=bool)
    kept = np.flatnonzero(_recurring(hashes, found.first))
    if not len(kept):
        return flags
    ends = np.cumsum(count[kept] + 1)
    begin = ends - count[kept] - 1
    run = np.repeat(np.arange(len(kept)), count[kept])
    inside = np.arange(len(run)) - np.repeat(np.cumsum(count[kept]) - count[kept], count[kept])
    source = found.first[kept][run] + inside
    _, number = np.unique(hashes[source], return_inverse=True)
    tokens = np.zeros(int(ends[-1]), dtype=np.int64)
    tokens[begin[run] + inside] = number + 1
    doc, where = runs.docs[kept][run], runs.place[kept][run] + inside
    order = np.lexsort((where, doc))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (where[order][1:] != where[order][:-1])
    place = np.full(len(tokens), np.iinfo(np.int64).max)
    place[(begin[run] + inside)[order]] = np.cumsum(new)
    hit = covered_windows(tokens, int(number.max()) + 2, begin, count[kept], place)
    window = inside < count[kept][run] - WINDOW + 1
    first = np.cumsum(runs.lengths) - runs.lengths
    flags[(first[kept][run] + inside)[window]] = hit[(begin[run] + inside)[window]]
    return flags


def _recurring(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Runs whose key, the least gram of each of its windows, is also another run's or stands twice in the run."""
    grams = windows(hashes, GRAM)
    start, stop = first[:-1], first[1:] - GRAM + 1
    edges = np.stack([start, start + WINDOW - GRAM + 1], axis=1).ravel()
    key = np.minimum.reduceat(np.append(grams, np.uint64(2**64 - 1)), edges)[::2]
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    run = np.repeat(np.arange(len(start)), stop - start)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(stop - start) - (stop - start), stop - start) + start[run]
    own = np.bincount(run[grams[inside] == key[run]], minlength=len(start))
    return (count[which] > 1) | (own > 1)


RESULTS = ("n_words", "n_removed", "kept_text")


def remove_passages(docs: DataFrame, limit: int = SHARD) -> DataFrame:
    """The documents without ``text``, with n_words, n_removed and kept_text (kept words, joined by one space)."""
    kept = [c for c in docs.columns if c not in ("text", *RESULTS)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            data, offsets = texts(pa.array([unzipped(t) for t in batch.column("_text").to_pylist()], pa.large_binary()))
            found = words(data, offsets, SPACED)
            view = data.tobytes()
            rows = []
            for i, spans in enumerate(batch.column("_spans").to_pylist()):
                low, high = int(found.first[i]), int(found.first[i + 1])
                starts, ends = merged(spans, high - low)
                rest = np.ones(high - low, dtype=bool)
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                    rest[a:b] = False
                begin, end = found.starts[low:high][rest].tolist(), found.ends[low:high][rest].tolist()
                text = b" ".join([view[a:b] for a, b in zip(begin, end, strict=True)]).decode()
                rows.append((high - low, high - low - len(begin), text))
            kinds = (pa.int64(), pa.int64(), pa.string())
            own = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *own], [*kept, *RESULTS])

    fields = [T.StructField(name, T.LongType()) for name in RESULTS[:2]] + [T.StructField(RESULTS[2], T.StringType())]
    schema = T.StructType([*(docs.schema[c] for c in kept), *fields])
    marked = with_spans(docs.select(*kept, "text"), covered(docs, WORDS, judge, same_document=True, limit=limit))
    return marked.select(*kept, "_text", "_spans").mapInArrow(run, schema)
