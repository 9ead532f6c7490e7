"""Benchmark decontamination with suffix arrays of the training texts.

Documents are searched in shards of a few MB of whole texts. A shard's words, as
64-bit hashes, get a suffix array; suffixes of the benchmark texts are searched in it by
bisection, all at once. Equal windows of the benchmark are one class and searched once: the
run of the array that starts with a window holds all places where it occurs, so a shard has
no more hits than places. Items are attached to classes, by number, and named at the end. Every
place that is hit is then followed to the end of its match, in the suffix array of the
benchmark, which gives a document's longest verbatim match. A document is judged where it is
read: nothing is shuffled. :func:`longest_matches` searches every suffix to its end and gives
each item's longest verbatim match; one row for each item and task goes to the result.

The benchmark is the query set. It goes to the shards in blocks of bounded size, one
pass over the documents for each block; later passes add to what earlier ones found. What a
block has found is written before the next is collected, so the driver holds one at a time.

Defined results: words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are
lower-cased; null texts have none. A benchmark text of fewer words than a window is one
window; one without words matches nothing. Repeated items count once by id; an item
without an id counts as one with an empty id. Every document row gives one row; other
columns pass through; columns with the names of results are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardvigil.llm.suffixes import suffix_array
from cardvigil.llm.tables import staged
from cardvigil.llm.words import LETTERS_LOWER, pieces, texts, windows, words

WINDOW = 13
#: Bytes of text in a shard, or one document.
SHARD = 4 << 20
#: Bytes of benchmark text that go to the shards at once, about.
BLOCK_BYTES = 16 << 20

#: Stands between texts; no word has this hash.
_END = np.uint64(0)


def _spread(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, an end after each text, and where each text's words start."""
    found = words(data, offsets, LETTERS_LOWER)
    n = len(offsets) - 1
    first = found.first + np.arange(n + 1)
    out = np.full(len(found.starts) + n, _END, dtype=np.uint64)
    place = np.arange(len(found.starts)) + np.repeat(np.arange(n), np.diff(found.first))
    out[place] = np.maximum(found.hashes(), np.uint64(1))
    return out, first


@dataclass(frozen=True)
class Queries:
    """Benchmark words with ends between texts; of each suffix its start, its depth to search and its item's number."""

    tokens: np.ndarray
    starts: np.ndarray
    depths: np.ndarray
    items: list[int | None]
    item: np.ndarray

    @property
    def names(self) -> list[str]:
        return ["" if x is None else str(x) for x in self.items]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]], window: int) -> Queries:
        data, offsets = texts(pa.array([text for _, text in rows], pa.string()))
        tokens, first = _spread(data, offsets)
        starts, depths, item = [], [], []
        for i in range(len(rows)):
            n = int(first[i + 1] - first[i]) - 1
            size = min(n, window)
            if n:
                starts.append(first[i] + np.arange(n - size + 1))
                depths.append(np.full(n - size + 1, size))
                item.append(np.full(n - size + 1, i))
        join = lambda xs: np.concatenate(xs) if xs else np.zeros(0, dtype=np.int64)
        return cls(np.append(tokens, _END), join(starts), join(depths), [x for x, _ in rows], join(item))


@dataclass(frozen=True)
class Windows:
    """The different windows of a block of the benchmark, and its words in order of suffixes."""

    #: One suffix for each window; its item says nothing.
    queries: Queries
    #: The items of window ``i``, by number, are ``items[first[i]:first[i + 1]]``.
    first: np.ndarray
    items: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, found: Queries) -> Windows:
        keys = np.zeros(len(found.starts), dtype=np.uint64)
        for depth in np.unique(found.depths).tolist():
            mine = found.depths == depth
            keys[mine] = windows(found.tokens, depth)[found.starts[mine]] + np.uint64(depth)
        _, one, kind = np.unique(keys, return_index=True, return_inverse=True)
        pairs = np.unique(kind * max(1, len(found.items)) + found.item)
        kind, item = np.divmod(pairs, max(1, len(found.items)))
        single = Queries(found.tokens, found.starts[one], found.depths[one], found.items, found.item[one])
        deepest = int(np.bincount(found.item).max()) + int(found.depths.max()) if len(found.item) else 1
        return cls(single, np.searchsorted(kind, np.arange(len(one) + 1)), item.astype(np.int32), suffix_array(found.tokens, deepest))


def bisect(tokens: np.ndarray, order: np.ndarray, queries: Queries, after: bool) -> np.ndarray:
    """For each query the number of suffixes below it; with ``after``, those that start with it count too."""
    low = np.zeros(len(queries.starts), dtype=np.int64)
    high = np.full(len(queries.starts), len(order), dtype=np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        below = np.full(len(open_), after)
        left, depth = np.arange(len(open_)), 0
        while left.size:
            here = order[middle[left]] + depth
            mine = np.where(here < len(tokens), tokens[np.minimum(here, len(tokens) - 1)], _END)
            theirs = queries.tokens[queries.starts[open_[left]] + depth]
            below[left] = np.where(mine == theirs, below[left], mine < theirs)
            depth += 1
            left = left[(mine == theirs) & (theirs != _END) & (queries.depths[open_[left]] > depth)]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


def longest(tokens: np.ndarray, order: np.ndarray, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """Of each query suffix: the words of its longest verbatim match among the suffixes, and one place of it.

    The longest match is with a neighbour of the place where the suffix would stand.
    """
    whole = Queries(queries.tokens, queries.starts, np.full(len(queries.starts), len(queries.tokens)), queries.items, queries.item)
    at = bisect(tokens, order, whole, after=False)
    best, place = np.zeros(len(at), dtype=np.int64), np.full(len(at), -1)
    for slot in (at - 1, at):
        valid = np.flatnonzero((slot >= 0) & (slot < len(order)))
        start = order[slot[valid]]
        length, left = np.zeros(len(valid), dtype=np.int64), np.arange(len(valid))
        while left.size:
            here, there = start[left] + length[left], queries.starts[valid[left]] + length[left]
            inside = (here < len(tokens)) & (there < len(queries.tokens))
            left, here, there = left[inside], here[inside], there[inside]
            same = (tokens[here] == queries.tokens[there]) & (tokens[here] != _END)
            left = left[same]
            length[left] += 1
        better = length > best[valid]
        best[valid[better]], place[valid[better]] = length[better], start[better]
    return best, place


def _occurrences(tokens: np.ndarray, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """Places where a query occurs, and the query's number."""
    if not len(tokens) or not len(queries.starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    order = suffix_array(tokens, int(queries.depths.max()))
    low, high = bisect(tokens, order, queries, after=False), bisect(tokens, order, queries, after=True)
    count = high - low
    query = np.repeat(np.arange(len(count)), count)
    slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return order[slot], query


def _best(tokens: np.ndarray, queries: Queries, priority: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each item with a match: its number, the longest match's words, where it starts in the item, the least priority of its places."""
    none = np.zeros(0, dtype=np.int64)
    if not len(tokens) or not len(queries.starts):
        return none, none, none, none
    base = np.searchsorted(queries.item, queries.item)
    order = suffix_array(tokens, int(np.bincount(queries.item).max()) + 1)
    length, _ = longest(tokens, order, queries)
    most = np.zeros(len(queries.items), dtype=np.int64)
    np.maximum.at(most, queries.item, length)
    chosen = np.flatnonzero((length > 0) & (length == most[queries.item]))
    if not len(chosen):
        return none, none, none, none
    asked = Queries(queries.tokens, queries.starts[chosen], length[chosen], queries.items, queries.item[chosen])
    low, high = bisect(tokens, order, asked, after=False), bisect(tokens, order, asked, after=True)
    # Suffixes that begin alike share a run of the array; each run is read once.
    runs, run = np.unique(np.stack([low, high], axis=1), axis=0, return_inverse=True)
    least = np.minimum.reduceat(np.append(priority[order], np.iinfo(np.int64).max), runs.ravel())[::2][run.ravel()]
    start = queries.starts[chosen] - queries.starts[base[chosen]]
    by = np.lexsort((start, least, asked.item))
    first = by[np.diff(asked.item[by], prepend=-1) != 0]
    return asked.item[first], asked.depths[first], start[first], least[first]


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_FOUND = T.StructType(
    [
        T.StructField("_bench_words", T.LongType()),
        T.StructField("_bench_spans", _SPANS),
        T.StructField("_bench_items", T.ArrayType(T.IntegerType())),
        T.StructField("_bench_longest", T.StructType([T.StructField("words", T.LongType()), T.StructField("start", T.LongType())])),
    ]
)


def _lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Rows of as many of the values, in order, as counted."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), values)


def _spans(places: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> pa.ListArray:
    """Of each text the stretches of words that are hit."""
    covered = np.zeros(int(first[-1]) + 1, dtype=np.int64)
    np.add.at(covered, places, 1)
    np.add.at(covered, places + sizes, -1)
    edge = np.flatnonzero(np.diff(np.cumsum(covered) > 0, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    of = np.searchsorted(first, starts, "right") - 1
    fields = [pa.array((x - first[of]).astype(np.int32)) for x in (starts, ends)]
    return _lists(pa.StructArray.from_arrays(fields, ["start", "end"]), np.bincount(of, minlength=len(first) - 1))


def _items(found: Windows, doc: np.ndarray, window: np.ndarray, docs: int, base: int) -> pa.ListArray:
    """Of each document the numbers of the items whose windows it holds, each once; one document at a time."""
    met = np.unique(doc * max(1, len(found.queries.starts)) + window)
    doc, window = np.divmod(met, max(1, len(found.queries.starts)))
    parts, counts = [], np.zeros(docs, dtype=np.int64)
    which, begin = np.unique(doc, return_index=True)
    for i, a, b in zip(which, begin, np.append(begin, len(doc))[1:], strict=True):
        held = [found.items[found.first[w] : found.first[w + 1]] for w in window[a:b].tolist()]
        parts.append(np.unique(np.concatenate(held)) + np.int32(base))
        counts[i] = len(parts[-1])
    return _lists(pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32), pa.int32()), counts)


def _followed(found: Windows, tokens: np.ndarray, places: np.ndarray, first: np.ndarray) -> list[dict]:
    """Of each document its longest match with the benchmark that holds a window, and the first place of it."""
    out = [{"words": 0, "start": 0} for _ in range(len(first) - 1)]
    places = np.unique(places)
    if len(places):
        nothing = np.zeros(len(places), dtype=np.int64)
        length, _ = longest(found.queries.tokens, found.order, Queries(tokens, places, nothing, [], nothing))
        doc = np.searchsorted(first, places, "right") - 1
        best = np.lexsort((places, -length, doc))
        best = best[np.diff(doc[best], prepend=-1) != 0]
        for d, n, at in zip(doc[best].tolist(), length[best].tolist(), (places[best] - first[doc[best]]).tolist(), strict=True):
            out[d] = {"words": n, "start": at}
    return out


def _search(columns: list[str], found: Windows, base: int, shard: int):
    """Adds to each row its words and the spans, items and match found in it, after those found before."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", shard):
            tokens, first = _spread(*texts(batch.column("text")))
            place, window = _occurrences(tokens, found.queries)
            doc = np.searchsorted(first, place, "right") - 1
            own = {
                "_bench_words": pa.array(np.diff(first) - 1, pa.int64()),
                "_bench_spans": _spans(place, found.queries.depths[window], first),
                "_bench_items": _items(found, doc, window, batch.num_rows, base),
                "_bench_longest": _followed(found, tokens, place, first),
            }
            if base:
                for name in ("_bench_spans", "_bench_items"):
                    both = [x + y for x, y in zip(batch.column(name).to_pylist(), own[name].to_pylist(), strict=True)]
                    own[name] = pa.array(both, own[name].type)
                before = batch.column("_bench_longest").to_pylist()
                own["_bench_longest"] = [max(x, y, key=lambda m: (m["words"], -m["start"])) for x, y in zip(before, own["_bench_longest"], strict=True)]
            match = pa.struct([("words", pa.int64()), ("start", pa.int64())])
            own["_bench_longest"] = pa.array(own["_bench_longest"], match)
            rest = [c for c in columns if c not in own]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *own.values()], [*rest, *own])

    return run


def _named(columns: list[str], names: list[str]):
    """The items' numbers as how many names they have and a digest of the names, sorted and joined."""
    kinds, rank = np.unique(np.array(names, dtype=object), return_inverse=True) if names else (np.zeros(0, dtype=object), np.zeros(0, dtype=np.int64))
    kinds = [name.encode() for name in kinds.tolist()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, str]] = {b"": (0, hashlib.sha256(b"").hexdigest())}
        for batch in batches:
            items = batch.column("_bench_items")
            ends = np.frombuffer(items.buffers()[1], dtype=np.int32)[items.offset : items.offset + len(items) + 1]
            numbers = items.values.to_numpy()
            found = []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                ranks = np.unique(rank[numbers[a:b]])
                if (key := hashlib.blake2b(ranks.tobytes(), digest_size=16).digest() if len(ranks) else b"") not in known:
                    known[key] = len(ranks), hashlib.sha256(b",".join(kinds[r] for r in ranks.tolist())).hexdigest()
                found.append(known[key])
            if len(known) > 100_000:
                known = {b"": known[b""]}
            own = [pa.array([n for n, _ in found], pa.int64()), pa.array([digest for _, digest in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *own], [*columns, "n_items", "items_sha256"])

    return run


def _longest(queries: Queries, shard: int):
    """Rows (item_id, match) of each item's longest match in a task's documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for batch in pieces(batches, "text", shard):
            tokens, first = _spread(*texts(batch.column("text")))
            ids = batch.column("doc_id").to_pylist()
            ordered = sorted(set(ids), key=lambda x: (x is not None, x))
            number = {x: i for i, x in enumerate(ordered)}
            ranks = np.array([number[x] for x in ids], dtype=np.int64)
            words_ = np.diff(first)
            priority = (np.repeat(ranks, words_) << 32) + np.arange(len(tokens)) - np.repeat(first[:-1], words_)
            for i, n, start, least in zip(*(x.tolist() for x in _best(tokens, queries, priority)), strict=True):
                doc = ordered[least >> 32]
                new = (-n, (doc is not None, doc), least & 0xFFFFFFFF, start)
                best[i] = min(best.get(i, new), new)
        names = ["" if queries.items[i] is None else str(queries.items[i]) for i in best]
        rows = [{"less": n, "doc_id": doc, "doc_start": place, "item_start": start} for n, (_, doc), place, start in best.values()]
        match = pa.struct([("less", pa.int64()), ("doc_id", pa.int64()), ("doc_start", pa.int64()), ("item_start", pa.int64())])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(rows, match)], ["item_id", "match"])

    return run


def longest_matches(docs: DataFrame, items: DataFrame, shard: int = SHARD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, n_words, doc_id, doc_start, item_start): of each item its longest verbatim match in any document, in words.

    Of several as long, the one with the least doc_id (null first), then place in the document,
    then in the item. An item that shares no word has no row; one without an id has an empty id.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "item_id string, match struct<less:long,doc_id:long,doc_start:long,item_start:long>"
    found = None
    n = block_count(items, block_bytes)
    for k in range(n):
        rows = block(items, n, k)
        part = read.mapInArrow(_longest(Queries.of(rows, 1), shard), schema)
        if n > 1:
            part = staged(part, "longest")
        found = part if found is None else found.unionByName(part)
    best = found.groupBy("item_id").agg(F.min("match").alias("match"))
    return best.select("item_id", (-F.col("match.less")).alias("n_words"), "match.doc_id", "match.doc_start", "match.item_start")


def block_count(items: DataFrame, limit: int = BLOCK_BYTES) -> int:
    """Into how many blocks of about ``limit`` bytes the benchmark is dealt."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, math.ceil(total / limit))


def block(items: DataFrame, n: int, k: int) -> list[tuple[int | None, str | None]]:
    """The benchmark's rows of block ``k``."""
    dealt = items.select("item_id", "text").where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
    return [(row.item_id, row.text) for row in dealt.collect()]


def _covered(spans: Column) -> Column:
    """Words in the union of spans."""
    return F.aggregate(
        F.sort_array(spans),
        F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc.to, s.end).alias("to"),
            (acc.n + F.greatest(F.lit(0), s.end - F.greatest(acc.to, s.start))).alias("n"),
        ),
        lambda acc: acc.n,
    )


RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
MATCH = ("spans", "longest_words", "longest_start")


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shard: int = SHARD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents with the columns ``RESULTS`` and ``MATCH``.

    ``spans`` are the stretches of hit words, and ``longest_words`` and ``longest_start`` the
    longest verbatim match that holds a window, in words, and where it first begins; 0 without a hit.
    """
    kept = [c for c in docs.columns if c not in (*RESULTS, *MATCH, *_FOUND.names)]
    found, names = docs.select(*kept), []
    n = block_count(items, block_bytes)
    for k in range(n):
        queries = Queries.of(block(items, n, k), window)
        schema = T.StructType([f for f in found.schema if f.name not in _FOUND.names] + _FOUND.fields)
        found = found.mapInArrow(_search(found.columns, Windows.of(queries), len(names), shard), schema)
        # An empty first block would leave the next one without a base to tell that it is not the first.
        names += queries.names or [""]
        if k + 1 < n:
            found = staged(found, "benchmark-hits")
    columns = [*kept, "_bench_words", "_bench_spans", "_bench_longest"]
    schema = T.StructType([*(found.schema[c] for c in columns), T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType())])
    counted = found.mapInArrow(_named(columns, names), schema).select(
        *kept,
        F.col("_bench_words").alias("n_words"),
        _covered(F.col("_bench_spans")).alias("n_hit"),
        "n_items",
        "items_sha256",
        F.col("_bench_spans").alias("spans"),
        F.col("_bench_longest.words").alias("longest_words"),
        F.col("_bench_longest.start").alias("longest_start"),
    )
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that aren't contaminated, unchanged."""
    own = {c: f"_doc_{c}" for c in docs.columns if c in (*RESULTS, *MATCH, *_FOUND.names)}
    judged = contamination(docs.withColumnsRenamed(own), items, window).where(~F.col("contaminated"))
    return judged.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))
