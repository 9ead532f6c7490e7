"""Ranked lexical search with hashed max-sketches and exact rescoring.

The index holds one sketch for each document: an array of cells into which every term is
hashed a few times, and a cell keeps the greatest impact that fell into it. Inside a document
the impact of a term grows with its occurrences alone, so a cell stores occurrences, and the
index stays valid while the corpus' own counts change. The least of a term's cells bounds its
impact from above, and is nearly always exact: cells are many and mostly empty.

Queries go to the index in blocks. Looked up for a batch of sketches at once, the terms give
each document's upper bound for each query; weights and lengths enter as numbers. The
different texts with the highest bounds are scored exactly first, and the score at the last
rank that they and their copies fill is the threshold: every document whose bound does not
fall below it is scored exactly too. So the ranking is exact, only texts with a bound that high
are read again, and a large group of copies hides no other text. Top lists are cut within
tasks, then within salted groups, then for each query, so that no group grows with the documents.

Defined results: terms are `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+` after A-Z are
lower-cased; null texts have none. Every row of ``docs`` is a document of its own, rows that
repeat an id too; a null id ranks behind others of the same score. Rows of ``queries`` that
repeat an id are one query with the terms of all of them, and a null id is an id like others. A
query without terms, or none of whose terms occurs, has no rows, and so does an empty table.
Other columns, of whatever name, are not read. Terms are told apart by 64-bit hash where
documents are counted, and by their characters where scores are taken.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardvigil.llm.tables import staged
from cardvigil.llm.words import LETTERS_LOWER, give_back, pieces, texts, words

TOP = 50
#: Cells of a sketch for each different term, at least; a power of two of them, so at most twice as many.
CELLS, LEAST_CELLS = 16, 1024
PROBES = 6
#: The greatest number of occurrences that a cell tells exactly; it stands for all above.
MOST = 255
#: Different texts of the highest bounds that are scored for each query before there is a threshold.
FIRST = 2 * TOP
#: Terms and queries that are searched together, about, and (document, term) pairs looked at at once.
BLOCK_TERMS, BLOCK_QUERIES, LOOKUPS = 200_000, 2_000, 1 << 22
#: Bytes of sketches that are unpacked at once, or one.
UNPACKED = 1 << 25

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(rb"[0-9a-z\x80-\xFF]+")


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text, with repeats, as UTF-8."""
    return _TERM.findall((text or "").encode().lower())


def impact(tf, m):
    """What an occurrence count adds to a score for each unit of weight, in integers."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def length_norm(n, docs: int, terms: int):
    """A document's length against the mean one, in integers."""
    return 50 + (50 * n * docs) // terms


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def probes(hashes: np.ndarray, cells: int) -> np.ndarray:
    """Row by row the cells of each hash, one column for each probe."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(PROBES, dtype=np.uint64)
    return ((hashes[:, None] + step[:, None] * turns) & np.uint64(cells - 1)).astype(np.int64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The max-sketch of a document with these terms, at least one."""
    kinds, times = np.unique(hashes, return_counts=True)
    cells = max(LEAST_CELLS, 1 << (CELLS * len(kinds) - 1).bit_length())
    out = np.zeros(cells, dtype=np.uint8)
    rising = np.argsort(times, kind="stable")
    # Of several values for one cell the last is kept, which is the greatest.
    out[probes(kinds[rising], cells).ravel()] = np.repeat(np.minimum(times[rising], MOST), PROBES)
    return out


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 1 << 20):
        data, offsets = texts(batch.column("text"))
        found = words(data, offsets, LETTERS_LOWER)
        hashes = found.hashes()
        some = np.flatnonzero(np.diff(found.first))
        if len(some):
            pack = zstandard.ZstdCompressor(level=1).compress
            cells = [pack(sketch(hashes[found.first[i] : found.first[i + 1]]).tobytes()) for i in some]
            kept = batch.select(["doc_id", "text_hash"]).take(pa.array(some))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(np.diff(found.first)[some].astype(np.int64)), pa.array(cells, pa.binary())],
                ["doc_id", "text_hash", "n", "sketch"],
            )


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def index(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n, sketch) of every row that has a term, written to the shared folder."""
    return staged(_documents(docs).mapInArrow(_sketches, "doc_id long, text_hash long, n long, sketch binary"), "sketches")


@dataclass(frozen=True)
class Block:
    """Queries by number, their different terms, and for each term the queries that hold it."""

    terms: list[bytes]
    hashes: np.ndarray
    #: The queries of term ``i`` are ``queries[first[i]:first[i + 1]]``.
    first: np.ndarray
    queries: np.ndarray
    size: int
    weights: np.ndarray | None = None
    docs: int = 0
    total: int = 0

    @classmethod
    def of(cls, pairs: list[tuple[int, str]], size: int) -> Block:
        named = sorted((term.encode(), query) for query, term in pairs)
        terms = sorted({term for term, _ in named})
        data, offsets = texts(pa.array([t.decode() for t in terms], pa.string()))
        hashes = words(data, offsets, LETTERS_LOWER).hashes()
        counts = Counter(term for term, _ in named)
        first = np.cumsum([0, *(counts[t] for t in terms)])
        return cls(terms, hashes, first, np.array([q for _, q in named], dtype=np.int64), size)

    def weighted(self, df: dict[int, int], docs: int, total: int) -> Block:
        weights = np.array([weight(docs, df.get(i, 0)) for i in range(len(self.terms))], dtype=np.int64)
        return replace(self, weights=weights, docs=docs, total=total)

    @cached_property
    def of_query(self) -> list[list[tuple[bytes, int]]]:
        """Of each query its terms and their weights."""
        found: list[list[tuple[bytes, int]]] = [[] for _ in range(self.size)]
        for i, (term, value) in enumerate(zip(self.terms, self.weights.tolist(), strict=True)):
            for query in self.queries[self.first[i] : self.first[i + 1]].tolist():
                found[query].append((term, value))
        return found

    def bounds(self, sketches: np.ndarray, n: np.ndarray) -> np.ndarray:
        """No less than the score of each document (row, with ``n`` terms) for each query (column)."""
        at = probes(self.hashes, sketches.shape[1])
        seen = sketches[:, at[:, 0]]
        for k in range(1, PROBES):
            np.minimum(seen, sketches[:, at[:, k]], out=seen)
        doc, term = np.nonzero(seen)
        times = seen[doc, term].astype(np.int64)
        times = np.where(times == MOST, n[doc], times)
        gain = self.weights[term] * impact(times, length_norm(n[doc], self.docs, self.total))
        held = np.diff(self.first)[term]
        place = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held) + np.repeat(self.first[term], held)
        cell = np.repeat(doc * self.size, held) + self.queries[place]
        # Sums of integers below 2**53 are exact in doubles.
        sums = np.bincount(cell, weights=np.repeat(gain, held), minlength=len(n) * self.size)
        return sums.reshape(len(n), self.size).astype(np.int64)

    def scores(self, text: str, queries: list[int]) -> dict[int, int]:
        """Exact scores of a text for these queries, those above 0."""
        found = terms_of(text)
        m = length_norm(len(found), self.docs, self.total)
        times = Counter(found)
        out = {q: sum(value * impact(times[term], m) for term, value in self.of_query[q] if term in times) for q in queries}
        return {query: score for query, score in out.items() if score > 0}


def _document_frequencies(block: Block):
    """Rows (term, df): in how many of a task's documents each of the block's terms occurs."""
    order = np.argsort(block.hashes)
    known = block.hashes[order]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(known), dtype=np.int64)
        for batch in pieces(batches, "text", 1 << 20):
            found = words(*texts(batch.column("text")), LETTERS_LOWER)
            hashes = found.hashes()
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = np.flatnonzero(known[at] == hashes)
            doc = np.searchsorted(found.first, hit, "right") - 1
            df += np.bincount(np.unique(doc * len(known) + at[hit]) % len(known), minlength=len(known))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(order[some].astype(np.int32)), pa.array(df[some])], ["term", "df"])

    return run


def _chunks(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of the index with sketches of one size, ``limit`` rows at most, and their sketches."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        packed = batch.column("sketch").to_pylist()
        size = np.array([zstandard.frame_content_size(x) for x in packed], dtype=np.int64)
        for cells in np.unique(size).tolist():
            rows = np.flatnonzero(size == cells)
            step = max(1, min(limit, UNPACKED // cells))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                joined = b"".join(unpack(packed[i]) for i in part.tolist())
                yield batch.take(pa.array(part)), np.frombuffer(joined, dtype=np.uint8).reshape(len(part), cells)


def _limit(block: Block) -> int:
    return max(1, LOOKUPS // max(1, len(block.queries)))


#: Stands for a null id where ids are compared.
_BEHIND = np.iinfo(np.int64).max
_FOUND = "query int, doc_id long, text_hash long, bound long"


def _found(block: Block, query: np.ndarray, part: dict[str, np.ndarray], row: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    null = part["null"][row]
    return pa.RecordBatch.from_arrays(
        [pa.array(query.astype(np.int32)), pa.array(part["doc_id"][row], mask=null), pa.array(part["text_hash"][row]), pa.array(bound)],
        ["query", "doc_id", "text_hash", "bound"],
    )


def _columns(part: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {
        "doc_id": part.column("doc_id").fill_null(0).to_numpy(),
        "null": part.column("doc_id").is_null().to_numpy(zero_copy_only=False),
        "text_hash": part.column("text_hash").to_numpy(),
        "n": part.column("n").to_numpy(),
    }


def _highest(shared, many: int):
    """Of a task's documents those with the ``many`` highest bounds for each query, one for each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        best = np.zeros((0, block.size), dtype=np.int64)
        rows = {c: np.zeros((0, block.size), dtype=t) for c, t in (("doc_id", np.int64), ("null", bool), ("text_hash", np.int64))}
        for part, sketches in _chunks(batches, _limit(block)):
            own = _columns(part)
            # A text that is held for any query has been compared for all of them.
            _, new = np.unique(own["text_hash"], return_index=True)
            new = new[~np.isin(own["text_hash"][new], rows["text_hash"])]
            both = np.concatenate([best, block.bounds(sketches[new], own["n"][new])])
            spread = {c: np.concatenate([rows[c], np.broadcast_to(own[c][new][:, None], (len(new), block.size))]) for c in rows}
            if len(both) > many:
                top = np.argpartition(-both, many - 1, axis=0)[:many]
                both = np.take_along_axis(both, top, axis=0)
                spread = {c: np.take_along_axis(x, top, axis=0) for c, x in spread.items()}
            best, rows = both, spread
        at, query = np.nonzero(best)
        flat = {c: x[at, query] for c, x in rows.items()}
        yield _found(block, query, flat, np.arange(len(query)), best[at, query])
        give_back()

    return run


def _reaching(shared, scores: np.ndarray, ids: np.ndarray):
    """Documents whose bound is over a query's threshold, or equal to it with an id that is no larger."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        for part, sketches in _chunks(batches, _limit(block)):
            own = _columns(part)
            bound = block.bounds(sketches, own["n"])
            place = np.where(own["null"], _BEHIND, own["doc_id"])
            may = (bound > scores) | ((bound == scores) & (place[:, None] <= ids))
            row, query = np.nonzero(may & (bound > 0))
            yield _found(block, query, own, row, bound[row, query])
        give_back()

    return run


def _top(found: DataFrame, order: list[Column], many: int, name: str) -> DataFrame:
    """The first ``many`` rows of each query, in order, numbered: salted groups first."""
    salts = max(1, math.isqrt(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(salts)))
    within = salted.withColumn(name, F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(F.col(name) <= many)
    return within.withColumn(name, F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col(name) <= many).drop("salt")


def _with_copies(sketches: DataFrame, scored: DataFrame, many: int) -> DataFrame:
    """The scored texts' documents, for each text the ``many`` first by id."""
    # At most as many texts as there are first candidates of a block's queries.
    texts_ = F.broadcast(scored.select(F.col("text_hash").alias("_hash")).distinct())
    copies = sketches.select("doc_id", "text_hash").join(texts_, F.col("text_hash") == F.col("_hash")).drop("_hash")
    salted = copies.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    first = F.col("doc_id").asc_nulls_last()
    for keys in (["text_hash", "salt"], ["text_hash"]):
        salted = salted.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(first))).where(F.col("nth") <= many)
    return salted.select("doc_id", "text_hash").join(scored.select("query", "text_hash", "score"), "text_hash")


def _exact(docs: DataFrame, wanted: DataFrame, shared, few: bool = False) -> DataFrame:
    """(query, doc_id, text_hash, score) of the wanted pairs whose score is above 0, taken from the texts.

    ``few``: the wanted documents are bounded by the block and may be broadcast.
    """
    # At most as many queries as a block has.
    asked = wanted.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_set("query").alias("queries"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    read = _documents(docs).join(F.broadcast(asked) if few else asked, same).select("doc_id", "text_hash", "queries", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        for batch in pieces(batches, "text", 1 << 20):
            query, row, score = [], [], []
            for i, (text, queries) in enumerate(zip(batch.column("text").to_pylist(), batch.column("queries").to_pylist(), strict=True)):
                for q, s in block.scores(text or "", queries).items():
                    query.append(q)
                    row.append(i)
                    score.append(s)
            part = batch.select(["doc_id", "text_hash"]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int32()), *part.columns, pa.array(score, pa.int64())], ["query", "doc_id", "text_hash", "score"]
            )

    return read.mapInArrow(run, "query int, doc_id long, text_hash long, score long")


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, term): the different terms of each query."""
    lower = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return queries.select("item_id", F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def blocks(queries: DataFrame, at_most: int = BLOCK_TERMS) -> Iterator[tuple[list, Block]]:
    """Ids and terms of about ``at_most`` terms of queries at a time; a query is never split."""
    pairs = staged(query_terms(queries), "query-terms")
    size = pairs.groupBy("item_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("queries"), F.sum("n").alias("terms")).first()
    n = max(1, math.ceil((size.terms or 0) / at_most), math.ceil(size.queries / BLOCK_QUERIES))
    for k in range(n):
        rows = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()
        ids = sorted({row.item_id for row in rows}, key=lambda x: (x is not None, x))
        number = {x: i for i, x in enumerate(ids)}
        if rows:
            yield ids, Block.of([(number[row.item_id], row.term) for row in rows], len(ids))


def _ranking() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash")]


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, first: int = FIRST, at_most: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each query, best first."""
    spark = docs.sparkSession
    kind = queries.schema["item_id"].dataType.simpleString()
    result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    sketches = index(docs)
    corpus = sketches.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not corpus.docs:
        return result
    for ids, block in blocks(queries, at_most):
        counted = docs.select("text").mapInArrow(_document_frequencies(block), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
        shared = spark.sparkContext.broadcast(block.weighted({r.term: r.df for r in counted.collect()}, corpus.docs, corpus.terms))
        bounds = [F.col("bound").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash")]
        found = sketches.mapInArrow(_highest(shared, first), _FOUND).dropDuplicates(["query", "text_hash"])
        highest = staged(_top(found, bounds, first, "nth"), "highest")
        known = staged(_exact(docs, highest, shared, few=True).dropDuplicates(["query", "text_hash"]), "scored")
        scored = _top(_with_copies(sketches, known, top), _ranking(), top, "rank")
        scores, last = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
        for row in scored.where(F.col("rank") == top).collect():
            scores[row["query"]], last[row["query"]] = row.score, _BEHIND if row.doc_id is None else row.doc_id
        reaching = staged(sketches.mapInArrow(_reaching(shared, scores, last), _FOUND), "reaching")
        ranked = _top(_exact(docs, reaching, shared), _ranking(), top, "rank")
        # One row for each query of the block.
        names = spark.createDataFrame(list(enumerate(ids)), f"_query int, item_id {kind}")
        named = ranked.join(F.broadcast(names), F.col("query") == F.col("_query"))
        result = result.unionByName(named.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return result
