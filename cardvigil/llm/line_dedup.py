"""Drops lines that many documents share, in DataFrame functions only.

A line's key is the line stripped of ASCII white space and lower-cased (A-Z). A key
of enough code points that occurs in enough documents loses all its lines except
those of the largest ``doc_id`` holding it.

Keys travel as 128 bits of hash, never as text. Hashes are range-partitioned and
sorted within a partition by document and position, and a window streams over them:
of a key, the first occurrences in the last three documents go on. The range also
covers a slice of the documents, so that a line found in a third of all documents is
spread over thousands of ranges; the slices of a key then meet as a few rows each. What is
known of a shared key goes back to the slices it occurs in, and its lines are found there,
slice by slice. Decisions come back as keep bitmaps, 64 lines to a word, words that keep everything
left out, and only at the end meet the texts.

Defined results: a null or empty text is one empty line. Documents are counted by
``doc_id``: rows that repeat an id count once and all rows of the largest id keep
their lines; null ids count as one document, smaller than all others. Every input row
gives one output row. Other input columns are kept; ``text``, ``n_lines`` and
``n_dropped`` are the operator's. Lines are told apart by 128-bit hash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardvigil.llm.tables import staged

MIN_CHARS = 20
MIN_DOCS = 3
#: Slices of the documents that a key's occurrences are split by.
SLICES = 4096

SPACE = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(stripped) == F.length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(
        F.translate(stripped, string.ascii_uppercase, string.ascii_lowercase)
    )


def _hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row for each line that can be shared: two hashes, document, text hash, position."""
    lines = docs.select(
        F.col("doc_id"), F.xxhash64("text").alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), "key").alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).cast("int").alias("slice"),
        "doc_id",
        "text_hash",
        "pos",
    )


def first_occurrences(hashed: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, slice, doc_id): of each key and slice the first occurrences in the last ``min_docs`` documents."""
    ranged = hashed.repartitionByRange("h1", "h2", "slice")
    stream = Window.partitionBy("h1", "h2", "slice").orderBy(F.col("doc_id").desc_nulls_last(), "pos")
    firsts = (
        ranged.select(
            "h1",
            "h2",
            "slice",
            "doc_id",
            F.dense_rank().over(stream).alias("nth"),
            F.lag(F.struct("doc_id")).over(stream).alias("before"),
        )
        .where((F.col("nth") <= min_docs) & ~F.struct("doc_id").eqNullSafe(F.col("before")))
    )
    return firsts.select("h1", "h2", "slice", "doc_id")


def shared_keys(firsts: DataFrame, min_docs: int) -> DataFrame:
    """Keys of at least ``min_docs`` documents, with the largest document of each, once for each slice they occur in."""
    shared = (
        firsts.groupBy("h1", "h2")
        .agg(F.max("doc_id").alias("last"), F.count("*").alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )
    # A key has as many rows here as slices, however many lines it has.
    return firsts.select("h1", "h2", "slice").distinct().join(shared.drop("n_docs"), ["h1", "h2"])


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_hash, keep): words of 64 lines that lose some, ordered, as (word, bits)."""
    hashed = staged(_hashed_lines(docs, min_chars), "lines")
    shared = shared_keys(staged(first_occurrences(hashed, min_docs), "first-lines"), min_docs)
    dropped = hashed.join(shared, ["h1", "h2", "slice"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    words = dropped.groupBy("doc_id", "text_hash", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.bitwise_not(F.bit_or(F.expr("shiftleft(1L, pos % 64)"))).alias("bits")
    )
    return words.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def _dense(keep: Column) -> Column:
    """The words of a bitmap up to its last, left-out ones filled with ones."""
    gaps = F.transform(
        keep,
        lambda x, i: F.concat(
            F.array_repeat(F.lit(-1).cast("long"), x.word - F.when(i == 0, F.lit(-1)).otherwise(F.get(keep, i - 1).word) - 1),
            F.array(x.bits),
        ),
    )
    return F.flatten(gaps)


def drop_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents without their shared lines, with ``n_lines`` (before) and ``n_dropped``."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("_line_doc"),
        F.col("text_hash").alias("_line_hash"),
        _dense(F.col("keep")).alias("_line_keep"),
    )
    joined = docs.join(
        bitmaps,
        F.col("doc_id").eqNullSafe(F.col("_line_doc")) & (F.xxhash64("text") == F.col("_line_hash")),
        "left",
    )
    kept = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    split = joined.select(*kept, _lines(F.col("text")).alias("_line_all"), "_line_keep")
    of_line = lambda i: F.coalesce(F.get(F.col("_line_keep"), F.floor(i / 64).cast("int")), F.lit(-1).cast("long"))
    remaining = F.when(F.col("_line_keep").isNull(), F.col("_line_all")).otherwise(
        F.filter("_line_all", lambda _, i: F.getbit(of_line(i), i % 64) == 1)
    )
    done = split.select(*kept, F.size("_line_all").cast("long").alias("n_lines"), remaining.alias("_line_left"))
    return done.select(
        *kept,
        F.array_join("_line_left", "\n").alias("text"),
        "n_lines",
        (F.col("n_lines") - F.size("_line_left")).alias("n_dropped"),
    ).select(*docs.columns, *(c for c in ("n_lines", "n_dropped") if c not in docs.columns))
