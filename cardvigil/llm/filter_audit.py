"""Filter interaction audit: what each filter removes in every order of the filters.

Each document is read once and becomes a pattern: the set of filters it fails. Patterns are
counted per part, which is all that any order of the filters depends on. From the counts the
removals of all coalitions (subsets of the filters) are tabulated. An order's steps are
differences of coalitions: a filter removes what the coalition with it removes beyond the
one before it. A filter's Shapley value, its mean removal over all orders, is the solution
of a least squares problem: the additive game that is nearest to the tabulated one, coalitions
weighted by the Shapley kernel, whose values add up to the removal of all filters together.
Its normal equations are solved in rationals, so the values are exact.

Whether a text occurred before is asked of the whole table: texts meet as 256 bits of hash,
the smallest id of each is found by a partial aggregate, and a document looks for the pair
of its hash and its own id among those, so that a text that a third of all documents share
is no hot key. Only ids, hashes, parts and bits are shuffled, no text.

Defined results: a null text is empty and has no words, so it fails ``A`` only, and ``E``
where a smaller id has an empty or null text. Rows that repeat an id are documents of their
own, none of which is smaller than another. A null id is neither smaller nor larger than any
and has no label. An id labelled more than once counts as labelled so in any of its labels.
A null part is the empty string; a table without rows has no part. Other columns, of
whatever name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardvigil.llm.tables import staged

SPACE = " \t\n\x0b\x0c\r"
MIN_WORDS = 100
#: Percent of words that are different, at least, and of code points that are A-Z, at most.
DISTINCT, CAPITALS = 80, 10
SYMBOLS = "[#$%&*|]"

#: Filters by name, in the order of their bits; ``E`` compares documents and has no own test.
NAMES = "ABCDE"


def _tests(text: Column, words: Column) -> dict[str, Column]:
    """Of each filter that looks at one text: whether it fails."""
    n = F.size(words)
    return {
        "A": n < MIN_WORDS,
        "B": F.lit(100).cast("long") * F.size(F.array_distinct(words)) < F.lit(DISTINCT).cast("long") * n,
        "C": F.lit(100).cast("long") * F.regexp_count(text, F.lit("[A-Z]")) > F.lit(CAPITALS).cast("long") * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def judged(docs: DataFrame, part: str) -> DataFrame:
    """(doc_id, part, hash, pattern): the filters that each text fails by itself, as bits."""
    read = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    stripped = F.btrim(F.col("text"), F.lit(SPACE))
    words = F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, r"[\x20\x09-\x0D]+"))
    # A step of its own, so that words are split once and not once for each use.
    split = read.withColumn("words", words)
    tests = _tests(F.col("text"), F.col("words"))
    pattern = sum((test.cast("int") * (1 << NAMES.index(name)) for name, test in tests.items()), F.lit(0))
    return split.select(F.col("doc_id").cast("long").alias("doc_id"), "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("hash"), pattern.alias("pattern"))


def patterns(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, pattern, n, good, toxic): documents by the filters they fail, and how many are labelled so."""
    rows = staged(judged(docs, part), "audit")
    first = rows.groupBy("hash").agg(F.min("doc_id").alias("doc_id"))
    known = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), "good", "toxic")
    # Rows without an id match nothing, so they need not meet in one place to find that out.
    named, nameless = rows.where("doc_id IS NOT NULL"), rows.where("doc_id IS NULL")
    marked = named.join(first.withColumn("is_first", F.lit(True)), ["hash", "doc_id"], "left").join(known, "doc_id", "left")
    again = F.col("is_first").isNull().cast("int") * (1 << NAMES.index("E"))
    found = marked.select("part", (F.col("pattern") + again).alias("pattern"), "good", "toxic")
    found = found.unionByName(nameless.select("part", "pattern"), allowMissingColumns=True)
    zero = F.lit(0).cast("long")
    return found.groupBy("part", "pattern").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), zero).alias("good"), F.coalesce(F.sum("toxic"), zero).alias("toxic")
    )


def coalitions(counts: dict[int, int], filters: int) -> list[int]:
    """By each coalition, as bits, how many of the counted documents fail one of its filters."""
    return [sum(n for pattern, n in counts.items() if pattern & members) for members in range(1 << filters)]


def solve(rows: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system of linear equations."""
    table = [[*row, value] for row, value in zip(rows, right, strict=True)]
    for k in range(len(table)):
        pivot = next(i for i in range(k, len(table)) if table[i][k])
        table[k], table[pivot] = table[pivot], table[k]
        table[k] = [x / table[k][k] for x in table[k]]
        for i, row in enumerate(table):
            if i != k and row[k]:
                table[i] = [x - row[k] * y for x, y in zip(row, table[k], strict=True)]
    return [row[-1] for row in table]


def shapley(removed: list[int], filters: int) -> list[Fraction]:
    """Each filter's mean removal over all orders.

    Minimises sum of w(S) * (v(S) - sum of x in S)^2 over all coalitions S but none and all,
    with w(S) the Shapley kernel, where the x add up to v(all): the normal equations with one
    multiplier for that condition.
    """
    everyone = (1 << filters) - 1
    if filters == 1:
        return [Fraction(removed[everyone])]
    rows = [[Fraction(0)] * (filters + 1) for _ in range(filters + 1)]
    right = [Fraction(0)] * filters + [Fraction(removed[everyone])]
    for members in range(1, everyone):
        size = members.bit_count()
        weight = Fraction(filters - 1, comb(filters, size) * size * (filters - size))
        inside = [i for i in range(filters) if members >> i & 1]
        for i in inside:
            right[i] += weight * removed[members]
            for k in inside:
                rows[i][k] += weight
    for i in range(filters):
        rows[i][filters] = rows[filters][i] = Fraction(1)
    return solve(rows, right)[:filters]


def steps(part: str, counted: list[tuple[int, int, int, int]], names: str = NAMES) -> Iterator[tuple]:
    """Rows of all orders' steps in a part whose patterns are counted as (pattern, n, good, toxic)."""
    bits = {name: 1 << i for i, name in enumerate(names)}
    every = sum(bits.values())
    total = sum(n for _, n, _, _ in counted)
    removed, good, toxic = (coalitions({row[0]: row[k] for row in counted}, len(names)) for k in (1, 2, 3))
    values = {name: value * factorial(len(names)) for name, value in zip(names, shapley(removed, len(names)), strict=True)}
    assert all(value.denominator == 1 for value in values.values())
    for order in permutations(names):
        before = 0
        for step, name in enumerate(order, 1):
            after = before | bits[name]
            here = removed[after] - removed[before]
            yield (
                part, "".join(order), step, name, total - removed[after], here, removed[bits[name]] - here, removed[every] - removed[every ^ bits[name]],
                good[after] - good[before], toxic[after] - toxic[before], int(values[name]),
            )
            before = after


COLUMNS = ("part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
_ARROW = pa.schema(
    [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), ("filter", pa.string()), *((c, pa.int64()) for c in COLUMNS[4:])]
)


def _orders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            counted = [(x["pattern"], x["n"], x["good"], x["toxic"]) for x in row["counted"]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*steps(row["part"], counted), strict=True), _ARROW, strict=True)], schema=_ARROW)


def interactions(counted: DataFrame) -> DataFrame:
    """All orders' steps of each part, from its patterns: at most 32 rows go into one."""
    of_part = counted.groupBy("part").agg(F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("counted"))
    return of_part.mapInArrow(_orders, SCHEMA)


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row for each part, order of the filters and step, with the columns ``COLUMNS``."""
    return interactions(patterns(docs, labels, part))
