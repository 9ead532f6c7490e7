"""Elements of JSON array files of any size, one row each; no file is ever held as a whole.

Files are read as text cut behind every closing brace, which Spark does in parallel also
within a file. In an array of flat records each piece is one element, whatever else: that
is checked file by file, on counts, with a piece of text that a brace in a string or an
object inside an element would give away. Files that are not like that are read by one task
each, in order, an element at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUT = "}"
_LEADING = r"^[\s,\[]+"
_ROWS = 1000


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start, nth, size): text up to each closing brace, in order of start and nth within its file."""
    return spark.read.text(path, lineSep=CUT).select(
        "value",
        F.input_file_name().alias("file"),
        F.input_file_block_start().alias("start"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("_metadata.file_size").alias("size"),
    )


def _is_one_record():
    """A piece that, with its brace, is a flat object after what separates elements."""
    bare = F.regexp_replace(F.regexp_replace("value", r"\\.", ""), _LEADING, "")
    quotes = F.length(bare) - F.length(F.translate(bare, '"', ""))
    return bare.rlike(r"^\{[^{\[]*$") & (quotes % 2 == 0)


def odd_files(cut: DataFrame) -> DataFrame:
    """(file, is_cut): files that hold more than flat records, and whether their last piece ends with a brace."""
    counted = cut.groupBy("file", "size").agg(
        F.count("*").alias("pieces"),
        F.sum(F.octet_length("value") + len(CUT)).alias("bytes"),
        F.count_if(_is_one_record()).alias("records"),
        F.max_by(F.regexp_replace("value", r"[\s\],]+", ""), F.struct("start", "nth")).alias("last"),
    )
    is_cut = F.col("bytes") == F.col("size")
    whole = F.when(is_cut, F.col("records") == F.col("pieces")).otherwise(
        (F.col("records") == F.col("pieces") - 1) & (F.col("last") == "")
    )
    return counted.filter(~whole).select("file", is_cut.alias("is_cut"))


_QUOTED = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_MARK = re.compile(r'["{}\[\],]')


class Elements:
    """Splits the text of one file, as it comes, into the elements of its array.

    Text outside an array is taken object by object.
    """

    def __init__(self) -> None:
        self.held: list[str] = []
        self.depth = 0
        self.in_array = self.quoted = False

    def _take(self, text: str) -> Iterator[str]:
        self.held.append(text)
        element = "".join(self.held).strip()
        self.held = []
        if element:
            yield element

    def feed(self, text: str) -> Iterator[str]:
        at = begin = 0
        while at < len(text):
            if self.quoted:
                if (end := _QUOTED.match(text, at)) is None:
                    break
                at, self.quoted = end.end(), False
            if (mark := _MARK.search(text, at)) is None:
                break
            at, kind = mark.end(), mark[0]
            if kind == '"':
                self.quoted = True
            elif kind in "{[":
                if kind == "[" and self.depth == 0:
                    yield from self._take(text[begin : mark.start()])
                    self.in_array, begin = True, at
                self.depth += 1
            elif kind in "}]":
                self.depth = max(0, self.depth - 1)
                if self.depth == 0:
                    ends_array = self.in_array and kind == "]"
                    yield from self._take(text[begin : mark.start() if ends_array else at])
                    self.in_array, begin = self.in_array and not ends_array, at
            elif self.depth == 1 and self.in_array:
                yield from self._take(text[begin : mark.start()])
                begin = at
        self.held.append(text[begin:])

    def rest(self) -> Iterator[str]:
        """What is left where a file ends."""
        yield from self._take("")


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of files whose pieces come in order, one file after the other."""

    def found() -> Iterator[str]:
        file, reader, waiting, is_cut = None, Elements(), None, True
        for batch in batches:
            for name, value, cut in zip(*(batch.column(c).to_pylist() for c in ("file", "value", "is_cut")), strict=True):
                if name != file:
                    if waiting is not None:
                        yield from reader.feed(waiting + (CUT if is_cut else ""))
                        yield from reader.rest()
                    file, reader, is_cut = name, Elements(), cut
                elif waiting is not None:
                    yield from reader.feed(waiting + CUT)
                waiting = value
        if waiting is not None:
            yield from reader.feed(waiting + (CUT if is_cut else ""))
            yield from reader.rest()

    rows: list[str] = []
    for element in found():
        rows.append(element)
        if len(rows) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])
            rows = []
    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(value): the elements of all arrays in the files, as text; what can't be an element is one too.

    An array cut short ends with what is left of its last element. Records outside an array are
    taken one by one. An empty file has no element.
    """
    cut = pieces(spark, path)
    odd = odd_files(cut)
    flat = cut.join(odd, "file", "left_anti").select(F.regexp_replace("value", _LEADING, "").alias("value"))
    flat = flat.filter(F.col("value").startswith("{")).select(F.concat("value", F.lit(CUT)).alias("value"))
    rest = cut.join(odd, "file").repartition("file").sortWithinPartitions("file", "start", "nth")
    return flat.unionAll(rest.select("file", "value", "is_cut").mapInArrow(_in_order, "value string"))
