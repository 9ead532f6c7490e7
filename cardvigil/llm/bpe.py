"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut before encoding where the split pattern must cut anyway: between a
character that is no white space and a following blank. No match of the pattern holds
white space after another character, so the parts' ids are the whole text's ids, and
memory follows the part. Very long runs of white space, on which the library's pattern gives
up, are cut out as the pattern would match them: all of a run is one match but its last
character, which goes with the text behind it; at the end of a text, all of it. Decoding joins the tokens' raw bytes, so texts that end
inside a character or split one over tokens come back byte by byte.

Defined results: a null text is empty and has no ids; repeated rows and null ids are
kept as they are; other columns pass through, columns named ``n_tokens``, ``ids`` or
``decoded`` are replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cardvigil.llm.words import pieces

RANKS = "byte_bpe_50k.tiktoken"
#: Characters after which a long text is cut at the next safe place.
PART = 1 << 16
_SAFE = re.compile(r"(?<=\S)(?=[ \t\n])")
#: Characters of white space in a row from which they are cut out; the library reads ten times as many.
RUN = 1 << 16
#: The characters that are white space in the split pattern.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Matches a text as one piece.
_WHOLE = "(?s:.+)"


@cache
def codec(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file (lines of base64 bytes and rank), once for a process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts that can be encoded apart."""
    at = 0
    while len(text) - at > size and (cut := _SAFE.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


@cache
def _long_runs(run: int) -> re.Pattern:
    return re.compile(f"(?<![{_WHITE}])[{_WHITE}]{{{run},}}")


@dataclass(frozen=True)
class Codec:
    """An encoding by a split pattern, and the same ranks for a piece that is not split."""

    split: tiktoken.Encoding
    whole: tiktoken.Encoding

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        return cls(codec(path, pattern), codec(path, _WHOLE))

    def ids(self, text: str, run: int = RUN) -> Iterator[list[int]]:
        """The text's ids, part by part; white space from ``run`` characters on is cut out."""
        at = 0
        for found in _long_runs(run).finditer(text) if len(text) >= run else ():
            end = found.end() - (found.end() < len(text))
            yield from map(self.split.encode_ordinary, parts(text[at : found.start()]))
            yield self.whole.encode_ordinary(text[found.start() : end])
            at = end
        yield from map(self.split.encode_ordinary, parts(text[at:]))


def ids_of(encoding: Codec, text: str) -> bytes:
    """The text's ids as little-endian unsigned 32-bit integers."""
    return b"".join(np.asarray(ids, dtype="<u4").tobytes() for ids in encoding.ids(text))


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Replaces ``text`` by ``n_tokens`` (long) and ``ids`` (binary, little-endian unsigned 32-bit)."""
    path = path or public_tokenizers.path(RANKS)
    kept = [c for c in docs.columns if c not in ("text", "n_tokens", "ids")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = Codec.of(path, pattern)
        for batch in pieces(batches, "text"):
            ids = [ids_of(encoding, text or "") for text in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                [*kept, "n_tokens", "ids"],
            )

    schema = T.StructType(
        [*(docs.schema[c] for c in kept), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )
    return docs.select(*kept, "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Adds ``decoded`` (binary): the raw bytes of the tokens in ``ids``; null ids give none."""
    path = path or public_tokenizers.path(RANKS)
    kept = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = codec(path, pattern)
        for batch in batches:
            texts = [
                None if ids is None else encoding.decode_bytes(np.frombuffer(ids, dtype="<u4").tolist())
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.binary())], [*kept, "decoded"])

    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField("decoded", T.BinaryType())])
    return encoded.select(*kept).mapInArrow(run, schema)
