"""Words of many texts at once, as numpy arrays over the texts' UTF-8 bytes.

All separators are ASCII, so words are found on bytes. A word's hash is 64 bits of a
polynomial over a random table of byte values, mixed; equal words have equal hashes
wherever they stand.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once, as far as rows allow.
PIECE = 4 << 20
#: Bytes that are hashed at once.
BLOCK = 1 << 20
#: Bytes of a word up to which its hash is a polynomial.
SHORT = 64

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Alphabet:
    """Byte by byte: what it is read as, and whether it belongs to words."""

    read: np.ndarray
    in_word: np.ndarray


def _alphabet(lower: bool, in_word: Iterable[int]) -> Alphabet:
    read = np.arange(256, dtype=np.uint8)
    if lower:
        read[ord("A") : ord("Z") + 1] += 32
    flags = np.zeros(256, dtype=bool)
    flags[list(in_word)] = True
    return Alphabet(read, flags[read])


_SPACES = {0x20, *range(0x09, 0x0E)}
#: `[^\x20\x09-\x0D]+`, as it stands or lower-cased.
SPACED = _alphabet(False, set(range(256)) - _SPACES)
SPACED_LOWER = _alphabet(True, set(range(256)) - _SPACES)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, lower-cased.
LETTERS_LOWER = _alphabet(True, {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)})


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all their bits."""
    part = x >> np.uint64(30)
    x = np.bitwise_xor(x, part)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=part)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=part)
    return x


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows in a row, and where each row starts (one more at the end). Null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = texts(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    give_back()


def joined(batches: Iterable[pa.RecordBatch], column: str, least: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``least`` bytes of text, but for the last."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += int(texts(batch.column(column))[1][-1]) if batch.num_rows else 0
        if size >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def give_back() -> None:
    """Hands memory that this worker has freed back to the machine: idle workers live on."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, made once for a process."""

    up: np.ndarray | None = None
    down: np.ndarray | None = None

    @classmethod
    def get(cls) -> tuple[np.ndarray, np.ndarray]:
        if cls.up is None:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                powers = np.full(BLOCK + 1, base, dtype=np.uint64)
                powers[0] = 1
                setattr(cls, name, np.multiply.accumulate(powers))
        return cls.up, cls.down


def _digest(span: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(span.tobytes(), digest_size=8).digest(), "little")


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, short: int | None = None) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``; starts and ends are in order.

    Polynomials modulo 2**64 of long spans can be made to collide whatever the base is. Spans
    of more than ``short`` bytes get a cryptographic hash; that is for spans that don't overlap.
    """
    up, down = _Powers.get()
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        if ends[at] - low > BLOCK:
            out[at] = _digest(data[low : int(ends[at])])
            at += 1
            continue
        to = int(np.searchsorted(ends, low + BLOCK, "right"))
        block = data[low : int(ends[to - 1])]
        sums = np.empty(len(block) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[block] * up[: len(block)], out=sums[1:])
        a, b = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        at = to
    for i in np.flatnonzero(ends - starts > short).tolist() if short is not None else ():
        out[i] = _digest(data[int(starts[i]) : int(ends[i])])
    return out


@dataclass(frozen=True)
class Words:
    """Byte spans of the words, and of each text the numbers of its words: ``first[i]`` to ``first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    read: np.ndarray

    def hashes(self) -> np.ndarray:
        return span_hashes(self.read, self.starts, self.ends, SHORT)


def words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    """The words of texts that lie one after the other; none crosses from a text to the next."""
    inside = alphabet.in_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] |= inside[edges]
    stops = np.zeros(len(data) + 1, dtype=bool)
    stops[1:] = inside
    stops[1:-1] &= ~inside[1:]
    stops[edges] |= inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops), np.searchsorted(starts, offsets), alphabet.read[data])


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each ``size`` consecutive ones; the last ``size - 1`` places have none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    factor = np.uint64(1)
    for k in range(size):
        total += hashes[k : k + n] * factor
        factor = np.uint64(int(factor) * _BASE % 2**64)
    return mixed(total)
