"""Chat formatting with a compiled template, and reading the output back.

Turns of a conversation are rendered in order to one text with a loss mask: the spans
that the template marks as generated. Control strings inside texts are escaped, so the
output has exactly the template's own, and the reader gets every turn back.

A conversation streams through its task row by row; what is held is one turn and a part
of output. The digests chain over a conversation's turns, so a conversation, however
long, stays in one task, in bounded memory.

Defined results: null texts and roles are empty; rows that tie on ``turn`` are ordered
by role and text, and repeated rows are turns of their own; rows without ``conv_id`` are
one conversation. Other input columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardvigil.llm.template import Piece, compiled
from cardvigil.llm.words import pieces

#: Strings that only the template may write.
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</ROLE>>", "<</SYS>>")
TEMPLATE = (
    "{{ bos }}{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %} {% generation %}{{ m.text | escape }}{% endgeneration %} </s>"
    "{% else %}<<SYS>> {{ m.role | escape }} <</ROLE>> {{ m.text | escape }} <</SYS>>{% endif %}"
    "{% endfor %}"
)
CONSTANTS = {"bos": "<s>"}
#: Characters of output in a row, or one piece.
PART = 1 << 16

_CONTROL = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))


def escape(text: str) -> str:
    """A backslash after the first character of each control string and of each backslash."""
    return _CONTROL.sub(lambda found: f"{found[0][0]}\\{found[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip}


def _messages(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, dict[str, str]]]:
    for batch in pieces(batches, "text"):
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            yield conv, {"role": role or "", "text": text or ""}


def _parts(rendered: Iterable[Piece], size: int) -> Iterator[tuple[str, list[dict[str, int]]]]:
    """Pieces gathered to parts, with the generated spans of each."""
    texts: list[str] = []
    spans: list[dict[str, int]] = []
    length = 0
    for text, generated in rendered:
        if generated and text:
            spans.append({"start": length, "end": length + len(text)})
        texts.append(text)
        length += len(text)
        if length >= size:
            yield "".join(texts), spans
            texts, spans, length = [], [], 0
    yield "".join(texts), spans


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _rows(rows: Iterable[tuple], size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    length = 0
    for row in rows:
        held.append(row)
        length += len(row[2]) + 64
        if length >= 16 * size:
            yield _batch(held)
            held, length = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, part, text, spans = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.int64()), pa.array(part, pa.int32()), pa.array(text, pa.string()), pa.array(spans, _SPANS)],
        ["conv_id", "part", "formatted", "loss"],
    )


def format_conversations(turns: DataFrame, template: str = TEMPLATE, part: int = PART) -> DataFrame:
    """(conv_id, part, formatted, loss): a conversation's output is its parts in order.

    Rows come out grouped by conversation and in order of ``part``; ``loss`` has spans
    of code points in ``formatted``, and no text is cut at a part's end.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template, CONSTANTS, FILTERS)

        def rows() -> Iterator[tuple]:
            for conv, group in groupby(_messages(batches), key=lambda x: x[0]):
                for n, (text, spans) in enumerate(_parts(render(m for _, m in group), part)):
                    yield conv, n, text, spans

        yield from _rows(rows(), part)

    ordered = (
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.select("conv_id", "role", "text").mapInArrow(
        run, "conv_id long, part int, formatted string, loss array<struct<start:int,end:int>>"
    )


class Reader:
    """Gets turns back from output that arrives in parts."""

    #: How a turn begins, ends, and where its role ends.
    FORMS = (("[INST] ", " [/INST]", "user"), (" ", " </s>", "assistant"), ("<<SYS>> ", " <</SYS>>", None))

    def __init__(self) -> None:
        self.rest = ""
        self.begun = False

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """The turns (role, text) that end in what has come so far."""
        self.rest += text
        at = 0
        if not self.begun and self.rest.startswith(CONSTANTS["bos"]):
            self.begun, at = True, len(CONSTANTS["bos"])
        while turn := self._turn(at):
            role, body, at = turn
            yield role, body
        self.rest = self.rest[at:]

    def _turn(self, at: int) -> tuple[str, str, int] | None:
        for opening, closing, role in self.FORMS:
            if not self.rest.startswith(opening, at):
                continue
            start = at + len(opening)
            stop = self.rest.find(closing, start)
            if stop < 0:
                return None
            body = self.rest[start:stop]
            if role is None:
                role, _, body = body.partition(" <</ROLE>> ")
            return unescape(role), unescape(body), stop + len(closing)
        return None

    def finish(self) -> None:
        if self.rest:
            raise ValueError(f"output that is no turn: {self.rest[:100]!r}")


def read_back(formatted: DataFrame) -> DataFrame:
    """A row for each conversation: digests of the turns and of the loss text, read from the output.

    ``formatted`` is as ``format_conversations`` returns it, in its order.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")), strict=True)

        found: list[tuple] = []
        for conv, group in groupby(parts(), key=lambda x: x[0]):
            reader, turns, loss = Reader(), hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, text, spans in group:
                chars += len(text)
                for role, body in reader.feed(text):
                    n_turns += 1
                    turns.update(f"{role}\n{body}\n".encode())
                for span in spans:
                    learned = unescape(text[span["start"] : span["end"]])
                    loss_chars += len(learned)
                    loss.update(learned.encode())
            reader.finish()
            found.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(found) == 10_000:
                yield _digests(found)
                found = []
        if found:
            yield _digests(found)

    return formatted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)
