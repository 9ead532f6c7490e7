import hashlib
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardvigil.llm import chat
from cardvigil.llm.template import Const, TemplateError, Text, compiled, fold, parse

FILTERS = chat.FILTERS


def render(source, messages, constants=None):
    return list(compiled(source, constants or {}, FILTERS)(iter(messages)))


def text_of(source, messages=(), constants=None):
    return "".join(t for t, _ in render(source, messages, constants))


MESSAGES = [{"role": "user", "text": "a"}, {"role": "assistant", "text": " b "}, {"role": "user", "text": "c"}]


def test_rendering():
    assert text_of("{% for m in messages %}{{ m.role }}={{ m.text | trim }};{% endfor %}", MESSAGES) == "user=a;assistant=b;user=c;"
    loops = "{% for m in messages %}{% if loop.first %}<{% endif %}{{ m.text }}{% if not loop.last %},{% else %}>{% endif %}{% endfor %}"
    assert text_of(loops, MESSAGES) == "<a, b ,c>"
    branch = "{% for m in messages %}{% if m.role == 'user' and m.text != 'c' %}1{% elif m.role == 'assistant' or loop.last %}2{% else %}3{% endif %}{% endfor %}"
    assert text_of(branch, MESSAGES) == "122"


def test_generation_markers():
    source = "x{% for m in messages %}{% generation %}{{ m.text }}{% endgeneration %}|{% endfor %}"
    assert render(source, MESSAGES[:2]) == [("x", False), ("a", True), ("|", False), (" b ", True), ("|", False)]


def test_constants_are_folded():
    tree = fold(parse("a{{ 'b' + bos }}{% if on == 'no' %}never{% else %}c{% endif %}d", FILTERS), {"bos": "<s>", "on": "yes"}, FILTERS)
    assert tree == (Text("ab<s>cd"),)
    assert fold(parse("{{ 'x<s>' | escape }}", FILTERS), {}, FILTERS) == (Text("x<\\s>"),)
    assert fold(parse("{% if '' or not '' %}y{% endif %}", FILTERS), {}, FILTERS) == (Text("y"),)
    assert fold(Const("z"), {}, FILTERS) == Const("z")


@pytest.mark.parametrize(
    "source",
    [
        "{{ m.__class__ }}", "{{ m.text.upper }}", "{{ open('x') }}", "{{ m.text | eval }}", "{% import os %}", "{{ 1 }}",
        "{% for m in messages %}", "{% endfor %}", "{% if x %}", "{% else %}", "{% for m in m.text %}{% endfor %}", "{{ (a }}",
    ],
)
def test_what_is_not_in_the_language(source):
    with pytest.raises(TemplateError):
        parse(source, FILTERS)


def test_messages_are_not_held_together():
    seen = []

    def messages():
        for i in range(5):
            seen.append(i)
            yield {"role": "user", "text": str(i)}

    pieces = compiled("{% for m in messages %}{{ m.text }}{% endfor %}", {}, FILTERS)(messages())
    next(pieces)
    assert seen == [0, 1]


PARTS = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "/", ">", " ", "a", "é", "\n", "💧"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(PARTS)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a b", "</s>", ""]), PARTS), max_size=6), st.integers(1, 40))
def test_reader_gets_every_turn_back(turns, cut):
    pieces = compiled(chat.TEMPLATE, chat.CONSTANTS, FILTERS)({"role": r, "text": t} for r, t in turns)
    pieces = list(pieces)
    output = "".join(t for t, _ in pieces)
    reader, got = chat.Reader(), []
    for at in range(0, len(output), cut):
        got += reader.feed(output[at : at + cut])
    reader.finish()
    assert got == turns
    assert [chat.unescape(t) for t, generated in pieces if generated] == [t for r, t in turns if r == "assistant"]


def expected(rows):
    out = []
    key = lambda r: (r[0] is not None, r[0] or 0)
    for conv, group in groupby(sorted(rows, key=lambda r: (*key(r), r[1], r[2] or "", r[3] or "")), key=lambda r: r[0]):
        turns = [(r or "", t or "") for _, _, r, t in group]
        loss = "".join(t for r, t in turns if r == "assistant")
        body = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(body.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edge_conversations(spark, rows):
    given = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", "tie"), (2, 0, None, "no role"), (None, 0, "user", "no id"),
        (3, 5, "assistant", "</s>[INST] \\ <s>" * 3), (3, 5, "assistant", "</s>[INST] \\ <s>" * 3), (4, 0, "user", "long " * 50_000),
        (4, 1, "assistant", "é💧" * 60_000), (4, 2, "tool", "<</ROLE>> x"),
    ]
    turns = spark.createDataFrame([(*r, "x", 1) for r in given], "conv_id long, turn long, role string, text string, part string, formatted int")
    formatted = chat.format_conversations(turns)
    assert formatted.where("conv_id = 4").count() > 1
    got = rows(chat.read_back(formatted), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == expected(given)
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0
