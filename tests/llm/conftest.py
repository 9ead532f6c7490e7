import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Columns whose names the operators use themselves.
    "key string, bucket long, node long, pos long, line string, spans string, n_words long, kept string, "
    "n_lines string, n_dropped string, `order` string, contaminated string, n_bytes string"
)

SENTENCE = "the quick brown fox jumps over the lazy dog while seventeen grey geese fly south along the slow river to the sea"
OTHER = "a second passage that has nothing in common with the first one and goes on for quite some time about boats and their owners"
SHARED_LINE = "  This Line Is Shared By Many Documents\t"


def edge_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows, odd characters, shared lines and passages."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (4, SENTENCE),
        (5, SENTENCE),
        (5, SENTENCE),
        (6, f"{SENTENCE} {OTHER}\n{SHARED_LINE}\nend"),
        (7, f"{SHARED_LINE.strip().upper()}\nÉté à Öland {SENTENCE}"),
        (8, f"{SHARED_LINE}\n{SHARED_LINE}\n\n{OTHER}"),
        (9, "word"),
        (10, "Ünïcödé 💧   text   with [INST] </s> \\ <s>"),
        (11, " ".join(f"{w}{i}" for i in range(4000) for w in ("long", "text", "the", "and"))),
        (12, "x" * 300),
        (13, ("y " * 200).strip()),
        (None, SENTENCE),
        (None, None),
        (14, f"{OTHER} {SENTENCE.replace('geese', 'ducks')}"),
        (15, f"{SHARED_LINE}\n" + "z" * 60 + "\n" + "z" * 60),
        (-3, f"{OTHER}\r\nminus three"),
    ]


@pytest.fixture(scope="session")
def edge_rows():
    return edge_texts()


@pytest.fixture
def make_docs(spark):
    """Documents with clashing extra columns."""

    def make(rows):
        full = [(i, t, "en", "s", None, *(["x"] + [9] * 3 + ["x", "x", 9] + ["x"] * 6)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture
def edge_docs(make_docs, edge_rows):
    return make_docs(edge_rows)


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


@pytest.fixture
def rows():
    return rows_of
