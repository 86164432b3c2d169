from __future__ import annotations

import random

import pytest

SCHEMA = """doc_id long, text string, lang string, source string, n_chars long, digest string, n string, gram int, lines string,
            covered string, others string, node int, component int, piece string, ids string, words string, n_words int, kept string,
            bin int, base string, spans string, name string, runs string, d2 string, x0 string, n_lines string, packed string"""


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["the", "an", "er", "in", "on", "re", "at"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def odd_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty texts, a very long one, copies, near copies, repeated rows, a null id, marks of several bytes."""
    base = prose(1, 300)
    edited = base.split()
    edited[150] = "changed"
    return [
        (1, None),
        (2, ""),
        (3, "  \n\t "),
        (4, "one"),
        (4, "one"),
        (5, prose(2, 30_000)),
        (6, base),
        (7, base),
        (8, " ".join(edited)),
        (9, base.upper()),
        (None, base),
        (None, prose(3, 40)),
        (10, "äöü ß ☃ 😀 \u00a0 end\nline\nline\nline\nline"),
        (11, "a\nb\nc\nd\ne"),
        (12, "x\na\nb\nc\nd\ny"),
        (13, "mail me.x@host.example.org or +1 (234) 555-7890 at 10.0.0.255, card 4111 1111 1111 1111"),
        (14, prose(4, 60) + "\n" + prose(5, 60)),
    ]


def frame(spark, rows):
    """The rows with every column that an operator might use for itself, partly null."""
    full = [
        (i, t, None if k % 3 else "en", None if k % 4 else "s", 7, *["x", "y", 1, "l", "c", "o", 2, 3, "p", "i", "w", 4, "k", 5, "b", "s", "n", "r", "d", "x", "l", "p"])
        for k, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_rows())


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def texts():
    return odd_rows()
