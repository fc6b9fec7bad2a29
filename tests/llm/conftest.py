"""Small documents with every odd case the operators promise to handle."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = (
    "the harbour lies quiet under a pale sky while boats drift toward open water and gulls call over roofs "
    "that shine with rain from last night as children run along stones counting waves until evening comes"
).split()


def sentence(seed: int, size: int) -> str:
    """Words in an order that the seed decides, the same in every run."""
    state = seed * 2654435761 % (1 << 32)
    out = []
    for _ in range(size):
        state = (state * 1664525 + 1013904223) % (1 << 32)
        out.append(WORDS[(state >> 16) % len(WORDS)])
    return " ".join(out)


@pytest.fixture
def odd_rows():
    """Null in any column, empty and blank texts, repeated rows, a hot source, one long text."""
    rows = [(i, sentence(i, 40 + i % 30), "en", "hot" if i % 3 else f"s{i % 7}", 10) for i in range(60)]
    return rows + [
        (100, None, "en", "hot", 0),
        (101, "", "en", "hot", 0),
        (102, " \n\t \n", "en", None, 5),
        (103, sentence(3, 43), "en", "hot", 10),
        (103, sentence(3, 43), "en", "hot", 10),
        (104, sentence(4, 44), None, None, None),
        (None, sentence(5, 45), "en", "s1", 10),
        (None, None, None, None, None),
        (105, sentence(77, 20_000), "en", "hot", 100_000),
        (106, "Äpfel ümläut ß 漢字 \U0001f600 é", "de", "s2", 30),
        (107, "x", "en", "s2", 1),
    ]


@pytest.fixture
def odd_docs(spark, odd_rows):
    """The rows with further columns, of many types, whose names operators use inside."""
    more = (
        "size long, fp string, score double, grade int, tie array<long>, copies map<string,int>, gone date, salt boolean, "
        "of timestamp, line struct<a:int>, target decimal(9,2), component_id binary"
    )
    rest = ("x", 0.5, 7, [1, 2], {"k": 1}, date(2024, 1, 2), True, datetime(2024, 1, 2, 3), (4,), Decimal("1.25"), b"y")
    rows = [(*r, i, *rest) for i, r in enumerate(odd_rows)]
    return spark.createDataFrame(rows, f"{DOCUMENTS}, {more}").repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
