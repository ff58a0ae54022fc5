"""Small tables with the odd rows that every operator must take."""

from __future__ import annotations

import random

import pytest

WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(text: str, seed: int, n: int) -> str:
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
    return " ".join(words)


def odd_texts() -> list[tuple[int | None, str | None]]:
    """NULL and blank texts, ties, repeated rows, a NULL id, copies, near copies and a very long text."""
    base = prose(1, 300)
    rows = [
        (1, base), (2, base), (3, edited(base, 2, 4)), (4, edited(base, 3, 5)), (5, edited(base, 4, 40)),
        (6, None), (7, ""), (8, " \t\n"), (9, "one two"), (10, "one two"), (11, "One  TWO"), (12, "one two three four five"),
        (13, prose(5, 200)), (13, prose(5, 200)), (14, prose(6, 150)), (14, prose(7, 150)), (None, base), (None, prose(8, 90)),
        (15, prose(9, 30_000)), (16, "Ünïcödé tëxt " * 20), (17, "a" * 500), (18, "日本語のテキスト" * 30), (19, "12345 !!! ???"),
    ]
    return [*rows, *((20 + i, edited(base, 50 + i, 3)) for i in range(12))]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with the columns of documents and further ones whose names operators use inside."""
    rows = [(i, t, "en", "s" if k % 3 else None, len(t or ""), "z", k) for k, (i, t) in enumerate(odd_texts())]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, set_id string, score int"
    ).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark, odd):
    return spark.createDataFrame([], odd.schema)
