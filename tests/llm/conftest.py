import random

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [(1, "one two three four five six seven", 1, "a"), (2, None, 2, "b"), (3, "", 3, "c"), (None, "one two", 4, "d"),
            (4, "   \n\t ", 5, None), (5, "word " * 40_000, 6, "e"), (6, "word " * 40_000, 7, "e"),
            (7, "mail a.b@c.org now", 8, "f"), (7, "mail a.b@c.org now", 8, "f"), (None, None, None, None)]
    return spark.createDataFrame(rows, DOCS + ", n_entities int, kept string")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice([2, 3, 4, 5, 7, 9]))) for _ in range(n))
