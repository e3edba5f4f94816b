import random

import pytest

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(n)]


def text(n, seed):
    return " ".join(words(n, seed))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and white texts, ties, repeated rows, a long
    text, and further columns whose names clash with those of results."""
    long = text(6000, 1)
    rows = [
        (1, text(120, 2), "en", "a", 1, 9.0, 3), (2, text(120, 2), "en", "a", 1, 9.0, 3), (2, text(120, 2), "en", "a", 1, 9.0, 3),
        (3, None, "en", "b", 0, 9.0, 3), (4, "", None, None, 0, None, None), (5, " \n\t ", "en", "b", 4, 9.0, 3),
        (None, text(70, 3), "de", None, 7, 9.0, 3), (6, "Ünï \U0001f600 ▁ x", "fr", "b", 9, 9.0, 3), (7, long, "en", "c", 1, 9.0, 3),
        (8, "Licensed under CC BY-NC 4.0.", "en", "c", 1, 9.0, 3), (9, text(60, 2) + " " + text(90, 8), "en", "c", 2, 9.0, 3),
        (10, "one two", "en", None, 2, 9.0, 3), (11, "ONE two", "en", "", 2, 9.0, 3),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, shard int")


@pytest.fixture(scope="session")
def no_documents(awkward):
    return awkward.where("false")
