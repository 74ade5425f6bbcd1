import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and other columns whose names the operators use themselves."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    long = " ".join(word() for _ in range(9000))
    base = " ".join(word() for _ in range(120))
    rows = [
        (0, None, "en", "a", 1), (1, "", "en", "a", 1), (2, " \n\t ", None, None, 1), (3, long, "en", "a", 1), (4, base, "de", "b", 1),
        (5, base, "de", "b", 1), (5, base, "de", "b", 1), (6, base + " more words here", "de", "b", 1), (None, "no id here", "fr", "c", 1),
        (7, "One two", "en", "a", 1), (8, "one TWO", "en", "a", 1), (9, "x" * 250, "en", "c", 1), (10, "\n".join(["same line"] * 30), "en", "c", 1),
        (11, "<|endoftext|> a  b c", "en", "c", 1), (12, "wort\x00los 日本語 " * 40, "en", "c", 1),
    ]
    return spark.createDataFrame([(*r, 7, "t", 9) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, size int, key string, root int")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
