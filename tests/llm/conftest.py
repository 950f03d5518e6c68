from __future__ import annotations

import random

import pytest

from journey.session import get_spark

DOCS_DDL = ("doc_id long, text string, lang string, source string, n_chars long, n_words string, text_ string, key int, "
            "__host string, __blob string, __key string, __spans string, __clean string, host string, blob int, spans string, clean string")


@pytest.fixture(scope="session")
def spark():
    yield get_spark("*", shuffle_partitions=4, app="journey-llm-tests")


def documents(spark, texts):
    """A documents table with extra columns whose names clash with working names."""
    rows = [(i, t, "en" if (i or 0) % 2 else None, f"src{(i or 0) % 3}" if (i or 1) % 5 else None, len(t or ""), "x", "y", 7, *["z"] * 5, "h", 5, "s", "c")
            for i, t in texts]
    return spark.createDataFrame(rows, DOCS_DDL)


def prose(seed, n, words=400):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(words)]
    return [rng.choice(vocab) for _ in range(n)]


#: nulls, empty, blanks only, short, very long, ties and repeated rows
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "é" * 70_000), (7, " ".join(prose(1, 30_000))),
        (8, "A b c d e f"), (8, "A b c d e f"), (9, "a B C d e F"), (10, "x\x00y   z"), (11, "\U0001f600 a@b.co")]
