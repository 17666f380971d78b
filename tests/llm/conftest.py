import string

import pytest


@pytest.fixture(scope="session")
def vocabulary_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def frame(spark):
    """Rows (doc_id, text) with further columns whose names clash with internal ones."""

    def make(rows, parts=3):
        wide = [(i, t, 7, "x", None) for i, t in rows]
        schema = "doc_id long, text string, _row int, score string, ids string"
        return spark.createDataFrame(wide, schema).repartition(parts)

    return make


@pytest.fixture(scope="session")
def prose():
    """A function giving ``n`` words that depend on the seed."""
    import random

    def make(n, seed):
        rng = random.Random(seed)
        return " ".join(
            "".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 7))) for _ in range(n)
        )

    return make


#: Rows that every operator must take: null key, null text, empty, blanks, repeated rows.
ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "alone here"), (4, "one two"), (4, "one two"), (None, None)]


@pytest.fixture
def odd():
    return list(ODD)
