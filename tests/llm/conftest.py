import random

import pytest


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, lang, source]) with a column whose name clashes with inner ones."""

    def make(rows):
        rows = [(r[0], r[1], *(list(r[2:]) + ["en", "s"][len(r) - 2:]), "clash", 1) for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key string, h long")

    return make


@pytest.fixture
def rng():
    return random.Random(20240607)


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


VOCABULARY = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu") for b in ("rn", "st", "ll", "nd", "mé", "x")]
