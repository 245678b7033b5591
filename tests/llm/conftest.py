import random

import pytest


@pytest.fixture()
def words():
    """A maker of texts of invented words."""
    rng = random.Random(11)
    parts = ["ka", "lo", "mi", "ren", "tus", "vel", "dor", "ash", "ei", "qui"]
    vocabulary = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(400)]
    return lambda n, seed=0: " ".join(random.Random(seed).choices(vocabulary, k=n))


@pytest.fixture()
def documents(spark):
    """A table like ``documents`` from (doc_id, text) rows, with further columns whose names operators use too."""

    def make(rows):
        full = [(i, t, None, "src0", None if t is None else len(t), 0.5, 7, "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "score double, sequence_id long, row string")

    return make
