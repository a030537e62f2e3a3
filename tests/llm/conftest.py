import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """documents of (doc_id, text) pairs, or of whole rows."""

    def make(rows):
        full = [(r[0], r[1], "en", f"s{i % 3}", len(r[1] or "")) if len(r) == 2 else r for i, r in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic invented prose."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice(["ba", "ko", "li", "tu", "re", "sha", "non", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(600)]

    def write(seed, words):
        r = random.Random(seed)
        return " ".join(r.choice(vocabulary) for _ in range(words))

    return write
