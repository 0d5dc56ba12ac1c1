import numpy as np
import pytest

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, score string, seed int, kept string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns with clashing names."""
    rng = np.random.default_rng(5)
    words = ["the", "of", "und", "der", "les", "que", "ción", "änd", "x1", "haus", "maison", "casa", "house", "river", "stone", "cloud"]
    prose = [" ".join(rng.choice(words, 60)) for _ in range(12)]
    long = " ".join(rng.choice(words, 30_000))
    texts = [None, "", "   ", "!!! 123", "é", *prose, prose[0], prose[0], prose[1] + " tail", "a" * 3000, long, long]
    rows = [(i, t, ["en", "de", None][i % 3], "s", 1, 9, "c", 7, "k") for i, t in enumerate(texts)]
    rows += [rows[6], (None, prose[2], "en", None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
