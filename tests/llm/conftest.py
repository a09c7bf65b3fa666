import pytest


@pytest.fixture
def documents(spark):
    """Makes a table of documents with columns whose names could clash with an operator's own."""

    def make(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t), -1.0, "x", 7) for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, key string, size int"
        )

    return make


def prose(rng, n, words=None):
    words = words or [a + b for a in "an er the on st in re".split() for b in "a ion ly ed ing ou sh wh".split()]
    return " ".join(rng.choice(words) for _ in range(n))
