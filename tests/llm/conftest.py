import random

import pytest

#: Columns of documents, and some that clash with names the operators use inside or return.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "kept string, n_words string, size string, t1 string, node string, topic string, ids string")


@pytest.fixture
def documents(spark):
    """A frame of documents from texts; sources and languages repeat and are sometimes null."""
    def make(texts, parts=3, ids=None):
        rows = [
            (i if ids is None else ids[i], t, [None, "en", "de"][i % 3], ["a", "b", None, "a"][i % 4], len(t or ""), "x", "x", "x", "x", "x", "x", "x")
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return make


@pytest.fixture
def prose():
    """Words of several scripts, by a seeded draw."""
    words = [a + b for a in ("lorem", "é", "the", "日本", "xy", "of") for b in ("", "1", "ñ", "ing", "zz")]

    def make(seed, n, white=" "):
        draw = random.Random(seed)
        return white.join(draw.choice(words) + str(draw.randint(0, 50)) for _ in range(n))
    return make
