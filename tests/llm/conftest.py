import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = (
    "row string, hash long, score double, words string, fingerprint string, deleted string, key long, n long, "
    "_ string, mix_shard long, mix_place long, mask int, part string, piece long, shard string, gid int, segment long"
)


def make(spark, texts, sources=None):
    """Documents of these texts, numbered from 0."""
    rows = [
        (k, t, "en", sources[k] if sources else "a", None if t is None else len(t)) for k, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def docs(spark):
    return lambda texts, sources=None: make(spark, texts, sources)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with an operator's names."""
    word = random.Random(5)
    long_text = "\n".join(" ".join(f"w{word.randrange(9000)}" for _ in range(40)) for _ in range(2500))
    prose = " ".join(f"p{k}" for k in range(80))
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \n\t\n ", None, "a", 5),
        (4, long_text, "en", "b", len(long_text)),
        (5, prose, "en", "a", len(prose)),
        (5, prose, "en", "a", len(prose)),
        (5, "other words under the same id", "en", "a", 29),
        (None, prose, "en", "a", len(prose)),
        (None, None, None, None, None),
        (6, "é ünïcode   x" + "\x0b" + "y", "fr", "ß", 14),
    ]
    extra = ("r", 1, 0.5, "w", "f", "d", 2, 3, "_", 4, 5, 6, "p", 7, "s", 8, 9)
    return spark.createDataFrame([r + extra for r in rows], f"{SCHEMA}, {CLASHING}")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], f"{SCHEMA}, {CLASHING}")
