import random

import pytest
from pyspark.sql import functions as F

CLASHING = ("score", "component_id", "key", "size", "h", "a", "b", "blob", "path", "mix", "n", "band", "value", "text_hash",
            "spans", "row", "word", "toxic", "id", "_id", "draws", "next", "range", "sig")


def words_of(rng: random.Random, n: int, vocab: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Builds a documents table with extra columns whose names the operators use inside."""
    def make(rows, clash=True, without=()):
        df = spark.createDataFrame([(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        return df.withColumns({c: F.lit("x") for c in CLASHING if c not in without}) if clash else df
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, repeated, tied and very long rows."""
    rng = random.Random(5)
    long = words_of(rng, 30_000)
    one = words_of(rng, 60)
    return [
        (1, one, "en", "s1"), (2, one, "en", "s2"), (2, one, "en", "s2"), (3, None, "en", None), (4, "", None, "s1"),
        (5, " \t\n", "en", "s3"), (6, "word", "en", "s1"), (None, one, "en", "s1"), (None, None, None, None),
        (7, long, "en", "s1"), (8, long + " tail", "de", None), (9, words_of(rng, 80), None, ""),
        (10, "Ünï cödé \U0001f600 " * 30, "de", "s3"), (10, "other text of the same id", "de", "s3"),
    ]
