import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with columns whose names clash with results."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None) for r in rows]
        return spark.createDataFrame(full, SCHEMA).withColumns({c: F.lit("x") for c in ("size", "kept", "score", "sample", "id", "k", "n", "rep", "_text", "part")})

    return build


@pytest.fixture(scope="session")
def odd(make):
    """Null, empty, blank, repeated and very long rows, ties, a null key and a null source."""
    r = random.Random(4)
    long = " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + str(r.randint(0, 900)) for _ in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "One two three four five six"), (6, "One two three four five six"), (7, long), (8, long + " end"), (9, "été ▁ x²  y\r\nz 日本語", None, None), (None, "a null key here now", "de", "t"), (10, "123 456 !!!", "fr", "t")]
    return make(rows)
