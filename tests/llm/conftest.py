import random

import pytest
from pyspark.sql import SparkSession

WORDS = [a + b for a in "ba de fi go lu ma ne po ri su ta vo".split() for b in "lan mer tis nok ral sen dit gop".split()]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def words():
    rng = random.Random(11)
    return lambda n: [rng.choice(WORDS) for _ in range(n)]


@pytest.fixture
def documents(spark: SparkSession):
    """A documents table of (doc_id, text[, lang[, source]]) rows."""

    def make(rows, extra=""):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row[:4], *("en", "a")[len(row[:4]) - 2 :])
            full.append((doc_id, text, lang, source, None if text is None else len(text), *row[4:]))
        return spark.createDataFrame(full, SCHEMA + extra)

    return make
