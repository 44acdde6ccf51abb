"""Fixtures and texts that the tests of this folder share."""

import pytest

SMALL = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"

#: A text that is long for one row, and a word as long as many texts.
LONG = " ".join(f"w{n % 977}x{n}" for n in range(60_000))
LONG_WORD = "a" * 300_000


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)
    return build


@pytest.fixture
def small(spark):
    """A table of the smallest test data."""
    def read(name):
        return spark.read.parquet(f"{SMALL}/{name}.parquet")
    return read
