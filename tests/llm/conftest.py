"""Documents with every odd row the operators have to take."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 997} and{i % 31}" for i in range(30_000))
CLASHING = "id long, tie string, fp int, key string, size long, score double, hits string, kept int, host string, vote int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again today", "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog again and again today", "en", "a"),
        (2, "The quick brown fox jumps over the lazy dog again and again today", "en", "b"),
        (3, None, "en", "a"),
        (4, "", None, None),
        (None, "no id at all but some words of its own", None, "b"),
        (None, None, None, None),
        (5, " \t\n ", "de", "c"),
        (6, LONG, "en", "a"),
        (7, "Straße Ünïcode 東京 \U0001f600 words, and Punctuation!!", "de", "c"),
        (8, "one", "de", "d"),
    ]
    extra = (9, "x", 1, "k", 3, 0.5, "h", 1, "www", 2)
    schema = f"doc_id long, text string, lang string, source string, {CLASHING}"
    return spark.createDataFrame([r + extra for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
