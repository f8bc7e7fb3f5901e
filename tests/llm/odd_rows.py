"""Rows that every document operator must stand, shared by the tests of this folder."""

import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
LONG = "Lorem ipsum dolor " * 20_000

# Nulls, empty and very long texts, ties, repeated rows; the extra columns clash with names the operators use.
ROWS = [
    (1, "The same text here, twice.", "en", "s0", 26),
    (2, "The same text here, twice.", "en", "s1", 26),
    (2, "The same text here, twice.", "en", "s1", 26),
    (3, None, "en", "s0", None),
    (4, "", None, "s0", 0),
    (5, "  \n\t ", "en", None, 5),
    (6, LONG, "la", "s0", len(LONG)),
    (7, "x" * 3000, None, "s0", 3000),
    (8, "password = 'abcdef123'", "en", "s2", 22),
    (None, "A row without an id, all alone.", "en", "s0", 31),
    (9, "12 34 -- 56 ??", None, "s1", 14),
    (10, "ünïcødé 漢字 😀 <|endoftext|>", "de", "s1", 23),
]
EXTRA = ["fp", "n", "row", "rest", "t", "id", "cell", "word", "mask", "component_id", "kept", "spans", "key", "size", "position", "held_out", "score", "a", "b"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields] + [T.StructField(n, T.StringType()) for n in EXTRA])
    return spark.createDataFrame([r + tuple(EXTRA) for r in ROWS], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
