from __future__ import annotations

import pytest
from pyspark.sql import functions as F

LONG = "lorem ipsum " * 30_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, very long and repeated texts, null and repeated ids, and columns with clashing names."""
    rows = [
        (1, "The cat sat on the mat and the dog was in the house of a friend.", "en"), (2, None, "en"), (3, "", None),
        (4, "  \n\t ", "en"), (5, "one", "en"), (6, LONG, "de"), (7, "same text here for all of them", "en"),
        (7, "same text here for all of them", "en"), (8, "same text here for all of them", "fr"), (None, "no id at all, but text", "en"),
        (None, None, None), (9, "ünïcödé <|im_end|> 漢字 😀 \\n '", "xx"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    extra = {c: F.lit(1) for c in ("key", "n", "node", "component", "ids", "block", "kind", "chunk", "prefix", "group", "number")}
    return df.withColumns(extra)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")
