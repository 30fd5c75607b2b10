from __future__ import annotations

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
BLOB = open(PATH, "rb").read()
OURS = bpe.encoder(BLOB, PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(BLOB), special_tokens={})
TEXTS = st.text(alphabet=st.sampled_from(list("abcdeth .,é中😀12\n'sS\t")), max_size=80)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | TEXTS)
def test_same_ids_as_the_library(text):
    ids = OURS.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert OURS.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60), st.integers(0, 60), st.integers(0, 10), st.binary(max_size=8))
def test_tables_after_edits_and_appends(data, start, width, new):
    start = min(start, len(data))
    end = min(start + width, len(data))
    table = bpe.PrefixTable(OURS.merges, data)
    assert table.ids() == OURS.merges.merge(data)
    table.replace(start, end, new)
    assert table.ids() == OURS.merges.merge(data[:start] + new + data[end:])
    table.append(b" the end")
    assert table.ids() == OURS.merges.merge(data[:start] + new + data[end:] + b" the end")


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(0, 80), st.integers(0, 10), TEXTS)
def test_texts_after_edits(text, start, width, new):
    start = min(start, len(text))
    end = min(start + width, len(text))
    found = bpe.TextEncoding(OURS, text)
    found.replace(start, end, new)
    assert found.ids() == LIBRARY.encode_ordinary(text[:start] + new + text[end:])


def test_an_edit_leaves_most_of_a_long_piece():
    data = bytes(97 + i * i % 26 for i in range(5000))
    assert bpe.PrefixTable(OURS.merges, data).replace(2500, 2501, b"q") < 500


def test_columns(spark, odd_docs, no_docs):
    codec = bpe.Codec(PATH, PATTERN)
    done = bpe.decode(bpe.encode(odd_docs, codec), codec).withColumn("back", F.col("decoded").cast("string"))
    rows = done.collect()
    assert len(rows) == odd_docs.count() and done.columns[: len(odd_docs.columns)] == odd_docs.columns
    for r in rows:
        assert list(r["ids"]) == LIBRARY.encode_ordinary(r["text"] or "") and r["back"] == (r["text"] or "")
    assert bpe.encode(no_docs, codec).collect() == []
