"""Every stage of the pipeline against a plain version of it on the smallest tables."""

from __future__ import annotations

import os
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from lotwise.llm import bpe, quality
from lotwise.llm.common import residue, stored, table

from .test_ngram_join import plain_classes, plain_set

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not there")


def test_stages(spark):
    docs, results = table(spark, SF_DIR, "documents"), {}
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
        results[name] = docs
        assert name == "token_ids" or docs.columns == columns
    source = table(spark, SF_DIR, "documents")
    scores = quality.quality_scores(source, table(spark, SF_DIR, "labels"), residue(F.col("key"), 4) == 2)
    good = {r["doc_id"]: r["text"] for r in source.join(scores.where("predicted = 1"), "doc_id").collect()}
    assert {r["doc_id"] for r in results["quality"].collect()} == set(good)
    expected = plain_classes({i: plain_set(t, pipeline.WORDS) for i, t in good.items()}, pipeline.PERCENT)
    kept = {i for i, c in expected.items() if i == c}
    assert sorted(r["doc_id"] for r in results["near_copies"].collect()) == sorted(kept)
    mixed = results["mixing"].collect()
    tokens, used = Counter(), Counter()
    for r in results["near_copies"].collect():
        tokens[r["source"]] += len((r["text"] or "").split())
    for r in mixed:
        used[r["source"]] += len((r["text"] or "").split())
    assert {r["doc_id"] for r in mixed} == kept
    assert all(tokens[s] <= used[s] <= pipeline.REPEATS * tokens[s] for s in tokens)
    ranks = bpe.read_ranks(open(public_tokenizers.path(pipeline.BPE_VOCABULARY), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = results["token_ids"].collect()
    assert Counter(r["doc_id"] for r in ids) == Counter(r["doc_id"] for r in mixed)
    assert all(list(r["ids"]) == library.encode_ordinary(good[r["doc_id"]] or "") for r in ids)


def test_mixing_keeps_columns_with_names_made_on_the_way(spark):
    names = ("block", "copies", "epoch", "epochs", "rest", "n_tokens", "size", "left_over", "__tokens", "__source", "__row")
    docs = spark.range(60).selectExpr("id AS doc_id", "repeat('word ', int(id % 5 + 1)) AS text", "if(id < 50, 'a', 'b') AS source")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    found = pipeline.mixed_sources(spark, docs, SF_DIR)
    assert found.columns == docs.columns
    assert set(map(tuple, found.collect())) == set(map(tuple, docs.collect()))


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    """Null, empty, long and repeated texts, null and repeated ids, clashing columns: rows go or stay whole."""
    odd, none = (d.withColumn("lang", F.lit(None).cast("string")) for d in (odd_docs, no_docs))
    given = Counter(map(tuple, odd.collect()))
    for name, stage in pipeline.STAGES:
        found = stage(spark, odd, SF_DIR)
        if name == "token_ids":
            assert Counter(r["doc_id"] for r in found.collect()) == Counter(r[0] for r in given.elements())
            assert stage(spark, none, SF_DIR).collect() == []
            continue
        rows = Counter(map(tuple, found.collect()))
        assert found.columns == odd.columns and set(rows) <= set(given), name
        if name == "near_copies":
            # of the texts that agree one stays, texts without words are in no class
            texts = Counter(r[odd.columns.index("text")] for r in rows.elements())
            assert texts["same text here for all of them"] == 1 and set(texts) == {r[odd.columns.index("text")] for r in given}
        if name == "mixing":
            assert set(rows) == set(given)
        assert stage(spark, none, SF_DIR).collect() == [], name
