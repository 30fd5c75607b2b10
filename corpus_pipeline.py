"""From raw documents to token ids: four stages, each over all that the one before it kept.

1. quality: the classifier is taught by ``labels`` (the held-out share of ids teaches nothing); rejected texts go.
2. near copies: of each class of texts linked by five-word shingles with a likeness of 0.8, one stays.
3. mixing: sources are used such that none is repeated more than ``REPEATS`` times and every document at least once;
   a document that is used twice is there twice.
4. token ids: byte-level BPE of every text.

All but the last return the columns of ``documents``. Trained scores and hash-dealt permutations have no counterpart in
SQL, so ``ORACLE_SQL`` is None and the tests compare every stage with a plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import bpe, mixing, ngram_join, quality
from lotwise.llm.common import residue, stored, table

BPE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORDS, PERCENT = 5, 80
REPEATS = 2.0


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"), residue(F.col("key"), 4) == 2)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, WORDS, PERCENT)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the input's columns travel as one, so that none clashes with a name made on the way
    counted = docs.select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("n_tokens"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
    )
    weights = mixing.temperature_weights(mixing.source_shares(counted), repeats=REPEATS)
    return mixing.uses(mixing.copies(counted, weights)).select("__row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    codec = bpe.Codec(public_tokenizers.path(BPE_VOCABULARY), public_tokenizers.PATTERN)
    encoded = bpe.encode(docs, codec)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality", good_texts), ("near_copies", without_near_copies), ("mixing", mixed_sources), ("token_ids", token_ids),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
