"""Restoring against all ways through a lattice, scores on held-out and on disguised texts, odd rows."""

from __future__ import annotations

import itertools
import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lotwise.llm import queries, toxicity
from lotwise.llm.common import residue

SF_DIR = "/root/testdata/sf0.01"
WORDS = "idiot loser stupid pathetic worthless the and of house garden water little people mother winter reason moron scum trash"


@pytest.fixture(scope="module")
def letters(spark):
    rows = [(i, WORDS) for i in range(40)] + [(None, None), (1, "")]
    return toxicity.letter_model(spark.createDataFrame(rows, "doc_id bigint, text string"))


def plain_score(parts, costs, model):
    """Log probability of one way: the channel and the letters of the words it spells."""
    total, a, b = sum(costs), 0, 0
    for c in "".join(parts) + " ":
        k = toxicity.letter_class(c)
        if k or b:
            total += model.log[(a * toxicity.CLASSES + b) * toxicity.CLASSES + k]
        a, b = (b, k) if k else (0, 0)
    return total


@pytest.mark.parametrize("seen, separated", [("1d10t", False), ("l.o.s", True), ("$$tuupp", False), ("a55", False), ("mo0or", False), ("t h 3", True)])
def test_likeliest_way_of_all(letters, seen, separated):
    ways = toxicity.lattice(seen, separated)
    scored = [(plain_score([o for o, _ in w], [c for _, c in w], letters), "".join(o for o, _ in w)) for w in itertools.product(*ways)]
    best = max(s for s, _ in scored)
    found = toxicity.decode(ways, letters)
    assert any(text == found and abs(s - best) < 1e-4 for s, text in scored)


def test_restored_texts(spark, letters):
    seen = ["you 1d10t!", "i d i o t here", "L.O.S.E.R", "looooser", "st*pid", "p@thet1c", "w-o-r-t-h-l-e-s-s", "idi​ot", "The HOUSE, and 12 people.", "", None]
    expected = ["you idiot!", "idiot here", "loser", "loser", "stupid", "pathetic", "worthless", "idiot", "the house, and 12 people.", "", None]
    df = spark.createDataFrame([(t,) for t in seen], "text string")
    assert [r[0] for r in df.select(toxicity.restored(F.col("text"), letters)).collect()] == expected


def test_features_are_those_of_the_restored_text(letters):
    reader, restorer = toxicity.Reader(letters), toxicity.Restorer(letters)
    for text in ("you 1d10t! L O S E R ünïcödé x2y 漢字 e3b3ed3cc8", "a " * 300, "Étéé ___ 99 ŉ", ""):
        assert reader(text) == toxicity.features_of(restorer.restore(text))


def test_trigrams_by_plain_counting():
    table, text = toxicity._class_table(), "Ab é, x\n漢c"
    words, k = ["ab", "é", "x", "漢c"], toxicity.CLASSES
    expected = []
    for w in words:
        c = [0, 0, *map(toxicity.letter_class, w), 0]
        expected += [(x * k + y) * k + z for x, y, z in zip(c, c[1:], c[2:])]
    assert sorted(toxicity.trigram_counts(text, table).tolist()) == sorted(expected)


def disguise(word, kind):
    if kind == "marks":
        return word.translate(str.maketrans("oieas", "01345"))
    return ".".join(word) if kind == "separated" else "".join(c * 4 if c in "aeiou" else c for c in word)


@pytest.fixture(scope="module")
def taught(spark):
    random = np.random.default_rng(5)
    clean = "the and of house garden water little people mother winter reason".split()
    bad = "idiot loser stupid pathetic worthless moron".split()
    rows = []
    for i in range(600):
        text = list(random.choice(clean, 12))
        if i % 3 == 0:
            text[int(random.integers(12))] = str(random.choice(bad))
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    # ids from 1000 on are not labelled
    rows += [(1000 + i, f"the house {disguise(bad[i % 6], kind)} and water", None)
             for i, kind in enumerate(["marks", "separated", "repeated"] * 6)]
    rows += [(2000, None, None), (2001, "", None), (2002, "  \n ", None), (None, "you idiot", None), (2003, "lorem ipsum " * 30_000, None),
             (2004, "the loser", None), (2004, "the loser", None), (2005, "a1" * 5000, None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("key", "label", "feature", "score")})
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[2] is not None] + [(None, 1), (7, 5), (8, None), (0, 0)], "doc_id bigint, toxic int")
    return docs.repartition(3), labels


def held(column="key"):
    return residue(F.col(column), 5) == 0


def test_disguised_words_are_found(spark, taught):
    docs, labels = taught
    found = toxicity.toxicity_scores(docs, labels, held()).collect()
    assert len(found) == docs.count()
    by = {r["doc_id"]: r for r in found}
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert all(by[i]["predicted"] == int(i % 3 == 0) for i in range(600))
    assert all(by[1000 + i]["predicted"] == 1 for i in range(18))
    assert [by[i]["predicted"] for i in (2000, 2001, 2002, 2003, 2004, 2005, None)] == [0, 0, 0, 0, 1, 0, 1]
    assert by[2000]["score"] == by[2001]["score"] == by[2002]["score"]


def test_bound_on_what_teaches(spark, taught):
    docs, labels = taught
    source = docs.select("doc_id", "text").withColumnRenamed("doc_id", "key")
    marks = labels.select(F.col("doc_id").alias("key"), F.col("toxic").alias("label"))
    assert 60 <= toxicity.taught_rows(source, marks, F.lit(False), most=100).count() <= 140
    assert toxicity.taught_rows(source, marks, F.lit(False), most=1000).count() == 600


def test_one_kind_of_label_none_and_empty_tables(spark, taught):
    docs, labels = taught
    some = docs.where("doc_id < 20")
    for mark, level in ((0, 0.0), (1, 1.0)):
        only = labels.where(F.col("toxic") == mark)
        assert all(abs(r["score"] - level) < 1e-6 for r in toxicity.toxicity_scores(some, only, held()).collect())
    assert all(r["score"] < 1e-6 for r in toxicity.toxicity_scores(some, labels.where("1 = 0"), held()).collect())
    assert toxicity.toxicity_scores(docs.where("1 = 0"), labels, held()).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not there")
def test_query_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF_DIR}/labels.parquet").to_pylist()}
    rows = queries.QUERIES["op13_toxicity"](spark, SF_DIR).collect()
    assert len(rows) == pq.read_table(f"{SF_DIR}/documents.parquet").num_rows
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)
