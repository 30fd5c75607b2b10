from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.llm import components, ngram_join, queries, shingles


def plain_set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def plain_classes(sets, percent):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if i < j and sets[i] and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_classes_as_by_all_pairs(spark, words, percent):
    random.seed(words)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = random.choices(vocabulary, k=60)
    texts = []
    for _ in range(12):  # chains of edits, a passage that many share, near copies of one text, exact copies
        base = random.choices(vocabulary, k=random.randint(3, 90))
        for _ in range(8):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(random.randint(0, 4)):
                base[random.randrange(len(base))] = random.choice(vocabulary)
        texts.append(" ".join(passage + base[:10]))
    for i in range(60):
        near = list(passage)
        for _ in range(i % 7):
            near[random.randrange(len(near))] = f"own{i}"
        texts.append(" ".join(near))
    texts += ["", None, " ", "one", "ONE", "one two", "A b C d", "a B c D"]
    rows = list(enumerate(texts))
    random.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = ngram_join.with_smallest_key(ngram_join.linked_classes(docs, words, percent)).collect()
    sets = {i: plain_set(t, words) for i, t in rows}
    expected = plain_classes(sets, percent)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in found} == {i: len(s) for i, s in sets.items()}
    kept = ngram_join.one_of_each(docs, words, percent).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(expected.values()))


def test_odd_rows(spark, odd_docs, no_docs):
    classes = ngram_join.linked_classes(odd_docs, 4, 85)
    found = ngram_join.with_smallest_key(classes).collect()
    assert len(found) == odd_docs.count()
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    assert by[7] == by[8] == {(4, 7)} and by[2] == {(0, 2)} and by[3] == {(0, 3)} and by[6] == {(2, 6)}
    kept = ngram_join.one_of_each(odd_docs, 4, 85)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 6, 7, 9]
    assert ngram_join.linked_classes(no_docs, 4, 85).collect() == [] and ngram_join.one_of_each(no_docs, 4, 85).collect() == []


def test_pieces_do_not_change_numbers(monkeypatch):
    texts = ["The  quick\tbrown fox " * 30, "x" * 500 + " y z", None, "a b c"]
    before = shingles.shingle_sets(texts, 3)
    monkeypatch.setattr(shingles, "PIECE", 64)
    shingles._powers.cache_clear()
    after = shingles.shingle_sets(texts, 3)
    shingles._powers.cache_clear()
    assert all((a == b).all() for a, b in zip(before, after))


def test_components(spark):
    random.seed(3)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 150), (None, 3)]
    random.shuffle(links)
    df = spark.createDataFrame([(b, a) if i % 2 else (a, b) for i, (a, b) in enumerate(links)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 100}
    assert components.components(df.where("1 = 0")).collect() == []


def test_hot_lists_give_few_pairs(spark):
    """A shingle list's pairs are linear in its length as long as its texts are of one class."""
    texts = [(i, " ".join(f"w{j}" if j != i % 90 else f"own{i}" for j in range(100))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = ngram_join.linked_classes(docs.unionByName(docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text")), 4, 80)
    assert found.select("component").distinct().count() == 1
    assert np.isclose(found.count(), 800)


def test_long_texts_are_hashed_in_slices_of_bounded_bytes():
    texts = ["a b c d " * 25_000] * 50 + ["e"] * 2_000 + [None, "f g " * 600_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["key", "text"])
    found = [chunk.column(1).to_pylist() for chunk in ngram_join._chunks([batch], 1)]
    assert [t for chunk in found for t in chunk] == texts
    # no text is cut: what stands before a slice's last text is bounded
    assert all(sum(len(t or "") for t in chunk[:-1]) <= ngram_join.TEXT_BYTES for chunk in found)


def test_texts_for_python_come_in_batches_bounded_by_bytes(spark, tmp_path):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    spark.createDataFrame([(1, "a b c d e")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set(setting, "64m")
    try:
        queries.op8_ngram_join(spark, str(tmp_path))
        assert spark.conf.get(setting) == "8m"
    finally:
        spark.conf.set(setting, before)
