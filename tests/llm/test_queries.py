"""The thin queries against plain versions on the smallest tables."""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

from lotwise.llm import bpe, forest, ppm, queries
from lotwise.llm.common import residue

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not there")


def read(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def run(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] or "" for r in read("documents")}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))


def test_edited_texts_and_likeness(spark, texts):
    found = {r["doc_id"]: r for r in run(spark, "op2_spots")}
    ids = sorted(texts, reverse=True)
    for i, following in zip(ids, ids[1:] + ids[:1]):
        text, other, r = texts[i], texts[following], found[i]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == sha(edited.encode())
        sets = [set(re.findall(".{8}", r[c])) for c in ("fingerprint", "edited_fingerprint")]
        following_set = set(re.findall(".{8}", found[following]["fingerprint"]))
        assert math.isclose(r["near_edited"], len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        assert math.isclose(r["near_next"], len(sets[0] & following_set) / len(sets[0] | following_set))
    by_text = {}
    for i in ids:
        assert by_text.setdefault(texts[i], found[i]["fingerprint"]) == found[i]["fingerprint"]


def test_neighbours(spark):
    rows = [r for r in read("embeddings") if r["embedding"]]
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    lengths = np.sqrt((x * x).sum(axis=1))
    found = {}
    for r in run(spark, "op4_forest"):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = asked = 0
    for q in np.flatnonzero(ids % 50 == 0):
        scores = (x * x[q]).sum(axis=1) / (lengths * lengths[q])
        scores[q] = -2
        best = np.lexsort((ids, -scores))[:5]
        mine = sorted(found[ids[q]])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        place = {int(v): i for i, v in enumerate(ids)}
        assert all(abs(scores[place[v]] - s) < 1e-12 for _, v, s in mine)
        hits, asked = hits + len({m[1] for m in mine} & set(ids[best].tolist())), asked + 5
    assert hits / asked >= 0.9


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [1.0, 1.0]),
            (7, [1.0]), (None, [1.0, 0.1]), (1, [2.0, 0.0])] + [(i, [3.0, 1.0]) for i in range(20, 60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumnRenamed("x", "key")
    found = forest.nearest(df, forest.F.col("key") % 10 == 0, k=3).orderBy("query_id", "rank").collect()
    by = {}
    for r in found:
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by[0] == [1, 1, None]
    assert by[20] == [21, 22, 23] and by[50] == [20, 21, 22]
    assert set(by) == {0, 20, 30, 40, 50}
    assert forest.nearest(df.where("1 = 0"), forest.F.col("key") % 10 == 0).collect() == []


def test_repeated_query_numbers(spark):
    """Rows of the query's own number hide no other row, and each of its vectors is a query of its own."""
    rows = [(50, [1.0, 0.0])] * 6 + [(51, [1.0, 0.0]), (52, [0.0, 1.0]), (60, [1.0, 0.0]), (60, [0.0, 1.0])] + [(61, [1.0, 1.0])] * 3
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = forest.nearest(df, forest.F.col("key") % 10 == 0, k=2).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault((r["query_id"], r["rank"]), []).append((r["vec_id"], round(r["score"], 6)))
    assert by[50, 1] == [(51, 1.0)] and by[50, 2] == [(60, 1.0)]
    # one query of number 60 looks along each axis
    assert sorted(by[60, 1]) == [(50, 1.0), (52, 1.0)] and sorted(by[60, 2]) == [(50, 1.0), (61, round(0.5**0.5, 6))]


def test_base_of_language_scores(spark, texts):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    counts = Counter()
    for i, t in texts.items():
        if not held[i]:
            counts.update([*words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    for r in run(spark, "op9_ppm"):
        tokens = [*words(texts[r["doc_id"]]), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(tokens), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens) and math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0


def test_quality(spark):
    labels = {r["doc_id"]: r["quality"] for r in read("labels")}
    rows = run(spark, "op6_quality")
    assert len(rows) == len(read("documents"))
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in judged) >= 0.85 * len(judged)


def test_mixing_uses(spark):
    rows = run(spark, "op5_mixing")
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in read("documents")}
    assert len({(r["doc_id"], r["epoch"]) for r in rows}) == len(rows)
    tokens, used = Counter(), Counter()
    for r in rows:
        tokens[r["source"]] += r["n_tokens"] if r["epoch"] == 0 else 0
        used[r["source"]] += r["n_tokens"]
    assert max(used[s] / tokens[s] for s in tokens) <= queries.REPEATS + 1e-9


def test_byte_pair_digests(spark, texts):
    ranks = bpe.read_ranks(open(public_tokenizers.path(queries.BPE_VOCABULARY), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r["doc_id"]: r for r in run(spark, "op1_bpe")}
    assert set(found) == set(texts)
    for i, text in texts.items():
        ids = library.encode_ordinary(text)
        expected = (len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode()))
        assert (found[i]["n_tokens"], found[i]["ids_sha256"], found[i]["decoded_sha256"]) == expected


def test_packed_ids_read_back(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path(queries.WORD_VOCABULARY))
    found, start = {r["doc_id"]: r for r in run(spark, "op10_packing")}, 0
    assert set(found) == set(texts)
    for i in sorted(texts):
        ids = np.array([*library.encode(texts[i], add_special_tokens=False).ids, queries.END_ID], "<u4")
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def plain_byte_scores(taught, asked, order):
    """Counts of every context in dictionaries; half of each count's unit escapes, longer contexts' bytes are excluded."""
    tables = [{} for _ in range(order + 1)]

    def bytes_of(text):
        return [255] * order + list(" ".join(words(text)).encode()) + [254]

    for text in taught:
        data = bytes_of(text)
        for i in range(order, len(data)):
            for k in range(order + 1):
                tables[k].setdefault(tuple(data[i - k : i]), Counter())[data[i]] += 1

    def log10(data, i):
        total_log, excluded = 0.0, set()
        for k in range(order, -1, -1):
            table = tables[k].get(tuple(data[i - k : i]))
            if table is None:
                continue
            left = {b: n for b, n in table.items() if b not in excluded}
            if data[i] in left:
                return total_log + math.log10((2 * left[data[i]] - 1) / (2 * sum(left.values())))
            if left:
                total_log += math.log10(len(left) / (2 * sum(left.values())))
            excluded = set(table)
        return total_log - math.log10(255 - len(tables[0].get((), ())))

    return [sum(log10(data, i) for i in range(order, len(data))) for data in map(bytes_of, asked)]


@pytest.mark.parametrize("order", [2, 4, 5])
def test_scores_of_a_plain_trie(spark, order):
    rows = [(i, t) for i, t in enumerate(
        ["the cat sat", "The dog sat on the mat", "", None, "a cat and a dog", "zebra", "the the the", "Mat, cat!", "é ü é", "on and on and on", "sat at the mat"])]
    held = {i: zlib.crc32(str(i).encode()) % 3 == 0 for i, _ in rows}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["score"] for r in ppm.text_scores(docs, residue(forest.F.col("doc_id"), 3) == 0, order=order).collect()}
    expected = plain_byte_scores([t or "" for i, t in rows if not held[i]], [t or "" for _, t in rows], order)
    assert any(held.values()) and [found[i] for i, _ in rows] == pytest.approx(expected, rel=1e-5)
