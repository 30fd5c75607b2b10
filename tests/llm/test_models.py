from __future__ import annotations

import math
import time
import random
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lotwise.llm import licences, mixing, ppm, quality, spots
from lotwise.llm.common import residue


def test_probabilities_of_all_bytes_sum_to_one():
    texts = [b"abracadabra", b"abrasive", b"cadabra abra", b""]
    for order in (0, 1, 2, 4, 5):
        codes, counts = np.unique(ppm.grams_of(texts, order)[0], return_counts=True)
        low = Counter()
        for t in texts:
            for c in ppm.grams_of([t], max(order, 1))[0].tolist():
                low[c & 0xFFFF] += 1
        keys = np.array(sorted(low), np.int64)
        trie = ppm.Trie(codes, counts, (keys, np.array([low[k] for k in keys.tolist()])), order)
        for context in (b"abrac", b"zzzzz", b"xabra", bytes([ppm.START]) * 5, b"dabra"):
            start = int.from_bytes(context[5 - order :], "big") if order else 0
            every = np.array([(start << 8) | s for s in range(255)], np.int64)
            assert math.isclose((10.0 ** trie.log10(every)).sum(), 1.0, rel_tol=1e-9)


def test_scores_do_not_depend_on_chunks(spark, odd_docs, no_docs, monkeypatch):
    docs = odd_docs.select("doc_id", "text", "key", "kind", "chunk")
    whole = {(r["doc_id"], r["n_tokens"]): r for r in ppm.text_scores(docs, residue(F.col("doc_id"), 3) == 0).collect()}
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 50_000)
    monkeypatch.setattr(ppm, "PIECE_BYTES", 40)
    parts = ppm.text_scores(docs, residue(F.col("doc_id"), 3) == 0).collect()
    assert len(parts) == docs.count()
    for r in parts:
        same = whole[r["doc_id"], r["n_tokens"]]
        assert math.isclose(r["score"], same["score"], rel_tol=1e-6) and math.isclose(r["base_score"], same["base_score"], rel_tol=1e-9)
    assert ppm.text_scores(no_docs, residue(F.col("doc_id"), 3) == 0).collect() == []


def test_chunks_are_cut_by_bytes(spark, monkeypatch):
    """Clustered ids, outliers, null ids, one id on a third of the rows, and one row many times."""
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 20_000)
    rows = [(i // 40 * 10**6 + i % 40, f"text {i} " + "abc " * (i % 50)) for i in range(400)]
    rows += [(2**62, "far"), (-(2**62), None), (None, "no id"), (None, None), (7, "")]
    rows += [(10**6 + 3, f"same id {i} " * 9) for i in range(300)] + [(5, "copy of one row " * 9)] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = residue(F.col("doc_id"), 3) == 0
    chunked, chunks = ppm._chunked(docs, "doc_id", "text", held)
    sizes = chunked.groupBy("chunk").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("b")).collect()
    assert len(sizes) == chunks > 3 and max(r["b"] for r in sizes) <= 40_000
    assert chunked.agg(F.sum("copies")).first()[0] == len(rows)

    def plain(found):
        return sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["held_out"], r["train_tokens"], round(r["score"], 3), round(r["base_score"], 6)) for r in found)

    parts = plain(ppm.text_scores(docs, held).collect())
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 10**9)
    assert parts == plain(ppm.text_scores(docs, held).collect()) and len(parts) == len(rows)


def test_known_text_is_likelier(spark):
    rows = [(i, "the cat sat on the mat and looked at the moon") for i in range(1, 20)] + [(50, "qwx zzkj vvq"), (51, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in ppm.text_scores(docs, F.col("doc_id") >= 19).collect()}
    assert found[19]["held_out"] and found[19]["score"] > -3 and found[50]["score"] < -15 and found[51]["n_tokens"] == 1


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text", "key", "source")
    labels = spark.createDataFrame(
        [(1, 1), (7, 1), (5, 0), (9, 0), (None, 1), (4, None), (6, 7), (6, 1)], "doc_id bigint, quality int")
    found = quality.quality_scores(docs, labels, residue(F.col("key"), 4) == 2).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert quality.accepted(docs, labels, residue(F.col("key"), 4) == 2).columns == docs.columns
    assert quality.quality_scores(no_docs, labels, residue(F.col("key"), 4) == 2).collect() == []
    one_class = labels.where("quality = 1")
    assert all(r["score"] == 1 for r in quality.quality_scores(docs, one_class, residue(F.col("key"), 4) == 2).collect())


def test_quality_on_plain_and_shouted_texts(spark):
    random.seed(1)
    vocabulary = ["".join(random.choices("aeioulnrst", k=random.randint(2, 9))) for _ in range(500)]
    rows = []
    for i in range(400):
        text = " ".join(random.choices(vocabulary, k=random.randint(20, 120)))
        rows.append((i, text.upper().replace(" ", "!! ") if i % 3 == 0 else text + ".", int(i % 3 != 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    held = residue(F.col("key"), 4) == 2
    found = {r["doc_id"]: r for r in quality.quality_scores(docs.drop("quality"), docs.drop("text"), held).collect()}
    outside = [i for i in found if found[i]["held_out"]]
    assert outside and sum(found[i]["predicted"] == rows[i][2] for i in outside) >= 0.97 * len(outside)


def test_isotonic():
    points, levels = quality.isotonic(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 0, 1, 1.0]))
    assert list(levels) == [0, 1 / 3, 1] and list(points) == [0, 2, 4.5]


def plain_power(shares, repeats):
    least = lambda a: max(shares) ** (1 - a) * min(shares) ** (a - 1)
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if least(middle) <= repeats else (middle, high)
    return high


def test_mixing_meets_the_limit_and_loses_nothing(spark):
    random.seed(2)
    rows = [(i, "big" if i < 600 else "mid" if i < 800 else None if i < 830 else "tiny", random.randint(1, 50)) for i in range(900)]
    rows += [(1000, "empty", 0), (1001, "empty", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    shares = mixing.source_shares(docs)
    tokens = Counter()
    for _, s, n in rows:
        tokens[s] += n
    total = sum(tokens.values())
    power = mixing.fitting_power(shares, repeats=2.5)
    assert math.isclose(power, plain_power([v / total for v in tokens.values() if v], 2.5), abs_tol=1e-6)
    weights = mixing.temperature_weights(shares, repeats=2.5)
    budgets = {r["__source"]: r for r in weights.collect()}
    placed = mixing.copies(docs, weights).collect()
    assert len(placed) == len(rows)
    for source in tokens:
        budget = budgets["-" if source is None else f"={source}"]
        own = [r for r in placed if r["source"] == source]
        used = sum(r["copies"] * r["n_tokens"] for r in own)
        assert min(r["copies"] for r in own) >= 1 and max(r["copies"] for r in own) - min(r["copies"] for r in own) <= 1
        assert budget["budget"] - 50 <= used <= budget["budget"] + 1e-6 or source == "empty"
    entropy = mixing.fitting_power(shares, entropy=0.9)
    q = [(v / total) ** entropy for v in tokens.values() if v]
    assert math.isclose(-sum(x / sum(q) * math.log(x / sum(q)) for x in q), 0.9, abs_tol=1e-6)
    fixed = mixing.temperature_weights(shares, repeats=4, budget=5000.0)
    used = mixing.uses(mixing.copies(docs, fixed))
    assert 5000 - 4 * 50 <= used.where("source IS NOT NULL OR source IS NULL").agg(F.sum("n_tokens")).first()[0] <= 5000


def test_mixing_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCUMENTS", 10)
    docs = spark.range(300).selectExpr("id AS doc_id", "if(id < 250, 'a', 'b') AS source", "id % 7 + 1 AS n_tokens")
    docs = docs.unionByName(docs.where("doc_id = 5"))  # a repeated row is used like its twin
    weights = mixing.temperature_weights(mixing.source_shares(docs), repeats=2.3)
    placed = mixing.copies(docs, weights)
    assert placed.where("doc_id = 5").select("copies").distinct().count() == 1
    reached = placed.where("source = 'b' AND copies > epochs").groupBy("block").count().count()
    whole = placed.where("source = 'b'").groupBy("block").agg(F.max("copies").alias("h"), F.min("copies").alias("l"))
    assert whole.where("h <> l").count() <= 1 and reached >= 1
    places = mixing.permuted(mixing.uses(placed)).groupBy("source", "epoch", "block").agg(
        F.max("place").alias("m"), F.count(F.lit(1)).alias("n"))
    assert places.where("m <> n").count() == 0
    empty = docs.where("1 = 0")
    assert mixing.copies(empty, mixing.temperature_weights(mixing.source_shares(empty), repeats=2.0)).collect() == []


def test_licences_by_identifier(spark):
    names = ["BSD-3-Clause", "BSD-2-Clause", "ISC", "GPL-2.0-only", "LGPL-2.1-or-later", "AGPL-3.0-only", "CC0-1.0", "Unlicense", "EPL-2.0", "CC-BY-3.0"]
    grant = "Foo is free software; you " + licences.SENTENCES["gpl2-later"][0].split("; you ", 1)[1]
    texts = [(f"// SPDX-License-Identifier: {n}\ncode", n) for n in names] + [(grant, "GPL-2.0-or-later")]
    df = spark.createDataFrame(texts, "text string, name string").select("name", licences.scan(F.col("text")).alias("f"))
    assert [list(r["f"]["licences"]) for r in df.collect()] == [[n] for _, n in texts]


def test_every_sentence_and_rule():
    """Each known sentence is found under its name, each rule's sentences give its licence."""
    for name, variants in licences.SENTENCES.items():
        for text in variants:
            assert licences.sentence_ids("Something else.\n" + text.replace("*", "A B, Inc. and others")) == ([name], 0), text
    for licence, marks in licences.RULES:
        text = "\n".join(licences.SENTENCES[m][0].replace("*", "X") for m in marks)
        assert licences.licences_of(licences.sentence_ids(text)[0]) == ([licence], []), licence


def test_names_of_any_length_and_many_beginnings():
    head, tail = licences.SENTENCES["bsd-names"][0].split(" * ")
    assert licences.sentence_ids(f"{head} {'word ' * 5000}{tail}") == (["bsd-names"], 0)
    start = time.perf_counter()
    assert licences.sentence_ids(f"{head}.\n" * 20_000) == ([], 0)
    assert time.perf_counter() - start < 5
    assert licences.sentence_ids(f"{head} one.\n{head} two {tail}")[0] == ["bsd-names"]


def test_licences(spark, odd_docs):
    grant = " ".join(licences.SENTENCES["bsd-grant"] + licences.SENTENCES["bsd-source"] + licences.SENTENCES["bsd-binary"])
    names = licences.SENTENCES["bsd-names"][0].replace("*", "the Old Mill Company")
    cases = {
        "Text before\nReleased under the MIT License.\nText after": (["MIT"], []),
        "# Licensed under the Apache License,\n#   Version 2.0 (the \"License\");\n# other words": (["Apache-2.0"], []),
        grant: (["BSD-2-Clause"], []), grant + " " + names: (["BSD-3-Clause"], []), names: ([], ["bsd-names"]),
        "not released under the MIT License.": ([], []),
        "Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.": (["CC-BY-4.0", "CC-BY-NC-4.0"], []),
        "  // " + "\n  // ".join(licences.SENTENCES["mit-grant"][0].split()): ([], ["mit-grant"]),
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string").select("text", licences.scan(F.col("text")).alias("f"))
    for r in df.collect():
        assert (list(r["f"]["licences"]), list(r["f"]["unmatched"])) == cases[r["text"]], r["text"]
    assert licences.sentence_ids("This code has its own licence. All is well.") == ([], 1)
    odd = odd_docs.select(licences.scan(F.col("text")).alias("f")).collect()
    assert all(list(r["f"]["licences"]) == [] for r in odd)


def test_spot_likeness(spark, odd_docs, no_docs):
    base = "The harbour master is proud of a lighthouse while the keeper was asleep and the lantern turned slowly in a fog"
    near = base.replace("asleep", "awake")
    rows = [(1, base), (2, base.upper() + "!"), (3, near), (4, "Other words about a garden with the tulips and a fountain"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    prints = {r["doc_id"]: set(r["found"]) for r in spots.fingerprints(docs).collect()}
    assert prints[1] == prints[2] and prints[5] == prints[6] and not prints[1] & prints[4]
    assert 0.5 <= len(prints[1] & prints[3]) / len(prints[1] | prints[3]) < 1
    pairs, members = spots.near_duplicates(docs, 0.5)
    number = {r["doc_id"]: r["number"] for r in members.collect()}
    assert number[1] == number[2]
    assert [(r["a"], r["b"]) for r in pairs.collect()] == [tuple(sorted((number[1], number[3])))]
    lined = spots.with_successor(odd_docs, "doc_id", "text").collect()
    assert len(lined) == odd_docs.count() and all(r["next_text"] is not None for r in lined)
    follows = {r["key"]: r["next_text"] for r in lined if r["key"] in (9, 6)}
    assert follows == {9: "same text here for all of them", 6: "one"}
    assert spots.with_successor(no_docs, "doc_id", "text").collect() == []


def test_signatures_make_words_once(spark):
    """A text's words and its chains are worked out at one place of the expression each."""
    texts = ["the cat sat on the mat", "nothing common here", "", "lone", "The The a B c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(spots.signatures(F.col("text")).alias("found"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1 and plan.count("regexp_extract_all(") == 2
    chains = (["the cat sat"], ["nothing common here"], [""], ["lone"], ["the the a b c", "the a b c", "a b c"])
    hashed = [sorted(spark.sql("SELECT " + ", ".join(f"hash('{c}')" for c in some)).first()) for some in chains]
    assert [r["found"] for r in df.collect()] == hashed


def test_scored_pieces_take_little_memory():
    """What a worker holds while it looks up the grams of one piece."""
    texts = ["some words of a text that is long enough, number %d. " % i * 20 for i in range(5000)]
    keys = np.unique(ppm.grams_of([ppm.normal_bytes(t) for t in texts[:50]], 5)[0])
    tracemalloc.start()
    for piece in ppm._pieces(texts, ppm.SCORED_BYTES):
        codes, _ = ppm.grams_of(piece, 5)
        ppm._found(keys, codes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50_000_000
