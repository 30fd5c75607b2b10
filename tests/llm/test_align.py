"""Alignment of two tokenizers against counting byte by byte."""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter

import public_tokenizers as vocabularies
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotwise.llm import align, queries

SF_DIR = "/root/testdata/sf0.001"
BLOB = open(vocabularies.path("byte_bpe_50k.json"), "rb").read()
OURS = align.ByteSide(BLOB, vocabularies.PATTERN)


@pytest.fixture(scope="module")
def pair():
    return align.Pair(vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model"), vocabularies.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=st.sampled_from(list("abth .,é中😀1\n'sS\t<|>")), max_size=80))
def test_ids_are_those_of_the_library(text):
    library = Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    assert OURS.ranked and OURS.ids([text]) == [library.encode(" " + text, add_special_tokens=False).ids]


def test_other_vocabularies_are_encoded_by_the_library():
    spec = json.loads(BLOB)
    spec["pre_tokenizer"]["use_regex"] = False
    side = align.ByteSide(json.dumps(spec).encode(), vocabularies.PATTERN)
    assert side.ranked is None and side.bytes_of(side.ids(["two words"])[0]) == b" two words"


def plain_tokens():
    first = Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=vocabularies.path("piece_bpe_32k.model"))
    table = align.byte_of_character()

    def tokens(text):
        data = b" " + text.encode()
        a = [(i, bytes(table[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        sound = text and b"".join(t for _, t in a) == data and b"".join(t for _, t in b) == data
        return (a, b) if sound else ([], [])

    return tokens


def plain_alignment(texts):
    """Per text the links, counted byte by byte, and the groups; then the counts over all texts."""
    tokens = plain_tokens()
    found = []
    for text in texts:
        sides = tokens(text or "")
        owners, ends = [], []
        for side in sides:
            owners.append([k for k, (_, data) in enumerate(side) for _ in data])
            ends.append({sum(len(d) for _, d in side[: k + 1]): k for k in range(len(side))} if len(side) < 500 else _ends(side))
        links = Counter((sides[0][x][0], sides[1][y][0]) for x, y in set(zip(*owners)))
        groups, done = [], (0, 0)
        for cut in sorted(ends[0].keys() & ends[1].keys()):
            upto = (ends[0][cut] + 1, ends[1][cut] + 1)
            groups.append("|".join(",".join(str(i) for i, _ in side[d:u]) for side, d, u in zip(sides, done, upto)))
            done = upto
        found.append((len(sides[0]), len(sides[1]), groups, links))
    counts = Counter(p for _, _, _, links in found for p in links)
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    for n_a, n_b, groups, links in found:
        yield (
            n_a, n_b, len(groups), sum(links.values()), sum(t for p, t in links.items() if counts[p] == most[p[0]]),
            sum(t * counts[p] for p, t in links.items()), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )


def _ends(side):
    at, out = 0, {}
    for k, (_, data) in enumerate(side):
        at += len(data)
        out[at] = k
    return out


def values(r):
    return tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


ODD = ["", None, " ", "  two  spaces ", "\ttab\r\n", "漢字😀 ünïcödé", "a▁b", "a<|endoftext|>b", "<s></s><unk>", "<0x41>", "a\x00b", "ﬁ ½",
       "same", "same", "The cat sat on the mat.", "x" * 3000, "lorem ipsum " * 2000]


def test_odd_texts_in_small_chunks(spark, pair, monkeypatch):
    rows = [(i if i != 12 else None, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("key", "chunk", "pair", "n_a", "place")})
    expected = Counter(zip((r[0] for r in rows), plain_alignment(ODD)))
    monkeypatch.setattr(align, "CHUNK_CHARS", 50)
    monkeypatch.setattr(align, "SLICE_CHARS", 20)
    found = align.alignment(df.repartition(3), pair).collect()
    assert Counter((r["doc_id"], values(r)) for r in found) == expected
    assert align.alignment(df.where("1 = 0"), pair).collect() == []
    assert all(sum(v) == 0 for v in ((r["n_a"], r["count_sum"]) for r in found if r["doc_id"] in (0, 1, 6)))


def test_groups_as_rows(spark, pair):
    df = spark.createDataFrame([("The cat, naïve",), (None,), ("",)], "text string")
    found = [r["g"] for r in df.select(align.token_groups(F.col("text"), pair).alias("g")).collect()]
    assert found[1] == found[2] == []
    a, b = plain_tokens()("The cat, naïve")
    assert [i for g in found[0] for i in g["a"]] == [i for i, _ in a] and [i for g in found[0] for i in g["b"]] == [i for i, _ in b]


def test_slices_hold_every_row(pair):
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "", "c" * 50, "d"] * 4)], ["text"])
    parts = list(align.text_slices(batch, 0, 10))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist() and len(parts) >= 4


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not there")
def test_query(spark):
    rows = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    expected = dict(zip((r["doc_id"] for r in rows), plain_alignment([r["text"] for r in rows])))
    assert {r["doc_id"]: values(r) for r in queries.QUERIES["op11_align"](spark, SF_DIR).collect()} == expected
