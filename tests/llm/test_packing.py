from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from lotwise.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("width", [1, 7, 15, 16, 17, 31, 32])
def test_bits_blocks_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 9001).astype("<u4")
    assert (packing.unpack(packing.pack(ids, width), width, len(ids)) == ids).all()
    counts = np.array([0, 1, 4095, 0, 4905])
    s = packing.Segment(packing.build_segment([None, 1, 2, 3, 4], counts, ids, width, 0, 0, 0))
    assert (np.concatenate([s.document(i) for i in range(5)]) == ids).all()
    assert (s.block(2) == ids[8192:]).all() and list(s.there) == [False, True, True, True, True]
    with pytest.raises(ValueError):
        packing.pack(np.array([2**width], "u8"), width)


def test_width():
    assert [packing.width_of(v) for v in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize("apart", [True, False])
def test_files(spark, odd_docs, no_docs, apart, monkeypatch):
    path = packing.write_packed(odd_docs, PATH, words_apart=apart)
    rows = packing.read_packed(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(PATH)
    expected = sorted(
        [r["doc_id"] is not None, r["doc_id"] or 0, library.encode(r["text"] or "", add_special_tokens=False).ids + [1]]
        for r in odd_docs.collect()
    )
    assert sorted([r["doc_id"] is not None, r["doc_id"] or 0, list(r["ids"])] for r in rows) == expected
    assert [r["doc_id"] or 0 for r in rows] == sorted(r["doc_id"] or 0 for r in rows)
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    assert packing.read_packed(spark, packing.write_packed(no_docs, PATH)).collect() == []


def test_word_ids_are_the_librarys_and_words_of_letters_go_together():
    """Marks, capitals, accents, digits, special strings: the ids of whole words; letters alone are encoded in few texts."""
    rng = random.Random(5)
    letters = "abstzAZ09\u00e9\u00c9\u00df\u00d7\u00f7\u0130\u0301\u0307\u00bc\u03a3\u212a'.,;:!?-<|>_()*\u6f22\u037e"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(20_000)]
    words += ["it's.", "IT'S,", "<|endoftext|>.", "<|ENDOFTEXT|>", "a<|endoftext|>b!", "...", "x...", "5.", "\u00e9!", "e\u0301.", "'ll."]
    plain = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz\u00e0\u00ff", k=9)) for _ in range(5000)]
    with open(PATH, "rb") as f:
        own = packing.WordTokenizer(f.read())
    library, calls = own.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **kw):
            calls.extend(texts)
            return library.encode_batch_fast(texts, **kw)

    own.tokenizer = Counting()
    for some in (plain, words):
        counts, ids = own.encode(pa.array([" ".join(some[i : i + 7]) for i in range(0, len(some), 7)]))
        expected = [library.encode(" ".join(some[i : i + 7]), add_special_tokens=False).ids for i in range(0, len(some), 7)]
        assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]
        assert some is not plain or len(calls) <= len(plain) // 100
