from __future__ import annotations

import json

import pytest
from conftest import values

from lotwise.functions.documents import leaf_pairs_of, read_document
from lotwise.operators import features as X
from lotwise.vocab import DOCUMENT_FEATURES


def pairs(text):
    found = leaf_pairs_of(text)
    return None if found is None else [(p["key"], p["value"]) for p in found]


@pytest.mark.parametrize("text, value", [
    ('{"a": 1}', {"a": 1}), ("{'a': true, 'b': null}", {"a": True, "b": None}), ("[1, 2]", [1, 2]), ("", {}), (None, {}),
    ("not valid json", {}), ("5", 5), ("'text'", {}), ("{'a': ", {}), ('{"a": 1} rest', {}), (" {} ", {}),
])
def test_read_document(text, value):
    assert read_document(text) == value


def test_leaf_pairs():
    assert pairs('{"A": {" Key ": "V "}, "b": true, "c": null, "l": [1], "d": 1.50}') == [
        ("key", "v"), ("b", "true"), ("c", "none"), ("d", "1.5")]
    assert pairs('{"x": {"k": 1}, "m": 2, "y": {"K": 3}}') == [("k", "3"), ("m", "2")]
    assert pairs("[1]") is None and pairs("7") is None
    assert pairs(None) == [] and pairs("junk") == []


def flags(spark, *documents):
    rows = spark.createDataFrame(
        [(i, d if d is None or isinstance(d, str) else json.dumps(d, ensure_ascii=False)) for i, d in enumerate(documents)],
        "listing_id bigint, ai_features string")
    return {r["listing_id"]: r.asDict() for r in X.document_features(rows).collect()}


def test_condition_rules(spark):
    good = {"historie": {"TÜV": "HU neu", "Scheckheft": "lückenlos", "Bereifung": "8-fach", "Garantie": "24 Monate",
                         "Unfallfrei": True, "Mängel": "Keine"}}
    bad = {"TÜV": "abgelaufen", "Scheckheft": "nein", "Bereifung": "Sommer", "Garantie": "keine",
           "Unfallfrei": "Nachlackierung, sonst ja", "Mängel": "Delle"}
    row = flags(spark, good, bad)
    names = ("tuv_neu", "scheckheft_gepflegt", "bereifung_8_fach", "garantie_monate", "unfallfrei", "mangel_vorhanden")
    assert [row[0][n] for n in names] == [1, 1, 1, 24, 1, 0]
    assert [row[1][n] for n in names] == [0, 0, 0, 0, 0, 1]


def test_first_matching_key_in_document_order(spark):
    row = flags(spark, {"reifen": "Sommer", "bereifung": "8-fach"}, {"bereifung": "8-fach", "reifen": "Sommer"},
                {"reifen": "Sommer", "ganzjahresreifen": "true"}, {"garantie": "1 Jahr"}, {"mangel": "none"}, {"mangel": ""})
    assert [row[i]["bereifung_8_fach"] for i in (0, 1)] == [0, 1]
    assert row[2]["bereifung_allwetter"] == 1
    assert row[3]["garantie_monate"] == 1
    assert row[4]["mangel_vorhanden"] == row[5]["mangel_vorhanden"] == 0


def test_equipment_rules(spark):
    row = flags(spark, {"Distronic": True, "Licht": "MULTIBEAM LED", "Klima": "4-Zonen", "Sound": "Burmester 3D Surround",
                        "Paket": "AMG Line", "Dach": "Panorama"},
                {"Distronic": False, "pano": "nein", "amg line": None, "matrix": "0"})
    assert [row[0][n] for n in DOCUMENT_FEATURES[7:]] == [1, 1, 1, 0, 1, 1, 1, 1]
    assert sum(row[1][n] for n in DOCUMENT_FEATURES) == 0


def test_which_documents_stay(spark):
    row = flags(spark, None, "junk", "{}", "[1]", "3", "{'TÜV': 'neu'}")
    assert sorted(row) == [0, 1, 2, 5]
    assert row[5]["tuv_neu"] == 1 and all(row[i][n] == 0 for i in (0, 1, 2) for n in DOCUMENT_FEATURES)


def test_responses(spark):
    rows = spark.createDataFrame([(1, 'Hier: {"a": {"b": 1}} ok'), (2, '{"a": 1'), (3, "nichts"), (4, None), (5, '{"a": 1} {x}'),
                                  (6, 'x\n{"a":\n 2}\ny'), (7, "} {")], "listing_id bigint, raw_output string")
    got = {r["listing_id"]: r["ai_features"] for r in X.parse_responses(rows).collect()}
    assert got == {1: '{"a": {"b": 1}}', 2: None, 3: None, 4: None, 5: None, 6: '{"a":\n 2}', 7: None}


def test_prompts(spark):
    listings = spark.createDataFrame([(99,), (100,), (817,), (818,), (500,)], "id bigint")
    details = spark.createDataFrame([(99, "a"), (100, "b"), (817, "c"), (818, "d"), (500, None)], "listing_id bigint, beschreibung string")
    assert sorted(values(X.prompt_candidates(listings, details, 100, 817), "id")) == [100, 817]
    assert X.prompt_candidates(listings, details).count() == 4
    made = X.build_prompts(X.prompt_candidates(listings, details, 100, 100), "vor {text} nach")
    assert values(made, "prompt") == ["vor b nach"]
