from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lotwise.functions import text as T
from lotwise.operators.explain import feature_label, signed_amount


def run(spark, fn, inputs, schema="s string"):
    rows = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(inputs)], f"i int, {schema}")
    return [r[0] for r in rows.orderBy("i").select(fn(*[F.col(c) for c in rows.columns[1:]]).alias("x")).collect()]


CASES = [
    (T.german_amount, {"12.345 €": 12345.0, "19.999,50 €": 19999.5, "1 234 €": 1234.0, "auf Anfrage": None,
                       "N/A": None, "nan": None, "12d": None, " 7 ": 7.0, "": None, None: None}),
    (T.german_distance, {"45.000 km": 45000.0, "0 km": 0.0, "-5 km": -5.0, "unknown": None, "45.000 km": 45000.0}),
    (T.horse_power, {"150 PS": 150.0, "N/A": None, "150,5 PS": None, "150.5 PS": 150.5}),
    (T.first_digits, {"2 Fahrzeughalter": "2", "ab 12 und 3": "12", "N/A": None}),
    (T.scrub_number, {"$24,999": 24999.0, "45,000 mi": 45000.0, "€12,500.50": 12500.5, "N/A": None, "-500 mi": -500.0,
                      "1-2": None, "2015.0": 2015.0, "": None, "1e5": 15.0}),
    (T.word_to_boolean, {"true": True, "1": True, "Yes": True, " y ": True, "T": True, "false": False, "0": False,
                         "no": False, "N": False, "f": False, "nan": None, "none": None, "null": None, "": None,
                         "maybe": None, None: None}),
    (lambda c: T.month_year(c).cast("string"), {
        "EZ 03/2020": "2020-03-01", "3/2020": "2020-03-01", "13/2020": None, "00/2020": None,
        "Erstzulassung 11/2019": "2019-11-01", "EZ: 03/2019": None, "03/202": None, "03/20201": None, "N/A": None}),
    (lambda c: T.month_year(c, lenient=True).cast("string"), {"EZ: 03/2019": "2019-03-01", "EZ 03/2019": "2019-03-01"}),
    (lambda c: T.title_word(c, 0), {"Volkswagen Golf": "volkswagen", "  BMW  X5 ": "bmw", "": None, "  ": None, None: None}),
    (lambda c: T.title_word(c, 1), {"Volkswagen Golf": "golf", "BMW": None}),
    (T.strip, {"  a b\t\n": "a b", "ä": "ä", "": "", " ": "", "x": "x"}),
    (T.safe_text, {None: "unbekannt", "": "unbekannt", "  ": "", " BMW ": "bmw"}),
    (T.display_name, {"mercedes-benz": "Mercedes-Benz", "nx": "NX", "f-150": "F-150", "c-klasse": "C-Klasse",
                      "GOLF": "Golf", "": "", None: None, "öl": "ÖL"}),
    (lambda c: T.canonical_link(c, "https://h"), {"/a?x=1&y=2": "https://h/a?x=1", "https://o/a": "https://o/a",
                                                "/a?x=1?z=3&q": "https://h/a?x=1"}),
    (lambda c: T.valid_vin(c, r"^[A-HJ-NPR-Z0-9]{11,17}$"), {
        " 1hgcm82633a004352 ": "1HGCM82633A004352", "INVALIDVIN!!!": None, "1HGCM82633A": "1HGCM82633A",
        "1HGCM82633": None, "IOQIOQIOQIOQ": None, None: None}),
    (feature_label, {"mileage": "Kilometerstand", "brand_bmw": "Marke: BMW", "fuel_diesel": "Kraftstoff: Diesel",
                     "some_new_thing": "Some New Thing", "body_style_suv": "Karosserie: SUV"}),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_text_rule(spark, case):
    fn, table = CASES[case]
    assert dict(zip(table, run(spark, fn, list(table)))) == table


def test_title_without_brand(spark):
    pairs = [("BMW X5  M", "bmw"), ("X5 bmwx BMW", "bmw"), ("a.b car", "a.b"), ("axb car", "a.b"), ("x\\Ey z", "x\\Ey")]
    assert run(spark, T.title_without_brand, pairs, "t string, b string") == ["X5 M", "X5 bmwx", "car", "axb car", "z"]


def test_signed_amount(spark):
    rows = run(spark, lambda c: signed_amount(c.cast("double"), "US"), ["1234.6", "-0.4", "0", "2.5"])
    assert rows == ["+1,235 $", "-0 $", "+0 $", "+2 $"]
