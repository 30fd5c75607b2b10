from __future__ import annotations

from datetime import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from lotwise.operators.cleaning_de import clean_de, cleaning_report_de
from lotwise.operators.cleaning_us import clean_us, dedup_us
from lotwise.vocab import DE_RAW_COLUMNS, US_RENAMES

DE = dict(zip(DE_RAW_COLUMNS, ("Volkswagen Golf", "12.345 €", "45.000 km", "EZ 03/2020", "150 PS", "Automatik", "Benzin",
                               "2 Fahrzeughalter", "Berlin", "https://x.example.com/1", "ABS", "Text")))
US = {**dict.fromkeys(US_RENAMES), "@id": "1", "createdAt": "2025-01-01T00:00:00Z", "retailListing_price": "$24,999",
      "retailListing_miles": "45,000 mi", "vehicle_year": "2020", "vehicle_make": "Ford", "vehicle_model": "F-150",
      "vehicle_vin": "1HGCM82633A004352", "history_ownerCount": "1", "history_accidentCount": "0", "history_oneOwner": "yes",
      "retailListing_zip": "02139"}
NOW = "2026-01-15T12:00:00Z"


def de(spark, *changes):
    schema = ", ".join(f"`{c}` string" for c in DE_RAW_COLUMNS) + ", row_pos bigint"
    return spark.createDataFrame([(*({**DE, **c}[k] for k in DE_RAW_COLUMNS), i) for i, c in enumerate(changes)], schema)


def us(spark, *changes):
    schema = ", ".join(f"`{c}` string" for c in US_RENAMES) + ", extra string, row_pos bigint"
    return spark.createDataFrame([(*({**US, **c}[k] for k in US_RENAMES), "x", i) for i, c in enumerate(changes)], schema)


def test_de_row(spark):
    row = clean_de(de(spark, {})).first().asDict()
    assert row["price_eur"] == 12345.0 and row["mileage_km"] == 45000.0 and row["power_ps"] == 150.0
    assert (row["registration"], row["brand"], row["model"]) == ("03/2020", "volkswagen", "golf")
    assert (row["transmission"], row["fuel"], row["owners"]) == ("automatic", "petrol", 2.0)
    assert row["car_age"] == pytest.approx(2132 / 365) and row["price_per_km"] == pytest.approx(12345 / 45000)
    assert (row["market"], row["source"], row["URL"]) == ("DE", "mobile", "https://x.example.com/1")
    assert "year" not in row and "reg_date" not in row


def test_de_columns_follow_input_order(spark):
    assert clean_de(de(spark, {}).drop("row_pos")).columns == [
        "title", "price_eur", "mileage_km", "power_ps", "transmission", "fuel", "owners", "location", "URL",
        "Ausstattung", "Beschreibung", "registration", "brand", "model", "car_age", "price_per_km", "market", "source"]


@pytest.mark.parametrize("column, kept, dropped", [
    ("Preis", ["501 €", "199.999 €"], ["500 €", "200.000 €", "auf Anfrage", None]),
    ("Kilometerstand", ["0 km", "299.999 km"], ["-1 km", "300.000 km", "N/A"]),
    ("Erstzulassung", ["01/1991", "12/2026", "3/2020"], ["12/1990", "01/2027", "13/2020", "EZ: 03/2019"]),
])
def test_de_bounds(spark, column, kept, dropped):
    rows = clean_de(de(spark, *[{column: v} for v in kept + dropped]))
    assert sorted(values(rows, "row_pos")) == list(range(len(kept)))


def test_de_zero_mileage_has_no_ratio(spark):
    assert values(clean_de(de(spark, {"Kilometerstand": "0 km"})), "price_per_km") == [None]


def test_de_unmapped_words(spark):
    rows = clean_de(de(spark, {"Kraftstoff": "Autogas (LPG)", "Getriebe": "CVT", "PS": "N/A", "Fahrzeughalter": "N/A"}))
    assert rows.select("fuel", "transmission", "power_ps", "owners").first() == (None, None, None, None)


def test_de_copies_collapse_with_nulls_equal(spark):
    rows = clean_de(de(spark, {"PS": "N/A"}, {}, {"PS": "N/A"}, {"Beschreibung": "anders"}))
    assert sorted(values(rows, "row_pos")) == [0, 1, 3]


def test_de_report_and_permutation(spark):
    raw = de(spark, {}, {"Preis": "500 €"}, {"Preis": "x"}, {"Kilometerstand": "300.000 km"}, {"Erstzulassung": "01/2027"})
    assert tuple(cleaning_report_de(raw).first()) == (5, 4, 3, 2, 1)
    assert clean_de(raw.orderBy(F.desc("row_pos"))).collect() == clean_de(raw).collect()


def test_us_row(spark):
    row = clean_us(us(spark, {}), NOW).first().asDict()
    assert (row["id"], row["make"], row["model"], row["year"]) == ("1", "ford", "f-150", 2020.0)
    assert (row["price_usd"], row["mileage_mi"], row["car_age"]) == (24999.0, 45000.0, 6.0)
    assert row["created_at"] == datetime(2025, 1, 1) and row["listing_age_days"] == 379
    assert (row["one_owner"], row["zip_code"], row["market"], row["source"]) == (True, "02139", "US", "auto.dev")
    assert not {"location", "extra", "vin_raw", "vehicle_vin", "row_pos"} & set(row)


@pytest.mark.parametrize("column, kept, dropped", [
    ("retailListing_price", ["500", "$300,000"], ["499", "300001", "call", None]),
    ("retailListing_miles", ["0", "400,000 mi"], ["-1", "400001", None]),
    ("vehicle_year", ["1990", "2026"], ["1989", "2027", ""]),
    ("history_ownerCount", ["0", "15", None], ["16"]),
    ("history_accidentCount", ["20", "N/A"], ["21"]),
    ("vehicle_make", ["Ford"], ["None", "", "nan", None]),
])
def test_us_bounds(spark, column, kept, dropped):
    changes = [{column: v, "@id": str(i), "vehicle_vin": f"1HGCM82633A0{i:05d}"} for i, v in enumerate(kept + dropped)]
    assert sorted(values(clean_us(us(spark, *changes), NOW), "id")) == [str(i) for i in range(len(kept))]


def test_us_vin_falls_back_and_keeps_invalid_rows(spark):
    rows = clean_us(us(spark, {"vehicle_vin": None, "vin": " 1hgcm82633a "}, {"vehicle_vin": "BAD!", "vin": "1HGCM82633A"}), NOW)
    assert sorted(values(rows, "vin"), key=str) == ["1HGCM82633A", None]


def test_us_first_copy_stays_and_missing_vins_compare_equal(spark):
    rows = clean_us(us(spark, {"@id": "b"}, {"@id": "a"}, {"@id": "c", "vehicle_vin": None}, {"@id": "d", "vehicle_vin": "x"}), NOW)
    assert sorted(values(rows, "id")) == ["b", "c"]


def test_us_listing_age(spark):
    rows = clean_us(us(spark, {"createdAt": "2026-02-01T00:00:00Z"}), NOW)
    assert values(rows, "listing_age_days") == [0]
    assert values(clean_us(us(spark, {"createdAt": "junk"}), NOW), "listing_age_days") == [None]
    assert "listing_age_days" not in clean_us(us(spark, {}).drop("createdAt"), NOW).columns


def test_us_absent_columns(spark):
    rows = clean_us(us(spark, {}).drop("vin", "vehicle_vin", "history_ownerCount"), NOW)
    assert values(rows, "vin") == [None] and "owner_count" not in rows.columns


def test_dedup_of_one_hot_key(spark):
    rows = spark.range(0, 20000, 1, 8).selectExpr("id AS row_pos", "CAST(NULL AS STRING) AS vin",
                                                  "CAST(id % 2 AS DOUBLE) AS price_usd")
    kept = dedup_us(rows)
    assert sorted(values(kept, "row_pos")) == [0, 1]
    plan = kept._jdf.queryExecution().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") < plan.rindex("WindowGroupLimit")
