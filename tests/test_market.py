from __future__ import annotations

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from lotwise.operators import market as M
from lotwise.operators.dedup import top_rows
from lotwise.vocab import BRAND_MODELS

LISTING = "id bigint, market string, brand string, model string, title string, price double, mileage double, location string, url string"


def view_de(spark, rows):
    """Rows (id, brand, model, title, price, mileage, location, fuel, power, owners, age)."""
    return spark.createDataFrame(rows, "id bigint, brand string, model string, title string, price double, mileage double, "
                                       "location string, fuel string, power_ps double, owners int, car_age double")


def test_market_view_joins_and_suffixes(spark):
    listings = spark.createDataFrame([(1, "DE", " BMW ", "X5", "BMW X5 M", 1.0, 2.0, "B", "u"), (2, "DE", None, "A", None, 1.0, 2.0, None, None),
                                      (3, "US", "ford", "f-150", None, 1.0, 2.0, None, None)], LISTING)
    details = spark.createDataFrame([(1, "petrol", "x")], "Listing_ID bigint, Fuel string, url string")
    features = spark.createDataFrame([(1, 1, 5)], "listing_id bigint, ausstattung_burmester_standart int, price int")
    rows = {r["id"]: r for r in M.market_view("de", listings, details, features).collect()}
    assert sorted(rows) == [1, 2]
    assert (rows[1]["brand"], rows[1]["fuel"], rows[1]["url"], rows[1]["url_de"]) == ("bmw", "petrol", "u", "x")
    assert (rows[1]["ausstattung_burmester_standard"], rows[1]["price"], rows[1]["price_feat"]) == (1, 1.0, 5)
    assert (rows[2]["brand"], rows[2]["fuel"]) == (None, None)


def test_market_view_us_titles(spark):
    listings = spark.createDataFrame([(i, "US", "ford", "f-150", None, 1.0, 2.0, None, None) for i in (1, 2, 3)], LISTING)
    details = spark.createDataFrame([(1, "XLT "), (2, " "), (3, None)], "listing_id bigint, trim string")
    rows = {r["id"]: r["title"] for r in M.market_view("US", listings, details).collect()}
    assert rows == {1: "Ford F-150 XLT", 2: "Ford F-150", 3: "Ford F-150"}
    bare = M.market_view("US", listings.drop("location", "url"))
    assert bare.first()["url"] == "" and bare.first()["title"] == "Ford F-150"


def test_options(spark):
    view = view_de(spark, [(1, "bmw", "x5", "BMW X5 M", 1.0, 1.0, "Berlin", None, 200.0, 1, 1.0), (2, "bmw", "x5", "X5  bmw M", 1.0, 1.0, "", None, 301.0, 1, 1.0),
                           (3, "bmw", "x5", "BMW X5 m", 1.0, 1.0, None, None, -1.0, 1, 1.0), (4, "bmw", "x3", "BMW", 1.0, 1.0, "nan", None, 99.0, 1, 1.0)])
    assert values(M.brand_options(view), "brand") == ["bmw"]
    models = {(r["brand"], r["model"]) for r in M.model_options(view).collect()}
    assert models == {("bmw", "x5"), ("bmw", "x3")} | {(b, m) for b, ms in BRAND_MODELS.items() for m in ms}
    trims = sorted((r["model"], r["ordinal"], r["option"]) for r in M.trim_options(view).collect())
    assert trims == [("x3", 0, "Alle"), ("x5", 0, "Alle"), ("x5", 1, "X5 M"), ("x5", 2, "X5 m")]
    assert {(r["model"], r["ordinal"]) for r in M.model_options(view).where("brand = 'bmw'").collect()} == {("x3", 1), ("x5", 2)}
    nameless = M.model_options(view.withColumns({"model": F.lit(None).cast("string")}).withColumn("brand", F.lit("opel")))
    assert values(nameless.where("brand = 'opel'"), "model") == ["unknown"]
    assert values(M.location_options(view), "location") == ["Berlin"]
    power = {(r["model"], r["trim"]): r["power_ps"] for r in M.default_power(view).collect()}
    assert power == {("x5", "x5 m"): 250, ("x3", ""): 99}
    assert values(M.default_power(view.withColumn("power_ps", F.lit(None).cast("double"))), "power_ps") == [150, 150]


def brute_match(offer, want):
    num = lambda k: want.get(k) or 0
    return (
        offer["brand"] == want["brand"] and offer["model"] == want["model"]
        and (num("mileage") <= 0 or (offer["mileage"] or 0) <= num("mileage"))
        and (num("car_age") <= 0 or (offer["car_age"] or 0) <= num("car_age"))
        and (num("owners") <= 0 or (99 if offer["owners"] is None else offer["owners"]) <= num("owners"))
        and (num("power_ps") <= 0 or (offer["power_ps"] or 0) >= num("power_ps"))
        and (not want.get("fuel") or (offer["fuel"] or "").lower() == want["fuel"].lower())
    )


def test_match_offers_against_brute_force(spark):
    rng = random.Random(3)
    maybe = lambda v: rng.choice([v, v, None])
    offers = [(i, rng.choice("aab"), rng.choice("xxy"), "t", maybe(rng.random() * 100), maybe(float(rng.randint(0, 9))), "L",
               maybe(rng.choice(["Petrol", "diesel"])), maybe(float(rng.randint(1, 9))), maybe(rng.randint(0, 4)), maybe(float(rng.randint(0, 9))))
              for i in range(300)]
    wants = [(s, rng.choice("ab"), rng.choice("xy"), maybe(float(rng.randint(0, 9))), maybe(float(rng.randint(0, 9))), maybe(float(rng.randint(0, 3))),
              maybe(float(rng.randint(0, 5))), maybe(rng.choice(["petrol", "DIESEL", ""]))) for s in range(25)]
    view = view_de(spark, offers)
    subjects = spark.createDataFrame(wants, "subject_id bigint, brand string, model string, mileage double, car_age double, "
                                            "owners double, power_ps double, fuel string")
    matched = M.match_offers(view, subjects, "DE").cache()
    o, w = [r.asDict() for r in view.collect()], [r.asDict() for r in subjects.collect()]
    want = {(s["subject_id"], x["id"]) for s in w for x in o if brute_match(x, s)}
    assert {(r["subject_id"], r["id"]) for r in matched.collect()} == want
    hot = M.hot_models(view, 20)
    assert max(values(hot, "slices")) > 5
    sliced = M.match_offers(view, subjects, "DE", hot)
    assert sliced.columns == matched.columns
    assert sorted((r["subject_id"], r["id"]) for r in sliced.collect()) == sorted(want)
    for ascending in (True, False):
        best = M.best_offers(matched, "price", ascending, 4).collect()
        price = {x["id"]: x["price"] for x in o}
        for s in w:
            ids = sorted((i for k, i in want if k == s["subject_id"]),
                         key=lambda i: (price[i] is None, (price[i] or 0) * (1 if ascending else -1), i))[:4]
            assert [r["id"] for r in sorted(best, key=lambda r: r["offer_rank"]) if r["subject_id"] == s["subject_id"]] == ids
        expected = sorted((r["subject_id"], r["offer_rank"], r["id"], r["title"]) for r in best)
        for rows_per_run in (5, 10_000):
            pruned = M.best_matches(view, subjects, "DE", "price", ascending, 4, rows_per_run)
            assert sorted((r["subject_id"], r["offer_rank"], r["id"], r["title"]) for r in pruned.collect()) == expected
    counts = {r["subject_id"]: r["offers"] for r in M.offer_counts(matched).collect()}
    assert sum(counts.values()) == len(want)
    assert "WindowGroupLimit" in M.best_offers(M.match_offers(view, subjects, "DE"))._jdf.queryExecution().toString()


def test_buyers_who_ask_the_same_are_one_question(spark, monkeypatch):
    """Many buyers of a hot model with many offers: what the joins put out is a few runs, not buyers times offers."""
    offers = spark.range(4000).selectExpr("id", "'a' AS brand", "'x' AS model", "double(id) AS price", "double(id % 7) AS mileage", "'t' AS title")
    buyers = spark.range(500).selectExpr("id AS subject_id", "'a' AS brand", "'x' AS model", "double(id % 2 + 5) AS mileage")
    seen = []

    def watched(df, keys, order, limit, rank):
        seen.append(df.count())
        return top_rows(df, keys, order, limit, rank)

    monkeypatch.setattr(M, "top_rows", watched)
    best = M.best_matches(offers, buyers, "DE", limit=20, rows_per_run=100)
    assert best.count() == 500 * 20 and sum(seen) <= 2 * 100
    want = {0: [i for i in range(4000) if i % 7 <= 5][:20], 1: list(range(20))}
    for s in (0, 1, 498, 499):
        assert values(best.where(F.col("subject_id") == s).orderBy("offer_rank"), "id") == want[s % 2]


def test_us_criteria_and_owner_quirk(spark):
    view = spark.createDataFrame([(1, "a", "x", "XLT", "V6", "gas", 6.0, 3), (2, "a", "x", None, "V8", "GAS", None, 3)],
                                 "id bigint, brand string, model string, trim string, engine string, fuel string, cylinders double, owner_count int")
    subject = lambda **k: spark.createDataFrame([(9, "a", "x", *k.values())], "subject_id bigint, brand string, model string, " + ", ".join(
        f"{n} {'double' if isinstance(v, float) else 'string'}" for n, v in k.items()))
    ids = lambda **k: sorted(values(M.match_offers(view, subject(**k), "US"), "id"))
    assert ids(trim="unknown", fuel="Gas") == [1, 2]
    assert ids(trim="xlt") == [1] and ids(engine="v8") == [2] and ids(cylinders=6.0) == [1]
    assert ids(owner_count=1.0) == [1, 2]


def test_trim_and_location(spark):
    view = view_de(spark, [(1, "bmw", "x5", "BMW X5 M", 1.0, 1.0, "B", None, 1.0, 1, 1.0), (2, "bmw", "x5", "BMW X5", 1.0, 1.0, None, None, 1.0, 1, 1.0)])
    want = spark.createDataFrame([(1, "bmw", "x5", "x5 m", None), (2, "bmw", "x5", "Alle", None), (3, "bmw", "x5", "Alle", "B")],
                                 "subject_id bigint, brand string, model string, trim string, location string")
    got = sorted((r["subject_id"], r["id"]) for r in M.match_offers(view, want, "DE").collect())
    assert got == [(1, 1), (2, 1), (2, 2), (3, 1)]
    shown = M.display_offers(view.withColumn("url", F.expr("CASE id WHEN 1 THEN 'http://x' ELSE 'ftp' END")), ["id"])
    assert sorted(values(shown, "link")) == ["", "http://x"]
    assert values(M.best_offers(M.match_offers(view, want, "DE"), limit=None), "subject_id") == [1, 2, 2, 3]


def brute_options(offers, want, column):
    base = [o for o in offers if (o["brand"], o["model"]) == (want["brand"], want["model"])]
    refined = base
    for test in (lambda o: (o["fuel"] or "").lower() == (want["fuel"] or "-").lower(), lambda o: o["cylinders"] is not None and o["cylinders"] == want["cylinders"]):
        narrowed = [o for o in refined if test(o)]
        refined = narrowed or refined
    found = sorted({o[column] for o in refined if o[column]})
    return found or (["unknown"] if base else ["fallback"])


def test_refined_options_against_brute_force(spark):
    rng = random.Random(4)
    pick = lambda *v: rng.choice([*v, None])
    offers = [(rng.choice("ab"), rng.choice("xyz"), pick("Gas", "diesel"), pick(4.0, 6.0, 8.0), pick("T1", "T2", ""), pick("V6")) for _ in range(40)]
    wants = [(i, rng.choice("abc"), rng.choice("xyz"), pick("gas", "DIESEL", "none"), pick(4.0, 6.0)) for i in range(40)]
    view = spark.createDataFrame(offers, "brand string, model string, fuel string, cylinders double, trim string, engine string")
    subjects = spark.createDataFrame(wants, "subject_id bigint, brand string, model string, fuel string, cylinders double")
    got = M.refined_options(view, subjects, ["trim", "engine"], {"trim": ["fallback"], "engine": ["fallback"]}).collect()
    o = [r.asDict() for r in view.collect()]
    for s in map(lambda r: r.asDict(), subjects.collect()):
        for column in ("trim", "engine"):
            mine = sorted(r["option"] for r in got if r["subject_id"] == s["subject_id"] and r["field"] == column)
            assert mine == brute_options(o, s, column), (s, column)


@pytest.mark.parametrize("own, expected", [("m2", ["m0", "m1", "m3", "m4", "m5"]), ("m7", ["m0", "m1", "m2", "m3", "m4"]),
                                           (None, ["m0", "m1", "m2", "m3", "m4"])])
def test_alternative_models(spark, own, expected):
    view = spark.createDataFrame([(10 - i, "a", f"m{9 - i}") for i in range(10)] + [(0, "b", "z"), (99, "a", "m0")],
                                 "id bigint, brand string, model string")
    subjects = spark.createDataFrame([(1, "a", own), (2, "zzz", "q")], "subject_id bigint, brand string, model string")
    got = M.alternative_models(view, subjects).orderBy("alt_rank")
    assert values(got, "alt_model") == expected
