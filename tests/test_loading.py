from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F
from test_cleaning import NOW, de, us

from lotwise.operators import loading, market
from lotwise.plans import ingest, registry
from lotwise.plans.workspace import workspace
from lotwise.session import scratch_path
from lotwise.sources import driver_views, raw, store
from lotwise.streaming import append


def test_run_de(spark):
    root = scratch_path(spark, "de")
    raw_rows = de(spark, {"Titel": "BMW X5"}, {"Preis": "1 €"}, {"Titel": "AUDI A4", "PS": "N/A", "Fahrzeughalter": "N/A"})
    tables = ingest.run(raw_rows, "de", root, 7, base=100)
    parents = {r["id"]: r for r in tables.listings.collect()}
    assert sorted(parents) == [101, 102]
    assert (parents[101]["brand"], parents[102]["brand"]) == ("bmw", "audi")
    assert (parents[101]["dataset_id"], parents[101]["currency"], parents[101]["mileage_unit"]) == (7, "EUR", "km")
    assert parents[101]["year"] is None and parents[101]["market"] == "DE" and parents[101]["url"].startswith("https")
    child = {r["listing_id"]: r for r in tables.details.collect()}
    assert (child[101]["owners"], child[102]["owners"], child[102]["power_ps"]) == (2, None, None)
    assert (child[101]["ausstattung"], child[101]["beschreibung"]) == ("ABS", "Text")


def test_run_both_markets_share_one_table_and_can_repeat(spark):
    root = scratch_path(spark, "both")
    for _ in range(2):
        ingest.run(de(spark, {}), "DE", root, 1)
        tables = ingest.run(us(spark, {}, {"@id": "2", "vehicle_vin": None}), "US", root, 2, NOW, base=10)
    listings = ingest.all_listings(spark, root)
    assert sorted((r["market"], r["id"]) for r in listings.collect()) == [("DE", 1), ("US", 11), ("US", 12)]
    row = listings.where("id = 11").first()
    assert (row["title"], row["location"], row["year"], row["brand"]) == (None, None, 2020, "ford")
    assert tables.details.first()["location"] is None
    plan = listings.where(F.col("market") == "US").select("id")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(market" in plan


def test_unknown_market_and_no_rows(spark):
    with pytest.raises(ValueError, match="unknown market"):
        ingest.clean(de(spark, {}), "FR")
    with pytest.raises(ValueError, match="no listing"):
        ingest.run(de(spark, {"Preis": "x"}), "DE", scratch_path(spark, "none"), 1)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="Beschreibung.*car_age|car_age.*Beschreibung"):
        loading.prepare_de(de(spark, {}).drop("Beschreibung"))


def test_count_mismatch(spark):
    with pytest.raises(RuntimeError, match="mismatch"):
        store.check_row_count(spark.range(3), spark.range(2))


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, None, 1)], "k bigint, v string, n int")
    merged = store.upsert(old, new, "k", [F.desc("n")])
    assert {r["k"]: r["v"] for r in merged.collect()} == {1: "a", 2: "d", 3: None}


def test_csv_round_trip_keeps_text(spark):
    path = scratch_path(spark, "csv")
    rows = de(spark, {"Beschreibung": 'Zeile 1\nZeile 2, "neu"', "Titel": "  BMW "}, {"Beschreibung": None}).drop("row_pos")
    store.append_csv(rows, path)
    store.append_csv(rows.limit(1), path)
    back = raw.read_raw(spark, path, "DE")
    assert back.count() == 3 and back.select("row_pos").distinct().count() == 3
    assert back.where("Beschreibung IS NOT NULL").first()["Beschreibung"] == 'Zeile 1\nZeile 2, "neu"'
    assert set(values(back, "Titel")) == {"  BMW ", "Volkswagen Golf"}
    with pytest.raises(ValueError):
        raw.read_raw(spark, path, "FR")


def test_cleaned_file_name_and_types(spark):
    assert store.cleaned_path("in/raw.csv", "out/") == "out/cleaned_raw.csv"
    cleaned = ingest.clean(de(spark, {}), "DE").drop("row_pos")
    path = store.write_cleaned(cleaned, "raw.csv", scratch_path(spark, "out"), "csv")
    assert raw.read_cleaned(spark, path, "DE", "csv").first() == cleaned.first()


def test_ragged_csv_and_snapshot(spark):
    path = scratch_path(spark, "ragged")
    store.write_ragged_csv([spark.createDataFrame([(1,)], "b int"), spark.createDataFrame([(2,)], "a int")], path)
    assert raw.read_csv(spark, path).columns == ["a", "b"]
    snapshot = store.write_snapshot(spark.range(2), scratch_path(spark, "snap"), datetime(2026, 1, 2, 3, 4, 5))
    assert snapshot.endswith("/run_ts=20260102_030405") and raw.read_csv(spark, snapshot).count() == 2


def test_json_pages(spark, tmp_path):
    pages = [{"data": [{"vin": "A", "history": {"ownerCount": 1}}, {"vin": "B", "x": [1]}]}, {"data": []}]
    for i, page in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(page, indent=1))
    rows = raw.read_json_pages(spark, str(tmp_path))
    assert sorted(values(rows, "vin")) == ["A", "B"] and {"history", "x", "row_pos"} < set(rows.columns)


def test_json_pages_in_lines(spark, tmp_path):
    """Many pages to a file, read in splits: all records in their order, keys of some pages in all."""
    for name, first in (("a", 0), ("b", 1000)):
        pages = [{"data": [{"id": first + 2 * i}, {"id": first + 2 * i + 1, "extra": "x" * 50}] if i % 3 else []} for i in range(300)]
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, pages)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = raw.read_json_pages(spark, str(tmp_path), lines=True)
        assert rows.rdd.getNumPartitions() > 1 and rows.columns == ["extra", "id", "row_pos"]
        found = rows.orderBy("row_pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["id"] for r in found] == [f + 2 * i + j for f in (0, 1000) for i in range(300) if i % 3 for j in (0, 1)]
    assert len({r["row_pos"] for r in found}) == len(found) == 800 and all((r["extra"] is None) == (r["id"] % 2 == 0) for r in found)


def test_inferred_pages_do_not_have_a_file_each(spark):
    w = workspace(spark, "/root/testdata/sf0.01")
    rows = registry.QUERIES["json_pages_inferred"](w)
    assert rows.count() == w.table("events").count() and len(rows.inputFiles()) < w.table("events").count() // 200



def test_bucketed_tables_join_without_shuffle(spark):
    a = store.write_bucketed(spark.range(1000).toDF("id"), "bucketed_a", scratch_path(spark, "a"), "id", 4)
    b = store.write_bucketed(spark.range(500).toDF("listing_id"), "bucketed_b", scratch_path(spark, "b"), "listing_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, a["id"] == b["listing_id"], "left")
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_load_that_stops_half_way_leaves_the_earlier_one(spark, monkeypatch):
    root = scratch_path(spark, "half")
    ingest.run(de(spark, {"Titel": "BMW X5"}), "DE", root, 1)
    write = store.Versions.write

    def stops(self, df, name, *rest):
        if name == "listing_de":
            raise RuntimeError("stopped between parent and child")
        return write(self, df, name, *rest)

    monkeypatch.setattr(store.Versions, "write", stops)
    with pytest.raises(RuntimeError, match="between"):
        ingest.run(de(spark, {"Titel": "AUDI A4"}, {"Titel": "VW Golf"}), "DE", root, 1)
    found = ingest.stored(spark, root, "de")
    assert values(found.listings, "brand") == ["bmw"] and found.details.count() == 1
    monkeypatch.undo()
    ingest.run(de(spark, {"Titel": "AUDI A4"}, {"Titel": "VW Golf"}), "DE", root, 1)
    found = ingest.stored(spark, root, "DE")
    assert sorted(values(found.listings, "brand")) == ["audi", "vw"] and found.details.count() == 2
    assert ingest.stored(spark, root, "US") is None


def test_views_join_without_exchange_also_in_another_session(spark):
    root = scratch_path(spark, "buckets")
    ingest.run(de(spark, {}, {"Titel": "AUDI A4"}), "DE", root, 1)
    ingest.run(us(spark, {}, {"@id": "2", "vehicle_vin": None}), "US", root, 2, NOW, base=10)
    features = spark.createDataFrame([(1, 1), (2, 0)], "listing_id bigint, tuv_neu int")
    ingest.store_features(features, root, 8)
    other = spark.newSession()
    for session in (spark, other):
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            d, u = (ingest.stored(session, root, m) for m in ("DE", "US"))
            views = market.market_view("DE", d.listings, d.details, store.Versions(session, root).current("listing_features")), \
                market.market_view("US", u.listings, u.details)
            assert sorted((r["id"], r["tuv_neu"]) for r in views[0].collect()) == [(1, 1), (2, 0)]
            assert sorted(values(views[1], "id")) == [11, 12]
            for view in views:
                plan = view._jdf.queryExecution().executedPlan().toString()
                assert "SortMergeJoin" in plan and "Exchange" not in plan
        finally:
            session.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_versions_by_name_and_age(spark):
    versions = store.Versions(spark, scratch_path(spark, "named"))
    assert versions.current("features") is None
    made, noon = [], datetime(2026, 1, 1, 12)

    def build():
        made.append(1)
        return spark.range(len(made))

    def rows(seconds):
        return versions.cached("view", build, timedelta(seconds=600), noon + timedelta(seconds=seconds)).count()

    assert [rows(s) for s in (0, 599, 600, 700)] == [1, 1, 2, 2]
    first = store.store_version(spark.range(3), versions.root, "features")
    store.store_version(versions.current("features").where("id > 0"), versions.root, "features")
    assert first.count() == 3 and versions.current("features").count() == 2
    assert [store.bucket_count(n) for n in (0, 10**6, 9 * 10**6, 17 * 10**6)] == [8, 8, 16, 32]


def test_stream_cleans_each_piece_once(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    store.append_csv(de(spark, {}, {}, {"Preis": "x"}).drop("row_pos"), folder)
    for extra in (0, 1):
        if extra:
            store.append_csv(de(spark, {"Titel": "AUDI A4"}).drop("row_pos"), folder)
        append.append_cleaned(append.raw_stream(spark, folder), "DE", root, str(tmp_path / "cp")).awaitTermination()
    assert sorted(values(spark.read.parquet(root), "brand")) == ["audi", "volkswagen"]


def test_csv_files_with_different_headers(spark, tmp_path):
    for name, lines in (("b", "b,a,c\n1,2,3\n4,5,6\n"), ("a", "a,b\n9,8\n"), ("c", "b,a,c\n7,,\n")):
        (tmp_path / f"{name}.csv").write_text(lines)
    rows = raw.read_csv(spark, str(tmp_path)).select("a", "b", "c").collect()
    assert sorted(map(tuple, rows), key=str) == [("2", "1", "3"), ("5", "4", "6"), ("9", "8", None), (None, "7", None)]
    order = raw.read_raw(spark, str(tmp_path), "US").orderBy("row_pos")
    assert values(order, "b") == ["8", "1", "4", "7"]


def test_us_stream_reads_by_header(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    row = {"retailListing_price": "20000", "retailListing_miles": "1000", "vehicle_year": "2020", "vehicle_make": "BMW",
           "vehicle_model": "X1", "vehicle_vin": "1HGCM82633A004352", "zz_unknown": "1"}
    for name, columns in (("one", sorted(row)), ("two", sorted(row, reverse=True))):
        cells = [f"{row[c]}{1 if name == 'two' and c == 'retailListing_price' else ''}" for c in columns]
        (folder / f"{name}.csv").write_text(",".join(columns) + "\n" + ",".join(cells) + "\n")
    stream = append.raw_stream(spark, str(folder))
    append.append_cleaned(stream, "US", root, str(tmp_path / "cp"), "2026-01-15T12:00:00Z").awaitTermination()
    found = spark.read.parquet(root)
    assert sorted(values(found, "price_usd")) == [20000.0, 200001.0] and set(values(found, "make")) == {"bmw"}
    with pytest.raises(ValueError):
        append.append_cleaned(stream, "US", root, str(tmp_path / "cp2"))


@pytest.mark.parametrize("market", ["DE", "US"])
def test_copies_in_later_files_are_dropped_as_in_one_batch(spark, tmp_path, market):
    """Files that arrive one after the other, with copies across them, give the rows of cleaning all at once."""
    folder, cleaned, root = (str(tmp_path / n) for n in ("in", "cleaned", "out"))
    if market == "DE":
        files = [[{}, {"Titel": "AUDI A4"}], [{"Titel": "AUDI A4"}, {"Titel": "VW Polo"}, {}], [{"Titel": "VW Polo"}, {"PS": "N/A"}]]
    else:
        files = [[{"@id": "1"}, {"@id": "2", "vehicle_vin": None}], [{"@id": "3"}, {"@id": "4", "vehicle_vin": None, "vehicle_year": "2019"}],
                 [{"@id": "5", "vehicle_vin": None}]]
    make, as_of = (de, None) if market == "DE" else (us, NOW)
    for n, rows in enumerate(files):
        store.append_csv(make(spark, *rows).drop("row_pos").coalesce(1), f"{folder}/{n}")
        stream = append.raw_stream(spark, f"{folder}/*")
        append.append_cleaned(stream, market, cleaned, str(tmp_path / "cp"), as_of).awaitTermination()
        append.append_firsts(spark, market, cleaned, root, str(tmp_path / "cp2")).awaitTermination()
    together = make(spark, *[r for rows in files for r in rows])
    expected = ingest.clean(together, market, as_of)
    shown = [c for c in expected.columns if c not in ("row_pos", "created_at")]
    found = spark.read.parquet(root)
    assert sorted(map(str, found.select(*shown).collect())) == sorted(map(str, expected.select(*shown).collect()))
    assert found.groupBy("piece").count().count() >= 2


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_tasks_that_widen_line_items_grow_with_them(spark, monkeypatch, threshold):
    sf, name = "/root/testdata/sf0.001", "spark.sql.autoBroadcastJoinThreshold"
    rows = lambda: sorted(driver_views.raw_us(spark, sf).select("row_pos", "row_sub", "retailListing_dealer", "vehicle_vin").collect())
    whole, before = rows(), spark.conf.get(name)
    monkeypatch.setattr(driver_views, "ROWS_PER_TASK", 500, raising=False)
    spark.conf.set(name, threshold)
    try:
        tasks = driver_views.raw_us(spark, sf).rdd.getNumPartitions()
        assert tasks == -(-len(whole) // 500) > spark.sparkContext.defaultParallelism
        assert rows() == whole
    finally:
        spark.conf.set(name, before)
