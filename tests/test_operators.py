from __future__ import annotations

import random
import statistics

import pandas as pd
import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise.functions.documents import slices
from lotwise.operators import columns as C
from lotwise.operators import features, medians, pages
from lotwise.operators import records as R
from lotwise.operators.medians import column_medians, grouped_median
from lotwise.operators.ranking import assign_ids, in_ranges, with_global_rank, with_ordinal


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_global_rank(spark, width):
    keys = random.Random(1).sample(range(-500, 5000), 300)
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    ranked = {r["k"]: r["rank"] for r in with_global_rank(rows, "k", block_width=width).collect()}
    assert ranked == {k: i for i, k in enumerate(sorted(keys), 1)}


def test_ids_follow_positions(spark):
    rows = spark.createDataFrame([(30, "c"), (10, "a"), (20, "b")], "row_pos bigint, v string")
    assert {r["v"]: r["id"] for r in assign_ids(rows, 100).collect()} == {"a": 101, "b": 102, "c": 103}


@pytest.mark.parametrize("values_per_range", [20, 300, 10**6])
def test_grouped_median_is_exact(spark, values_per_range):
    rng = random.Random(2)
    data = [(g, rng.choice([None, rng.random() * 10 ** rng.randint(0, 6), 5.0])) for g in (None, "a", "b", "hot")
            for _ in range({"hot": 900}.get(g, rng.randint(1, 60)))]
    data.append(("only null", None))
    rows = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r["m"] for r in grouped_median(rows, ["g"], "v", "m", values_per_range=values_per_range).collect()}
    want = {}
    for g in {g for g, _ in data}:
        found = [v for h, v in data if h == g and v is not None]
        if found:
            want[g] = pytest.approx(statistics.median(found))
    assert got == want
    empty = grouped_median(rows, ["g"], "v", "m", keep_empty=True, values_per_range=values_per_range)
    assert {r["g"]: r["m"] for r in empty.collect()} == want | {"only null": None}


def test_no_task_holds_a_hot_group_or_the_values_below_an_outlier(spark, monkeypatch):
    """A third of the rows in one group, one value far from all others: ranges stay near their size."""
    rows = spark.range(12_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        F.when(F.col("id") == 0, 1e300).otherwise(F.col("id") + 0.5).alias("v"),
    )
    sizes = []

    def watched(df, keys, rows_per_range):
        placed = in_ranges(df, keys, rows_per_range)
        sizes.extend(r["count"] for r in placed.groupBy("__part").count().collect())
        return placed

    monkeypatch.setattr(medians, "in_ranges", watched)
    got = {r["g"]: r["median"] for r in grouped_median(rows, ["g"], "v", values_per_range=1000).collect()}
    assert len(sizes) >= 8 and max(sizes) < 3000
    assert got == {r["g"]: pytest.approx(r["m"]) for r in rows.groupBy("g").agg(F.median("v").alias("m")).collect()}


@pytest.mark.parametrize("rows_per_range", [7, 10**6])
def test_ordinals_of_texts_in_hot_groups(spark, rows_per_range):
    rng = random.Random(6)
    data = [(rng.choice(["hot", "hot", "hot", "a", None]), f"{rng.choice('xyzÄß')}{i}") for i in range(300)]
    rows = spark.createDataFrame(data, "g string, t string").repartition(5)
    got = sorted(map(tuple, with_ordinal(rows, ["g"], ["t"], "n", 0, rows_per_range).collect()), key=str)
    want = []
    for g in {g for g, _ in data}:
        want += [(g, t, i) for i, t in enumerate(sorted((t for h, t in data if h == g), key=str.encode))]
    assert got == sorted(want, key=str)
    alone = with_ordinal(rows, [], ["t"], rows_per_range=rows_per_range).orderBy("ordinal")
    assert values(alone, "t") == sorted((t for _, t in data), key=str.encode)
    assert with_ordinal(rows.where("1 = 0"), ["g"], ["t"]).collect() == []


def test_equal_positions_are_ordered_by_the_next_one(spark):
    rows = spark.createDataFrame([(1, b, f"{b}") for b in (3, 1, 2)] + [(0, 9, "first")], "row_pos bigint, row_sub bigint, v string")
    assert {r["v"]: r["id"] for r in assign_ids(rows, ties=["row_sub"]).collect()} == {"first": 1, "1": 2, "2": 3, "3": 4}


def test_median_of_two_is_their_mean(spark):
    rows = spark.createDataFrame([(1.0, 5), (2.0, None)], "a double, b int")
    assert {r["column"]: r["median"] for r in column_medians(rows, ["a", "b"]).collect()} == {"a": 1.5, "b": 5.0}


def test_column_plumbing(spark):
    rows = spark.createDataFrame([(1, 2)], "URL int, B int")
    assert C.rename_if_free(rows, "URL", "url").columns == ["url", "B"]
    assert C.rename_if_free(rows.withColumn("x", F.lit(1)), "URL", "x").columns == ["URL", "B", "x"]
    assert C.lower_names(rows).columns == ["url", "b"]
    assert C.keep_existing(rows, ["B", "z"]).columns == ["B"]
    assert C.fill_absent(rows, ["B", "z"], "").first()["z"] == ""
    with pytest.raises(ValueError, match="z"):
        C.require_columns(rows, ["B", "z"])


RECORDS = [
    '{"vin": "A", "price": 1, "history": {"ownerCount": 0, "deep": {"x": {"y": 2}}}, "tags": ["ü\\"", null, 1], "empty": {}}',
    '{"vin": "A", "price": 2, "history": {"ownerCount": 3}}',
    '{"vin": "", "history": {"ownerCount": 1}}',
    '{"vin": null, "history": {"ownerCount": 1}}',
    '{"vin": "B", "history": null}',
    '{"vin": "C"}',
    '{"vin": "D", "history": {"ownerCount": null}, "list": [{"a": 1, "b": [true]}], "price": null}',
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = spark.createDataFrame(list(enumerate(RECORDS)), "row_pos bigint, j string")
    return R.parse_records(rows, "j").cache()


def test_owner_filter_and_first_vin(parsed):
    kept = R.with_owner_history(parsed)
    assert sorted(values(kept, "row_pos")) == [0, 1, 2, 3]
    assert values(R.first_per_vin(kept), "row_pos") == [0]
    assert sorted(values(R.first_per_vin(parsed), "vin")) == ["A", "B", "C", "D"]


def test_flatten(parsed):
    flat = R.flatten_records(parsed)
    assert set(flat.columns) == {"row_pos", "vin", "price", "history_ownerCount", "history_deep_x_y", "tags", "list"}
    rows = {r["row_pos"]: r for r in flat.collect()}
    assert rows[0]["history_deep_x_y"] == 2
    assert rows[6]["list"] == '[{"a": 1, "b": [true]}]'
    assert "history.ownerCount" in R.flatten_records(parsed, ".").columns


def test_json_text_escapes(spark):
    rows = spark.createDataFrame([(["ü\"x", None, "😀"],), (None,), ([],)], "a array<string>")
    texts = [r[0] for r in rows.select(R.json_text(F.col("a"), rows.schema["a"].dataType)).collect()]
    assert texts == ['["\\u00fc\\"x", null, "\\ud83d\\ude00"]', None, "[]"]


def test_ragged_union(spark):
    a, b = spark.createDataFrame([(1, 2)], "z int, a int"), spark.createDataFrame([(3, 4)], "z int, m int")
    union = C.ragged_union([a, b])
    assert union.columns == ["a", "m", "z"]
    assert sorted(map(tuple, union.collect()), key=str) == [(2, None, 1), (None, 4, 3)]


def test_flatten_of_nothing(spark):
    assert R.flatten_records(spark.createDataFrame([], StructType())).columns == []


def test_members_without_a_schema(spark):
    docs = ['{"a": null, "b": {"c": {"d": 1.5, "e": {}}, "list": ["x\\"y, z", {"k": null, "j": []}]}, "f": "t", "g": false}', '{"a": {"a": "in"}}',
            "{}", "[1]", "broken {", None, '{"a": {}, "n": 12345678901234567890}']
    rows = spark.createDataFrame(list(enumerate(docs)), "row_pos bigint, doc string")
    found = sorted(map(tuple, R.flatten_documents(rows, "doc", sep=".").collect()))
    assert found == [
        (0, "a", None), (0, "b.c.d", "1.5"), (0, "b.list", '["x\\"y, z", {"k": null, "j": []}]'), (0, "f", "t"), (0, "g", "false"),
        (1, "a.a", "in"), (6, "n", "12345678901234567890")]


def test_no_record_with_history_stops(parsed):
    with pytest.raises(ValueError, match="history"):
        R.vehicle_table(parsed.where("row_pos = 5"))


def test_documents_are_parsed_once(spark):
    """An explode behind the Python step brings no second one, and long documents go slice by slice."""
    docs = spark.range(1000).select(F.col("id").alias("listing_id"), F.concat(F.lit('{"A": "x'), "id", F.lit('"}')).alias("ai_features"))
    found = features.with_pairs(docs).where("kv is not null").select("listing_id", F.explode("kv").alias("kv"))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {(r[0], r[1]) for r in found.select("listing_id", "kv.value").collect()} == {(i, f"x{i}") for i in range(1000)}
    links = pages.all_links(spark.createDataFrame([(1, "u", '<a href="/fahrzeuge/details.html?id=1">x</a>')], "page_id int, url string, html string"))
    assert links._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1 and links.count() == 1


def test_slices_hold_few_rows():
    got = list(slices(iter([pd.Series(range(450)), pd.Series(range(3))])))
    assert [len(s) for s in got] == [200, 200, 50, 3] and [x for s in got for x in s] == [*range(450), *range(3)]
