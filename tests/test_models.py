from __future__ import annotations

import itertools
import random
import threading
import time
from math import factorial

import numpy as np
import pytest
from conftest import values
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from lotwise.operators import explain as X
from lotwise.operators import recommend as R
from lotwise.operators import scoring as S
from lotwise.operators import training as T
from lotwise.session import scratch_path

ROWS = ("listing_id bigint, price double, mileage double, brand string, model string, car_age double, power_ps double, owners int, "
        "transmission string, fuel string, tuv_neu int, ausstattung_pano int")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(200):
        brand, age, km = rng.choice(["bmw", "audi", "vw"]), rng.random() * 20, rng.random() * 2e5
        price = 40000 + {"bmw": 5000, "audi": 2000, "vw": 0}[brand] - 1000 * age - 0.05 * km + rng.random() * 500
        data.append((i, price, km, brand, rng.choice(["m1", "m2"]), age, rng.choice([None, 100.0, 150.0, 200.0]), rng.choice([None, 1, 2, 4]),
                     rng.choice(["manual", "automatic", "unbekannt"]), rng.choice(["petrol", "diesel"]), rng.randint(0, 1), rng.randint(0, 1)))
    return spark.createDataFrame(data, ROWS).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return T.fit_price_model(rows, "DE", {"maxDepth": (3,), "stepSize": (0.3,), "maxIter": (4,)})


def test_training_rows(spark):
    listings = spark.createDataFrame([(1, 10.0, 5.0, " BMW ", None), (2, None, 5.0, "a", "b"), (3, 1.0, 1.0, "", "  ")],
                                     "id bigint, price double, mileage double, brand string, model string")
    details = spark.createDataFrame([(i, 1.0, 2.0, 3, "Manual", None) for i in (1, 2, 3, 4)],
                                    "listing_id bigint, car_age double, power_ps double, owners int, transmission string, fuel string")
    features = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 1, 0), (9, 1, 0)], "listing_id bigint, tuv_neu int, seen int")
    got = T.training_rows_de(listings, details, features, ["seen"]).collect()
    assert [(r["listing_id"], r["brand"], r["model"], r["transmission"], r["fuel"], r["tuv_neu"]) for r in got] == [
        (1, "bmw", "unbekannt", "manual", "unbekannt", 1)]


def test_eligible(spark):
    data = [(1, 1.0, 1.0, 1.0, "Mercedes-Benz"), (2, 1.0, 1.0, 1.0, None), (3, 1.0, None, 1.0, "a"), (4, 1.0, 1.0, None, "a"), (5, 1.0, 1.0, 1.0, "a")]
    df = spark.createDataFrame(data, "listing_id bigint, price double, mileage double, car_age double, brand string")
    assert sorted(values(T.eligible(df, "US"), "listing_id")) == [2, 5]
    assert sorted(values(T.eligible(df, "DE"), "listing_id")) == [1, 2, 5]


def test_impute_and_columns(rows):
    filled, medians = T.impute(rows, "DE")
    assert medians == {"power_ps": rows.agg(F.median("power_ps")).first()[0], "owners": rows.agg(F.median("owners")).first()[0]}
    assert filled.where("power_ps IS NULL OR owners IS NULL").isEmpty()
    numeric, categorical = T.feature_columns(rows.columns, "DE")
    assert categorical == ["brand", "model", "transmission", "fuel"] and "price" not in numeric and "listing_id" not in numeric


def test_split_is_exact_and_independent_of_partitions(rows):
    first = {r["listing_id"]: (r["is_test"], r["fold"]) for r in T.split_rows(rows).collect()}
    again = {r["listing_id"]: (r["is_test"], r["fold"]) for r in T.split_rows(rows.repartition(7)).collect()}
    assert first == again and sum(t for t, _ in first.values()) == 40
    assert sum(t for t, _ in ((r["is_test"], 0) for r in T.split_rows(rows.limit(11)).collect())) == 3


def test_encoding(spark, rows, fitted):
    model, _ = fitted
    words = T.vocabulary(model.pipeline)
    assert words["brand"] == ["audi", "bmw", "vw"] and "brand_bmw" in model.names
    odd = rows.limit(2).withColumns({"brand": F.lit("other"), "fuel": F.lit(None).cast("string")})
    vector = S.predict_prices(model, odd).first()["features"]
    assert sum(v for n, v in zip(model.names, vector) if n.startswith(("brand_", "fuel_"))) == 0
    counts = S.unknown_categories(model, odd).first()
    assert (counts["brand"], counts["fuel"], counts["model"]) == (2, 2, 0)
    hot = T.one_hot_rows(model.pipeline, rows)
    assert hot.count() == rows.count() * 4


def test_fit_save_load(spark, rows, fitted):
    model, scored = fitted
    metrics = T.regression_metrics(scored).first()
    assert scored.count() == 40 and metrics["r2"] > 0.7
    root = scratch_path(spark, "models")
    assert T.load_model(spark, root, "DE") is None
    T.save_model(spark, model, root)
    loaded = T.load_model(spark, root, "DE")
    assert (loaded.numeric, loaded.categorical, loaded.medians) == (model.numeric, model.categorical, model.medians)
    a, b = (sorted((r["listing_id"], r["prediction"]) for r in S.predict_prices(m, rows).collect()) for m in (model, loaded))
    assert a == b and T.load_model(spark, root, "US") is None


def test_grid_search_takes_the_lower_error(rows):
    model, _ = T.fit_price_model(rows, "DE", {"maxDepth": (1, 3), "maxIter": (2,), "stepSize": (0.3,)})
    assert model.regressor.getOrDefault("maxDepth") == 3 and model.regressor.getNumTrees == 2


def test_staged_search_equals_plain_cross_validation(rows):
    """One long fit judged at every count gives the errors of one fit per count."""
    numeric, categorical = T.feature_columns(rows.columns, "DE")
    filled, _ = T.impute(rows, "DE")
    train = T.split_rows(T.encoder(numeric, categorical).fit(filled).transform(filled), 0.0).select("price", "features", "fold").cache()
    booster = GBTRegressor(labelCol="price", seed=T.SEED)
    grid = {"maxDepth": (2, 3), "stepSize": (0.3,), "maxIter": (1, 3)}
    params = ParamGridBuilder()
    for name, options in grid.items():
        params = params.addGrid(booster.getParam(name), list(options))
    plain = CrossValidator(
        estimator=booster, estimatorParamMaps=params.build(), numFolds=3, foldCol="fold",
        evaluator=RegressionEvaluator(labelCol="price", metricName="mae"),
    ).fit(train)
    found = T.search(train, booster, grid)
    assert [c.params for c in found] == [{p.name: v for p, v in m.items()} for m in params.build()]
    assert [c.error for c in found] == pytest.approx(plain.avgMetrics)


def test_levels_store_no_node_ids(rows, monkeypatch):
    """The trees are the same whether rows store their node or walk to it; a search and its refit walk."""
    used = []
    whole = T.search
    monkeypatch.setattr(T, "search", lambda train, booster, *rest: used.append((train, booster)) or whole(train, booster, *rest))
    model, _ = T.fit_price_model(rows, "DE", {"maxDepth": (3,), "stepSize": (0.3,), "maxIter": (2,)})
    train, booster = used[0]
    assert not booster.getCacheNodeIds() and not model.regressor.getCacheNodeIds()
    stored = booster.fit(train, {booster.maxDepth: 3, booster.stepSize: 0.3, booster.maxIter: 2, booster.cacheNodeIds: True})
    assert stored.toDebugString.split("\n")[1:] == model.regressor.toDebugString.split("\n")[1:]


def test_training_tasks_follow_the_rows(rows, monkeypatch):
    """Not their bytes: 200 rows arrive in one partition and are trained in five tasks."""
    class Found(Exception):
        pass

    def stop(train, *rest):
        raise Found(train.rdd.getNumPartitions(), train.count())

    monkeypatch.setattr(T, "search", stop)
    monkeypatch.setattr(T, "ROWS_PER_TASK", 50)
    with pytest.raises(Found) as found:
        T.fit_price_model(rows.coalesce(1), "DE")
    assert found.value.args == (5, 160)


@pytest.mark.parametrize("tasks, most", [(1, 4), (4, 2), (8, 1), (32, 1)])
def test_fits_of_many_tasks_do_not_run_side_by_side(rows, tasks, most):
    """Each fit holds its rows in bins, so a table that fills the four cores has one or two copies, not one per fit."""
    lock, running, seen = threading.Lock(), [0], []

    class Booster(GBTRegressor):
        def fit(self, train, params=None):
            with lock:
                running[0] += 1
                seen.append(running[0])
            time.sleep(0.2)
            with lock:
                running[0] -= 1
            return type("Fitted", (), {"evaluateEachIteration": lambda self, held, loss: [1.0]})()

    train = rows.withColumn("fold", F.col("listing_id") % 3).repartition(tasks)
    found = T.search(train, Booster(labelCol="price"), {"maxDepth": (1, 2, 3), "maxIter": (1,)})
    assert len(found) == 3 and len(seen) == 9 and max(seen) == most


def test_training_on_nothing_stops(rows):
    with pytest.raises(ValueError, match="no row is left"):
        T.fit_price_model(rows.where("listing_id < 0"), "DE", {"maxIter": (1,)})


def leaves_of(trees):
    """Value and ``feature: (low, high, share)`` of every leaf, by walking up from it."""
    inner = set(trees.parent.tolist())
    for leaf in (e for e in range(1, len(trees.feature)) if e not in inner):
        path, at = {}, leaf
        while at:
            path.setdefault(int(trees.feature[at]), (trees.low[at], trees.high[at], trees.share[at]))
            at = trees.parent[at]
        yield trees.value[leaf], path


def brute_shapley(leaves, x):
    """Shapley values from their definition over all feature subsets."""
    n = len(x)

    def value(known):
        total = 0.0
        for part, path in leaves:
            for f, (lo, hi, share) in path.items():
                part *= float(lo < x[f] <= hi) if f in known else share
            total += part
        return total

    result = np.zeros(n)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            for subset in itertools.combinations(others, size):
                weight = factorial(size) * factorial(n - size - 1) / factorial(n)
                result[i] += weight * (value({*subset, i}) - value(set(subset)))
    return result


def grown(rng, depth, features, rows, node_id=0, nodes=None):
    """Nodes of a random tree as a model stores them; features come back on a path, branches end early."""
    nodes = {} if nodes is None else nodes
    if depth == 0 or rows < 2 or (node_id and rng.random() < 0.2):
        nodes[node_id] = {"leftChild": -1, "prediction": rng.random() * 100, "rawCount": rows}
        return nodes
    left = rng.randint(1, rows - 1)
    node = {"prediction": 0.0, "rawCount": rows, "split": {
        "featureIndex": rng.randrange(features), "leftCategoriesOrThreshold": [rng.random()], "numCategories": -1}}
    nodes[node_id] = node
    node["leftChild"] = max(nodes) + 1
    grown(rng, depth - 1, features, left, node["leftChild"], nodes)
    node["rightChild"] = max(nodes) + 1
    grown(rng, depth - 1, features, rows - left, node["rightChild"], nodes)
    return nodes


@pytest.mark.parametrize("depth, features, count", [(1, 1, 1), (3, 2, 3), (4, 6, 4), (7, 5, 3), (10, 7, 2)])
def test_contributions_equal_brute_force(depth, features, count):
    rng = random.Random(depth)
    trees = X.flat_trees([(grown(rng, depth, features, 500), 0.5 + i) for i in range(count)] + [({0: {"leftChild": -1, "prediction": 7.0}}, 2.0)])
    leaves = list(leaves_of(trees))
    x = np.array([[rng.random() for _ in range(features)] for _ in range(4)])
    got = X.tree_contributions([trees], x)
    for row, phi in zip(x, got):
        assert phi == pytest.approx(brute_shapley(leaves, row), abs=1e-8)
        output = 14.0 + sum(v for v, path in leaves if all(lo < row[f] <= hi for f, (lo, hi, _) in path.items()))
        assert trees.base + phi.sum() == pytest.approx(output)


def test_rows_on_the_same_sides_are_worked_on_once(monkeypatch):
    """Forty rows at three positions among the cuts (below all, above all, in no range) cost three rows of work."""
    rng = random.Random(3)
    pieces = [X.flat_trees([(grown(rng, 4, 3, 500), 1.0) for _ in range(3)]) for _ in range(2)]
    cuts = sorted(c for p in pieces for part in (p.low, p.high) for c in part.tolist() if np.isfinite(c))
    kinds = np.array([[cuts[0] - 1, 0.5, 0.5], [cuts[0], 0.5, 0.5], [cuts[-1] + 1, 0.5, 0.5], [np.nan, 0.5, 0.5], [-np.inf, 0.5, 0.5]])
    x = kinds[[i % 5 for i in range(40)]]
    x[::10, 0] -= 1  # still below every cut
    plain = sum(X._block_contributions(p, x) for p in pieces)
    seen, work = [], X._block_contributions
    monkeypatch.setattr(X, "_block_contributions", lambda trees, rows: seen.append(len(rows)) or work(trees, rows))
    assert np.array_equal(X.tree_contributions(pieces, x), plain)
    assert seen == [3, 3]
    assert X.tree_contributions([], x).tolist() == np.zeros(x.shape).tolist() and X.tree_contributions(pieces, x[:0]).shape == (0, 3)


def test_pieces_and_blocks_add_up_to_the_same(spark, fitted, rows, monkeypatch):
    model, _ = fitted
    x = np.array([r["features"].toArray() for r in S.predict_prices(model, rows).collect()])
    whole = X.tree_contributions(X.model_trees(spark, model), x)
    monkeypatch.setattr(X, "BLOCK_NUMBERS", 100)
    pieces = X.model_trees(spark, model, edges=1)
    assert len(pieces) == 4 and np.allclose(X.tree_contributions(pieces, x), whole, atol=1e-9)
    groups = list(X._groups(pieces, pieces[0].nbytes + pieces[1].nbytes))
    assert [p for g in groups for p in g] == pieces and len(groups) >= 2


def test_contributions_add_up_for_any_chunking(fitted, rows):
    model, _ = fitted
    whole = X.explain(model, rows)
    total = F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c["contribution"])
    gap = whole.select(F.max(F.abs(F.col("base_value") + total - F.col("prediction")))).first()[0]
    assert gap < 1e-6
    pieces = X.explain(model, rows, every=True, most_bytes=1)
    assert {r["n"] for r in pieces.select(F.size("contributions").alias("n")).collect()} == {len(model.names)}
    pieces = pieces.select("listing_id", total.alias("t"))
    both = whole.select("listing_id", total.alias("u")).join(pieces, "listing_id")
    assert both.select(F.max(F.abs(F.col("t") - F.col("u")))).first()[0] < 1e-6
    top = X.contribution_rows(whole, "listing_id", 3, True)
    assert top.where("feature LIKE 'model@_%' ESCAPE '@'").isEmpty() and top.groupBy("listing_id").count().agg(F.max("count")).first()[0] == 3
    report = S.price_report(whole, "DE", "listing_id").first()["report"]
    assert '"waehrung":"€"' in report and '"berechneter_preis":' in report


CAR = "subject_id bigint, brand string, model string, role string, mileage double, car_age double, tuv_neu double, ausstattung_pano double, ausstattung_amg_line double"


def linear(df):
    price = F.lit(50000.0) - F.col("mileage") * 0.015 + F.when(F.col("model") == "cheap", -600.0).otherwise(0.0)
    for c, v in (("tuv_neu", 150.0), ("ausstattung_pano", 500.0), ("ausstattung_amg_line", 99.0), ("cylinders", 200.0)):
        if c in df.columns:
            price = price + F.coalesce(F.col(c), F.lit(0.0)) * v
    return df.withColumn("prediction", price)


def recommend(spark, cars, schema, market, **kw):
    view = spark.createDataFrame([(1, "a", "own"), (2, "a", "cheap"), (3, "a", "same")], "id bigint, brand string, model string")
    got = R.recommend(spark.createDataFrame(cars, schema), view, market, linear, **kw).orderBy("subject_id", "saving_rank").collect()
    return [(r["subject_id"], r["type"], round(r["saving"], 2)) for r in got], [r["text"] for r in got]


def test_recommend_de(spark):
    found, texts = recommend(spark, [(1, "a", "own", "buyer", 60000.0, 1.0, 1.0, 1.0, 1.0), (2, "a", "own", "seller", 60000.0, 1.0, 0.0, 0.0, 0.0),
                                     (3, "a", "own", "buyer", 20000.0, 1.0, 0.0, None, 0.0), (4, "b", "q", "buyer", 24999.0, 1.0, 0.0, 0.0, 0.0)], CAR, "DE")
    assert found == [(1, "alternative", 600.0), (1, "saving", 500.0), (1, "mileage_tip", 300.0), (1, "saving", 150.0),
                     (2, "upgrade", 500.0), (3, "alternative", 600.0)]
    assert texts[1] == "Wenn du auf 'Panoramadach' verzichtest, sparst du ca. 500 €."
    assert texts[2].startswith("Fahrzeuge mit 20,000 km weniger Laufleistung kosten ca. 300 € mehr")
    assert texts[4] == "Wenn du 'Panoramadach' anbietest, nimmt der Preis um ca. 500 € zu."
    assert texts[5] == "Ein 'Cheap' mit gleicher Ausstattung würde ca. 600 € weniger kosten."
    first, _ = recommend(spark, [(1, "a", "own", "buyer", 60000.0, 1.0, 1.0, 1.0, 1.0)], CAR, "DE", limit=2)
    assert [t for _, t, _ in first] == ["alternative", "saving"]


def test_recommend_us(spark):
    schema = "subject_id bigint, brand string, model string, mileage double, car_age double, cylinders double"
    found, texts = recommend(spark, [(1, "a", "own", 30000.0, 1.0, 6.0), (2, "a", "own", 5000.0, 1.0, 4.0), (3, "a", "own", 5000.0, 1.0, 5.0)], schema, "US")
    assert found == [(1, "alternative", 600.0), (1, "saving", 400.0), (1, "mileage_tip", 300.0), (2, "alternative", 600.0), (3, "alternative", 600.0)]
    assert texts[1] == "Ein 4-Zylinder-Motor würde ca. $400 sparen."


def test_requests_flags_and_depreciation(spark):
    asked = spark.createDataFrame([(1, "BMW", "X5", 10.0, 2.0, None)], "subject_id bigint, brand string, model string, mileage double, car_age double, fuel string")
    row = S.with_defaults(asked, "US").first()
    assert (row["brand"], row["model"], row["fuel"], row["doors"], row["trim"]) == ("bmw", "x5", "benzin", 4.0, "unbekannt")
    cars = spark.createDataFrame([(1, 1.0, 0.0, "Personal use"), (2, 3.0, 2.0, None)], "subject_id bigint, owner_count double, accident_count double, usage_type string")
    flags = {r["subject_id"]: (r["one_owner"], r["has_accidents"], r["personal_use"], r["is_used"]) for r in S.subject_records(cars, "US").collect()}
    assert flags == {1: (1.0, 0.0, 1.0, 1.0), 2: (0.0, 1.0, 0.0, 1.0)}
    loss = S.depreciation(asked.withColumn("mileage", F.lit(20000.0)), linear).first()
    assert (loss["price_new"], loss["price_used"], loss["loss"]) == (50000.0, 49700.0, 300.0)
