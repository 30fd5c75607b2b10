from __future__ import annotations

import random

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from lotwise.operators import boosting as B
from lotwise.operators import training as T

ROWS = "listing_id bigint, price double, mileage double, brand string, model string, car_age double, power_ps double, owners int, tuv_neu int"
GRID = {"maxDepth": (2, 3), "stepSize": (0.3,), "maxIter": (2, 5)}


@pytest.fixture(scope="module")
def rows(spark):
    """More values than bins in two columns, categories that a fold may lack, and nodes that end early."""
    rng = random.Random(11)
    data = []
    for i in range(1800):
        brand, age, km = rng.choice(["bmw", "audi", "vw", "fiat"]), float(rng.randint(0, 60)), rng.random() * 2e5
        model = "rare" if i % 150 == 0 else rng.choice(["m1", "m2", "m3"])
        price = 20000.0 if brand == "fiat" else 60000 + 3000 * len(model) - 700 * age - 0.05 * km + rng.random() * 900
        data.append((i * 7 % 1800, price, km, brand, model, age, rng.choice([100.0, 150.0, None]), rng.choice([1, 2]), rng.randint(0, 1)))
    return spark.createDataFrame(data, ROWS).cache()


def searched(rows, monkeypatch, **limits):
    """Choices, model and training rows of a search; ``limits`` of one task may be set lower."""
    used, whole = [], T.search
    with monkeypatch.context() as patch:
        for name, value in limits.items():
            patch.setattr(B, name, value)
        patch.setattr(T, "search", lambda train, *rest: used.append((train, rest[-1], whole(train, *rest))) or used[-1][2])
        model, scored = T.fit_price_model(rows, "DE", GRID)
    return used[0], model, scored


def test_fits_in_one_task_equal_those_over_all_tasks(rows, monkeypatch):
    (train, packed, found), model, scored = searched(rows, monkeypatch)
    (_, none, plain), same, also = searched(rows, monkeypatch, MOST_ROWS=10)
    assert packed is not None and none is None
    assert [c.params for c in found] == [c.params for c in plain]
    assert [c.error for c in found] == pytest.approx([c.error for c in plain], rel=1e-9)
    assert {r["listing_id"]: r["prediction"] for r in scored.collect()} == pytest.approx(
        {r["listing_id"]: r["prediction"] for r in also.collect()})
    assert model.regressor.treeWeights == same.regressor.treeWeights
    assert model.regressor.featureImportances.toArray() == pytest.approx(same.regressor.featureImportances.toArray())
    deep = {"maxDepth": 7, "stepSize": 0.3, "maxIter": 3}  # small nodes have splits of equal gain, and errors of training rows agree
    booster = GBTRegressor(labelCol="price", seed=T.SEED)
    sums = [m.transform(train).agg(F.sum(F.abs(F.col("price") - F.col("prediction")))).first()[0]
            for m in (B.fit(packed, booster, deep, len(model.names)), booster.fit(train, {booster.getParam(n): v for n, v in deep.items()}))]
    assert sums[0] == pytest.approx(sums[1], rel=0.02)
    stored = GBTRegressor(labelCol="price", seed=T.SEED, maxDepth=4, stepSize=0.3, maxIter=1).fit(train)
    first = B.fit(packed, GBTRegressor(labelCol="price", seed=T.SEED), {"maxDepth": 4, "stepSize": 0.3, "maxIter": 1}, len(model.names))
    assert first.trees[0].numNodes == stored.trees[0].numNodes and first.numFeatures == stored.numFeatures


def test_a_level_is_no_job(spark, rows):
    """Fifty trees of three levels, three folds and a refit take fewer jobs than one fit has levels."""
    spark.sparkContext.setJobGroup("levels", "")
    T.fit_price_model(rows, "DE", {"maxDepth": (3,), "stepSize": (0.3,), "maxIter": (50,)})
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("levels")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) < 150


def test_missing_numbers_still_stop_the_training(rows):
    holes = rows.withColumn("tuv_neu", F.when(F.col("listing_id") % 9 > 0, F.col("tuv_neu")))
    with pytest.raises(Exception, match="MUST NOT be NaN"):
        T.fit_price_model(holes, "DE", GRID)


def test_what_a_task_does_not_know_is_left_to_mllib():
    plain = GBTRegressor(labelCol="price")
    assert B.suits(plain, GRID, 1000, 3, [4])
    assert not B.suits(plain, GRID, B.MOST_ROWS + 1, 3, [4]) and not B.suits(plain, GRID, 1000, 3, [B.MOST_SUMS])
    assert not B.suits(plain, {"maxBins": (8,)}, 1000, 3, [4]) and not B.suits(GBTRegressor(lossType="absolute"), GRID, 1000, 3, [4])
    assert not B.suits(GBTRegressor(subsamplingRate=0.5), GRID, 1000, 3, [4])
    assert not B.suits(GBTRegressor(featureSubsetStrategy="sqrt"), GRID, 1000, 3, [4])
