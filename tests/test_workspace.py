from __future__ import annotations

import pytest

from lotwise import vocab as V
from lotwise.operators import training
from lotwise.plans import registry, workspace


@pytest.fixture
def searched(spark, monkeypatch):
    """A workspace whose searches are noted instead of run."""
    found = {}

    def note(rows, market, grid=None, **kw):
        found[market] = grid
        model = type("Model", (), {"regressor": Best()})()
        return model, spark.createDataFrame([(1, 2.0, 1.0)], "listing_id bigint, price double, prediction double")

    class Best:
        getNumTrees = 500

        def getOrDefault(self, name):
            return {"maxDepth": 6, "stepSize": 0.05}[name]

    monkeypatch.setattr(training, "fit_price_model", note)
    for rows in ("rows_us", "rows_de"):
        monkeypatch.setattr(workspace.Workspace, rows, None)
    return workspace.Workspace(spark, "none"), found


def test_trained_queries_rest_on_the_whole_grid(spark, searched):
    w, found = searched
    assert w.fitted_us and found == {"US": V.GRIDS["US"]}


def test_only_tree_counts_can_be_set(spark, searched):
    w, _ = searched
    spark.conf.set(workspace.TREE_COUNTS, "5,10")
    try:
        assert w.grid("DE") == V.GRIDS["DE"] | {"maxIter": (5, 10)}
    finally:
        spark.conf.unset(workspace.TREE_COUNTS)


def test_cv_grid_searches_both_markets(spark, searched):
    w, found = searched
    rows = {r["market"]: r for r in registry.cv_grid(w).collect()}
    assert found == V.GRIDS and set(rows) == {"DE", "US"}
    assert all((r["max_depth"], r["step_size"], r["trees"], r["mae"]) == (6, 0.05, 500, 1.0) for r in rows.values())


def test_unknown_categories_grow_no_tree(spark, monkeypatch):
    def fail(*args, **kw):
        raise AssertionError("a search was started")

    monkeypatch.setattr(training, "fit_price_model", fail)
    row = [(1, 100.0, 1.0, 1.0, "a", "m"), (2, 100.0, 1.0, 1.0, "b", "n"), (3, None, 1.0, 1.0, "c", "n")]
    rows = spark.createDataFrame(row, "listing_id bigint, price double, mileage double, car_age double, brand string, model string")
    monkeypatch.setattr(workspace.Workspace, "rows_us", rows)
    monkeypatch.setattr(workspace.Workspace, "cars_us", rows)
    found = registry.unknown_categories(workspace.Workspace(spark, "none")).first()
    assert (found["brand"], found["model"]) == (3, 0)


@pytest.mark.parametrize("name", ["raw_de", "raw_us"])
def test_raw_views_write_nothing(spark, monkeypatch, name):
    """A query on few raw columns makes these only; no wide text table is stored for it."""
    def fail(*args, **kw):
        raise AssertionError("a raw table was written")

    monkeypatch.setattr(workspace, "write_table", fail)
    view = getattr(workspace.Workspace(spark, "/root/testdata/sf0.001"), name).select("row_pos")
    assert "c_mktsegment" not in view._jdf.queryExecution().executedPlan().toString() and view.count() > 0
