from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lotwise.functions.documents import leaf_pairs_of
from lotwise.plans import registry
from lotwise.plans.workspace import Workspace


def test_chains_and_branches_at_any_depth():
    deep = {"Last": " X "}
    for i in range(2000):
        deep = {"outer": deep} if i % 3 else {"outer": deep, f"k{i % 6}": i, "l": [deep.get("no")], "e": {}}
    pairs = [(p["key"], p["value"]) for p in leaf_pairs_of(json.dumps(deep))]
    assert pairs == [("last", "x"), ("k0", "1998"), ("k3", "1995")]
    assert leaf_pairs_of('{"a": {"b": {}}}') == [] and leaf_pairs_of('{"a": {"b": [1]}}') == []
    assert leaf_pairs_of('{"a": {"b": null}}') == [{"key": "b", "value": "none"}]


def test_deep_documents_are_dealt_over_all_tasks(spark, tmp_path, monkeypatch):
    """A file with one row group and many splits: only one of the splits has rows."""
    n = 4000
    events = {"event_id": list(range(n)), "user_id": list(range(n)), "event_type": [f"type {i}" for i in range(n)]}
    pq.write_table(pa.table(events), tmp_path / "events.parquet", row_group_size=n, compression="none")
    monkeypatch.setattr(registry, "DEEP_ROWS", 500, raising=False)
    kept = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in kept:
            spark.conf.set(c, "4k")
        found = registry.doc_deep_pairs(Workspace(spark, str(tmp_path)))
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert sum(sizes) == n and len(sizes) == 8 and max(sizes) < 700
