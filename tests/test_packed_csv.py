from __future__ import annotations

import os

from conftest import values
from test_loading import de

from lotwise.plans import ingest
from lotwise.session import scratch_path
from lotwise.sources import raw, store
from lotwise.streaming import append


def stored(folder):
    """Names and bytes of the data files below a folder."""
    found = [os.path.join(d, f) for d, _, files in os.walk(folder) for f in files if f.startswith("part-")]
    return found, sum(map(os.path.getsize, found))


def listings(spark, n):
    texts = [{"Beschreibung": f'Zeile {i}\nZeile "2", {i * 7}', "URL": f"https://listings.example.com/{i}"} for i in range(n)]
    return de(spark, *texts).drop("row_pos")


def test_landed_raw_files_are_packed_and_whole(spark):
    """A fifth of their text at most; fields with line breaks and quotes come back as they were, in their order."""
    rows, path = listings(spark, 500).coalesce(2), scratch_path(spark, "packed")
    store.append_csv(rows, path)
    files, size = stored(path)
    assert len(files) == 2 and size < sum(len(",".join(v or "" for v in r)) for r in rows.collect()) / 5
    back = raw.read_raw(spark, path, "DE")
    assert sorted(map(tuple, back.drop("row_pos").select(rows.columns).collect())) == sorted(map(tuple, rows.collect()))
    assert values(back.orderBy("row_pos"), "URL") == values(rows, "URL")


def test_deliveries_are_packed_and_firsts_stay(spark, tmp_path):
    """Two deliveries, the second with copies of the first: what lands is a fifth of its text, rows are those of one batch."""
    rows, folder, cleaned, root = listings(spark, 400), *(str(tmp_path / n) for n in ("in", "cleaned", "out"))
    for n, part in enumerate((rows.limit(250), rows)):
        store.append_csv(part.coalesce(1), f"{folder}/{n}")
        append.append_cleaned(append.raw_stream(spark, f"{folder}/*"), "DE", cleaned, str(tmp_path / "names")).awaitTermination()
        append.append_firsts(spark, "DE", cleaned, root, str(tmp_path / "places")).awaitTermination()
    files, size = stored(folder)
    assert len(files) == 2 and size < sum(len(",".join(v or "" for v in r)) for r in rows.collect()) * 650 / 400 / 5
    whole = ingest.clean(raw.read_raw(spark, f"{folder}/1", "DE"), "DE")
    shown = [c for c in whole.columns if c != "row_pos"]
    found = [sorted(map(str, df.select(shown).collect())) for df in (spark.read.parquet(root), whole)]
    assert found[0] == found[1] and len(found[0]) == 400
