"""Vector codes: trees against comparison with every entry, odd rows, and the whole against plain integers."""

from __future__ import annotations

import numpy as np
import pytest

from lotwise.llm import codes


@pytest.mark.parametrize("n, width, spread", [(16, 8, 5000), (16, 2, 2), (200, 3, 40), (5, 1, 3), (1, 4, 9)])
def test_tree_finds_what_comparing_with_all_finds(n, width, spread):
    random = np.random.default_rng(n)
    points = random.integers(-spread, spread + 1, (n, width))
    points[n // 2 :] = points[: n - n // 2]  # equal entries: the lowest index counts
    queries = random.integers(-spread, spread + 1, (500, width))
    away = ((queries[:, None, :] - points[None]) ** 2).sum(axis=2)
    index, best = codes.Gnat(points).nearest(queries)
    assert (index == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def test_whole_subtrees_are_left_out():
    random = np.random.default_rng(1)
    centres = random.integers(-10**6, 10**6, (20, 8))
    points = (centres[:, None] + random.integers(-100, 100, (20, 20, 8))).reshape(-1, 8)
    tree = codes.Gnat(points)
    tree.nearest(points[::3] + 1)
    assert tree.compared < len(points[::3]) * len(points) / 5


def plain_codes(rows, entries, rounds):
    """rows: (key, label, integers) in the order of keys."""
    width = len(rows[0][2]) // codes.PARTS
    cut = [[v[p * width : (p + 1) * width] for p in range(codes.PARTS)] for _, _, v in rows]
    books = [[cut[e][p] for e in range(min(entries, len(rows)))] for p in range(codes.PARTS)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(x) // len(groups[e]) for x in zip(*groups[e])] if e in groups else old for e, old in enumerate(book)]
    found = [[nearest(c[p], books[p]) for p in range(codes.PARTS)] for c in cut]
    return {r[0]: ("".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for r, f in zip(rows, found)}


def test_codes_of_odd_rows(spark):
    random = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    sound = [(i, None if i % 5 == 0 else i % 3, [float(x) for x in random.normal(0, 0.3, 16)]) for i in range(60)]
    sound += [(60, 1, sound[7][2]), (61, 1, sound[7][2]), (62, None, [0.0] * 16)]
    odd = [(-1, 1, None), (-2, 1, []), (-3, 1, [None] + [0.0] * 15), (-4, 1, [nan] + [0.0] * 15), (-5, 1, [inf] + [0.0] * 15),
           (-6, 1, [0.5] * 8), (-7, 1, [0.5] * 15), (-8, 1, [1e9] * 16)]
    df = spark.createDataFrame(sound + odd, "vec_id bigint, label int, embedding array<double>").selectExpr("*", "1 AS key", "2 AS code")
    found = {r["vec_id"]: r for r in codes.vector_codes(df.repartition(5), entries=6, rounds=4).collect()}
    rows = [(k, l, [int(np.floor(4096 * x)) for x in v]) for k, l, v in sound]
    expected = plain_codes(rows, 6, 4)
    assert {k: (r["code"], r["error"]) for k, r in found.items()} == expected
    by_label = {}
    for k, l, _ in rows:
        by_label[l] = by_label.get(l, 0) + expected[k][1]
    assert all(found[k]["label_error"] == by_label[l] for k, l, _ in rows)
    assert len({r["codebooks_sha256"] for r in found.values()}) == 1


def test_null_keys_repeated_rows_and_empty_tables(spark):
    rows = [(None, 1, [0.25] * 8), (3, None, [0.5] * 8), (3, None, [0.5] * 8), (3, None, [-0.5] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    found = sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in codes.vector_codes(df).collect())
    # seeds: the vectors of id 3 in their order, the null id last; equal entries have the lower index
    assert found == [("3", "00" * 8, 0, 0), ("3", "01" * 8, 0, 0), ("3", "01" * 8, 0, 0), ("None", "03" * 8, 0, 0)]
    assert codes.vector_codes(df.where("1 = 0")).collect() == []
