"""The forest's neighbours: exact distances, measured recall, and the exact search where recall is not reached."""

import numpy as np
import pytest

from tenura.operators import resampling
from tenura.operators.neighbours import Forest, _leaves, _nearest_within, forest_neighbours

SMALL = Forest(leaf_rows=60, cell_rows=300, sample_rows=400, batch=4, asked=60)


def table(spark, points):
    return spark.createDataFrame([(f"k{i}", [float(v) for v in p]) for i, p in enumerate(points)], "_id string, _x array<double>")


@pytest.mark.parametrize("width", [2, 20, 90])
def test_recall_is_reached_and_distances_are_exact(spark, width):
    draw = np.random.default_rng(width)
    points = draw.normal(size=(1500, width))
    points[:150] = points[0] + draw.normal(size=(150, width)) * 1e-3
    best, measured, trees = forest_neighbours(table(spark, points), 5, 0.9, SMALL)
    assert measured >= 0.9 and trees % 4 == 0
    hits = total = 0
    rows = best.collect()
    assert len(rows) == len(points)
    for r in rows:
        i = int(r["_id"][1:])
        d = ((points - points[i]) ** 2).sum(axis=1)
        assert [c["d"] for c in r["_best"]] == pytest.approx([d[int(c["id"][1:])] for c in r["_best"]], rel=1e-12)
        assert [c["d"] for c in r["_best"]] == sorted(c["d"] for c in r["_best"]) and r["_id"] not in {c["id"] for c in r["_best"]}
        d[i] = np.inf
        hits += sum(c["d"] <= np.sort(d)[4] * (1 + 1e-9) for c in r["_best"])
        total += 5
    assert hits / total >= 0.87


def test_one_leaf_is_exact(spark):
    points = np.random.default_rng(3).normal(size=(200, 7))
    best, measured, trees = forest_neighbours(table(spark, points), 5, 1.0, Forest())
    assert (measured, trees) == (1.0, 1)
    for r in best.collect():
        d = ((points - points[int(r["_id"][1:])]) ** 2).sum(axis=1)
        assert [c["d"] for c in r["_best"]] == pytest.approx(np.sort(d)[1:6].tolist())


def test_search_is_exact_where_the_forest_is_not_enough(spark):
    points = np.random.default_rng(4).normal(size=(600, 30))
    few = Forest(leaf_rows=10, cell_rows=50, batch=1, most=1, asked=50)
    assert forest_neighbours(table(spark, points), 5, 0.99, few)[0] is None
    df = table(spark, points).toDF("k", "x")
    exact = {r["k"]: r["neighbours"] for r in resampling.near_neighbours(df, "k", "x").collect()}
    found = {r["k"]: r["neighbours"] for r in resampling.near_neighbours(df, "k", "x", recall=0.99, forest=few).collect()}
    assert exact == found


def test_crowded_points_and_tiny_tables(spark):
    same = spark.range(3000).selectExpr("cast(id as string) as k", "array(if(id < 2990, 0.0D, cast(id as double))) as x")
    found = resampling.near_neighbours(same, "k", "x", recall=0.9)
    assert found.count() == 3000 and found.where("x[0] = 0 AND neighbours[4][0] = 0").count() == 2990
    schema = "k string, x array<double>"
    assert resampling.near_neighbours(spark.createDataFrame([], schema), "k", "x", recall=0.9).count() == 0
    few = resampling.near_neighbours(spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("c", None)], schema), "k", "x", recall=0.9).collect()
    assert {r["k"]: r["neighbours"] for r in few} == {"a": [[2.0]], "b": [[1.0]]}


def test_parts():
    draw = np.random.default_rng(0)
    x = np.zeros((100, 3))
    leaves = _leaves(x, 10, draw)
    assert sorted(np.concatenate(leaves)) == list(range(100)) and max(map(len, leaves)) <= 10
    places, distance = _nearest_within(np.array([[0.0], [1.0], [3.0], [3.0]]), 2)
    assert places.tolist() == [[1, 2], [0, 2], [3, 1], [2, 1]] and distance[:, 0].tolist() == [1.0, 1.0, 0.0, 0.0]
    assert _nearest_within(np.array([[1.0]]), 5)[0].shape == (1, 0)
