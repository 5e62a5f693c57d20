"""Centroid clustering against brute force in Python's integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.llm import pivots
from tenura.llm.pivots import LONGEST, PivotClustering, clusters, nearest, pivot_distances

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, near string, v string, sums string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z", "s") for i, v in rows], SCHEMA)


def brute_force(rows, how):
    limit = pivots.LARGEST
    kept = [
        (i, [math.floor(max(-limit, min(limit, how.scale * x))) for x in v])
        for i, v in rows if v is not None and len(v) == how.components and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = [hashlib.sha256(f"{how.seed}:{i}".encode()).hexdigest() if i is not None else "~" for i, _ in kept]
    order = sorted(range(len(kept)), key=lambda j: (digest[j], kept[j][1]))
    centroids = [kept[j][1] for j in order[: how.clusters]]

    def assign():
        found = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(how.rounds):
        found = assign()
        for k in range(len(centroids)):
            mine = [v for (_, v), (c, _) in zip(kept, found) if c == k]
            if mine:
                centroids[k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [(c, min(d, LONGEST)) for c, d in assign()]
    sums = {k: sum(d for c, d in found if c == k) for k, _ in found}
    total = min(sum(sums.values()), LONGEST)
    return sorted(
        (i is None, i or 0, c, d, min(sums[c], LONGEST), total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for (i, _), (c, d) in zip(kept, found)
    )


def rows_of(df):
    return sorted(
        (r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()
    )


def drawn(n, width, seed=1):
    draw = np.random.default_rng(seed)
    middle = draw.normal(0, 2, (5, width))
    return [(i, (middle[i % 5] + draw.normal(0, 0.7, width)).tolist()) for i in range(n)]


@pytest.mark.parametrize("how", [
    PivotClustering(components=6), PivotClustering(components=6, pivots=1), PivotClustering(components=6, clusters=3, rounds=2, pivot_sample=4),
])
def test_same_as_brute_force(spark, how):
    rows = drawn(300, 6)
    assert rows_of(clusters(table(spark, rows), how)) == brute_force(rows, how)


def test_awkward_rows(spark):
    how = PivotClustering(components=3)
    rows = [
        (1, [0.5, 1.0, -1.0]), (1, [0.5, 1.0, -1.0]), (None, [0.25, 0.0, 0.0]), (None, [9.0, 9.0, 9.0]), (2, None), (3, []), (4, [1.0, 2.0]),
        (5, [1.0, 2.0, None]), (6, [1.0, 2.0, math.nan]), (7, [1.0, 2.0, math.inf]), (8, [-0.0001, 0.0, 1e-9]), (9, [-math.inf, 0.0, 0.0]),
        *[(20 + i, [0.5, 0.5, 0.5]) for i in range(40)], *[(70 + i, [i / 4, -i / 4, 0.0]) for i in range(9)],
    ]
    assert rows_of(clusters(table(spark, rows), how)) == brute_force(rows, how)


def test_components_beyond_64_bits(spark):
    how = PivotClustering(components=2, clusters=3)
    rows = [(i, [1e300 if i % 3 == 0 else 2e5 * i, -4e9 * (i % 4)]) for i in range(30)]
    found = rows_of(clusters(table(spark, rows), how))
    assert found == brute_force(rows, how)
    assert {r[4] for r in found} and max(r[5] for r in found) <= LONGEST


@pytest.mark.parametrize("rows", [[], [(1, [None, None])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_few_or_no_rows(spark, rows):
    how = PivotClustering(components=2)
    found = clusters(table(spark, rows), how)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert rows_of(found) == brute_force(rows, how)


def test_pivots_save_exact_distances_and_keep_ties():
    draw = np.random.default_rng(5)
    middle = draw.integers(-4000, 4000, (8, 16))
    x = np.concatenate([m + draw.integers(-200, 200, (100, 16)) for m in middle])
    ties = np.concatenate([middle, middle])
    places = pivot_distances(x, middle[:4])
    cluster, distance, computed = nearest(x, places, ties, pivot_distances(ties, middle[:4]))
    exact = ((x[:, None, :] - ties[None]) ** 2).sum(axis=2)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert cluster.max() < 8
    assert computed < 0.5 * len(x) * len(ties)


def test_does_not_depend_on_partitions(spark):
    rows = drawn(200, 4, seed=9)
    how = PivotClustering(components=4)
    one = rows_of(clusters(table(spark, rows).repartition(1), how))
    assert one == rows_of(clusters(table(spark, rows).repartition(7, F.col("vec_id") % 3), how))
