"""Nearest neighbours in many dimensions: a forest of random projections that grows until its measured recall suffices."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.session import checkpointed


@dataclass(frozen=True)
class Forest:
    """A tree halves all rows by projections on random directions until a part has at most ``leaf_rows``.

    The upper halvings, down to cells of about ``cell_rows``, are learned on at most ``sample_rows`` rows of the least
    hashes; every row is then placed, and a cell is halved further where it lies. ``batch`` trees are added at a time until
    the share of true neighbours of ``asked`` rows, found by comparing them with all rows, reaches the wanted recall;
    after ``most`` trees the caller has to search exactly.
    """

    leaf_rows: int = 1_000
    cell_rows: int = 20_000
    sample_rows: int = 50_000
    batch: int = 4
    most: int = 64
    asked: int = 200
    seed: int = 17


def _unit_directions(draw: np.random.Generator, count: int, width: int) -> np.ndarray:
    directions = draw.normal(size=(count, width))
    return directions / np.linalg.norm(directions, axis=1, keepdims=True)


class _Cells:
    """The upper part of one tree: a heap of directions and thresholds learned on a sample."""

    def __init__(self, sample: np.ndarray, levels: int, seed: tuple[int, ...]):
        draw = np.random.default_rng(seed)
        inner = (1 << levels) - 1
        self.levels, self.cuts = levels, np.zeros(inner)
        self.directions = _unit_directions(draw, inner, sample.shape[1])
        parts = [np.arange(len(sample))]
        for node in range(inner):
            part = parts[node]
            projected = np.nan_to_num(sample[part]) @ self.directions[node]
            self.cuts[node] = np.median(projected) if len(part) else 0.0
            low = projected <= self.cuts[node]
            parts += [part[low], part[~low]]

    def of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.levels):
            above = np.einsum("ij,ij->i", np.nan_to_num(x), self.directions[node]) > self.cuts[node]
            node = 2 * node + 1 + above
        return node - ((1 << self.levels) - 1)


def _leaves(x: np.ndarray, leaf_rows: int, draw: np.random.Generator) -> list[np.ndarray]:
    """Places of rows, halved by random projections until each part is small; equal projections are halved by place."""
    done, todo = [], [np.arange(len(x))]
    while todo:
        part = todo.pop()
        if len(part) <= leaf_rows:
            done.append(part)
            continue
        order = np.argsort(np.nan_to_num(x[part]) @ _unit_directions(draw, 1, x.shape[1])[0], kind="stable")
        middle = len(part) // 2
        todo += [part[order[:middle]], part[order[middle:]]]
    return done


def _nearest_within(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the places and exact squared distances of its ``k`` nearest others; candidates come from products.

    A row with a component that is no finite number is infinitely far from all others.
    """
    n = len(x)
    k = min(k, n - 1)
    if k <= 0:
        return np.empty((n, 0), np.int64), np.empty((n, 0))
    strange = ~np.isfinite(x).all(axis=1)
    centred = np.where(strange[:, None], 0.0, x)
    centred = centred - centred.mean(axis=0)
    squares = (centred * centred).sum(axis=1)
    near = squares[:, None] + squares[None] - 2 * centred @ centred.T
    near[strange], near[:, strange] = np.inf, np.inf
    np.fill_diagonal(near, np.inf)
    # Rounding can swap near-equal distances, so a few more are measured exactly.
    wide = min(n - 1, k + 3)
    places = np.argpartition(near, wide - 1, axis=1)[:, :wide]
    with np.errstate(invalid="ignore", over="ignore"):
        exact = ((x[:, None, :] - x[places]) ** 2).sum(axis=2)
    exact[np.isnan(exact) | (places == np.arange(n)[:, None])] = np.inf
    order = np.lexsort((places, exact))[:, :k]
    return np.take_along_axis(places, order, axis=1), np.take_along_axis(exact, order, axis=1)


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in vectors])


def _found_by_trees(points: DataFrame, trees: list[_Cells], first: int, k: int, how: Forest) -> DataFrame:
    """(_id, _other, d) of the nearest rows in the same leaf, for each of some trees."""

    def place(batches):
        for batch in batches:
            for start in range(0, len(batch), 4096):
                part = batch.iloc[start : start + 4096]
                x = _matrix(part["_x"])
                for i, tree in enumerate(trees):
                    yield part.assign(_tree=first + i, _cell=tree.of(x))[["_tree", "_cell", "_id", "_x"]]

    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_id")
        x, ids = _matrix(group["_x"]), group["_id"].to_numpy()
        draw = np.random.default_rng((how.seed, int(group["_tree"].iloc[0]), int(group["_cell"].iloc[0])))
        out = []
        for leaf in _leaves(x, how.leaf_rows, draw):
            others, distance = _nearest_within(x[leaf], k)
            found = pd.DataFrame({
                "_id": np.repeat(ids[leaf], others.shape[1]), "_other": ids[leaf][others.ravel()], "d": distance.ravel()})
            out.append(found[found["_id"] != found["_other"]])
        return pd.concat(out, ignore_index=True)

    placed = points.select("_id", "_x").mapInPandas(place, "_tree int, _cell bigint, _id string, _x array<double>")
    return placed.groupBy("_tree", "_cell").applyInPandas(search, "_id string, _other string, d double")


def _true_distances(points: DataFrame, asked: pd.DataFrame, k: int) -> dict[str, list[float]]:
    """Exact squared distances of the ``k`` nearest rows of a few asked rows, by one pass over all."""
    x, ids = _matrix(asked["_x"]), asked["_id"].to_numpy()

    def compare(batches):
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.iloc[start : start + 512]
                y, others = _matrix(part["_x"]), part["_id"].to_numpy()
                for i, name in enumerate(ids):
                    d = ((y - x[i]) ** 2).sum(axis=1)[others != name]
                    near = np.sort(np.where(np.isnan(d), np.inf, d))[:k]
                    yield pd.DataFrame({"_id": name, "d": near})

    found = points.select("_id", "_x").mapInPandas(compare, "_id string, d double")
    best = found.groupBy("_id").agg(F.slice(F.sort_array(F.collect_list("d")), 1, k).alias("d"))
    return {r["_id"]: r["d"] for r in best.collect()}


def forest_neighbours(points: DataFrame, k: int, recall: float, how: Forest = Forest()) -> tuple[DataFrame | None, float, int]:
    """Nearest rows of distinct vectors (_id, _x): a table (_id, _best), its measured recall and the number of trees.

    ``_best`` has up to ``k`` (d, id), nearest first, with exact squared distances. The table is None where ``most`` trees
    do not reach the recall. Pass a checkpointed table.
    """
    rows = points.count()
    # A bounded number of rows of the least hashes, the same in every run.
    order = [F.xxhash64("_id"), F.col("_id")]
    levels = max(0, int(np.ceil(np.log2(max(rows, 1) / how.cell_rows))))
    sample = _matrix(points.orderBy(*order).limit(min(how.sample_rows, 256 << levels)).toPandas()["_x"]) if levels else np.zeros((0, 1))
    width = sample.shape[1]
    asked = points.orderBy(F.xxhash64(F.lit("asked"), "_id"), "_id").limit(how.asked).select("_id", "_x").toPandas()
    truth = _true_distances(points, asked, k) if len(asked) else {}
    names = list(truth)
    best, trees, measured = None, 0, 1.0
    while trees < how.most:
        count = how.batch if rows > how.leaf_rows else 1
        made = [_Cells(sample.reshape(-1, width), levels, (how.seed, trees + i)) for i in range(count)]
        found = _found_by_trees(points, made, trees, k, how).select("_id", F.struct("d", F.col("_other").alias("id")).alias("c"))
        if best is not None:
            found = found.unionByName(best.select("_id", F.explode("_best").alias("c")))
        # At most k rows a tree; the same neighbour found twice counts once.
        near = F.slice(F.sort_array(F.collect_set("c")), 1, k)
        best = checkpointed(found.groupBy("_id").agg(near.alias("_best")))
        trees += count
        got = {r["_id"]: [c["d"] for c in r["_best"]] for r in best.where(F.col("_id").isin(names)).collect()} if names else {}
        hits = sum(d <= truth[i][-1] * (1 + 1e-9) for i in names for d in got.get(i, []))
        wanted = sum(map(len, truth.values()))
        measured = hits / wanted if wanted else 1.0
        if measured >= recall:
            return best, measured, trees
    return None, measured, trees
