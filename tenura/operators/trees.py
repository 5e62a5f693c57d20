"""Exact attributions of tree ensembles: every root-to-leaf path is a row of a table with its conditions and covers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.session import scratch_folder

# A node: children are ids in the same tree, -1 in a leaf; ``x[slot] <= threshold`` goes left.
NODES = "tree int, id int, left int, right int, slot int, threshold double, cover double, value double"
# Rows and paths that are worked on at once.
ROWS, PATHS = 64, 2048
# Slots up to which all combinations of a path are tabulated, and values (8 bytes each) that the tables of a task may have.
TABLE_SLOTS, TABLE_VALUES = 6, 1 << 24


def ensemble_nodes(model) -> DataFrame:
    """The nodes of a fitted classifier of Spark, from its stored form; covers are summed training weights.

    Values of boosted trees add up to the log-odds of class 1, those of a forest to its probability.
    """
    if not isinstance(model, (GBTClassificationModel, RandomForestClassificationModel)):
        raise ValueError(f"not a tree ensemble: {type(model).__name__}")
    boosted = isinstance(model, GBTClassificationModel)
    spark = SparkSession.active()
    path = scratch_folder(spark, "trees")
    model.save(path)
    weights = spark.createDataFrame(list(enumerate(float(w) for w in model.treeWeights)), "tree int, _weight double")
    stored = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    stats = F.col("impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    if boosted:
        cover, value = stats[0], 2.0 * F.col("_weight") * F.col("prediction")
    else:
        cover, value = total, F.try_divide(stats[1], total) * F.col("_weight") / float(sum(model.treeWeights))
    split, kinds = F.col("split.leftCategoriesOrThreshold"), F.col("split.numCategories")
    # A slot with two categories is a threshold between them; which one goes left decides the children's order.
    swapped = (kinds == 2) & (split[0] == 1.0)
    checked = F.when(kinds > 2, F.raise_error(F.lit("slots with more than two categories"))).otherwise(
        F.when(kinds == 2, 0.5).otherwise(F.get(split, F.lit(0))))
    return stored.join(F.broadcast(weights), "tree").select(
        "tree", "id",
        F.when(swapped, F.col("rightChild")).otherwise(F.col("leftChild")).alias("left"),
        F.when(swapped, F.col("leftChild")).otherwise(F.col("rightChild")).alias("right"),
        F.col("split.featureIndex").alias("slot"), checked.cast("double").alias("threshold"),
        cover.alias("cover"), value.alias("value"),
    )


@dataclass(frozen=True)
class Paths:
    """Paths with the same number of slots: a row per leaf, a column per slot that its path asks for.

    A row of data satisfies a slot if ``low < x <= high``; ``share`` is the part of the cover that does, over all
    splits of the slot on this path.
    """

    value: np.ndarray
    slot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def path_table(nodes: DataFrame) -> list[Paths]:
    """All paths of the trees, grouped by their length. The table is as large as the model, which the driver holds."""
    trees: dict[int, dict[int, object]] = {}
    for row in nodes.collect():
        trees.setdefault(row["tree"], {})[row["id"]] = row
    found: dict[int, list[tuple[float, dict]]] = {}
    for tree in trees.values():
        children = {i for row in tree.values() for i in (row["left"], row["right"])}
        todo = [(next(i for i in tree if i not in children), {})]
        while todo:
            i, steps = todo.pop()
            node = tree[i]
            if node["left"] < 0:
                found.setdefault(len(steps), []).append((node["value"], steps))
                continue
            for child, above in ((node["left"], False), (node["right"], True)):
                low, high, share = steps.get(node["slot"], (-np.inf, np.inf, 1.0))
                part = tree[child]["cover"] / node["cover"] if node["cover"] else 0.0
                cut = node["threshold"]
                step = (max(low, cut), high, share * part) if above else (low, min(high, cut), share * part)
                todo.append((child, {**steps, node["slot"]: step}))
    tables = []
    for size, paths in sorted(found.items()):
        shape = (len(paths), size)
        slot = np.array([list(steps) for _, steps in paths], np.int64).reshape(shape)
        low, high, share = (
            np.array([[step[k] for step in steps.values()] for _, steps in paths], float).reshape(shape) for k in range(3))
        tables.append(Paths(np.array([value for value, _ in paths], float), slot, low, high, share))
    return tables


def base_value(tables: Sequence[Paths]) -> float:
    """The prediction when no slot is known: values weighed by their covers' shares."""
    return float(sum((t.value * t.share.prod(axis=1)).sum() for t in tables))


def predictions(x: np.ndarray, tables: Sequence[Paths]) -> np.ndarray:
    """Values of the leaves that the rows of ``x`` reach, a few rows and paths at a time."""
    total = np.zeros(len(x))
    for t in tables:
        for start in range(0, len(t.value), PATHS):
            part = slice(start, start + PATHS)
            for first in range(0, len(x), ROWS):
                asked = x[first : first + ROWS, t.slot[part]]
                total[first : first + ROWS] += ((asked > t.low[part]) & (asked <= t.high[part])).all(axis=2) @ t.value[part]
    return total


class Walk:
    """All trees of a node table side by side, to score rows of which some slots are replaced."""

    def __init__(self, nodes: DataFrame):
        rows = nodes.orderBy("tree", "id").collect()  # as many as the model has nodes
        place = {(r["tree"], r["id"]): i for i, r in enumerate(rows)}
        below = {(r["tree"], c) for r in rows for c in (r["left"], r["right"])}
        self.slot = np.array([r["slot"] if r["left"] >= 0 else -1 for r in rows], np.int64)
        self.threshold = np.array([r["threshold"] if r["left"] >= 0 else 0.0 for r in rows], float)
        self.left, self.right = (
            np.array([place[r["tree"], r[side]] if r["left"] >= 0 else i for i, r in enumerate(rows)], np.int64) for side in ("left", "right"))
        self.value = np.array([r["value"] if r["left"] < 0 else 0.0 for r in rows], float)
        self.roots = np.array([i for i, r in enumerate(rows) if (r["tree"], r["id"]) not in below], np.int64)
        number = {rows[i]["tree"]: k for k, i in enumerate(self.roots)}
        self.uses: dict[int, list[int]] = {}
        for r in rows:
            if r["left"] >= 0:
                self.uses.setdefault(r["slot"], []).append(number[r["tree"]])

    def values(self, x: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
        """The leaf value of each row in each of the chosen trees."""
        at = np.broadcast_to(self.roots if chosen is None else self.roots[chosen], (len(x), len(self.roots) if chosen is None else len(chosen)))
        rows = np.arange(len(x))[:, None]
        while (self.slot[at] >= 0).any():
            slot = np.maximum(self.slot[at], 0)
            at = np.where(x[rows, slot] <= self.threshold[at], self.left[at], self.right[at])
        return self.value[at]

    def swapped(self, own: np.ndarray, other: np.ndarray, groups: Sequence[Sequence[int]]) -> np.ndarray:
        """For each group of slots the prediction when these are taken from ``other``: only trees that use them are walked."""
        found = np.empty((len(own), len(groups)))
        for start in range(0, len(own), 256):
            part = slice(start, start + 256)
            values = self.values(own[part])
            whole = values.sum(axis=1)
            for j, slots in enumerate(groups):
                chosen = np.array(sorted({t for s in slots for t in self.uses.get(s, [])}), np.int64)
                moved = own[part].copy()
                moved[:, slots] = other[part][:, slots]
                found[part, j] = whole + (self.values(moved, chosen) - values[:, chosen]).sum(axis=1)
        return found


def path_weights(met: np.ndarray, share: np.ndarray) -> np.ndarray:
    """For each slot of each path the summed weight of all subsets of the other slots, times what knowing it changes.

    ``met`` says which slots a row satisfies (rows, paths, slots). A known slot contributes whether it is met, an
    unknown one its share. The polynomial whose k-th coefficient adds up the subsets of k known slots is extended slot by
    slot; a slot is then unwound from it by division, and coefficients are weighed by the chance that k slots come first.
    """
    size = met.shape[2]
    one = met.astype(float)
    whole = np.zeros((*met.shape[:2], size + 1))
    whole[..., 0] = 1.0
    for j in range(size):
        moved = whole[..., :-1] * one[..., j, None]
        whole *= share[None, :, j, None]
        whole[..., 1:] += moved
    chance = [factorial(k) * factorial(size - 1 - k) / factorial(size) for k in range(size)]
    found = np.empty(met.shape)
    for j in range(size):
        z = share[None, :, j]
        with np.errstate(divide="ignore", invalid="ignore"):
            # Not met: the polynomial was only multiplied by the share. Met: divide by share + t from the top.
            total = sum(c * whole[..., k] for k, c in enumerate(chance)) / z
        rest, top = np.zeros(met.shape[:2]), np.zeros(met.shape[:2])
        for k in range(size - 1, -1, -1):
            top = whole[..., k + 1] - z * top
            rest += chance[k] * top
        # A slot with share 0 that is not met: the rest is multiplied out anew.
        lost = ~met[..., j] & (z == 0)
        if lost.any():
            others = [i for i in range(size) if i != j]
            anew = np.zeros((*met.shape[:2], size))
            anew[..., 0] = 1.0
            for i in others:
                moved = anew[..., :-1] * one[..., i, None]
                anew *= share[None, :, i, None]
                anew[..., 1:] += moved
            total = np.where(lost, anew @ np.array(chance), total)
        found[..., j] = (one[..., j] - z) * np.where(met[..., j], rest, total)
    return found


def attributed(x: np.ndarray, tables: Sequence[Paths], feature_of: np.ndarray, features: int) -> np.ndarray:
    """Shapley values of the rows of ``x``, summed over the slots of each feature, in bounded memory."""
    found = np.zeros((len(x), features))
    for t in tables:
        size = t.slot.shape[1]
        if not size:
            continue
        for start in range(0, len(t.value), PATHS):
            part = slice(start, start + PATHS)
            slot, value = t.slot[part], t.value[part]
            owner = feature_of[slot]
            spread = [np.zeros((len(value), features)) for _ in range(size)]
            for j in range(size):
                spread[j][np.arange(len(value)), owner[:, j]] = value
            for first in range(0, len(x), ROWS):
                some = x[first : first + ROWS]
                met = (some[:, slot] > t.low[part]) & (some[:, slot] <= t.high[part])
                weights = path_weights(met, t.share[part])
                for j in range(size):
                    found[first : first + ROWS] += weights[..., j] @ spread[j]
    return found


class Lookup:
    """Up to ``PATHS`` paths of one length with what their slots add, tabulated for all combinations of met slots.

    A row then takes one number per slot of a path from a table, whose entries are ``path_weights`` of the combination
    times the path's value. Slots are in the order of their features.
    """

    def __init__(self, t: Paths, feature_of: np.ndarray):
        paths, size = t.slot.shape
        met = (np.arange(1 << size)[:, None] >> np.arange(size) & 1).astype(bool)
        weights = path_weights(np.broadcast_to(met[:, None, :], (1 << size, paths, size)), t.share) * t.value[:, None]
        owner = feature_of[t.slot].ravel()
        order = np.argsort(owner, kind="stable")
        self.table = weights.transpose(1, 2, 0).reshape(paths * size, -1)[order].ravel()
        self.path, self.start = order // size, np.arange(len(order)) << size
        self.features, self.first = np.unique(owner[order], return_index=True)
        # Paths share splits, so a condition is asked once.
        asked, self.condition = np.unique(np.stack([t.slot.ravel(), t.low.ravel(), t.high.ravel()]), axis=1, return_inverse=True)
        self.condition = self.condition.reshape(paths, size)
        self.slot, self.low, self.high = asked[0].astype(np.int64), asked[1], asked[2]
        self.value, self.size = t.value, size

    def add(self, x: np.ndarray, found: np.ndarray, total: np.ndarray) -> None:
        """Add attributions and predictions of the rows of ``x``."""
        asked = x[:, self.slot]
        met = ((asked > self.low) & (asked <= self.high)).astype(np.int64)
        combination = np.zeros((len(x), len(self.value)), np.int64)
        for j in range(self.size):
            combination += met.take(self.condition[:, j], axis=1) << j
        found[:, self.features] += np.add.reduceat(self.table.take(combination.take(self.path, axis=1) + self.start), self.first, axis=1)
        total += (combination == (1 << self.size) - 1) @ self.value


def lookups(tables: Sequence[Paths], feature_of: np.ndarray) -> tuple[list[Lookup], list[Paths]]:
    """Tabulated paths, and those that are too long or too many for that."""
    made, rest, left = [], [], TABLE_VALUES
    for t in tables:
        paths, size = t.slot.shape
        left -= (paths * size) << min(size, 32)
        if not 0 < size <= TABLE_SLOTS or left < 0:
            left += (paths * size) << min(size, 32)
            rest.append(t)
            continue
        for start in range(0, paths, PATHS):
            part = slice(start, start + PATHS)
            made.append(Lookup(Paths(t.value[part], t.slot[part], t.low[part], t.high[part], t.share[part]), feature_of))
    return made, rest


def path_attributions(
    df: DataFrame, key: str, vector: str, tables: Sequence[Paths], slots: Sequence[Sequence[str]], features: Sequence[str]
) -> DataFrame:
    """(key, base, prediction, attributions) of an array column: exact Shapley values of the ensemble per feature.

    An unknown slot follows both branches by their covers. ``slots`` are the vector's slots of each feature, in vector
    order. ``base`` and the values add up to ``prediction``. The table of paths goes to the tasks with the function;
    a task with more rows than a path has combinations of slots tabulates them first.
    """
    feature_of = np.repeat(np.arange(len(features)), [len(s) for s in slots])
    base, names = base_value(tables), list(features)
    entry = pa.struct([("feature", pa.string()), ("shap_value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rest = None, tables
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(feature_of))
                if known is None and len(x) > 1 << TABLE_SLOTS:
                    known, rest = lookups(tables, feature_of)
                values, total = attributed(x, rest, feature_of, len(names)), predictions(x, rest)
                for paths in known or []:
                    for first in range(0, len(x), ROWS):
                        part = slice(first, first + ROWS)
                        paths.add(x[part], values[part], total[part])
                entries = pa.StructArray.from_arrays([pa.array(names * len(x), pa.string()), pa.array(values.ravel())], fields=list(entry))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(names)), entries)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(len(x), base)), pa.array(total), lists],
                    names=[key, "base", "prediction", "attributions"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, vector).mapInArrow(
        run, f"`{key}` {kind}, base double, prediction double, attributions array<struct<feature:string,shap_value:double>>")
