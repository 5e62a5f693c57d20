"""Second-order boosting with penalties: several models grow side by side from histograms that executors sum up."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.trees import NODES
from tenura.session import MOST_TASK_ROWS, checkpointed, even_task_count, task_count

MOST_BINS = 64
# Histogram cells that one job sums (16 bytes each), rounds between two stored states.
CELLS = 1 << 22
SETTLE = 25
# Rows of a block, of a task at most where there are more than all cores can take otherwise, bytes that the driver sums.
BLOCK_ROWS = 1 << 15
TASK_ROWS = 400_000
DRIVER_BYTES = 1 << 26
# A split must gain more than rounding does.
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class Boosting:
    """One model. Leaf values are -soft(G, alpha) / (H + penalty) * rate over summed gradients G and Hessians H.

    A split gains half of score(left) + score(right) - score(node), with score = soft(G, alpha)^2 / (H + penalty), and
    is made if that exceeds ``gamma`` and both sides have a Hessian of ``least_child``.
    """

    rounds: int = 300
    depth: int = 6
    rate: float = 0.1
    row_share: float = 0.8
    column_share: float = 0.8
    least_child: float = 1.0
    gamma: float = 0.0
    alpha: float = 0.0
    penalty: float = 1.0


@dataclass
class Tree:
    """Nodes as arrays; a leaf has slot -1. ``bin`` is the last bin that goes left."""

    slot: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for name, what in (("slot", -1), ("bin", -1), ("left", -1), ("right", -1), ("value", value), ("cover", cover)):
            getattr(self, name).append(what)
        return len(self.slot) - 1

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of bin numbers reaches."""
        slot, cut = np.array(self.slot, np.int64), np.array(self.bin, np.int64)
        leaf, own = slot < 0, np.arange(len(slot))
        # A leaf leads to itself on both sides, so all rows take the same steps.
        child = np.stack([np.where(leaf, own, self.right), np.where(leaf, own, self.left)], axis=1).ravel()
        slot = np.where(leaf, 0, slot)
        at, flat, start = np.zeros(len(bins), np.int64), np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
        while not leaf.take(at).all():
            at = child.take(2 * at + (flat.take(start + slot.take(at)) <= cut.take(at)))
        return at


def soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_value(g: float, h: float, how: Boosting) -> float:
    return float(-soft(np.float64(g), how.alpha) / (h + how.penalty) * how.rate) if h + how.penalty > 0 else 0.0


def best_split(histogram: np.ndarray, how: Boosting) -> tuple[int, int, float, float, float]:
    """(column, bin, gain, G left, H left) of the best split of a (columns, bins, 2) histogram; column -1 for none.

    Equal gains go to the first column and bin.
    """
    column, cut, *rest = (v[0] for v in best_splits(histogram[None], how))
    return int(column), int(cut), *map(float, rest)


def best_splits(histograms: np.ndarray, how: Boosting) -> tuple[np.ndarray, ...]:
    """``best_split`` of each node of a (nodes, columns, bins, 2) array, as five arrays."""
    sums = histograms.cumsum(axis=2)
    g, h = sums[..., 0], sums[..., 1]
    whole_g, whole_h = g[..., -1:], h[..., -1:]

    def score(gs, hs):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(hs + how.penalty > 0, soft(gs, how.alpha) ** 2 / (hs + how.penalty), 0.0)

    gain = 0.5 * (score(g, h) + score(whole_g - g, whole_h - h) - score(whole_g, whole_h))
    allowed = (h >= how.least_child) & (whole_h - h >= how.least_child) & (gain > how.gamma + LEAST_GAIN)
    allowed[..., -1] = False
    nodes, width = len(gain), gain.shape[2]
    gain = np.where(allowed, gain, -np.inf).reshape(nodes, -1)
    at, each = gain.argmax(axis=1), np.arange(nodes)
    found = np.isfinite(gain[each, at])
    left = [np.where(found, v.reshape(nodes, -1)[each, at], 0.0) for v in (gain, g, h)]
    return np.where(found, at // width, -1), np.where(found, at % width, -1), *left


def _unit(ids: np.ndarray, *parts: int) -> np.ndarray:
    """Numbers in [0, 1) that depend only on row ids and parts."""
    value = ids.astype(np.uint64)
    for part in parts:
        value = (value ^ np.uint64((part * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(31)
    return (value >> np.uint64(11)).astype(float) / float(1 << 53)


def cut_points(vectors: DataFrame, vector: str, bins: int = MOST_BINS) -> list[list[float]]:
    """Per slot of an array column the upper ends of its bins but the last, from a mergeable sketch of fixed size."""
    slots = vectors.select(F.posexplode(vector).alias("slot", "value"))
    fractions = [i / bins for i in range(1, bins)]
    found = slots.groupBy("slot").agg(
        F.percentile_approx("value", fractions, 100 * bins).alias("cuts"), F.max("value").alias("most")).collect()  # one row a slot
    cuts = {r["slot"]: sorted({c for c in r["cuts"] if c < r["most"]}) for r in found}
    return [cuts[i] for i in range(len(cuts))]


@dataclass
class Boosted:
    """A fitted model: trees over bins, the cut points, and the margin it starts from."""

    trees: list[Tree]
    cuts: list[list[float]]
    start: float
    how: Boosting

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The table of nodes that ``trees.path_table`` reads; the start is a tree of one leaf. Covers are Hessians."""
        rows = [(-1, 0, -1, -1, -1, None, 1.0, self.start)]
        for t, tree in enumerate(self.trees):
            for i, slot in enumerate(tree.slot):
                cut = float(self.cuts[slot][tree.bin[i]]) if slot >= 0 else None
                rows.append((t, i, tree.left[i], tree.right[i], slot, cut, float(tree.cover[i]), float(tree.value[i])))
        return spark.createDataFrame(rows, NODES)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.cuts)

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins, total = self.binned(x), np.full(len(x), self.start)
        for tree in self.trees:
            total += np.array(tree.value)[tree.leaves_of(bins)]
        return total


def binned(x: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)


def with_boosted_probability(df: DataFrame, model: Boosted, vector: str, into: str = "probability") -> DataFrame:
    """Add the probability of class 1, scored in batches from an array column."""
    kinds = pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.schema.get_field_index(vector)).flatten().to_numpy(zero_copy_only=False)
            p = 1 / (1 + np.exp(-model.margins(x.reshape(batch.num_rows, len(model.cuts)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, kinds)], names=[*batch.schema.names, into])

    return df.mapInArrow(run, df.withColumn(into, F.lit(0.0)).schema)


@dataclass(frozen=True)
class Layout:
    """How bin numbers of slots are kept: a code for each wide slot, and one for each bundle of indicators.

    Slots of two bins are mostly indicators. Those of which no row has two in the upper bin share a code: 0 for none of
    them, else the place of the one. A row goes right at a node if its code there is in a range.
    """

    sizes: Sequence[int]
    column: Sequence[int]  # of each slot, -1 for one bin
    place: Sequence[int]  # in a bundle; 0 for wide slots

    @classmethod
    def of(cls, sizes: Sequence[int], together: np.ndarray) -> Layout:
        """``together``: for each two slots, whether a row has both above their first bins."""
        column, place, used, bundles = [-1] * len(sizes), [0] * len(sizes), 0, []
        for slot in range(len(sizes)):
            if sizes[slot] > 2:
                column[slot], used = used, used + 1
        for slot in range(len(sizes)):
            if sizes[slot] != 2:
                continue
            fitting = (i for i, b in enumerate(bundles) if len(b) < MOST_BINS - 1 and not together[slot, b].any())
            at = next(fitting, len(bundles))
            if at == len(bundles):
                bundles.append([])
            bundles[at].append(slot)
            column[slot], place[slot] = used + at, len(bundles[at])
        return cls(list(sizes), column, place)

    @property
    def columns(self) -> int:
        return max(self.column, default=-1) + 1

    def coded(self, bins: np.ndarray) -> np.ndarray:
        """A (columns, rows) array of codes from a (rows, slots) array of bins."""
        codes = np.zeros((self.columns, len(bins)), np.uint8)
        for slot, size in enumerate(self.sizes):
            if size > 1:
                codes[self.column[slot]] += bins[:, slot] if size > 2 else bins[:, slot] * np.uint8(self.place[slot])
        return codes

    def leaves(self, tree: Tree, codes: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The node that each row reaches, of all rows or of some."""
        n = codes.shape[1]
        rows = np.arange(n) if rows is None else rows
        slot, cut, own = np.array(tree.slot, np.int64), np.array(tree.bin, np.int64), np.arange(len(tree.slot))
        height = [0] * len(own)
        for node in np.flatnonzero(slot >= 0):
            height[tree.left[node]] = height[tree.right[node]] = height[node] + 1
        if max(height) == 0:
            return np.zeros(len(rows), np.int64)
        leaf, slot = slot < 0, np.maximum(slot, 0)
        place, wide = np.array(self.place).take(slot), np.array(self.sizes).take(slot) > 2
        low, high = np.where(wide, cut + 1, place)[:, None], np.where(wide, MOST_BINS, place)[:, None]
        code = np.arange(MOST_BINS)
        # A leaf leads to itself, so all rows take the same steps.
        right, left = np.where(leaf, own, tree.right)[:, None], np.where(leaf, own, tree.left)[:, None]
        following = np.where((code >= low) & (code <= high), right, left).ravel()
        start = np.where(leaf, 0, np.array(self.column).take(slot) * n)
        flat, at = codes.ravel(), np.zeros(len(rows), np.int64)
        for _ in range(max(height)):
            step = start.take(at)
            step += rows
            at *= MOST_BINS
            at += flat.take(step)
            at = following.take(at)
        return at

    def moved(self, margin: np.ndarray, codes: np.ndarray, trees: Sequence[Tree], rows: np.ndarray | None = None) -> np.ndarray:
        for tree in trees:
            margin += np.array(tree.value).take(self.leaves(tree, codes, rows))
        return margin


STATE = "id binary, label binary, train binary, bins binary, margins binary"


class BoostingRun:
    """Models that grow in the same jobs over one stored table of bin numbers.

    A round of a model takes one job per level of its tree, and no model waits for another's: a job holds the level that
    each of them has come to, so there are as many as the longest-growing model has levels. Tasks add gradients and
    Hessians into histograms of all nodes that all models have at that level. If these are few the driver sums them, in
    the tasks' order; else Spark brings the rows of a node together, which are as many as there are tasks, sums them in
    the same order and returns the best split. The driver holds trees and histograms of a bounded size only. Rows lie in
    blocks, an array for each column. Once there is a new tree for each model growing, a job applies them to the rows'
    margins, which executors keep for the next ones, for the models growing only; every few times they are stored.
    """

    def __init__(
        self, vectors: DataFrame, settings: Sequence[Boosting], key: str, label: str, vector: str, train: str,
        positive_weight: float = 1.0, seed: int = 42, patience: int | None = None,
    ):
        spark = vectors.sparkSession
        self.settings, self.seed, self.patience = list(settings), seed, patience
        rows = vectors.where(train)
        self.cuts = cuts = cut_points(rows, vector)
        weight = F.when(F.col(label) == 1, float(positive_weight)).otherwise(1.0)
        sums = vectors.agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.when(F.col(train), weight)).alias("w"),
            F.sum(F.when(F.col(train), weight * F.col(label))).alias("y")).first()
        share = min(max((sums["y"] or 0.0) / (sums["w"] or 1.0), 1e-6), 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        self.positive_weight = float(positive_weight)

        def to_bins(batches):
            for batch in batches:
                x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], _packed(binned(x, cuts))], names=["id", "label", "train", "bins"])

        plain = vectors.select(
            F.xxhash64(F.col(key).cast("string")).alias("id"), F.col(label).cast("double").alias("label"),
            F.coalesce(F.col(train).cast("boolean"), F.lit(False)).alias("train"), F.col(vector).alias("x"))
        # Larger tables round gradients to a grid on which all sums are exact, so they do not depend on how rows are dealt.
        few = sums["rows"] <= spark.sparkContext.defaultParallelism * MOST_TASK_ROWS
        parts = task_count(spark, sums["rows"]) if few else even_task_count(spark, sums["rows"], TASK_ROWS)
        coded = plain.mapInArrow(to_bins, "id bigint, label double, train boolean, bins binary")
        dealt = checkpointed(coded.repartition(parts, "id").sortWithinPartitions("id"))
        self.layout = layout = Layout.of(self._sizes(), _together(dealt, len(cuts)))
        block_rows = BLOCK_ROWS

        def to_blocks(batches):
            for ids, y, train, bins in _blocks(batches, len(cuts), block_rows):
                block = _block(ids, y, train, layout.coded(bins), [])
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary()) for part in block], names=["id", "label", "train", "bins", "margins"])

        self.state = checkpointed(dealt.mapInArrow(to_blocks, STATE))
        self.unit = None if few else 2.0 ** (np.ceil(np.log2(max(sums["w"] or 0.0, 1.0))) - 51)
        # Sums of the nodes of the last level, if the driver had them and they are exact.
        self.sums: dict[tuple[int, int], np.ndarray] = {}
        self.spark, self.parts = spark, parts
        self.kept: list[RDD] = []
        self.trees: list[list[Tree]] = [[] for _ in self.settings]
        # Models whose margins the rows have, and how many trees are in them.
        self.carried: list[int] = []
        self.settled = [0] * len(self.settings)
        self.blocks = self.state.rdd
        self.stored = self.blocks, self.carried, self.settled
        self.losses: list[tuple[int, int, float, float]] = []
        self.best: list[tuple[float, int]] = [(np.inf, 0)] * len(self.settings)
        self.stopped = [False] * len(self.settings)

    def _pending(self) -> list[list[Tree]]:
        return [trees[n:] for trees, n in zip(self.trees, self.settled)]

    def _frames(self):
        """A function for tasks: blocks of the state as (ids, labels, weights, train, codes, a model's margins without pending trees)."""
        columns, carried, start, positive = self.layout.columns, {t: i for i, t in enumerate(self.carried)}, self.start, self.positive_weight

        def frames(blocks):
            for block in blocks:
                ids, y, train, codes, margins = (np.frombuffer(part, t) for part, t in zip(block, _KINDS))
                margins = margins.reshape(-1, len(ids))

                def margin(trial, margins=margins, n=len(ids)):
                    return margins[carried[trial]] if trial in carried else np.full(n, start)

                yield ids, y, np.where(y == 1, positive, 1.0), train, codes.reshape(columns, len(ids)), margin

        return frames

    def _columns(self, trial: int, round_: int) -> np.ndarray:
        count = max(1, int(np.ceil(self.settings[trial].column_share * len(self.cuts))))
        draw = np.random.default_rng([self.seed, trial, round_])
        return np.sort(draw.permutation(len(self.cuts))[:count])

    def _summed(self, wanted: list[tuple[int, int]], growing: dict[int, Tree], measure: list[int]) -> list[dict]:
        """Best splits of the (trial, node) pairs, and losses (node -1) of the models to be measured."""
        pending, settings, seed, layout, frames = self._pending(), self.settings, self.seed, self.layout, self._frames()
        sizes, unit = self._sizes(), self.unit
        rounds = [len(t) for t in self.trees]
        columns = {trial: self._columns(trial, rounds[trial]) for trial in sorted({t for t, _ in wanted})}
        cells = {trial: int(sum(sizes[c] for c in cs)) for trial, cs in columns.items()}
        # Where sums are exact, a node's are its parent's less its sibling's: rows of the larger one need not be added.
        above, rest = self.sums, self._rest(wanted, growing)
        nodes: dict[int, list[int]] = {}
        for trial, node in wanted:
            if (trial, node) not in rest:
                nodes.setdefault(trial, []).append(node)
        direct = 16 * sum(len(n) * cells[trial] for trial, n in nodes.items()) * self.parts <= DRIVER_BYTES
        if not direct:
            nodes, rest = {trial: [n for t, n in wanted if t == trial] for trial in columns}, {}
        live = sorted({*nodes, *measure})

        def added(blocks):
            sums = {trial: np.zeros((len(n), 2, cells[trial])) for trial, n in nodes.items()}
            losses = {trial: np.zeros(4) for trial in measure}
            # By trial: histograms of the codes of each column that is asked for, and the sums of all rows of a node.
            asked = {trial: sorted({layout.column[c] for c in cs if sizes[c] > 1}) for trial, cs in columns.items()}
            histograms = {trial: np.zeros((2, len(asked[trial]), len(n) * MOST_BINS)) for trial, n in nodes.items()}
            totals = {trial: np.zeros((2, len(n))) for trial, n in nodes.items()}
            for ids, y, w, train, codes, margin in frames(blocks):
                training = np.flatnonzero(train)
                keys = ids[training]
                for trial in live:
                    if trial in losses:
                        whole = layout.moved(margin(trial).copy(), codes, pending[trial])
                        loss = w * (np.logaddexp(0, whole) - y * whole)
                        losses[trial] += [loss[train].sum(), w[train].sum(), loss[~train].sum(), w[~train].sum()]
                    if trial not in nodes:
                        continue
                    how, count = settings[trial], len(nodes[trial])
                    rows = training if how.row_share >= 1 else training[_unit(keys, seed, trial, rounds[trial]) < how.row_share]
                    if len(growing[trial].slot) > 1:
                        place = np.full(len(growing[trial].slot), -1)
                        place[nodes[trial]] = np.arange(count)
                        at = place.take(layout.leaves(growing[trial], codes, rows))
                        inside = np.flatnonzero(at >= 0)
                        rows, at = rows.take(inside), at.take(inside)
                    else:
                        at = np.zeros(len(rows), np.int64)
                    own = whole.take(rows) if trial in losses else layout.moved(margin(trial).take(rows), codes, pending[trial], rows)
                    weights, p = w.take(rows), 1 / (1 + np.exp(-own))
                    parts = [weights * (p - y.take(rows)), weights * p * (1 - p)]
                    if unit:
                        parts = [np.rint(v / unit) * unit for v in parts]
                    first = at * MOST_BINS
                    for k in range(2):
                        totals[trial][k] += np.bincount(at, parts[k], count)
                    for i, column in enumerate(asked[trial]):
                        cell = first + codes[column].take(rows)
                        for k in range(2):
                            histograms[trial][k, i] += np.bincount(cell, parts[k], count * MOST_BINS)
            for trial, n in nodes.items():
                start = 0
                for slot in columns[trial]:
                    size = sizes[slot]
                    for k in range(2):
                        into, whole = sums[trial][:, k, start : start + size], totals[trial][k]
                        if size > 1:
                            found = histograms[trial][k, asked[trial].index(layout.column[slot])].reshape(len(n), MOST_BINS)
                        if size > 2:
                            into[:] = found[:, :size]
                        elif size == 2:
                            into[:, 1] = found[:, layout.place[slot]]
                            into[:, 0] = whole - into[:, 1]
                        else:
                            into[:, 0] = whole
                    start += size
            part = TaskContext.get().partitionId()
            made = [(trial, node, part, sums[trial][i].tobytes()) for trial, n in nodes.items() for i, node in enumerate(n)]
            return made + [(trial, -1, part, total.tobytes()) for trial, total in losses.items()]

        def splits_of(trial: int, found: list[int], total: np.ndarray) -> list[tuple]:
            """Of nodes of one trial, from their (nodes, 2, cells) histograms."""
            which = [sizes[c] for c in columns[trial]]
            ends = np.cumsum(which)
            first = total[:, :, : ends[0]].cumsum(axis=2)[:, :, -1]
            best = [np.full(len(found), -1), np.full(len(found), -1), *np.zeros((3, len(found)))]
            for kind in (lambda size: size > 2, lambda size: size == 2):
                own = [i for i, size in enumerate(which) if kind(size)]
                if not own:
                    continue
                histogram = np.zeros((len(found), len(own), max(which[i] for i in own), 2))
                for k, i in enumerate(own):
                    histogram[:, k, : which[i]] = total[:, :, ends[i] - which[i] : ends[i]].transpose(0, 2, 1)
                column, *rest = best_splits(histogram, settings[trial])
                slot = np.where(column >= 0, columns[trial][own].take(np.maximum(column, 0)), -1)
                # Equal gains go to the first slot.
                better = (slot >= 0) & ((best[0] < 0) | (rest[1] > best[2]) | ((rest[1] == best[2]) & (slot < best[0])))
                best = [np.where(better, new, old) for new, old in zip((slot, *rest), best)]
            slot, cut, gain, left_g, left_h = best
            return list(zip([trial] * len(found), found, slot.tolist(), cut.tolist(), gain.tolist(), *first.T.tolist(), left_g.tolist(), left_h.tolist()))

        def made_of(rows: list[tuple[int, int, np.ndarray]]) -> list[tuple]:
            """Splits and losses of summed rows (trial, node, sums)."""
            made: list[tuple] = []
            groups: dict[int, list[tuple[int, np.ndarray]]] = {}
            for trial, node, total in rows:
                if node < 0:
                    train, validation = total[0] / max(total[1], 1e-300), total[2] / max(total[3], 1e-300)
                    made.append((trial, -1, -1, -1, 0.0, float(train), float(validation), 0.0, 0.0))
                else:
                    groups.setdefault(trial, []).append((node, total))
            for trial, found in groups.items():
                made += splits_of(trial, [n for n, _ in found], np.stack([s for _, s in found]).reshape(len(found), 2, -1))
            return made

        def settled(batches):
            made, summed, size = [], [], 0
            for batch in batches:
                for trial, node, one in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                    if not summed or summed[-1][:2] != (trial, node):
                        if size > CELLS:
                            made, summed, size = made + made_of(summed), [], 0
                        summed.append((trial, node, 0.0 + np.frombuffer(one)))
                        size += len(one) // 16
                    else:
                        summed[-1][2][:] += np.frombuffer(one)
            made += made_of(summed)
            kinds = [pa.int32() if t == "int" else pa.float64() for t in _SPLIT.values()]
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(kinds)], names=list(_SPLIT))

        schema = ", ".join(f"{n} {t}" for n, t in _SPLIT.items())
        parts = self.blocks.mapPartitions(added)
        self.sums = {}
        if direct:
            rows, summed = sorted(parts.collect()), {}
            for trial, node, _, one in rows:
                summed[trial, node] = summed.get((trial, node), 0.0) + np.frombuffer(one)
            for (trial, node), (parent, sibling) in rest.items():
                summed[trial, node] = above[trial, parent] - summed[trial, sibling]
            if unit:
                self.sums = {key: total for key, total in summed.items() if key[1] >= 0}
            return [dict(zip(_SPLIT, row)) for row in made_of([(*key, total) for key, total in summed.items()])]
        table = self.spark.createDataFrame(parts, "trial int, node int, part int, sums binary", verifySchema=False)
        together = table.repartition("trial", "node").sortWithinPartitions("trial", "node", "part")
        return [r.asDict() for r in together.mapInArrow(settled, schema).collect()]

    def _rest(self, wanted: list[tuple[int, int]], growing: dict[int, Tree]) -> dict[tuple[int, int], tuple[int, int]]:
        """(trial, node) -> (parent, sibling) of the larger of two children that are wanted of a parent whose sums are there."""
        asked, rest = set(wanted), {}
        for trial, parent in self.sums:
            tree = growing.get(trial)
            if tree is None or parent >= len(tree.slot) or tree.slot[parent] < 0:
                continue
            small, large = sorted((tree.left[parent], tree.right[parent]), key=lambda n: tree.cover[n])
            if {(trial, small), (trial, large)} <= asked:
                rest[trial, large] = parent, small
        return rest

    def _sizes(self) -> list[int]:
        return [len(c) + 1 for c in self.cuts]

    def _level(self, wanted: list[tuple[int, int]], growing: dict[int, Tree], measure: list[int]) -> list[dict]:
        """``_summed`` in as many jobs as bounded histograms ask for."""
        size = max(1, CELLS // max(1, sum(self._sizes()), self.layout.columns * MOST_BINS))
        found: list[dict] = []
        for start in range(0, max(len(wanted), 1), size):
            if len(wanted) > size:
                self.sums = {}  # of some nodes only
            found += self._summed(wanted[start : start + size], growing, measure if not start else [])
        return found

    def _noted(self, found: list[dict]) -> None:
        for r in found:
            if r["node"] >= 0:
                continue
            trial, rounds = r["trial"], len(self.trees[r["trial"]])
            self.losses.append((trial, rounds, r["g"], r["h"]))
            if r["h"] < self.best[trial][0] - 1e-12:
                self.best[trial] = (r["h"], rounds)
            elif self.patience is not None and rounds - self.best[trial][1] >= self.patience:
                self.stopped[trial] = True

    def advance(self, upto: dict[int, int]) -> None:
        """Grow models to a number of rounds, from the trees they have; one without gain on validation rows stops early."""
        measured = {trial for trial, rounds, *_ in self.losses if rounds == len(self.trees[trial])}
        growing: dict[int, Tree] = {}
        wanted: dict[int, list[int]] = {}
        levels: dict[int, int] = {}
        self.sums = {}
        while True:
            for t, n in upto.items():
                if t not in growing and len(self.trees[t]) < n and not self.stopped[t]:
                    growing[t], levels[t] = Tree(), 0
                    wanted[t] = [growing[t].add(0.0, 0.0)]
            measure = [t for t in upto if t not in measured and not self.stopped[t]]
            if not growing and not measure:
                return self._release()
            pending, active = self._pending(), [t for t in upto if t in growing or t in measure]
            if sum(len(pending[t]) for t in active) >= max(1, len(growing)):
                self._move(active)
            found = self._level([(t, node) for t, nodes in wanted.items() for node in nodes], growing, measure)
            self._noted(found)
            measured.update(measure)
            wanted = {t: [] for t in growing}
            for r in sorted((r for r in found if r["node"] >= 0), key=lambda r: (r["trial"], r["node"])):
                trial, tree, node, how = r["trial"], growing[r["trial"]], r["node"], self.settings[r["trial"]]
                tree.value[node], tree.cover[node] = leaf_value(r["g"], r["h"], how), r["h"]
                if r["slot"] < 0:
                    continue
                tree.slot[node], tree.bin[node] = r["slot"], r["bin"]
                g, h = r["left_g"], r["left_h"]
                tree.left[node] = tree.add(leaf_value(g, h, how), h)
                tree.right[node] = tree.add(leaf_value(r["g"] - g, r["h"] - h, how), r["h"] - h)
                if levels[trial] + 1 < how.depth:
                    wanted[trial] += [tree.left[node], tree.right[node]]
            for t in list(growing):
                levels[t] += 1
                if self.stopped[t]:
                    del growing[t], wanted[t]
                elif not wanted[t]:
                    self.trees[t].append(growing.pop(t))
                    measured.discard(t)
                    del wanted[t]

    def _with_all_trees(self, models: list[int]) -> RDD:
        """Blocks with the margins of some models after all their trees."""
        pending, layout, frames = self._pending(), self.layout, self._frames()

        def run(blocks):
            for ids, y, _, train, codes, margin in frames(blocks):
                yield _block(ids, y, train, codes, [layout.moved(margin(t).copy(), codes, pending[t]) for t in models])

        return self.blocks.mapPartitions(run, preservesPartitioning=True)

    def _carry(self, models: list[int]) -> None:
        self.carried, self.settled = models, [len(trees) if t in models else 0 for t, trees in enumerate(self.trees)]

    def _move(self, models: list[int]) -> None:
        """Have the next job apply the trees since the last call, and keep the rows it makes for the jobs after it."""
        if len(self.kept) >= SETTLE:
            return self.settle(models)
        if len(self.kept) > 1:
            self.kept[-2].unpersist()  # the rows made from it are kept by now
        self.blocks = self._with_all_trees(models).persist(StorageLevel.MEMORY_AND_DISK)
        self.kept.append(self.blocks)
        self._carry(models)

    def settle(self, models: Sequence[int] | None = None) -> None:
        """Store the rows with all trees so far in their margins, of some models or of all."""
        models = list(range(len(self.settings)) if models is None else models)
        self.state = checkpointed(self.spark.createDataFrame(self._with_all_trees(models), STATE, verifySchema=False))
        self._carry(models)
        self.stored = self.state.rdd, self.carried, self.settled
        self._release()

    def _release(self) -> None:
        """Go back to the rows last stored; trees since then count as not yet in their margins."""
        for rows in self.kept:
            rows.unpersist()
        self.kept = []
        self.blocks, self.carried, self.settled = self.stored

    def scores(self, trials: Sequence[int]) -> DataFrame:
        """(trial, label, probability) of the validation rows for some models, each as ``model`` returns it."""
        pending, layout, frames = self._pending(), self.layout, self._frames()
        surplus = {t: self.trees[t][self.best[t][1] :] if self.patience is not None else [] for t in trials}

        def run(batches):
            blocks = (tuple(batch.column(i)[row].as_buffer() for i in range(len(_KINDS))) for batch in batches for row in range(batch.num_rows))
            for _, y, _, train, codes, margin in frames(blocks):
                rows = np.flatnonzero(~train)
                for trial in trials:
                    whole = layout.moved(margin(trial).take(rows), codes, pending[trial], rows)
                    whole = whole - layout.moved(np.zeros(len(rows)), codes, surplus[trial], rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(whole), trial, np.int32)), pa.array(y.take(rows).astype(np.int32)), pa.array(1 / (1 + np.exp(-whole)))],
                        names=["trial", "label", "probability"])

        return self.state.mapInArrow(run, "trial int, label int, probability double")

    def model(self, trial: int) -> Boosted:
        """The model up to its best round where rounds were measured for stopping, else whole."""
        rounds = self.best[trial][1] if self.patience is not None else len(self.trees[trial])
        return Boosted(self.trees[trial][:rounds], self.cuts, self.start, self.settings[trial])


_SPLIT = {
    "trial": "int", "node": "int", "slot": "int", "bin": "int", "gain": "double", "g": "double", "h": "double",
    "left_g": "double", "left_h": "double",
}
_KINDS = (np.int64, np.float64, np.bool_, np.uint8, np.float64)


def _block(ids: np.ndarray, y: np.ndarray, train: np.ndarray, codes: np.ndarray, margins: Sequence[np.ndarray]) -> tuple[bytes, ...]:
    """Arrays of some rows as one row of the state."""
    return tuple(np.ascontiguousarray(p).tobytes() for p in (ids, y, train, codes, np.concatenate(margins) if margins else np.empty(0)))


def _blocks(batches, slots: int, size: int):
    """(ids, labels, train, bins) of rows in blocks of a size."""
    held, count = [], 0
    for batch in batches:
        ids, y, train = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        bins = _unpacked(batch.column(3)).reshape(batch.num_rows, slots)
        held, count = [*held, (ids, y, train.astype(bool), bins)], count + batch.num_rows
        while count >= size:
            whole = [np.concatenate(parts) for parts in zip(*held)]
            yield [v[:size] for v in whole]
            held, count = [[v[size:] for v in whole]], count - size
    if count:
        yield [np.concatenate(parts) for parts in zip(*held)]


def _together(rows: DataFrame, slots: int) -> np.ndarray:
    """For each two slots, whether a row is above the first bins of both."""
    def seen(batches):
        found = np.zeros((slots, slots))
        for batch in batches:
            upper = (_unpacked(batch.column(0)).reshape(-1, slots) > 0).astype(np.float32)
            found += upper.T @ upper > 0
        yield pa.RecordBatch.from_arrays([pa.array([(found > 0).tobytes()], pa.binary())], names=["found"])

    parts = rows.select("bins").mapInArrow(seen, "found binary").collect()  # one row a task
    return np.any([np.frombuffer(r["found"], np.bool_).reshape(slots, slots) for r in parts], axis=0)


def _packed(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    n, width = len(matrix), matrix.shape[1] * matrix.itemsize
    ends = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix))])


def _unpacked(column: pa.Array) -> np.ndarray:
    """The bytes of all values of a binary column, one after another."""
    if not len(column):
        return np.empty(0, np.uint8)
    ends = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].copy() if data is not None else np.empty(0, np.uint8)


def parameters(how: Boosting) -> dict[str, float]:
    return {name: float(value) for name, value in asdict(how).items()}
