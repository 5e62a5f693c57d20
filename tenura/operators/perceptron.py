"""A perceptron with weighted rows: loss and gradient are summed in the tasks, the driver holds the weights only."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.session import checkpointed

# Rows of a partition and of a step, and groups in which the partial sums of all tasks meet before the driver.
PARTITION_ROWS = 50_000
STEP_ROWS = 4_096
GROUPS = 16


@dataclass(frozen=True)
class Perceptron:
    """Hidden layers with rectifiers and one logistic output; ``penalty`` is on half the squared weights per unit of weight.

    The share ``held`` of the rows, by a hash of the key, is not learned from: training ends when their loss has not
    fallen for ``patience`` rounds, and the weights of the best round are kept.
    """

    hidden: tuple[int, ...] = (128, 64, 32)
    rounds: int = 500
    penalty: float = 1e-4
    held: float = 0.1
    patience: int = 10
    memory: int = 10
    seed: int = 42


def unpacked(theta: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, offsets) of each layer, as views of one vector."""
    found, at = [], 0
    for below, above in zip(layers, layers[1:]):
        matrix = theta[at : at + below * above].reshape(below, above)
        at += below * above
        found.append((matrix, theta[at : at + above]))
        at += above
    return found


def first_weights(layers: Sequence[int], seed: int) -> np.ndarray:
    """Uniform weights in the range that suits rectifiers, no offsets."""
    draw = np.random.default_rng(seed)
    parts = []
    for below, above in zip(layers, layers[1:]):
        limit = np.sqrt(6.0 / (below + above))
        parts += [draw.uniform(-limit, limit, below * above), np.zeros(above)]
    return np.concatenate(parts)


def margins(theta: np.ndarray, layers: Sequence[int], x: np.ndarray) -> np.ndarray:
    steps = unpacked(theta, layers)
    for matrix, offset in steps[:-1]:
        x = np.maximum(x @ matrix + offset, 0.0)
    return (x @ steps[-1][0] + steps[-1][1])[:, 0]


def loss_and_gradient(theta: np.ndarray, layers: Sequence[int], x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed weighted logistic loss of some rows and its gradient, without the penalty."""
    steps = unpacked(theta, layers)
    seen = [x]
    for matrix, offset in steps[:-1]:
        seen.append(np.maximum(seen[-1] @ matrix + offset, 0.0))
    margin = (seen[-1] @ steps[-1][0] + steps[-1][1])[:, 0]
    loss = float((w * (np.logaddexp(0, margin) - y * margin)).sum())
    back = (w * (1 / (1 + np.exp(-margin)) - y))[:, None]
    parts: list[np.ndarray] = []
    for (matrix, _), below in zip(reversed(steps), reversed(seen)):
        parts = [(below.T @ back).ravel(), back.sum(axis=0), *parts]
        back = (back @ matrix.T) * (below > 0)
    return loss, np.concatenate(parts)


def lbfgs_direction(gradient: np.ndarray, pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The descent direction by the two loops over (step, change of gradient) pairs, the newest last."""
    q, alphas = gradient.copy(), []
    for s, y in reversed(pairs):
        alpha = (s @ q) / (y @ s)
        alphas.append(alpha)
        q -= alpha * y
    if pairs:
        s, y = pairs[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), alpha in zip(pairs, reversed(alphas)):
        q += (alpha - (y @ q) / (y @ s)) * s
    return -q


def minimised(
    objective: Callable[[np.ndarray], tuple[float, np.ndarray, float]], theta: np.ndarray, how: Perceptron
) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """The weights of the round with the least held-out loss, and (loss, held-out loss) of every round.

    ``objective`` gives the penalised mean loss, its gradient and the held-out loss. A step is halved until the loss falls
    enough; training also ends where no step does.
    """
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    value, gradient, held = objective(theta)
    best, history, since = (held, theta), [(value, held)], 0
    for _ in range(how.rounds):
        direction = lbfgs_direction(gradient, pairs)
        slope = gradient @ direction
        if slope >= 0:
            pairs, direction, slope = [], -gradient, -(gradient @ gradient)
        size = 1.0 if pairs else min(1.0, 1.0 / max(np.abs(gradient).sum(), 1e-12))
        for _ in range(25):
            moved = theta + size * direction
            after, next_gradient, next_held = objective(moved)
            if after <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        step, change = moved - theta, next_gradient - gradient
        if step @ change > 1e-12:
            pairs = [*pairs, (step, change)][-how.memory :]
        theta, value, gradient, held = moved, after, next_gradient, next_held
        history.append((value, held))
        since = since + 1 if held >= best[0] - 1e-6 else 0
        if held < best[0]:
            best = (held, theta)
        if since >= how.patience or np.abs(gradient).max() < 1e-6:
            break
    return best[1], history


class Losses:
    """The objective of ``minimised`` over a stored table of (label, weight, held, x): one job each time it is asked."""

    def __init__(self, rows: DataFrame, key: str, label: str, weight: str, vector: str, how: Perceptron, layers: Sequence[int]):
        self.how, self.layers = how, list(layers)
        unit = F.pmod(F.xxhash64(F.lit(how.seed), F.col(key).cast("string")), F.lit(1 << 40)) / float(1 << 40)
        plain = rows.select(
            F.xxhash64(F.col(key).cast("string")).alias("id"), F.col(label).cast("double").alias("label"),
            F.col(weight).cast("double").alias("weight"), (unit < how.held).alias("held"), F.col(vector).alias("x"))
        parts = max(1, -(-rows.count() // PARTITION_ROWS))
        self.rows = checkpointed(plain.repartition(parts, "id").sortWithinPartitions("id"))

    def __call__(self, theta: np.ndarray) -> tuple[float, np.ndarray, float]:
        layers = self.layers

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(4 + len(theta))
            for whole in batches:
                for start in range(0, whole.num_rows, STEP_ROWS):
                    batch = whole.slice(start, STEP_ROWS)
                    y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                    held = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
                    x = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, layers[0])
                    loss, gradient = loss_and_gradient(theta, layers, x[~held], y[~held], w[~held])
                    margin = margins(theta, layers, x[held])
                    held_loss = (w[held] * (np.logaddexp(0, margin) - y[held] * margin)).sum()
                    total[:4] += [loss, w[~held].sum(), held_loss, w[held].sum()]
                    total[4:] += gradient
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part % GROUPS], pa.int32()), pa.array([part], pa.int32()), pa.array([total.tobytes()])], names=["unit", "part", "sums"])

        def met(group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(s) for s in group.sort_values("part")["sums"])
            return pd.DataFrame({"unit": [group["unit"].iloc[0]], "sums": [total.tobytes()]})

        parts = self.rows.mapInArrow(added, "unit int, part int, sums binary")
        found = parts.groupBy("unit").applyInPandas(met, "unit int, sums binary").collect()  # at most GROUPS rows
        total = sum(np.frombuffer(bytes(r["sums"])) for r in sorted(found, key=lambda r: r["unit"]))
        weight = max(total[1], 1e-300)
        penalty = np.concatenate([
            np.concatenate([np.ones(b * a), np.zeros(a)]) for b, a in zip(layers, layers[1:])]) * self.how.penalty
        loss = total[0] / weight + 0.5 * float((penalty * theta * theta).sum())
        held = total[2] / total[3] if total[3] > 0 else loss
        return loss, total[4:] / weight + penalty * theta, held


class PerceptronModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A stage of a pipeline that adds ``probability``, a vector of both classes' probabilities."""

    layers = Param(Params._dummy(), "layers", "units of all layers", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "weights and offsets, layer by layer", TypeConverters.toListFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, layers=None, weights=None, featuresCol="features"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        layers, theta = self.getOrDefault("layers"), np.array(self.getOrDefault("weights"))

        @F.pandas_udf("double")
        def probability(vectors: pd.Series) -> pd.Series:
            x = np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, layers[0]))
            return pd.Series(1 / (1 + np.exp(-margins(theta, layers, x))))

        p = probability(vector_to_array(F.col(self.getOrDefault("featuresCol"))))
        scored = dataset.withColumn("_p", p)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))).drop("_p")


def fit_perceptron(
    rows: DataFrame, key: str, label: str, weight: str, vector: str, inputs: int, how: Perceptron = Perceptron(), features: str = "features"
) -> tuple[PerceptronModel, list[tuple[float, float]]]:
    """The fitted stage and the losses of its rounds, from an array column. A weight counts as that many equal rows."""
    layers = [inputs, *how.hidden, 1]
    objective = Losses(rows, key, label, weight, vector, how, layers)
    theta, history = minimised(objective, first_weights(layers, how.seed), how)
    return PerceptronModel(layers=layers, weights=theta.tolist(), featuresCol=features), history
