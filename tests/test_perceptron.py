"""The weighted perceptron: gradients by differences, weights as repeated rows, early stopping and the stored stage."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tenura.operators import modeling
from tenura.operators.perceptron import (
    Losses, Perceptron, PerceptronModel, first_weights, fit_perceptron, lbfgs_direction, loss_and_gradient, margins, minimised,
)

SCHEMA = "key string, label double, weight double, x array<double>"


def rows(n=160, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 4))
    y = ((x[:, 0] * x[:, 1] > 0) | (x[:, 2] > 1)).astype(float)
    return x, y, 1.0 + np.arange(n) % 3


def table(spark, x, y, w, name="k"):
    return spark.createDataFrame([(f"{name}{i}", float(a), float(b), [float(v) for v in r]) for i, (r, a, b) in enumerate(zip(x, y, w))], SCHEMA)


def test_gradient_by_differences():
    x, y, w = rows(30)
    layers = [4, 6, 5, 1]
    theta = first_weights(layers, 3) + 0.01
    loss, gradient = loss_and_gradient(theta, layers, x, y, w)
    for i in range(0, len(theta), 5):
        moved = np.zeros_like(theta)
        moved[i] = 1e-6
        up, down = (loss_and_gradient(theta + s * moved, layers, x, y, w)[0] for s in (1, -1))
        assert (up - down) / 2e-6 == pytest.approx(gradient[i], rel=1e-4, abs=1e-5)
    double = loss_and_gradient(theta, layers, np.concatenate([x, x]), np.concatenate([y, y]), np.concatenate([w, w]))
    assert double[0] == pytest.approx(2 * loss) and np.allclose(double[1], 2 * gradient)


def test_a_weight_counts_as_repeated_rows(spark):
    x, y, w = rows()
    how, layers = Perceptron(hidden=(5,), held=0.2), [4, 5, 1]
    weighted = Losses(table(spark, x, y, w), "key", "label", "weight", "x", how, layers)
    times = w.astype(int)
    again = table(spark, np.repeat(x, times, axis=0), np.repeat(y, times), np.ones(times.sum()))
    keys = np.repeat(np.arange(len(x)), times)
    again = again.withColumn("key", F.concat(F.lit("k"), F.element_at(F.array(*[F.lit(int(k)) for k in keys]), F.substring("key", 2, 9).cast("int") + 1)))
    repeated = Losses(again, "key", "label", "weight", "x", how, layers)
    theta = first_weights(layers, 7)
    one, two = weighted(theta), repeated(theta)
    assert one[0] == pytest.approx(two[0]) and np.allclose(one[1], two[1]) and one[2] == pytest.approx(two[2])


def test_distributed_sums_equal_one_pass(spark, monkeypatch):
    x, y, w = rows()
    how, layers = Perceptron(hidden=(5, 3), held=0.0, penalty=0.0), [4, 5, 3, 1]
    monkeypatch.setattr("tenura.operators.perceptron.PARTITION_ROWS", 7)
    theta = first_weights(layers, 7)
    loss, gradient, held = Losses(table(spark, x, y, w), "key", "label", "weight", "x", how, layers)(theta)
    expected = loss_and_gradient(theta, layers, x, y, w)
    assert loss == held == pytest.approx(expected[0] / w.sum()) and np.allclose(gradient, expected[1] / w.sum())


def test_quadratic_minimum():
    matrix = np.diag([1.0, 10.0, 100.0])
    target = np.array([1.0, -2.0, 3.0])

    def objective(theta):
        gap = theta - target
        value = 0.5 * gap @ matrix @ gap
        return value, matrix @ gap, value

    theta, history = minimised(objective, np.zeros(3), Perceptron(rounds=60))
    assert np.allclose(theta, target, atol=1e-3) and history[-1][0] < 1e-6
    assert lbfgs_direction(np.array([1.0, 2.0]), []).tolist() == [-1.0, -2.0]


def test_fit_learns_and_is_stored(spark, tmp_path):
    x, y, w = rows(300, 5)
    df = table(spark, x, y, w)
    stage, history = fit_perceptron(df, "key", "label", "weight", "x", 4, Perceptron(hidden=(16, 8), rounds=120))
    assert history[-1][0] < 0.6 * history[0][0] and all(b[0] <= a[0] + 1e-12 for a, b in zip(history, history[1:]))
    vectors = df.withColumn("features", array_to_vector("x"))
    PipelineModel(stages=[stage]).save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model").stages[0]
    assert isinstance(again, PerceptronModel)
    found = {r.key: r.p for r in again.transform(vectors).select("key", vector_to_array("probability")[1].alias("p")).collect()}
    expected = 1 / (1 + np.exp(-margins(np.array(stage.getOrDefault("weights")), stage.getOrDefault("layers"), x)))
    assert np.allclose([found[f"k{i}"] for i in range(len(x))], expected)
    assert (np.array([found[f"k{i}"] for i in range(len(x))]) > 0.5).__eq__(y > 0.5).mean() > 0.8


def test_pipeline_from_raw_features(spark):
    df = spark.range(200).selectExpr(
        "cast(id as string) msno", "cast(id % 2 as int) is_churn", "cast(id % 2 * 3 + id % 5 as int) bd", "if(id % 3 = 0, 'male', null) gender")
    model = modeling.fit(df, ["bd", "gender"], modeling.PERCEPTRON, hidden=(8,), rounds=60)
    scored = modeling.with_probability(model, df)
    assert scored.columns == [*df.columns, "probability"]
    means = {r.is_churn: r.p for r in scored.groupBy("is_churn").agg(F.avg("probability").alias("p")).collect()}
    assert means[1] > means[0] + 0.3
