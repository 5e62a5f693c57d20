import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.operators.ordered import exact_quantiles, hash_positions, moments_of_counts, running_totals, value_counts

FRACTIONS = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]


def skewed(seed=7, n=900):
    """A third of the rows hold one value; the others spread over several magnitudes."""
    draw = np.random.default_rng(seed)
    values = np.exp(draw.normal(0, 3, n))
    values[: n // 3] = 2.5
    return values


@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_quantiles_equal_numpy_for_any_number_of_ranges(spark, ranges):
    frames = {"a": skewed(1), "b": skewed(2, 31), "c": np.array([4.0])}
    rows = [(k, float(v)) for k, vs in frames.items() for v in vs] + [("a", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    found = {r["k"]: r for r in exact_quantiles(df, "v", FRACTIONS, ["k"], ranges=ranges).collect()}
    for key, values in frames.items():
        assert found[key]["n"] == len(values)
        np.testing.assert_allclose(found[key]["quantiles"], np.quantile(values, FRACTIONS), rtol=1e-12)


def test_quantiles_without_keys_and_with_a_null_key(spark):
    values = skewed(3)
    df = spark.createDataFrame([(None, float(v)) for v in values], "k string, v double")
    for keys in ([], ["k"]):
        row = exact_quantiles(df, "v", FRACTIONS, keys).first()
        np.testing.assert_allclose(row["quantiles"], np.quantile(values, FRACTIONS), rtol=1e-12)


def test_narrow_types_use_the_built_in_aggregate(spark):
    df = spark.range(101).select(F.col("id").cast("smallint").alias("v"))
    result = exact_quantiles(df, "v", [0.5, 0.25])
    assert "percentile" in result._jdf.queryExecution().toString()
    assert result.first()["quantiles"] == [50.0, 25.0]


def test_running_totals_cross_ranges(spark):
    values = skewed(4)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = running_totals(value_counts(df, [], "v"), [], "v", ["n"], ranges=9).orderBy("v").collect()
    expected, counts = np.unique(values, return_counts=True)
    np.testing.assert_allclose([r["v"] for r in rows], expected)
    assert [r["n_cum"] for r in rows] == list(np.cumsum(counts))


def test_moments_of_counts(spark):
    values = skewed(5)
    counts = value_counts(spark.createDataFrame([("x", float(v)) for v in values], "k string, v double"), ["k"], "v")
    row = moments_of_counts(counts, "v", ["k"]).first()
    assert row["count"] == len(values)
    np.testing.assert_allclose([row["mean"], row["variance"]], [values.mean(), values.var(ddof=1)], rtol=1e-9)


def test_hash_positions_are_a_permutation_that_ignores_partitioning(spark):
    df = spark.range(500)
    one = {r["id"]: r["p"] for r in hash_positions(df.repartition(3), "id", "s", "p").collect()}
    two = {r["id"]: r["p"] for r in hash_positions(df.repartition(11), "id", "s", "p").collect()}
    other = {r["id"]: r["p"] for r in hash_positions(df, "id", "t", "p").collect()}
    assert one == two != other
    assert sorted(one.values()) == list(range(500))
