"""Per-customer attributions: sample customers, top attributions, linear and sampling Shapley values."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.ordered import exact_quantiles, hash_positions
from tenura.session import checkpointed


def tier_samples(latest: DataFrame) -> DataFrame:
    """One customer per tier: the highest High, the lowest Low and the Medium nearest to that tier's median.

    Ties go to the lowest customer_id; a tier without customers has no row.
    """
    latest = checkpointed(latest.select("customer_id", "risk_tier", "churn_probability"))
    medians = exact_quantiles(latest, "churn_probability", [0.5], keys=["risk_tier"])
    medians = F.broadcast(medians.select("risk_tier", F.col("quantiles")[0].alias("_median")))  # one row per tier
    p = F.col("churn_probability").cast("double")
    distance = F.when(F.col("risk_tier") == "High", -p).when(F.col("risk_tier") == "Low", p).otherwise(
        F.round(F.abs(p - F.col("_median")), 9)
    )
    chosen = F.min(F.struct(distance.alias("distance"), "customer_id", "churn_probability")).alias("s")
    return (
        latest.where(F.col("risk_tier").isin("High", "Medium", "Low"))
        .join(medians, "risk_tier")
        .groupBy("risk_tier")
        .agg(chosen)
        .select(F.lower("risk_tier").alias("tier"), "s.customer_id", "s.churn_probability")
    )


def top_attributions(attributions: Column | str, k: int = 5, digits: int = 6) -> Column:
    """The ``k`` entries of largest absolute value of an array of (feature, shap_value), rounded."""
    column = F.col(attributions) if isinstance(attributions, str) else attributions
    keyed = F.transform(column, lambda e, i: F.struct(
        (-F.abs(e["shap_value"])).alias("order"), i.alias("position"), e["feature"].alias("feature"),
        e["shap_value"].alias("shap_value"),
    ))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda e: F.struct(
        e["feature"].alias("feature"), F.bround(e["shap_value"], digits).alias("shap_value")
    ))


def linear_attributions(
    df: DataFrame, key: str, vector: str, coefficients: Sequence[float], means: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """coefficient * (x - mean) of every slot of an array column: one array of (feature, shap_value) per row."""
    parts = F.array(*[
        F.struct(F.lit(n).alias("feature"), F.lit(float(c)).alias("c"), F.lit(float(m)).alias("m"))
        for n, c, m in zip(names, coefficients, means)
    ])
    values = F.zip_with(parts, F.col(vector), lambda p, x: F.struct(
        p["feature"].alias("feature"), (p["c"] * (x - p["m"])).alias("shap_value")
    ))
    return df.select(key, values.alias("attributions"))


def sum_to_features(attributions: Column | str, slots: Mapping[str, Sequence[str]]) -> Column:
    """Sum the attributions of encoded slots back to the raw feature each came from."""
    column = F.col(attributions) if isinstance(attributions, str) else attributions

    def total(feature: str, members: Sequence[str]) -> Column:
        mine = F.filter(column, lambda e: e["feature"].isin(list(members)))
        value = F.aggregate(mine, F.lit(0.0), lambda acc, e: acc + e["shap_value"])
        return F.struct(F.lit(feature).alias("feature"), value.alias("shap_value"))

    return F.array(*[total(f, m) for f, m in slots.items()])


def global_importance(df: DataFrame, attributions: str = "attributions") -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    entries = df.select(F.inline(attributions))
    return (
        entries.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("mean_abs_attribution"))
        .orderBy(F.col("mean_abs_attribution").desc(), "feature")
    )


@dataclass(frozen=True)
class AdditiveScore:
    """A score whose log-odds are ``start`` plus one term per raw feature.

    ``score`` adds ``probability`` to a frame with the features; ``terms`` gives (key, ``into``) with the array of terms
    in the features' order.
    """

    score: Callable[[DataFrame], DataFrame]
    terms: Callable[[DataFrame, str, str], DataFrame]
    start: float

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.score(df)


def array_rows(column: pa.Array, width: int) -> np.ndarray:
    """The arrays of a column, all of one width, as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def row_arrays(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as arrays."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]), pa.array(matrix.ravel()))


def _switched_terms(steps: DataFrame, key: str, n: int, start: float, permutations: int) -> DataFrame:
    """(key, base, probability, v) of rows with own terms ``x``, donor terms ``b`` and a ``turn``: means over the orders."""

    def run(batches):
        for batch in batches:
            own, other = array_rows(batch.column(1), n), array_rows(batch.column(2), n)
            turn = array_rows(batch.column(3), n).astype(np.int64)
            margin = np.empty((len(own), n + 1))
            margin[:, 0] = start + other.sum(axis=1)
            margin[:, 1:] = margin[:, :1] + np.take_along_axis(own - other, turn, axis=1).cumsum(axis=1)
            p = 1 / (1 + np.exp(-margin))
            values = np.empty((len(own), n))
            np.put_along_axis(values, turn, np.diff(p, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p[:, 0]), pa.array(p[:, n]), row_arrays(values)], names=[key, "base", "probability", "v"])

    kind = steps.schema[key].dataType.simpleString()
    walked = steps.select(key, "x", "b", "turn").mapInArrow(run, f"`{key}` {kind}, base double, probability double, v array<double>")
    names = [f"_v{i}" for i in range(n)]
    sums = walked.groupBy(key).agg(
        *[(F.sum(c) / permutations).alias(c) for c in ("base", "probability")],
        *[(F.sum(F.col("v")[i]) / permutations).alias(name) for i, name in enumerate(names)])
    return sums.select(key, "base", "probability", F.array(*names).alias("v"))


def sampling_shapley(
    rows: DataFrame,
    background: DataFrame,
    key: str,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    permutations: int = 8,
    seed: int = 42,
    background_key: str | None = None,
) -> DataFrame:
    """Shapley values by sampled feature orders, on raw features: one array of (feature, shap_value) per row.

    For each row and order, features switch one by one from a background row's values to the row's own. ``score`` adds a
    ``probability`` column to a frame with the features. The steps telescope, so ``base`` plus the values is the row's own
    prediction. Orders and background rows depend only on the keys and the seed: background rows are numbered in the hash
    order of their key, and each row and order draws one number of the whole background, so a value that most
    background rows hold is drawn as often.

    With an ``AdditiveScore`` rows and donors are encoded once, and every step of an order is scored by the term that
    switches.
    """
    features, n = list(features), len(features)
    packed = F.struct(*[F.col(f) for f in features])
    additive = isinstance(score, AdditiveScore)

    def with_values(df: DataFrame, df_key: str, into: str) -> DataFrame:
        return score.terms(df, df_key, into) if additive else df.select(df_key, packed.alias(into))

    donors = checkpointed(
        hash_positions(
            with_values(background, background_key or key, "b").withColumnRenamed(background_key or key, "_donor"), "_donor", f"background:{seed}", "_position")
        .drop("_donor")
    )
    size = donors.count()
    if not size:
        raise ValueError("the background has no rows")
    draw = F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col("order"))
    order = F.transform(
        F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.struct(
            F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col("order"), j).alias("h"), j.alias("j")))),
        lambda s: s["j"],
    )
    steps = (
        with_values(rows, key, "x").withColumn("order", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
        .withColumn("_position", F.pmod(draw, F.lit(size)))
        .join(donors, "_position")
        .drop("_position")
        .withColumn("turn", order)
    )
    if additive:
        values = F.array(*[F.struct(F.lit(f).alias("feature"), F.col("v")[i].alias("shap_value")) for i, f in enumerate(features)])
        return _switched_terms(steps, key, n, score.start, permutations).select(key, "base", "probability", values.alias("attributions"))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n))))

    def mixed(i: int, name: str) -> Column:
        switched = F.array_position("turn", F.lit(i)) <= F.col("step")
        return F.when(switched, F.col(f"x.{name}")).otherwise(F.col(f"b.{name}")).alias(name)

    frame = steps.select(key, "order", "turn", "step", *[mixed(i, f) for i, f in enumerate(features)])
    scored = score(frame)
    # Step s adds its score to the feature switched at s and takes it from the one switched next.
    terms = F.array_compact(F.array(
        F.when(F.col("step") > 0, F.struct(F.try_element_at("turn", F.col("step")).alias("i"), F.col("probability").alias("v"))),
        F.when(F.col("step") < n, F.struct(F.try_element_at("turn", F.col("step") + 1).alias("i"), (-F.col("probability")).alias("v"))),
        F.when(F.col("step") == 0, F.struct(F.lit(-1).alias("i"), F.col("probability").alias("v"))),
        F.when(F.col("step") == n, F.struct(F.lit(-2).alias("i"), F.col("probability").alias("v"))),
    ))
    sums = scored.select(key, F.inline(terms)).groupBy(key, "i").agg((F.sum("v") / permutations).alias("v"))
    by_slot = sums.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m"))
    values = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.coalesce(F.try_element_at("m", F.lit(i)), F.lit(0.0)).alias("shap_value"))
        for i, f in enumerate(features)
    ])
    return by_slot.select(
        key, F.try_element_at("m", F.lit(-1)).alias("base"), F.try_element_at("m", F.lit(-2)).alias("probability"),
        values.alias("attributions"),
    )
