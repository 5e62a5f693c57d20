"""Exploratory profiles: rates, counts, histograms, box statistics, variances, correlations and coverage."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.operators.ordered import moments_of_counts, quantiles_of_counts, value_counts as distinct_values
from tenura.session import checkpointed


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in without]


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column) with the value as a double."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*entries)))


def churn_rate(df: DataFrame, label: str = "is_churn") -> DataFrame:
    return df.agg(F.avg(label).alias("churn_rate"))


def churn_rate_by(df: DataFrame, dimension: str, label: str = "is_churn") -> DataFrame:
    """Churn rate per value of a dimension, highest first; NULL is no value."""
    return (
        df.where(F.col(dimension).isNotNull())
        .groupBy(dimension)
        .agg(F.avg(label).alias("churn_rate"))
        .orderBy(F.col("churn_rate").desc(), dimension)
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, in one pass; NULL is not counted."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*entries)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins over each column's own range; empty bins are kept, the last bin is closed.

    A constant column gets a range of one unit around its value.
    """
    values = long_form(df, columns).where(F.col("value").isNotNull())
    flat = F.col("high") == F.col("low")
    limits = (
        values.groupBy("column")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .select(
            "column",
            F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(flat, 1.0).otherwise(F.col("high") - F.col("low")).alias("span"),
        )
    )
    limits = F.broadcast(limits)  # one row per named column
    place = F.floor((F.col("value") - F.col("low")) / (F.col("span") / bins)).cast("int")
    counted = (
        values.join(limits, "column")
        .groupBy("column", F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    grid = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(F.broadcast(counted), ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("low") + F.col("bin") * (F.col("span") / bins)).alias("bin_lower"),
        (F.col("low") + (F.col("bin") + 1) * (F.col("span") / bins)).alias("bin_upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def _quartiles(counts: DataFrame) -> DataFrame:
    """Quartiles per column of a (column, value, n) table; one row per named column, hence small."""
    quartiles = quantiles_of_counts(counts, "value", [0.25, 0.5, 0.75], keys=["column"])
    return F.broadcast(quartiles.select("column", *[
        F.col("quantiles")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))
    ]))


def box_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (the outermost values within 1.5 interquartile ranges) and the count of outliers.

    The input is read once, for its distinct values.
    """
    counts = checkpointed(distinct_values(long_form(df, columns), ["column"], "value"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        counts.join(_quartiles(counts), "column")
        .groupBy("column", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )


def variance_ranking(df: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    """Columns by sample variance, largest first, with their rank."""
    variances = df.agg(*[F.var_samp(c).alias(c) for c in columns])
    ordered = F.array_sort(
        F.array(*[F.struct((-F.col(c)).alias("negated"), F.lit(c).alias("column")) for c in columns])
    )
    return variances.select(F.posexplode(F.slice(ordered, 1, top)).alias("pos", "s")).select(
        (F.col("pos") + 1).alias("rank"), F.col("s.column").alias("column"), (-F.col("s.negated")).alias("variance")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows that have both, in one aggregation.

    A pair with a constant side has no correlation. The built-in corr() would divide by zero there under ANSI rules,
    hence the three sums of squares.
    """
    pairs = list(combinations(columns, 2))
    values = df.selectExpr(*[f"cast({c} as double) as {c}" for c in columns])
    both = [f"try_divide(regr_sxy({a}, {b}), sqrt(regr_sxx({a}, {b}) * regr_syy({a}, {b})))" for a, b in pairs]
    alone = [f"if(var_pop({c}) > 0, 1.0D, null)" for c in columns]
    measured = values.agg(F.expr(f"array({', '.join(both + alone)})").alias("measured"))
    cells = [(a, b, i) for i, (a, b) in enumerate(pairs)] + [(b, a, i) for i, (a, b) in enumerate(pairs)]
    cells += [(c, c, len(pairs) + i) for i, c in enumerate(columns)]
    rows = ", ".join(f"struct('{a}' as column_a, '{b}' as column_b, measured[{i}] as correlation)" for a, b, i in cells)
    return measured.selectExpr(f"inline(array({rows}))")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])
    return counted.select(F.inline(rows))


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; NULL counts as one key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum of each column."""
    counts = checkpointed(distinct_values(long_form(df, columns), ["column"], "value"))
    return moments_of_counts(counts, "value", ["column"]).join(_quartiles(counts), "column").select(
        "column", "count", "mean", F.sqrt("variance").alias("std"), "min",
        F.col("q1").alias("p25"), F.col("median").alias("p50"), F.col("q3").alias("p75"), "max",
    )


def coverage(train: DataFrame, features: DataFrame) -> DataFrame:
    """Share of customers each source knows (percent, 1 dp) and churn rate before and after the build (2 dp)."""

    def percent(total, digits):
        share = F.try_divide(total.cast("decimal(20,0)") * 100, F.count(F.lit(1)).cast("decimal(20,0)"))
        return F.round(share, digits)

    def known(column):
        return percent(F.count(column), 1)

    return features.agg(
        known("city").alias("pct_demographics"),
        known("transaction_count").alias("pct_transactions"),
        known("num_active_days").alias("pct_user_logs"),
        percent(F.sum("is_churn"), 2).alias("features_churn_rate"),
        F.count(F.lit(1)).alias("feature_rows"),
    ).withColumn("raw_churn_rate", train.agg(percent(F.sum("is_churn"), 2).alias("rate")).scalar())
