"""Descriptive fairness tables and training-data facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.labels import UNKNOWN, age_band


def group_fairness(
    cases: DataFrame,
    group: str,
    label: str = "is_churn",
    probability: str = "churn_probability",
    threshold: float = 0.5,
    weight: str | None = None,
) -> DataFrame:
    """Size, churn rate and predicted churn rate per gender or age band; a missing group is Unknown.

    Rows with ``predicted`` need no probability; with ``weight`` each row counts that often.
    """
    if group not in ("gender", "age_band"):
        raise ValueError(f"unsupported group column: {group}")
    source = "gender" if group == "gender" else "bd"
    if source not in cases.columns:
        name = F.lit(UNKNOWN)
    elif group == "gender":
        name = F.when(F.col("gender").isNull() | (F.col("gender") == ""), UNKNOWN).otherwise(F.col("gender"))
    else:
        name = age_band("bd")
    predicted = F.col("predicted") if "predicted" in cases.columns else (F.col(probability) >= threshold).cast("int")
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    return (
        cases.groupBy(name.alias(group))
        .agg(
            F.sum(w).alias("sample_size"),
            (F.sum(w * F.col(label)) / F.sum(w)).alias("churn_rate"),
            (F.sum(w * predicted) / F.sum(w)).alias("predicted_churn_rate"),
        )
        .orderBy(group)
    )


def fairness_gap(table: DataFrame) -> DataFrame:
    """Largest minus smallest churn rate of the groups; 0 when there are none."""
    return table.agg(F.coalesce(F.max("churn_rate") - F.min("churn_rate"), F.lit(0.0)).alias("fairness_gap"))


def training_date_range(df: DataFrame, column: str = "feature_created_at") -> DataFrame:
    """First and last day of a timestamp column."""
    day = F.to_date(column)
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
