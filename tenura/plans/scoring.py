"""Batch scoring: contract check, probability, tier and provenance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.labels import risk_tier
from tenura.operators.modeling import with_probability
from tenura.schemas import PREDICTION_SCHEMA, fields
from tenura.sources.tables import append_log, project


def score_customers(
    features: DataFrame,
    model: PipelineModel,
    input_columns: Sequence[str],
    scored_at: datetime,
    feature_snapshot_id: str | None = None,
    model_version: str | None = None,
    threshold_version: str = "v1",
    high: float = 0.7,
    medium: float = 0.4,
) -> DataFrame:
    """Prediction rows of every customer. Exactly the model's input columns are read; a missing one is an error."""
    inputs = project(features, ["msno", *input_columns], features.columns + list(input_columns))
    scored = with_probability(model, inputs).select(
        F.col("msno").alias("customer_id"),
        F.col("probability").alias("churn_probability"),
        risk_tier("probability", high, medium).alias("risk_tier"),
        F.lit(scored_at).alias("scored_at"),
        F.lit(None).alias("shap_values"),
        F.lit(feature_snapshot_id).alias("feature_snapshot_id"),
        F.lit(model_version).alias("model_version"),
        F.lit(threshold_version).alias("threshold_version"),
    )
    return scored.selectExpr(*[f"cast({name} as {kind}) as {name}" for name, kind in fields(PREDICTION_SCHEMA)])


def score_and_append(path: str, *args, **kwargs) -> None:
    """Score and append the rows to the prediction log, partitioned by scoring day."""
    append_log(score_customers(*args, **kwargs), path, "scored_at")
