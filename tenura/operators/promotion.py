"""Champion and challenger: the promotion gate and the append-only log of model versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION_LOG = "model_name string, version int, stage string, role string, run_id string, roc_auc double, logged_at timestamp"
# Stages of a version, and the names of the gate's decisions.
STAGING, PRODUCTION, ARCHIVED = "Staging", "Production", "Archived"
FIRST_CHAMPION = "promoted_initial_champion"
NEW_CHAMPION = "promoted_over_champion"
KEPT_CHAMPION = "kept_existing_champion"
BUSINESS_LOSS = "kept_existing_champion_business_regression"


def gate_columns(
    df: DataFrame,
    challenger_auc: str = "challenger_auc",
    champion_auc: str = "champion_auc",
    challenger_business: str = "challenger_business",
    champion_business: str = "champion_business",
    threshold: float = 0.0,
    tolerance: float = 0.01,
) -> DataFrame:
    """Decide promotion for each (challenger, champion) row.

    The challenger needs a strictly higher AUC than the champion plus threshold, and a business metric that fell by at
    most the tolerance. A missing business metric passes. A champion without AUC counts as none.
    """
    delta = F.col(challenger_business) - F.col(champion_business)
    business_ok = F.coalesce(delta >= -abs(tolerance), F.lit(True))
    auc_ok = F.col(challenger_auc) > F.col(champion_auc) + threshold
    none = F.col(champion_auc).isNull()
    return (
        df.withColumn("auc_margin", F.col(challenger_auc) - F.col(champion_auc))
        .withColumn("business_delta", delta)
        .withColumn("business_gate_ok", business_ok)
        .withColumn(
            "decision",
            F.when(none, FIRST_CHAMPION)
            .when(auc_ok & business_ok, NEW_CHAMPION)
            .when(~auc_ok, KEPT_CHAMPION)
            .otherwise(BUSINESS_LOSS),
        )
        .withColumn("promote", F.col("decision").startswith("promoted"))
    )


def current_production(version_log: DataFrame, model_name: str | Column) -> DataFrame:
    """The highest version whose newest logged stage is Production."""
    name = F.lit(model_name) if isinstance(model_name, str) else model_name
    state = F.struct("stage", "role", "run_id", "roc_auc")
    newest = (
        version_log.where(F.col("model_name") == name)
        .groupBy("model_name", "version")
        .agg(F.max_by(state, "logged_at").alias("state"))
    )
    live = newest.where(F.col("state.stage") == PRODUCTION)
    return live.groupBy("model_name").agg(
        F.max("version").alias("version"), F.max_by("state", "version").alias("state")
    ).select("model_name", "version", "state.*")


def version_changes(
    spark: SparkSession, model_name: str, version: int, run_id: str, roc_auc: float, promote: bool,
    logged_at: datetime, champion: DataFrame | None = None,
) -> DataFrame:
    """Log rows of one registration: the new version's stage, and the former champion archived on promotion."""
    stage, role = (PRODUCTION, "champion") if promote else (STAGING, "challenger")
    rows = spark.createDataFrame([(model_name, version, stage, role, run_id, roc_auc, logged_at)], VERSION_LOG)
    if champion is None:
        return rows
    former = champion.where(F.col("version") != version).select(
        "model_name", "version",
        F.lit(ARCHIVED if promote else PRODUCTION).alias("stage"),
        F.lit("former_champion" if promote else "champion").alias("role"),
        "run_id", "roc_auc", F.lit(logged_at).cast("timestamp").alias("logged_at"),
    )
    return rows.unionByName(former)
