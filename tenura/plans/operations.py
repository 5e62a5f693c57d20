"""Plans over stored logs: attributions of scored customers, validation runs, registrations and monitoring rows."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators import promotion, quality
from tenura.operators.attributions import top_attributions
from tenura.plans.bundle import ModelBundle, checked_inputs
from tenura.plans.monitoring import monitoring_verdict
from tenura.plans.training import model_attributions
from tenura.schemas import PREDICTION_SCHEMA, VALIDATION_SCHEMA
from tenura.session import checkpointed
from tenura.sources.tables import append_log, first_existing, keyed_update, read_log, rewrite_partitions


def existing_log(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A log's rows, or None before its first append."""
    try:
        first_existing(spark, [path])
    except ValueError:
        return None
    return read_log(spark, path, schema)


def attribute_newest_scores(
    spark: SparkSession, log_path: str, features: DataFrame, background: DataFrame, made: ModelBundle, top: int = 5
) -> int:
    """Write the top attributions of the newest scoring run into the prediction log; returns the number of its rows.

    Only the day partitions of that run are rewritten, from a checkpoint, so the plan never reads what it replaces.
    """
    log = read_log(spark, log_path, PREDICTION_SCHEMA)
    newest = log.agg(F.max("scored_at").alias("at")).first()["at"]
    if newest is None:
        return 0
    run = checkpointed(log.where(F.col("scored_at") == F.lit(newest)))
    scored = checked_inputs(features, made).join(run.select(F.col("customer_id").alias("msno")).distinct(), "msno", "left_semi")
    values = model_attributions(made.model, scored, background, made.input_columns)
    changes = values.select(
        F.col("msno").alias("customer_id"), F.lit(newest).alias("scored_at"), top_attributions("attributions", top).alias("shap_values")
    )
    days = run.select("run_date").distinct()
    rows = log.join(F.broadcast(days), "run_date", "left_semi")  # the day or days of one run
    updated = checkpointed(keyed_update(rows, changes, ["customer_id", "scored_at"], ["shap_values"]))
    rewrite_partitions(updated, log_path, "run_date")
    return run.count()


def validate_and_log(
    spark: SparkSession, tables: Mapping[str, DataFrame], rule_set: Mapping, log_path: str, run_id: str, as_of: datetime
) -> DataFrame:
    """Run the rules against the log's passing baselines, append the stamped results and return the run's verdict."""
    former = existing_log(spark, log_path, VALIDATION_SCHEMA)
    results = checkpointed(quality.run_rules(spark, tables, rule_set, as_of, former))
    append_log(quality.stamped_results(results, run_id, as_of), log_path, "created_at")
    return quality.verdict(results)


def register(
    spark: SparkSession, log_path: str, model_name: str, run_id: str, metrics: Mapping[str, float | None],
    champion_business: float | None, logged_at: datetime, tolerance: float = 0.01,
) -> DataFrame:
    """Pass a challenger through the gate and append its version, and the champion's change, to the version log.

    ``metrics`` has the challenger's roc_auc and business metric. Returns the gate's row with the new version.
    """
    log = existing_log(spark, log_path, promotion.VERSION_LOG)
    champion = checkpointed(promotion.current_production(log, model_name)) if log is not None else None
    former = champion.first() if champion is not None else None
    highest = log.where(F.col("model_name") == model_name).agg(F.max("version").alias("v")).first()["v"] if log is not None else None
    version = (highest or 0) + 1
    pair = spark.createDataFrame(
        [(metrics["roc_auc"], former["roc_auc"] if former else None, metrics.get("business"), champion_business)],
        "challenger_auc double, champion_auc double, challenger_business double, champion_business double",
    )
    decided = checkpointed(promotion.gate_columns(pair, tolerance=tolerance).withColumn("version", F.lit(version)))
    promote = decided.first()["promote"]
    changes = promotion.version_changes(spark, model_name, version, run_id, metrics["roc_auc"], promote, logged_at, champion if former else None)
    append_log(changes, log_path, "logged_at")
    return decided


def monitor_and_log(
    spark: SparkSession, log_path: str, version_log_path: str, model_name: str, predictions: DataFrame, features: DataFrame,
    train: DataFrame, as_of: datetime, **limits,
) -> DataFrame:
    """Append a monitoring row whose reference AUC is that of the version now in production; returns the row."""
    log = existing_log(spark, version_log_path, promotion.VERSION_LOG)
    champion = promotion.current_production(log, model_name).first() if log is not None else None
    reference = champion["roc_auc"] if champion else None
    row = checkpointed(monitoring_verdict(predictions, features, train, as_of, reference_auc=reference, **limits))
    append_log(row, log_path, "monitored_at")
    return row

