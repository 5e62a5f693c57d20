"""Portfolio counts, score buckets, segment breakdowns, the retention queue and customer cards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions import labels
from tenura.operators.latest import latest_predictions, newest_rows
from tenura.session import checkpointed

CARD_FEATURES = [
    "transaction_count", "cancel_count", "num_active_days", "avg_total_secs", "avg_plan_days", "latest_is_auto_renew",
]
QUEUE_LENGTH = 50


def portfolio_counts(predictions: DataFrame) -> DataFrame:
    """Customers in total and per tier, and the newest score time, over the latest row of each customer."""
    tier = F.col("risk_tier")
    return latest_predictions(predictions).agg(
        F.count(F.lit(1)).alias("total_scored"),
        F.count_if(tier == "High").alias("high_count"),
        F.count_if(tier == "Medium").alias("medium_count"),
        F.count_if(tier == "Low").alias("low_count"),
        F.max("scored_at").alias("latest_scored_at"),
    )


def score_buckets(predictions: DataFrame) -> DataFrame:
    """All ten buckets with their count and their height in percent of the largest one (half-even rounding)."""
    bucket = labels.score_bucket("churn_probability")
    names = labels.SCORE_BUCKETS
    counts = latest_predictions(predictions).select(bucket.alias("bucket")).agg(
        *[F.count_if(F.col("bucket") == name).alias(f"_{i}") for i, name in enumerate(names)]
    )
    largest = F.greatest(*[F.col(f"_{i}") for i in range(len(names))])
    rows = F.array(*[F.struct(F.lit(n).alias("bucket"), F.col(f"_{i}").alias("count")) for i, n in enumerate(names)])
    percent = F.bround(100.0 * F.col("count") / F.greatest(F.col("largest"), F.lit(1))).cast("int")
    return (
        counts.select(largest.alias("largest"), F.explode(rows).alias("row"))
        .select("largest", "row.*")
        .select("bucket", "count", percent.alias("pct"))
    )


def with_features(predictions: DataFrame, features: DataFrame, how: str = "left") -> DataFrame:
    """Prediction rows joined with their customer's features; an inner join gives the attribution input."""
    return predictions.join(features.withColumnRenamed("msno", "customer_id"), "customer_id", how)


def segment_breakdown(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Size, high-risk count and mean probability of four families of segments, in one pass.

    The payment family is grouped by the raw flag, so 0 and NULL stay two rows of the same name.
    """
    flag = F.col("latest_is_auto_renew").cast("int")

    def segment(kind: str, name: Column, group: Column) -> Column:
        return F.struct(F.lit(kind).alias("segment_type"), name.alias("segment_name"), group.alias("_group"))

    none = F.lit(None).cast("int")
    families = F.array(
        segment("payment_behavior", labels.payment_behavior(flag), flag),
        segment("cancel_history", labels.cancel_history("cancel_count"), none),
        segment("usage_intensity", labels.usage_intensity("num_active_days"), none),
        segment("tenure", labels.tenure("transaction_count"), none),
    )
    needed = features.select("msno", "latest_is_auto_renew", "cancel_count", "num_active_days", "transaction_count")
    joined = with_features(latest_predictions(predictions), needed, "inner")
    return (
        joined.select(F.explode(families).alias("s"), "risk_tier", "churn_probability")
        .groupBy("s")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("risk_tier") == "High").alias("high_count"),
            F.round(F.avg(F.col("churn_probability").cast("decimal(20,10)")), 4).alias("avg_churn_prob"),
        )
        .select("s.segment_type", "s.segment_name", "total", "high_count", "avg_churn_prob")
        .orderBy("segment_type", "segment_name")
    )


def retention_queue(
    predictions: DataFrame,
    features: DataFrame,
    risk_tier: str | None = None,
    segment: str | None = None,
    default_features: Sequence[str] = (),
    length: int = QUEUE_LENGTH,
) -> DataFrame:
    """The customers with the highest latest probability, enriched for the retention team.

    An unknown tier or segment does not filter. The segment filter comes after the limit, so fewer rows may return.
    Ties at the last place go to the lowest customer_id.
    """
    latest = latest_predictions(predictions)
    if risk_tier in labels.RISK_TIERS:
        latest = latest.where(F.col("risk_tier") == risk_tier)
    top = checkpointed(latest.orderBy(F.col("churn_probability").desc(), "customer_id").limit(length))
    # Both broadcast sides hold at most ``length`` rows, so the feature table is scanned but not shuffled.
    keys = top.select(F.col("customer_id").alias("msno"))
    known = features.select("msno", *CARD_FEATURES).join(F.broadcast(keys), "msno", "left_semi")
    attributions = "shap_values" if "shap_values" in predictions.columns else None
    queue = labels.enriched(with_features(top, F.broadcast(known)), default_features, attributions)
    if segment in labels.CUSTOMER_SEGMENTS:
        queue = queue.where(F.col("customer_segment") == segment)
    return queue


def queue_summary(queue: DataFrame) -> DataFrame:
    """Counts and mean probability of the displayed rows; zeros when there are none."""
    tier = F.col("risk_tier")
    return queue.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(tier == "High").alias("high_risk_count"),
        F.count_if(tier == "Medium").alias("medium_risk_count"),
        F.coalesce(F.avg(F.col("churn_probability").cast("double")), F.lit(0.0)).alias("avg_churn_probability"),
    )


def customer_cards(
    predictions: DataFrame, features: DataFrame, default_features: Sequence[str] = ()
) -> DataFrame:
    """The newest prediction of every customer with features and enrichment."""
    attributions = "shap_values" if "shap_values" in predictions.columns else None
    rows = with_features(latest_predictions(predictions), features.select("msno", *CARD_FEATURES))
    return labels.enriched(rows, default_features, attributions)


def customer_card(
    predictions: DataFrame, features: DataFrame, customer_id: str | Column, default_features: Sequence[str] = ()
) -> DataFrame:
    """The card of one customer; no row when the customer was never scored."""
    wanted = F.lit(customer_id) if isinstance(customer_id, str) else customer_id
    ties = ["scored_at"] + [c for c in ("pred_id",) if c in predictions.columns]
    newest = newest_rows(predictions.where(F.col("customer_id") == wanted), ties)
    known = features.where(F.col("msno") == wanted).select("msno", *CARD_FEATURES)
    attributions = "shap_values" if "shap_values" in predictions.columns else None
    return labels.enriched(with_features(newest, known), default_features, attributions)


def monitoring_status(monitoring_log: DataFrame) -> DataFrame:
    """The newest monitoring row, as the status panel shows it."""
    return newest_rows(monitoring_log, ["monitored_at"]).select(
        "monitored_at", "baseline_auc", "current_auc", "auc_delta", "max_psi", "breached", "breached_reasons",
        "baseline_row_count", "current_row_count",
    )
