"""Row-level labels: age bands, risk tiers, score buckets, customer segments, actions and explanations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# Closed age ranges; the last one is open at the top.
AGE_BANDS = [(18, 24, "18-24"), (25, 34, "25-34"), (35, 44, "35-44"), (45, 54, "45-54"), (55, None, "55+")]

# Probability buckets of the portfolio chart.
SCORE_BUCKETS = [
    "0-10%", "10-20%", "20-30%", "30-40%", "40-50%", "50-60%", "60-70%", "70-80%", "80-90%", "90-100%",
]

RISK_TIERS = ("High", "Medium", "Low")
CUSTOMER_SEGMENTS = ("Payment Friction", "Low Engagement", "Stable", "General")

# The sentence shown for a feature that drives a customer's risk.
FEATURE_SENTENCES = {
    "transaction_count": "Transaction activity is lower than what we usually see for retained customers.",
    "cancel_count": "Recent cancellation behaviour suggests the subscription relationship is unstable.",
    "num_active_days": "Listening activity has dropped, which is often an early sign of churn.",
    "avg_total_secs": "Average listening time is low, pointing to weaker engagement.",
    "avg_plan_days": "Plan duration patterns look less sticky than healthier subscribers.",
    "latest_is_auto_renew": "Auto-renewal behaviour suggests weaker renewal commitment.",
    "total_amount_paid": "Payment history indicates weaker subscription commitment than typical retained users.",
    "total_num_songs": "Overall listening volume is lower than the platform usually sees from retained customers.",
    "avg_num_songs": "Average listening volume has softened compared with healthier users.",
    "total_num_unq": "Content variety has narrowed, which can signal declining engagement.",
    "avg_num_unq": "The customer is exploring less content than typical retained listeners.",
    "latest_membership_expire_date": "Membership timing indicates upcoming renewal risk.",
    "renewal_count": "Renewal history is weaker than what we usually see among retained subscribers.",
    "registered_via": "Signup channel patterns resemble customers who are more likely to churn.",
    "bd": "Age-band patterns resemble users with elevated churn risk.",
    "gender": "This customer profile matches churn patterns seen in similar user groups.",
    "city": "Location-based patterns align with groups that show elevated churn risk.",
}


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def numeric(value: Column | str) -> Column:
    """Lenient number: text that is no number becomes NULL."""
    return _column(value).try_cast("double")


def age_band(age: Column | str) -> Column:
    """Closed integer age ranges; anything outside or between them is Unknown."""
    value = numeric(age)
    label = F
    for low, high, name in AGE_BANDS:
        inside = (value >= low) if high is None else value.between(low, high)
        label = label.when(inside & ~F.isnan(value), name)
    return label.otherwise(UNKNOWN)


def risk_tier(probability: Column | str, high: float = 0.7, medium: float = 0.4) -> Column:
    p = _column(probability)
    return F.when(p >= high, HIGH).when(p >= medium, MEDIUM).otherwise(LOW)


def score_bucket(probability: Column | str) -> Column:
    """Ten buckets whose lower limit belongs to the bucket."""
    p = _column(probability)
    label = F
    for step, name in enumerate(SCORE_BUCKETS[:-1], start=1):
        label = label.when(p < step / 10, name)
    return label.otherwise(SCORE_BUCKETS[-1])


def payment_behavior(auto_renew: Column | str) -> Column:
    return F.when(_column(auto_renew) == 1, "Auto-Renew").otherwise("Manual")


def cancel_history(cancels: Column | str) -> Column:
    c = _column(cancels)
    return F.when(c == 0, "Never Cancelled").when(c == 1, "1 Cancellation").otherwise("2+ Cancellations")


def usage_intensity(active_days: Column | str) -> Column:
    d = _column(active_days)
    return F.when(d < 30, "Light (<30 days)").when(d < 90, "Moderate (30-90 days)").otherwise("Heavy (90+ days)")


def tenure(transactions: Column | str) -> Column:
    t = _column(transactions)
    return F.when(t <= 3, "New (<=3 txns)").when(t <= 10, "Developing (4-10 txns)").otherwise("Established (11+ txns)")


def has_cancel_history(cancels: Column | str) -> Column:
    return F.when(F.coalesce(_column(cancels), F.lit(0)) > 0, 1).otherwise(0)


# The names of segments and actions that stored rows and reports hold.
FRICTION, IDLE, STABLE, GENERAL = "Payment Friction", "Low Engagement", "Stable", "General"
ACTIONS = {
    "re-engage": "Send re-engagement campaign",
    "escalate": "Escalate to retention team",
    "remind": "Send targeted reminder or lightweight incentive",
    "watch": "No immediate action; monitor only",
}
# Tiers and priorities.
HIGH, MEDIUM, LOW, URGENT = "High", "Medium", "Low", "Urgent"


def customer_segment() -> Column:
    """Segment from cancel_count, latest_is_auto_renew, num_active_days, avg_total_secs and risk_tier.

    A missing cancel count is no cancellation; a missing auto-renew flag is no friction.
    """
    friction = (F.coalesce(F.col("cancel_count"), F.lit(0)) > 0) | (F.col("latest_is_auto_renew") == 0)
    idle = (F.col("num_active_days") < 10) | (F.col("avg_total_secs") < 900)
    return (
        F.when(friction, FRICTION)
        .when(idle, IDLE)
        .when(F.col("risk_tier") == LOW, STABLE)
        .otherwise(GENERAL)
    )


def intervention_priority() -> Column:
    """Priority from risk_tier and customer_segment."""
    pressing = F.col("customer_segment").isin(FRICTION, IDLE)
    return (
        F.when((F.col("risk_tier") == HIGH) & pressing, URGENT)
        .when(F.col("risk_tier") == HIGH, HIGH)
        .when(F.col("risk_tier") == MEDIUM, MEDIUM)
        .otherwise(LOW)
    )


def recommended_action() -> Column:
    """Next action from risk_tier and customer_segment."""
    tier, segment = F.col("risk_tier"), F.col("customer_segment")
    return (
        F.when((tier == HIGH) & (segment == IDLE), ACTIONS["re-engage"])
        .when((tier == HIGH) & (segment == FRICTION), ACTIONS["escalate"])
        .when(tier == MEDIUM, ACTIONS["remind"])
        .otherwise(ACTIONS["watch"])
    )


def humanized(feature: Column) -> Column:
    """``num_active_days`` to ``Num active days``."""
    words = F.lower(F.trim(F.regexp_replace(feature, "_", " ")))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substring(words, 2, 1 << 20))


def feature_sentence(feature: Column, sentences: Mapping[str, str] = FEATURE_SENTENCES) -> Column:
    lookup = F.create_map(*[F.lit(part) for pair in sentences.items() for part in pair])
    fallback = F.concat(humanized(feature), F.lit(" is contributing to this customer's churn risk."))
    return F.coalesce(F.try_element_at(lookup, feature), fallback)


def top_features(attributions: Column | str | None, defaults: Sequence[str], n: int = 3) -> Column:
    """Names of the first ``n`` attributions, or the global ones when a customer has none."""
    fallback = F.array(*[F.lit(f) for f in list(defaults)[:n]]).cast("array<string>")
    if attributions is None:
        return fallback
    names = F.transform(F.slice(_column(attributions), 1, n), lambda entry: entry["feature"])
    names = F.filter(names, lambda name: name.isNotNull() & (name != ""))
    return F.when(F.size(names) > 0, names).otherwise(fallback)


def explanations(features: Column) -> Column:
    """Business sentences of an array of feature names."""
    return F.transform(features, lambda feature: feature_sentence(feature))


def enriched(df: DataFrame, default_features: Sequence[str] = (), attributions: str | None = None) -> DataFrame:
    """Add segment, priority, action, top features and explanations to prediction rows joined with features."""
    return (
        df.withColumn("customer_segment", customer_segment())
        .withColumn("intervention_priority", intervention_priority())
        .withColumn("recommended_action", recommended_action())
        .withColumn("top_3_features", top_features(attributions, default_features))
        .withColumn("business_explanations", explanations(F.col("top_3_features")))
    )


def outcome_columns(df: DataFrame, label: str) -> DataFrame:
    """Add actual, is_misclassified and error_type (correct, FN or FP) to rows with ``predicted``."""
    return df.selectExpr("*", f"cast({label} as int) as actual").selectExpr(
        "*",
        "cast(actual <> predicted as int) as is_misclassified",
        "case when actual = 1 and predicted = 0 then 'FN' when actual = 0 and predicted = 1 then 'FP' "
        "else 'correct' end as error_type",
    )


def case_columns(df: DataFrame, label: str, probability: str, threshold: float = 0.5) -> DataFrame:
    """Add predicted (probability at the threshold or above), actual, is_misclassified and error_type."""
    return outcome_columns(df.withColumn("predicted", (F.col(probability) >= threshold).cast("int")), label)


def stable_bucket(key: Column | str) -> Column:
    """Bucket 0..99 from the first eight hex digits of the key's MD5."""
    digest = F.md5(_column(key).cast("string").cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int")
