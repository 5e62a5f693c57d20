from datetime import datetime

from pyspark.sql import functions as F

from tenura.functions import labels
from tenura.operators import dashboard

FEATURES = (
    "msno string, transaction_count int, cancel_count int, num_active_days int, avg_total_secs double, "
    "avg_plan_days double, latest_is_auto_renew int"
)


def predictions(spark, rows):
    return spark.createDataFrame(
        [(i, c, p, t, datetime(2024, 1, d)) for i, (c, p, t, d) in enumerate(rows)],
        "pred_id int, customer_id string, churn_probability double, risk_tier string, scored_at timestamp")


def test_segment_rules_on_nulls(spark):
    rows = [
        ("a", None, None, None, None, None, None), ("b", 1, 0, 5, 2000.0, 1.0, 1), ("c", 1, 0, 50, 899.0, 1.0, 1),
        ("d", 1, 0, 50, 900.0, 1.0, 0), ("e", 1, 2, 50, 900.0, 1.0, 1), ("f", 1, 0, 10, 900.0, 1.0, 1),
    ]
    df = spark.createDataFrame(rows, FEATURES).withColumn("risk_tier", F.lit("Low"))
    found = {r["msno"]: r["s"] for r in df.select("msno", labels.customer_segment().alias("s")).collect()}
    assert found == {"a": "Stable", "b": "Low Engagement", "c": "Low Engagement", "d": "Payment Friction",
                     "e": "Payment Friction", "f": "Stable"}


def test_tiers_buckets_and_bands_at_their_limits(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.3,), (0.39999,), (0.4,), (0.7,), (1.0,)], "p double")
    found = [tuple(r) for r in df.select(labels.risk_tier("p"), labels.score_bucket("p")).collect()]
    assert found == [("Low", "0-10%"), ("Low", "10-20%"), ("Low", "30-40%"), ("Low", "30-40%"), ("Medium", "40-50%"),
                     ("High", "70-80%"), ("High", "90-100%")]
    ages = spark.createDataFrame([(17.0,), (18.0,), (24.5,), (54.0,), (300.0,), (None,)], "bd double")
    assert [r[0] for r in ages.select(labels.age_band("bd")).collect()] == ["Unknown", "18-24", "Unknown", "45-54", "55+", "Unknown"]


def test_explanations_prefer_the_customers_own_features(spark):
    df = spark.createDataFrame(
        [([("num_active_days", 0.5), ("odd_name_", 0.1), ("city", 0.0), ("bd", 0.0)],), ([],), (None,), ([(None, 1.0)],)],
        "a array<struct<feature:string,shap_value:double>>")
    rows = df.select(labels.top_features("a", ["gender", "bd"]).alias("f")).withColumn("e", labels.explanations(F.col("f"))).collect()
    assert rows[0]["f"] == ["num_active_days", "odd_name_", "city"]
    assert rows[0]["e"][1] == "Odd name is contributing to this customer's churn risk."
    assert all(r["f"] == ["gender", "bd"] for r in rows[1:])


def test_queue_takes_the_top_rows_before_the_segment_filter(spark):
    preds = predictions(spark, [(f"c{i:03d}", 0.9, "High", 1) for i in range(60)] + [("z", 0.95, "High", 1), ("low", 0.1, "Low", 1)])
    features = spark.createDataFrame([(f"c{i:03d}", 1, 0, 5, 2000.0, 1.0, 1) for i in range(60)], FEATURES)
    queue = dashboard.retention_queue(preds, features)
    assert queue.count() == 50
    ids = [r["customer_id"] for r in queue.orderBy("customer_id").collect()]
    assert ids[-1] == "z" and ids[0] == "c000" and "c049" not in ids
    assert dashboard.retention_queue(preds, features, segment="General").count() == 1
    assert dashboard.retention_queue(preds, features, "Nonsense", "Nonsense").count() == 50
    assert dashboard.retention_queue(preds, features, "Low").count() == 1
    summary = dashboard.queue_summary(queue.where("false")).first()
    assert tuple(summary) == (0, 0, 0, 0.0)


def test_portfolio_and_buckets_use_the_latest_row(spark):
    preds = predictions(spark, [("a", 0.9, "High", 1), ("a", 0.1, "Low", 2), ("b", 0.45, "Medium", 1)])
    row = dashboard.portfolio_counts(preds).first()
    assert (row["total_scored"], row["high_count"], row["medium_count"], row["low_count"]) == (2, 0, 1, 1)
    buckets = dashboard.score_buckets(preds).collect()
    assert [b["bucket"] for b in buckets] == labels.SCORE_BUCKETS
    assert {b["bucket"]: (b["count"], b["pct"]) for b in buckets if b["count"]} == {"10-20%": (1, 100), "40-50%": (1, 100)}
    assert all(b["pct"] == 0 for b in dashboard.score_buckets(preds.where("false")).collect())


def test_manual_payers_stay_two_rows(spark):
    preds = predictions(spark, [("a", 0.9, "High", 1), ("b", 0.8, "High", 1), ("c", 0.1, "Low", 1)])
    features = spark.createDataFrame(
        [("a", 1, 0, 5, 1.0, 1.0, 0), ("b", 1, None, None, 1.0, 1.0, None), ("c", 20, 1, 40, 1.0, 1.0, 1)], FEATURES)
    rows = [tuple(r) for r in dashboard.segment_breakdown(preds, features).collect()]
    manual = [r for r in rows if r[1] == "Manual"]
    assert len(manual) == 2 and all(r[2] == 1 for r in manual)
    names = {r[1] for r in rows}
    assert {"2+ Cancellations", "Heavy (90+ days)", "Established (11+ txns)"} <= names


def test_card_of_an_unknown_customer_is_empty(spark):
    preds = predictions(spark, [("a", 0.9, "High", 1), ("a", 0.2, "Low", 3)])
    features = spark.createDataFrame([("a", 1, 0, 5, 1.0, 1.0, 1)], FEATURES)
    assert dashboard.customer_card(preds, features, "a").first()["risk_tier"] == "Low"
    assert dashboard.customer_card(preds, features, "nobody").count() == 0


def test_case_columns_and_stable_bucket(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.4), (0, 0.6), (0, 0.1)], "y int, p double")
    assert [r["error_type"] for r in labels.case_columns(df, "y", "p").collect()] == ["correct", "FN", "FP", "correct"]
    # First eight hex digits of MD5("a") are 0cc175b9.
    assert spark.range(1).select(labels.stable_bucket(F.lit("a"))).first()[0] == int("0cc175b9", 16) % 100
