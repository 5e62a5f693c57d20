from decimal import Decimal

from pyspark.sql import functions as F

from tenura.operators import features
from tenura.operators.latest import latest_per_key, latest_predictions, newest_rows
from tenura.schemas import FEATURE_COLUMNS, RAW_SCHEMAS

TXN = "txn_id bigint, " + RAW_SCHEMAS["transactions"]


def test_latest_row_ties_and_undated_rows(spark):
    df = spark.createDataFrame([
        (1, "a", 10, 30, 1, 1, 0, 20240101, 20240301, 0),
        (3, "a", 11, 30, 1, 1, 1, 20240101, 20240201, 0),
        (9, "a", 12, 31, 1, 1, 0, None, 20230101, 1),
    ], TXN)
    row = features.transaction_features(df).first()
    assert (row["latest_payment_method_id"], row["latest_is_auto_renew"]) == (11, 1)
    assert row["latest_membership_expire_date"] == 20240301  # the maximum, not the latest row's
    assert (row["transaction_count"], row["renewal_count"], row["cancel_count"]) == (3, 2, 1)
    assert row["avg_plan_days"] == Decimal("30.33")
    assert features.latest_transactions(df).first()["txn_id"] == 3


def test_half_cents_round_away_from_zero(spark):
    df = spark.createDataFrame([(i, "a", 1, d, 1, 1, 0, 20240101, 20240101, 0) for i, d in enumerate([1] * 199 + [2])], TXN)
    assert features.transaction_features(df).first()["avg_plan_days"] == Decimal("1.01")  # 1.005


def test_null_plays_add_no_songs(spark):
    df = spark.createDataFrame([
        ("a", 20240101, 1, 1, 1, 1, 1, 4, Decimal("10.00")),
        ("a", 20240101, None, 5, 5, 5, 5, 2, Decimal("20.01")),
        ("a", 20240102, 2, 0, 0, 0, 0, None, None),
    ], RAW_SCHEMAS["user_logs"])
    row = features.activity_features(df).first()
    assert (row["num_active_days"], row["total_num_songs"], row["total_num_unq"]) == (2, 7, 6)
    assert (row["avg_num_songs"], row["avg_num_unq"], row["avg_total_secs"]) == (Decimal("3.5"), Decimal("3"), Decimal("15.005"))


def test_customers_unknown_to_a_source_keep_nulls(spark):
    train = spark.createDataFrame([("a", 1), ("b", 0)], RAW_SCHEMAS["train"])
    empty = {name: spark.createDataFrame([], ddl) for name, ddl in RAW_SCHEMAS.items()}
    table = features.customer_features(
        train, empty["members"], spark.createDataFrame([], TXN), empty["user_logs"])
    assert table.columns == FEATURE_COLUMNS
    rows = table.collect()
    assert len(rows) == 2 and all(r["transaction_count"] is None and r["city"] is None for r in rows)


def test_a_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.col("id").alias("scored_at"))
    result = latest_predictions(df)
    assert result.where("customer_id = 'hot'").first()["scored_at"] == 2997
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_nulls_are_never_the_newest(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2)], "k string, t int, v int")
    assert latest_per_key(df, ["k"], ["t"]).first()["v"] == 2
    assert newest_rows(df, ["t"]).first()["v"] == 2
