import datetime

import pytest
from pyspark.sql import functions as F

from tenura.functions.dates import date_from_int
from tenura.operators import cleanse

TXN = (
    "txn_id bigint, msno string, payment_method_id smallint, payment_plan_days int, plan_list_price int, "
    "actual_amount_paid int, is_auto_renew smallint, transaction_date int, membership_expire_date int, is_cancel smallint"
)


def transactions(spark):
    return spark.createDataFrame([
        (5, "a", 41, 30, 149, 149, 1, 20170301, 20170401, 0),
        (2, "a", 3, 7, 50, 40, 0, 20170201, 20170501, 1),
        (7, "a", 38, 10, 180, 180, 1, 20170301, 20170331, 0),
        (9, "b", 26, 195, 900, 894, 1, 20160101, 20160714, 0),
    ], TXN)


def test_rollup_first_last_and_any(spark):
    rows = {r["msno"]: r for r in cleanse.transaction_rollup(cleanse.merge_rare_payment_methods(transactions(spark))).collect()}
    a = rows["a"]
    assert (a["payment_method_id"], a["is_auto_renewal"]) == (1, 0)  # lowest txn_id, recoded from 3
    assert (a["last_plan_days"], a["last_plan_price"]) == (30, 180)  # each the largest of the last date
    assert (a["is_cancel"], a["no_of_transactions"], a["membership_expire_date"]) == (1, 3, 20170501)
    assert (a["total_payment_plan_days"], a["total_plan_list_price"], a["total_actual_amount_paid"]) == (47, 379, 369)
    assert (rows["b"]["last_plan_days"], rows["b"]["is_cancel"], rows["b"]["payment_method_id"]) == (195, 0, 1)


def test_negative_plan_values_survive_packing(spark):
    df = transactions(spark).withColumn("plan_list_price", F.lit(-5))
    assert {r["last_plan_price"] for r in cleanse.transaction_rollup(df).collect()} == {-5}


def test_age_median_ignores_outliers(spark):
    df = spark.createDataFrame([("a", 20), ("b", 31), ("c", -7000), ("d", 2015), ("e", None)], "msno string, bd smallint")
    assert {r["msno"]: r["bd"] for r in cleanse.clean_age(df).collect()} == {"a": 20, "b": 31, "c": 25.5, "d": 25.5, "e": 25.5}


def test_age_median_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", 2)], "msno string, bd smallint")
    assert cleanse.clean_age(df).first()["bd"] is None


def test_dates_raise_or_become_null(spark):
    df = spark.createDataFrame([(20240229,), (20230229,)], "d int")
    assert [r[0] for r in df.select(date_from_int("d", lenient=True)).collect()] == [datetime.date(2024, 2, 29), None]
    with pytest.raises(Exception):
        df.select(date_from_int("d")).collect()


def test_rules_reject_unknown_actions(spark):
    df = transactions(spark)
    with pytest.raises(ValueError, match="null handling"):
        cleanse.apply_rules(df, {"null_handling": {"msno": "guess"}})
    with pytest.raises(ValueError, match="duplicate handling"):
        cleanse.apply_rules(df, {"duplicate_handling": "shuffle"})


def test_rules_drop_rows_and_columns(spark):
    df = spark.createDataFrame([("a", 1, "x"), (None, 2, "y")], "msno string, v int, gone string")
    rules = {"null_handling": {"msno": "drop_row", "gone": "drop_column", "v": "keep"}}
    result = cleanse.apply_rules(df, rules)
    assert result.columns == ["msno", "v"] and result.count() == 1
