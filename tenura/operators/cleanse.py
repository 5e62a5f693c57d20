"""Cleansing: recodes, outliers, medians, date casts, per-customer rollups and rule-driven chains of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions.dates import date_from_int
from tenura.operators.features import recency, tie_break
from tenura.operators.ordered import exact_quantiles

# Payment methods too rare to keep apart, and the code they are merged into.
RARE_PAYMENT_METHODS = [3, 6, 8, 10, 11, 12, 13, 14, 16, 18, 20, 22, 26]
MERGED_PAYMENT_METHOD = 1
PLAUSIBLE_AGE = (18, 90)


def recode(df: DataFrame, column: str, codes: Sequence[int], into: int) -> DataFrame:
    """Replace the listed codes by one value; other values and NULL stay."""
    kind = df.schema[column].dataType
    return df.withColumn(
        column, F.when(F.col(column).isin(list(codes)), F.lit(into).cast(kind)).otherwise(F.col(column))
    )


def merge_rare_payment_methods(transactions: DataFrame) -> DataFrame:
    return recode(transactions, "payment_method_id", RARE_PAYMENT_METHODS, MERGED_PAYMENT_METHOD)


def null_outside(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Set values outside [low, high] to NULL."""
    keep = F.lit(True)
    if low is not None:
        keep = keep & (F.col(column) >= low)
    if high is not None:
        keep = keep & (F.col(column) <= high)
    return df.withColumn(column, F.when(keep, F.col(column)))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs by the exact (interpolated) median of the known values; the column becomes a double."""
    for column in columns:
        median = exact_quantiles(df.select(column), column, [0.5]).select(F.col("quantiles")[0]).scalar()
        df = df.withColumn(column, F.coalesce(F.col(column).cast("double"), median))
    return df


def clean_age(members: DataFrame, column: str = "bd") -> DataFrame:
    """Implausible ages become NULL, then every NULL becomes the median of what is left."""
    return impute_median(null_outside(members, column, *PLAUSIBLE_AGE), [column])


def _packed(date: str, value: str) -> Column:
    """Date in the high half and value in the low half of one long, so that max() finds the last date's largest value."""
    return F.shiftleft(F.col(date).cast("bigint"), 32) + F.col(value).cast("bigint") + F.lit(1 << 31)


def _unpacked(packed: str) -> Column:
    return (F.col(packed).bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 31)).cast("int")


def transaction_rollup(transactions: DataFrame, first_by: str | None = None) -> DataFrame:
    """One row per customer: first payment settings, totals, date span and the plan on the last date.

    "First" is the lowest ``first_by`` (``txn_id`` where there is one), else the lowest date and then the lowest
    settings; undated rows come last. Plan days and price on the last date are each the largest among that date's rows.
    is_cancel is 1 when any transaction was a cancellation.
    """
    order = first_by or ("txn_id" if "txn_id" in transactions.columns else None)
    first = F.col(order) if order else recency(tie_break(transactions), "coalesce(transaction_date, 99999999)")
    return (
        transactions.withColumn("_first", first)
        .withColumn("_days", _packed("transaction_date", "payment_plan_days"))
        .withColumn("_price", _packed("transaction_date", "plan_list_price"))
        .groupBy("msno")
        .agg(
            F.min_by("payment_method_id", "_first").alias("payment_method_id"),
            F.sum("payment_plan_days").alias("total_payment_plan_days"),
            F.sum("plan_list_price").alias("total_plan_list_price"),
            F.sum("actual_amount_paid").alias("total_actual_amount_paid"),
            F.max("_days").alias("_days"),
            F.max("_price").alias("_price"),
            F.min_by("is_auto_renew", "_first").alias("is_auto_renewal"),
            F.min("transaction_date").alias("first_transaction_date"),
            F.max("transaction_date").alias("last_transaction_date"),
            F.max("membership_expire_date").alias("membership_expire_date"),
            F.max(F.when(F.col("is_cancel") == 1, 1).otherwise(0)).alias("is_cancel"),
            F.count(F.lit(1)).alias("no_of_transactions"),
        )
        .withColumn("last_plan_days", _unpacked("_days"))
        .withColumn("last_plan_price", _unpacked("_price"))
        .drop("_days", "_price")
    )


def derived_columns(df: DataFrame) -> DataFrame:
    """Durations in days, average plan price and days, and the amount still due."""
    count = F.col("no_of_transactions")
    return (
        df.withColumn("membership_duration_days", F.datediff("membership_expire_date", "registration_init_time"))
        .withColumn("transaction_span_days", F.datediff("last_transaction_date", "first_transaction_date"))
        .withColumn("avg_plan_price", F.col("total_plan_list_price").cast("double") / count)
        .withColumn("avg_plan_days", F.col("total_payment_plan_days").cast("double") / count)
        .withColumn("amount_due", F.col("total_plan_list_price") - F.col("total_actual_amount_paid"))
    )


DATE_COLUMNS = [
    "registration_init_time", "first_transaction_date", "last_transaction_date", "membership_expire_date",
]
TRAINING_COLUMNS = [
    "msno", "is_churn", "city", "bd", "registered_via", "payment_method_id", "last_plan_days", "last_plan_price",
    "is_auto_renewal", "is_cancel", "no_of_transactions", "membership_duration_days", "transaction_span_days",
    "avg_plan_price", "avg_plan_days", "amount_due",
]


def member_transactions(train: DataFrame, members: DataFrame, transactions: DataFrame) -> DataFrame:
    """Labelled members with cleaned ages, their rollup and real dates (inner joins)."""
    rollup = transaction_rollup(merge_rare_payment_methods(transactions))
    joined = clean_age(members).drop("gender").join(rollup, "msno").join(train, "msno")
    return joined.withColumns({name: date_from_int(name) for name in DATE_COLUMNS})


def training_table(train: DataFrame, members: DataFrame, transactions: DataFrame) -> DataFrame:
    """The cleaned training table: labels, members and transaction rollups with derived columns."""
    return derived_columns(member_transactions(train, members, transactions)).select(*TRAINING_COLUMNS)


# Default rules per table, in the vocabulary ``apply_rules`` understands (fixed values).
DEFAULT_RULES: dict[str, dict] = {
    "train": {"null_handling": {"msno": "drop_row", "is_churn": "drop_row"}},
    "members": {
        "outlier_treatment": {"bd": {"min": 18, "max": 90}},
        "null_handling": {
            "msno": "drop_row",
            "city": "keep",
            "bd": "impute_median",
            "gender": "drop_column",
            "registered_via": "keep",
            "registration_init_time": "keep",
        },
        "type_casting": {"registration_init_time": "date"},
    },
    "transactions": {
        "recode": {"payment_method_id": {"codes": RARE_PAYMENT_METHODS, "into": MERGED_PAYMENT_METHOD}},
        "duplicate_handling": "aggregate_by_msno",
        "type_casting": {
            "first_transaction_date": "date",
            "last_transaction_date": "date",
            "membership_expire_date": "date",
        },
    },
    "user_logs": {"type_casting": {"date": "date"}},
}
NULL_ACTIONS = ("keep", "drop_row", "drop_column", "impute_median")


def apply_rules(df: DataFrame, rules: Mapping) -> DataFrame:
    """Apply one table's cleansing rules: outliers, dropped rows, recodes, medians, rollup, casts, dropped columns."""
    null_actions = dict(rules.get("null_handling") or {})
    unknown = sorted({a for a in null_actions.values() if a not in NULL_ACTIONS})
    if unknown:
        raise ValueError(f"unknown null handling: {unknown}")
    strategy = rules.get("duplicate_handling") or "none"
    if strategy not in ("none", "not_applicable", "aggregate_by_msno"):
        raise ValueError(f"unknown duplicate handling: {strategy}")

    def with_action(action: str) -> list[str]:
        return [c for c, a in null_actions.items() if a == action]

    for column, limits in (rules.get("outlier_treatment") or {}).items():
        df = null_outside(df, column, limits.get("min"), limits.get("max"))
    if with_action("drop_row"):
        df = df.dropna(subset=with_action("drop_row"))
    for column, spec in (rules.get("recode") or {}).items():
        df = recode(df, column, spec["codes"], spec["into"])
    df = impute_median(df, with_action("impute_median"))
    if strategy == "aggregate_by_msno":
        df = transaction_rollup(df)
    casts = rules.get("type_casting") or {}
    df = df.withColumns({c: date_from_int(c) if to == "date" else F.col(c).cast(to) for c, to in casts.items()})
    return df.drop(*with_action("drop_column"))
