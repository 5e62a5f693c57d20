"""One-row-per-customer features from payments, activity logs and members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.latest import latest_per_key
from tenura.schemas import FEATURE_SCHEMA, fields


def _mean(total: str, count: str, precision: int, scale: int, name: str) -> str:
    """Decimal mean as SQL, rounded half away from zero; NULL when nothing was counted."""
    quotient = f"try_divide(cast({total} as decimal(28,2)), cast({count} as decimal(10,0)))"
    return f"cast(round({quotient}, {scale}) as decimal({precision},{scale})) as {name}"


def tie_break(df: DataFrame, tie: str | None = None) -> str:
    """What decides between transactions of one date, as SQL: a non-negative integer, the larger being the newer.

    Without a ``tie`` column it is ``txn_id`` if the table has one. The loader's layout has none; then the order is that
    of the payment settings themselves (method, then auto-renewal, NULL lowest), which are all that is taken from a row.
    """
    if tie or "txn_id" in df.columns:
        return tie or "txn_id"
    return "(coalesce(cast(payment_method_id as int), -40000) + 40000) * 10L + coalesce(cast(is_auto_renew as int), -1) + 1"


def recency(tie: str, date: str = "transaction_date") -> Column:
    """Date and tie-break packed in one decimal.

    A number keeps the ordering inside a hash aggregate; a struct would force a sort-based one. ``tie`` must be a
    non-negative integer. A row without a date is never the newest.
    """
    return F.expr(f"cast(cast({date} as decimal(10,0)) * 10000000000000000000BD + {tie} as decimal(38,0))")


def latest_transactions(transactions: DataFrame, tie: str | None = None) -> DataFrame:
    """The newest transaction row of each customer.

    Ties go to the highest ``tie`` (``txn_id`` where there is one), else to the highest row, compared column by column.
    """
    column = tie or ("txn_id" if "txn_id" in transactions.columns else None)
    rest = [column] if column else [c for c in transactions.columns if c not in ("msno", "transaction_date")]
    return latest_per_key(transactions, ["msno"], ["transaction_date", *rest])


def transaction_features(transactions: DataFrame, tie: str | None = None) -> DataFrame:
    """Counts, amounts and the latest payment settings per customer, in one aggregation.

    The latest row is the one with the highest (transaction_date, ``tie_break``); undated rows never win. The expiry date is
    the maximum over all rows, not the one of the latest row.
    """
    aggregates = [
        "cast(count(1) as int) as transaction_count",
        "cast(count_if(is_cancel = 0) as int) as renewal_count",
        "cast(sum(is_cancel) as int) as cancel_count",
        "cast(sum(actual_amount_paid) as decimal(20,2)) as total_amount_paid",
        "sum(payment_plan_days) as _plan_days",
        "count(payment_plan_days) as _plans",
        "max_by(payment_method_id, _recency) as latest_payment_method_id",
        "max_by(is_auto_renew, _recency) as latest_is_auto_renew",
        "max(membership_expire_date) as latest_membership_expire_date",
    ]
    totals = transactions.withColumn("_recency", recency(tie_break(transactions, tie))).groupBy("msno").agg(*[F.expr(a) for a in aggregates])
    return totals.selectExpr("* except (_plan_days, _plans)", _mean("_plan_days", "_plans", 8, 2, "avg_plan_days"))


def activity_features(user_logs: DataFrame) -> DataFrame:
    """Active days, listening time, songs and variety per customer.

    A log row with any NULL play count adds no songs and is not counted in their mean.
    """
    aggregates = [
        "cast(count(distinct date) as int) as num_active_days",
        "cast(sum(total_secs) as decimal(28,2)) as total_secs",
        "count(total_secs) as _timed",
        "sum(_songs) as total_num_songs",
        "count(_songs) as _played",
        "sum(num_unq) as total_num_unq",
        "count(num_unq) as _varied",
    ]
    logs = user_logs.selectExpr("*", "num_25 + num_50 + num_75 + num_985 + num_100 as _songs")
    return logs.groupBy("msno").agg(*[F.expr(a) for a in aggregates]).selectExpr(
        "* except (_timed, _played, _varied)",
        _mean("total_secs", "_timed", 12, 4, "avg_total_secs"),
        _mean("total_num_songs", "_played", 10, 4, "avg_num_songs"),
        _mean("total_num_unq", "_varied", 10, 4, "avg_num_unq"),
    )


def customer_features(
    train: DataFrame, members: DataFrame, transactions: DataFrame, user_logs: DataFrame, tie: str | None = None
) -> DataFrame:
    """The feature table: every labelled customer, with NULLs where a source knows nothing about them.

    Both aggregates run before the joins, so each join sees at most one row per customer on either side.
    """
    joined = (
        train.join(members, "msno", "left")
        .join(transaction_features(transactions, tie), "msno", "left")
        .join(activity_features(user_logs), "msno", "left")
    )
    return joined.selectExpr(*[f"cast({name} as {kind}) as {name}" for name, kind in fields(FEATURE_SCHEMA)])
