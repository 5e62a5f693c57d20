"""Newest-row operators. Ties are broken by explicit columns and NULL order values come last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _descending(columns: Sequence[str]):
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key, the newest by ``newest_by``.

    The ``row_number() = 1`` filter lets Spark drop all but one row per key and task before the shuffle, so a hot key
    costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_descending(newest_by)))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def newest_rows(df: DataFrame, newest_by: Sequence[str], n: int = 1) -> DataFrame:
    """The newest ``n`` rows of a log table (a distributed top-n, no global sort)."""
    return df.orderBy(*_descending(newest_by)).limit(n)


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """The newest scored row of each customer."""
    ties = ["scored_at"] + [c for c in ("pred_id",) if c in predictions.columns]
    return latest_per_key(predictions, ["customer_id"], ties)
