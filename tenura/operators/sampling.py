"""Reproducible samples, splits and cohorts. Draws depend on keys, never on partitioning."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.labels import stable_bucket
from tenura.operators.ordered import BROADCAST_ROWS
from tenura.session import checkpointed

PREFIX = 3  # hex digits: 4096 hash ranges per stratum


def seeded_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))


def _chosen(df: DataFrame, key: str, stratum: str, fraction: float, seed: int, into: str) -> DataFrame:
    """Mark round(fraction * n) rows of each stratum, those with the lowest seeded hash.

    Rows are counted per hash prefix; whole ranges below the cut are taken, and only the one range that holds the cut
    is ranked. No stratum is ever sorted as a whole. The table is read three times, so pass one that is cheap to read.
    """
    hashed = df.withColumn("_hash", seeded_hash(key, seed)).withColumn("_range", F.substring("_hash", 1, PREFIX))
    sizes = hashed.groupBy(stratum, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    # At most 16 ** PREFIX rows per stratum reach these windows.
    upto = Window.partitionBy(stratum).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.bround(F.lit(fraction) * F.sum("_rows").over(Window.partitionBy(stratum)))
    below = F.sum("_rows").over(upto) - F.col("_rows")
    cuts = sizes.select(
        F.col(stratum).alias("_stratum"), F.col("_range").alias("_cut"),
        F.greatest(wanted - below, F.lit(0)).alias("_quota"), "_rows",
    )
    same = F.col(stratum).eqNullSafe(F.col("_stratum")) & (F.col("_range") == F.col("_cut"))
    cuts = checkpointed(cuts)
    joined = hashed.join(F.broadcast(cuts) if cuts.count() <= BROADCAST_ROWS else cuts, same)
    split = (F.col("_quota") > 0) & (F.col("_quota") < F.col("_rows"))
    whole = joined.where(~split).withColumn(into, F.col("_quota") >= F.col("_rows"))
    order = Window.partitionBy(stratum, "_range").orderBy("_hash", key)
    ranked = joined.where(split).withColumn(into, F.row_number().over(order) <= F.col("_quota"))
    return whole.unionByName(ranked).drop("_hash", "_range", "_stratum", "_cut", "_quota", "_rows")


def stratified_sample(df: DataFrame, key: str, stratum: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Exactly round(fraction * n) rows of every stratum."""
    return _chosen(df, key, stratum, fraction, seed, "_chosen").where("_chosen").drop("_chosen")


def approximate_stratified_sample(df: DataFrame, stratum: str, fractions: dict, seed: int = 42, key: str = "msno") -> DataFrame:
    """A draw per row by the seeded hash of its key: one pass, no shuffle, counts only about right.

    A stratum without a fraction gives no rows.
    """
    unit = F.conv(F.substring(seeded_hash(key, seed), 1, 13), 16, 10).cast("double") / float(1 << 52)
    share = F.lit(0.0)
    for value, fraction in fractions.items():
        share = F.when(F.col(stratum).eqNullSafe(F.lit(value)), float(fraction)).otherwise(share)
    return df.where(unit < share)


def keep_sampled(df: DataFrame, sample: DataFrame, key: str = "msno") -> DataFrame:
    """Rows of a related table whose key was sampled."""
    return df.join(sample.select(key), key, "left_semi")


def simple_sample(df: DataFrame, rows: int, key: str, seed: int = 42) -> DataFrame:
    """Random share min(1, rows / count) of a table: the rows whose seeded key hash lies below it.

    The draw does not depend on partitioning or retries; rows of one key stand or fall together.
    """
    if rows <= 0:
        raise ValueError("rows must be positive")
    total = df.count()
    if total <= rows:
        return df
    place = F.conv(F.substring(seeded_hash(key, seed), 1, 12), 16, 10).cast("bigint")
    return df.where(place < F.lit(rows * (1 << 48) // total))


def train_validation_split(
    df: DataFrame, key: str = "msno", label: str = "is_churn", validation: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split``: validation for exactly round(validation * n) rows of each label, else train."""
    marked = _chosen(df, key, label, validation, seed, "_chosen")
    return marked.withColumn("split", F.when(F.col("_chosen"), "validation").otherwise("train")).drop("_chosen")


def hash_cohort(key: Column | str) -> Column:
    """Stable cohort of a key: about 70 percent baseline, the others current."""
    return F.when(stable_bucket(key) < 70, "baseline").otherwise("current")


def time_cohort(scored_at: str, as_of: datetime, current_days: int = 7, baseline_days: int = 90) -> Column:
    """current from as_of - 7 days on, baseline in the 83 days before, else NULL."""
    stamp = F.col(scored_at).cast("timestamp_ntz")

    def before(days: int) -> Column:
        return F.lit((as_of - timedelta(days=days)).isoformat(sep=" ")).cast("timestamp_ntz")

    return F.when(stamp >= before(current_days), "current").when(stamp >= before(baseline_days), "baseline")


def monitoring_cohorts(
    df: DataFrame, key: str = "msno", window: str = "window", min_rows: int = 50, weight: str | None = None
) -> DataFrame:
    """Rows of the two cohorts with ``cohort`` and ``cohort_strategy``; ``window`` holds each row's time_cohort.

    Time windows decide unless either holds fewer than ``min_rows`` rows; then every row, of whatever age, is assigned
    by key hash. One small aggregation makes that choice; pass a checkpointed table, since it is read for that as well.
    """
    weights = F.col(weight) if weight else F.lit(1)

    def rows(cohort: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(window) == cohort, weights)), F.lit(0))

    enough = df.agg((F.least(rows("current"), rows("baseline")) >= min_rows).alias("enough")).scalar()
    strategy = F.when(enough, "time_window").otherwise("hash_fallback")
    cohort = F.when(F.col("cohort_strategy") == "time_window", F.col(window)).otherwise(hash_cohort(key))
    return (
        df.withColumn("cohort_strategy", strategy)
        .withColumn("cohort", cohort)
        .where(F.col("cohort").isNotNull())
    )
