"""Model-monitoring metrics: population stability, AUC with ties, calibration, Brier score and score distribution.

Every metric takes an optional ``weight`` column, so that rows can be collapsed to (key, score) counts first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.labels import has_cancel_history
from tenura.operators.ordered import BROADCAST_ROWS, matched, quantiles_of_counts, ranged, running_totals, value_counts
from tenura.operators.sampling import time_cohort
from tenura.session import checkpointed

# Features watched when no importance table names better ones.
DEFAULT_MONITORED_FEATURES = [
    "transaction_count", "total_amount_paid", "avg_plan_days", "num_active_days", "avg_total_secs",
]
SEGMENT_COLUMNS = ("latest_is_auto_renew", "has_cancel_history")
PSI_BINS = 10
PSI_FLOOR = 1e-6


def _weight(weight: str | None) -> Column:
    return F.col(weight) if weight else F.lit(1)


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def labelled_predictions(
    predictions: DataFrame,
    features: DataFrame,
    train: DataFrame,
    monitored: Sequence[str] = tuple(DEFAULT_MONITORED_FEATURES),
    extra: Sequence[str] = ("scored_at",),
) -> DataFrame:
    """Every scored row of a labelled customer, with segment flags and monitored features as doubles."""
    known = features.select(
        F.col("msno"),
        F.coalesce("latest_is_auto_renew", F.lit(0)).cast("int").alias("latest_is_auto_renew"),
        has_cancel_history("cancel_count").alias("has_cancel_history"),
        *[F.col(c).cast("double").alias(c) for c in monitored],
    ).join(train.select("msno", F.col("is_churn").cast("int").alias("label")), "msno")
    scored = predictions.where(F.col("churn_probability").isNotNull()).select(
        F.col("customer_id").alias("msno"), F.col("churn_probability").cast("double").alias("score"), *extra
    )
    return scored.join(known, "msno")


def monitoring_frame(
    predictions: DataFrame, features: DataFrame, train: DataFrame, as_of,
    monitored: Sequence[str] = tuple(DEFAULT_MONITORED_FEATURES),
) -> DataFrame:
    """The rows of ``labelled_predictions`` collapsed to one per (customer, score, time window) with their count ``n``.

    The collapse runs before the join, so a customer scored very often brings few rows into it.
    """
    collapsed = (
        predictions.where(F.col("churn_probability").isNotNull())
        .groupBy("customer_id", "churn_probability", time_cohort("scored_at", as_of).alias("window"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return labelled_predictions(collapsed, features, train, monitored, extra=("window", "n"))


def roc_auc(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), weight: str | None = None, strict: bool = False
) -> DataFrame:
    """Area under the ROC curve; tied scores count half. NULL for one class, or an error when ``strict``.

    Rows collapse to distinct scores. Each score range ranks its own scores, and range totals join the ranges.
    """
    keys = list(keys)
    w = _weight(weight)
    counts = checkpointed(value_counts(df.withColumn("_score", F.col(score).cast("double")), keys, "_score", {
        "pos": F.when(F.col(label) == 1, w).otherwise(0), "neg": F.when(F.col(label) == 0, w).otherwise(0),
    }))
    spread, _ = ranged(counts, keys, "_score")
    lower = Window.partitionBy(*keys, "_range").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    beaten = F.coalesce(F.sum("neg").over(lower), F.lit(0)).cast("double") + F.col("neg") / 2
    per_range = (
        spread.withColumn("_wins", F.col("pos") * beaten)
        .groupBy(*keys, "_range")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("_wins").alias("wins"))
    )
    # A few dozen rows per key reach this window.
    below = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("wins") + F.col("pos").cast("double") * F.coalesce(F.sum("neg").over(below), F.lit(0))
    area = per_range.withColumn("wins", wins).groupBy(*keys).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.try_divide(F.sum("wins"), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"),
    )
    if strict:
        area = area.withColumn("roc_auc", F.when(F.col("roc_auc").isNotNull(), F.col("roc_auc")).otherwise(
            F.raise_error(F.lit("AUC needs both positive and negative classes")).cast("double")))
    return area


def roc_points(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """True and false positives at every distinct threshold, with their rates."""
    w = _weight(weight)
    counts = checkpointed(value_counts(df.withColumn("_order", -F.col(score).cast("double")), [], "_order", {
        "pos": F.when(F.col(label) == 1, w).otherwise(0), "neg": F.when(F.col(label) == 0, w).otherwise(0),
    }))
    points = running_totals(counts, [], "_order", ["pos", "neg"])
    totals = counts.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).alias("t")).scalar()
    return points.select(
        (-F.col("_order")).alias("threshold"),
        F.col("pos_cum").alias("true_positives"), F.col("neg_cum").alias("false_positives"),
        F.try_divide(F.col("pos_cum").cast("double"), totals["pos"]).alias("tpr"),
        F.try_divide(F.col("neg_cum").cast("double"), totals["neg"]).alias("fpr"),
    )


def unit_edges(bins: int) -> list[float]:
    """Limits of equal-width bins over [0, 1]: multiples of the width in floating point, the last one exactly 1."""
    if bins <= 0:
        raise ValueError("the number of bins must be positive")
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def _unit_bin(score: Column, bins: int) -> Column:
    """Index of the left-closed bin that holds the score, after clipping to [0, 1]; 1 is in the last bin."""
    clipped = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    index = F.lit(0)
    for edge in unit_edges(bins)[1:-1]:
        index = index + (clipped >= edge).cast("int")
    return index


def score_bins(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), bins: int = 10, weight: str | None = None
) -> DataFrame:
    """Rows, positives, summed scores and summed squared errors per equal-width score bin that holds rows."""
    unit_edges(bins)
    w, s = _weight(weight), F.col(score).cast("double")
    distance = s - F.col(label)
    return df.groupBy(*keys, _unit_bin(s, bins).alias("bin")).agg(
        F.sum(w).cast("bigint").alias("rows"), F.sum(w * F.col(label)).cast("bigint").alias("positives"),
        F.sum(w * s).alias("scores"), F.sum(w * distance * distance).alias("squares"),
    )


def calibration_list(binned: Column, bins: int = 10) -> Column:
    """All bins, from a map of bin to (rows, positives, scores): an array of calibration structs."""
    edges = F.array(*[F.lit(e) for e in unit_edges(bins)])

    def entry(i: Column) -> Column:
        held = F.try_element_at(binned, i)
        return F.struct(
            i.alias("bin"), edges[i].alias("bin_lower"), edges[i + 1].alias("bin_upper"),
            (held["scores"] / held["rows"]).alias("mean_pred"), (held["positives"] / held["rows"]).alias("actual_rate"),
            F.coalesce(held["rows"], F.lit(0).cast("bigint")).alias("count"),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), entry)


def distribution_list(binned: Column, total: Column, bins: int = 10) -> Column:
    """All bins, from a map of bin to (rows, ...): an array of (bin, limits, count, share)."""
    edges = F.array(*[F.lit(e) for e in unit_edges(bins)])

    def entry(i: Column) -> Column:
        rows = F.coalesce(F.try_element_at(binned, i)["rows"], F.lit(0).cast("bigint"))
        return F.struct(
            i.alias("bin"), edges[i].alias("bin_lower"), edges[i + 1].alias("bin_upper"), rows.alias("count"),
            (rows / F.greatest(total, F.lit(1))).alias("pct"),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), entry)


def bin_map(condition: Column | None = None) -> Column:
    """Aggregate of score_bins rows: map of bin to (rows, positives, scores)."""
    entry = F.struct("bin", F.struct("rows", "positives", "scores"))
    return F.map_from_entries(F.collect_list(entry if condition is None else F.when(condition, entry)))


def calibration_bins(
    df: DataFrame, label: str, score: str, bins: int = 10, weight: str | None = None
) -> DataFrame:
    """Mean score, observed rate and count of equal-width score bins; empty bins stay with NULL means."""
    held = score_bins(df, label, score, (), bins, weight).agg(bin_map().alias("held"))
    return held.select(F.inline(calibration_list(F.col("held"), bins)))


def max_calibration_error(bins: DataFrame) -> DataFrame:
    """Largest gap between mean score and observed rate of a non-empty bin; 0 when all are empty."""
    gap = F.abs(F.col("mean_pred") - F.col("actual_rate"))
    return bins.agg(F.coalesce(F.max(gap), F.lit(0.0)).alias("max_calibration_error"))


def brier_score(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """Mean squared distance between score and label; NaN without rows."""
    w, distance = _weight(weight), F.col(score).cast("double") - F.col(label)
    mean = F.try_divide(F.sum(w * distance * distance), F.sum(w))
    return df.agg(F.coalesce(mean, F.lit(float("nan"))).alias("brier_score"))


def score_distribution(df: DataFrame, score: str, bins: int = 10, weight: str | None = None) -> DataFrame:
    """Count and share of equal-width score bins; scores are clipped to [0, 1]."""
    held = score_bins(df.withColumn("_label", F.lit(0)), "_label", score, (), bins, weight).agg(
        bin_map().alias("held"), F.sum("rows").alias("total")
    )
    return held.select(F.inline(distribution_list(F.col("held"), F.coalesce("total", F.lit(0)), bins)))


def psi(
    df: DataFrame, value: str, keys: Sequence[str] = (), cohort: str = "cohort", weight: str | None = None,
    bins: int = PSI_BINS,
) -> DataFrame:
    """Population stability index of current against baseline rows, one row per key.

    Bins lie between the baseline's exact quantiles; outer bins are open. NaN when a side has fewer than two finite
    values, 0 when the baseline is constant.
    """
    keys = list(keys)
    w = _weight(weight)
    # One pass over the rows; NULL and infinite values stay, so that every key is known.
    every = checkpointed(
        df.groupBy(*keys, F.col(value).cast("double").alias("_value")).agg(
            F.sum(F.when(F.col(cohort) == "baseline", w).otherwise(0)).alias("base"),
            F.sum(F.when(F.col(cohort) == "current", w).otherwise(0)).alias("curr"),
        )
    )
    counts = every.where(_finite(F.col("_value")))
    fractions = [i * (1.0 / bins) for i in range(bins)] + [1.0]
    edges = quantiles_of_counts(counts.where(F.col("base") > 0), "_value", fractions, keys, n="base")
    edges = edges.select(*keys, F.array_distinct("quantiles").alias("_edges"))
    inner = F.slice("_edges", 2, F.greatest(F.size("_edges") - 2, F.lit(0)))
    if keys:
        edges = checkpointed(edges)  # eleven numbers per key, and any column may be the key
        placed = matched(counts, edges, keys, edges.count() <= BROADCAST_ROWS)
        series = every.select(*keys).distinct()
    else:
        placed = counts.withColumn("_edges", edges.select("_edges").scalar())
    index = F.size(F.filter(inner, lambda edge: edge <= F.col("_value")))
    binned = placed.groupBy(*keys, index.alias("_bin")).agg(
        F.sum("base").alias("base"), F.sum("curr").alias("curr"), F.first("_edges").alias("_edges")
    )
    # At most ``bins`` rows per key reach this window.
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    base_n, curr_n = F.sum("base").over(whole), F.sum("curr").over(whole)
    shares = binned.select(
        *keys, "_edges", base_n.alias("baseline_rows"), curr_n.alias("current_rows"),
        (F.col("base") / F.greatest(base_n, F.lit(1)) + PSI_FLOOR).alias("b"),
        (F.col("curr") / F.greatest(curr_n, F.lit(1)) + PSI_FLOOR).alias("c"),
    )
    measured = shares.groupBy(*keys).agg(
        F.max("baseline_rows").alias("baseline_rows"), F.max("current_rows").alias("current_rows"),
        F.sum((F.col("c") - F.col("b")) * F.log(F.col("c") / F.col("b"))).alias("_sum"),
        F.max(F.size("_edges")).alias("_limits"),
    )
    result = (
        F.when((F.col("baseline_rows") < 2) | (F.col("current_rows") < 2) | F.col("_sum").isNull(), float("nan"))
        .when(F.col("_limits") < 2, 0.0)
        .otherwise(F.col("_sum"))
    )
    if keys:
        measured = series.join(measured, keys, "left")  # keys without any finite value stay, as NaN
    return measured.select(*keys, F.coalesce(result, F.lit(float("nan"))).alias("psi"))


def feature_psi(df: DataFrame, features: Sequence[str], weight: str | None = None) -> DataFrame:
    """PSI of every feature in one job."""
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    kept = ["cohort"] + ([weight] if weight else [])
    return psi(df.select(*kept, F.inline(entries)), "value", ["feature"], weight=weight)


def max_finite_psi(values: DataFrame) -> DataFrame:
    return values.agg(F.coalesce(F.max(F.when(_finite(F.col("psi")), F.col("psi"))), F.lit(0.0)).alias("max_psi"))


def segment_entries(df: DataFrame, columns: Sequence[str]) -> Column:
    """``column=value`` of every segment column of a row, NULL values as NULL."""
    return F.array(*[
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in columns if c in df.columns
    ])


def segment_psi(
    df: DataFrame, columns: Sequence[str] = SEGMENT_COLUMNS, score: str = "score", weight: str | None = None
) -> DataFrame:
    """PSI of the score within each value of each segment column; an absent column gives ``column=missing``, NaN."""
    if score not in df.columns:
        raise ValueError(f"score column {score!r} is missing")
    kept = ["cohort", score] + ([weight] if weight else [])
    present = [c for c in columns if c in df.columns]
    absent = [c for c in columns if c not in df.columns]
    spark = df.sparkSession
    parts = []
    if present:
        long = df.select(*kept, F.explode(segment_entries(df, present)).alias("segment")).where(F.col("segment").isNotNull())
        parts.append(psi(long, score, ["segment"], weight=weight))
    if absent:
        parts.append(spark.createDataFrame([(f"{c}=missing", float("nan")) for c in absent], "segment string, psi double"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def breached_segments(segments: DataFrame, threshold: float = 0.2) -> DataFrame:
    """One row with the sorted names of segments whose finite PSI exceeds the threshold."""
    over = _finite(F.col("psi")) & (F.col("psi") > threshold)
    return segments.agg(F.sort_array(F.collect_list(F.when(over, F.col("segment")))).alias("breached_segments"))


def insufficient_data(df: DataFrame, minimum: int = 1000, weight: str | None = None) -> DataFrame:
    """Whether the current cohort is too small for a verdict."""
    rows = F.coalesce(F.sum(F.when(F.col("cohort") == "current", _weight(weight))), F.lit(0))
    return df.agg(rows.alias("current_rows")).withColumn("insufficient", F.col("current_rows") < minimum)


def top_importances(importances: DataFrame, n: int) -> DataFrame:
    """The ``n`` features of highest permutation importance."""
    return importances.orderBy(F.col("perm_importance_mean").desc(), "feature").limit(n)


def monitored_features(importances: DataFrame | None, feature_columns: Sequence[str], n: int = 5) -> list[str]:
    """Names to watch: the most important existing features, or the defaults when there are fewer than ``n``.

    The importance table has one row per feature; at most ``n`` names reach the driver.
    """
    if importances is None or "feature" not in importances.columns:
        return list(DEFAULT_MONITORED_FEATURES)
    allowed = [c for c in feature_columns if c not in ("msno", "is_churn", "feature_created_at")]
    usable = importances.where(F.col("feature").isin(allowed))
    ranked = top_importances(usable, n) if "perm_importance_mean" in importances.columns else usable.limit(n)
    names = [row["feature"] for row in ranked.collect()]
    return names if len(names) == n else list(DEFAULT_MONITORED_FEATURES)
