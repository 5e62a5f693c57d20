"""The weekly monitoring verdict and the retraining decision that follows from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators import monitoring as m
from tenura.operators.sampling import hash_cohort, monitoring_cohorts
from tenura.schemas import fields
from tenura.session import checkpointed
from tenura.sources.tables import rewrite_partitions

COHORT_BASELINE = "historical_baseline_window"

# The reasons of a verdict; %s stands for a threshold.
NO_BASELINE = "Insufficient baseline class coverage for AUC and no production baseline artifact found."
ONE_CLASS = "Insufficient current class coverage for AUC (requires both churn/non-churn)."
PSI_REASON = "PSI threshold breached: max_psi=%.4f (>%s)"
AUC_REASON = "AUC degradation threshold breached: delta=%.4f (>%s)"
FEW_ROWS_REASON = "Insufficient labelled samples in current window: %d < %s"
CALIBRATION_REASON = "Calibration error exceeds threshold: %.4f > %s"
SEGMENT_REASON = "Segment PSI breached (%s): %s"


def cohort_frame(
    predictions: DataFrame, features: DataFrame, train: DataFrame, as_of: datetime,
    monitored: Sequence[str] = tuple(m.DEFAULT_MONITORED_FEATURES), min_cohort_rows: int = 50,
) -> DataFrame:
    """Collapsed labelled rows with their cohort. The joins run once: their small result is written, then split."""
    frame = checkpointed(m.monitoring_frame(predictions, features, train, as_of, monitored))
    return monitoring_cohorts(frame, min_rows=min_cohort_rows, weight="n")


def _cohort_facts(frame: DataFrame) -> DataFrame:
    """Sizes, classes, squared error and score bins of both cohorts in one row, from one pass."""

    def total(column: str, cohort: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("cohort") == cohort, F.col(column))), F.lit(0))

    current = F.col("cohort") == "current"
    facts = m.score_bins(frame, "label", "score", ["cohort", "cohort_strategy"], weight="n").agg(
        F.max("cohort_strategy").alias("cohort_strategy"),
        total("rows", "baseline").alias("baseline_row_count"), total("rows", "current").alias("current_row_count"),
        total("positives", "baseline").alias("baseline_pos"), total("positives", "current").alias("current_pos"),
        F.sum(F.when(current, F.col("squares"))).alias("_squares"),
        m.bin_map(current).alias("_held"),
    )
    some = F.col("current_row_count") > 0
    gap = F.transform("calibration_bins", lambda b: F.abs(b["mean_pred"] - b["actual_rate"]))
    return (
        facts.withColumn("baseline_neg", F.col("baseline_row_count") - F.col("baseline_pos"))
        .withColumn("current_neg", F.col("current_row_count") - F.col("current_pos"))
        .withColumn("brier_score", F.try_divide(F.col("_squares"), F.col("current_row_count")))
        .withColumn("calibration_bins", F.when(some, m.calibration_list(F.col("_held"))))
        .withColumn("score_distribution", F.when(some, m.distribution_list(F.col("_held"), F.col("current_row_count"))))
        .withColumn("max_calibration_error", F.array_max(gap))
        .drop("_squares", "_held")
    )


def _long(frame: DataFrame, features: Sequence[str], segments: Sequence[str], keys: Sequence[str] = ("cohort",)) -> DataFrame:
    """(keys, n, family, name, value) of every watched feature and of the score within every segment."""
    entries = [
        F.struct(F.lit("feature").alias("family"), F.lit(f).alias("name"), F.col(f).cast("double").alias("value"))
        for f in features
    ] + [
        F.struct(F.lit("segment").alias("family"), F.concat(F.lit(f"{c}="), F.col(c).cast("string")).alias("name"),
                 F.col("score").alias("value"))
        for c in segments
    ]
    return frame.select(*keys, "n", F.inline(F.array(*entries))).where(F.col("name").isNotNull())


@dataclass(frozen=True)
class Limits:
    """What a verdict compares with."""

    reference_auc: float | None = None
    reference_source: str = "registry_production"
    min_samples: int = 1000
    psi_threshold: float = 0.2
    auc_delta_threshold: float = 0.05
    calibration_threshold: float = 0.10
    segment_threshold: float = 0.2


def monitoring_verdict(
    predictions: DataFrame,
    features: DataFrame,
    train: DataFrame,
    as_of: datetime,
    monitored: Sequence[str] = tuple(m.DEFAULT_MONITORED_FEATURES),
    reference_auc: float | None = None,
    reference_source: str = "registry_production",
    min_samples: int = 1000,
    min_cohort_rows: int = 50,
    psi_threshold: float = 0.2,
    auc_delta_threshold: float = 0.05,
    calibration_threshold: float = 0.10,
    segment_threshold: float = 0.2,
) -> DataFrame:
    """One monitoring row: cohorts, AUCs, drift, calibration, reasons and status.

    The labelled rows are collapsed, joined and written once; every metric then reads that small table. Too few
    labelled current rows give status insufficient_data without a breach, but keep the reasons found.
    """
    frame = cohort_frame(predictions, features, train, as_of, monitored, min_cohort_rows)
    limits = Limits(
        reference_auc, reference_source, min_samples, psi_threshold, auc_delta_threshold, calibration_threshold, segment_threshold)
    return _verdict_row(frame, _long(frame, monitored, m.SEGMENT_COLUMNS), as_of, limits)


STATE = "day date, hashed string, family string, name string, value double, label int, n bigint"


def daily_state(
    predictions: DataFrame, features: DataFrame, train: DataFrame, monitored: Sequence[str] = tuple(m.DEFAULT_MONITORED_FEATURES),
) -> DataFrame:
    """Counts by day of all that a verdict needs: scores with their label, feature values, scores within segments.

    Counts of several days, or of parts of a day, add up. ``hashed`` is the cohort of the customer's hash, for verdicts that
    fall back on it. The table has one row per distinct value, not per scored row.
    """
    collapsed = (
        predictions.where(F.col("churn_probability").isNotNull())
        .groupBy("customer_id", "churn_probability", F.to_date(F.col("scored_at").cast("timestamp_ntz")).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = m.labelled_predictions(collapsed, features, train, monitored, extra=("day", "n"))
    frame = checkpointed(frame.withColumn("hashed", hash_cohort("msno")))
    scores = frame.select("day", "hashed", "n", F.lit("score").alias("family"), F.lit(None).cast("string").alias("name"),
                          F.col("score").alias("value"), "label")
    long = _long(frame, monitored, m.SEGMENT_COLUMNS, ("day", "hashed")).withColumn("label", F.lit(None).cast("int"))
    keys = ["day", "hashed", "family", "name", "value", "label"]
    counted = scores.unionByName(long).groupBy(*keys).agg(F.sum("n").alias("n"))
    return counted.selectExpr(*[f"cast({n} as {t}) as {n}" for n, t in fields(STATE)])


def record_days(
    spark: SparkSession, path: str, predictions: DataFrame, features: DataFrame, train: DataFrame, first: date, last: date,
    monitored: Sequence[str] = tuple(m.DEFAULT_MONITORED_FEATURES),
) -> None:
    """Write the state of the rows scored from ``first`` up to and without ``last``; a day recorded again is replaced.

    Only these days' predictions are read. Labels and features are those known at this time.
    """
    def start(day: date) -> Column:
        return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")

    at = F.col("scored_at").cast("timestamp_ntz")
    state = daily_state(predictions.where((at >= start(first)) & (at < start(last))), features, train, monitored)
    rewrite_partitions(state.withColumn("run_date", F.col("day")), path, "run_date")


def state_verdict(
    spark: SparkSession, path: str, as_of: datetime, limits: Limits = Limits(), min_cohort_rows: int = 50,
) -> DataFrame:
    """The verdict of ``monitoring_verdict`` from the recorded days, without reading a prediction.

    ``as_of`` is a midnight, so that a day lies in one window. Days before the baseline window are only read where the
    windows hold too few rows and customers' hashes decide instead.
    """
    if as_of != datetime(as_of.year, as_of.month, as_of.day):
        raise ValueError("recorded days can be judged as of a midnight only")
    state = spark.read.schema(f"{STATE}, run_date date").parquet(path)

    def since(days: int) -> Column:
        return F.lit((as_of - timedelta(days=days)).date())

    recent = checkpointed(state.where(F.col("run_date") >= since(90)))
    window = F.when(F.col("day") >= since(7), "current").otherwise("baseline")
    sizes = {r["window"]: r["n"] for r in recent.where("family = 'score'").groupBy(window.alias("window")).agg(F.sum("n").alias("n")).collect()}
    if min(sizes.get("current", 0), sizes.get("baseline", 0)) >= min_cohort_rows:
        rows, cohort, strategy = recent, window, "time_window"
    else:
        rows, cohort, strategy = state, F.col("hashed"), "hash_fallback"
    marked = rows.select("family", "name", "value", "label", "n", cohort.alias("cohort"))
    merged = marked.groupBy("family", "name", "value", "label", "cohort").agg(F.sum("n").alias("n"))
    merged = checkpointed(merged.withColumn("cohort_strategy", F.lit(strategy)))
    scores = merged.where("family = 'score'").withColumnRenamed("value", "score")
    return _verdict_row(scores, merged.where("family <> 'score'"), as_of, limits)


def _verdict_row(frame: DataFrame, long: DataFrame, as_of: datetime, limits: Limits) -> DataFrame:
    """A verdict from counted scores (label, score, cohort, cohort_strategy, n) and values (family, name, value, cohort, n)."""
    reference_auc, min_samples, psi_threshold = limits.reference_auc, limits.min_samples, limits.psi_threshold
    auc_delta_threshold, calibration_threshold = limits.auc_delta_threshold, limits.calibration_threshold
    segment_threshold, reference_source = limits.segment_threshold, limits.reference_source
    areas = m.roc_auc(frame, "label", "score", ["cohort"], weight="n")
    area = areas.agg(F.map_from_entries(F.collect_list(F.struct("cohort", "roc_auc"))).alias("by_cohort")).scalar()
    drift = m.psi(long, "value", ["family", "name"], weight="n")
    named = F.struct("name", "psi")
    drift_maps = drift.agg(F.struct(
        F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("family") == "feature", named)))).alias("feature"),
        F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("family") == "segment", named)))).alias("segment"),
    )).scalar()
    any_rows = F.col("current_row_count") > 0

    def day(days: int) -> Column:
        return F.lit(as_of - timedelta(days=days)).cast("timestamp")

    given = F.lit(reference_auc).cast("double")
    baseline_ok = (F.col("baseline_pos") > 0) & (F.col("baseline_neg") > 0)
    current_ok = (F.col("current_pos") > 0) & (F.col("current_neg") > 0)
    row = (
        _cohort_facts(frame)
        .withColumn("_areas", area)
        .withColumn("_drift", drift_maps)
        .withColumn("baseline_auc", F.coalesce(given, F.try_element_at("_areas", F.lit("baseline"))))
        .withColumn("baseline_auc_source", F.lit(reference_source if reference_auc is not None else COHORT_BASELINE))
        .withColumn("current_auc", F.when(
            F.col("baseline_auc").isNotNull() & current_ok, F.try_element_at("_areas", F.lit("current"))))
        .withColumn("auc_delta", F.col("baseline_auc") - F.col("current_auc"))
        .withColumn("psi_by_feature", F.col("_drift.feature"))
        .withColumn("segment_psi", F.when(any_rows, F.col("_drift.segment")))
        .withColumn("max_psi", F.coalesce(
            F.array_max(F.filter(F.map_values("psi_by_feature"), lambda v: v.isNotNull() & ~F.isnan(v))), F.lit(0.0)))
    )
    insufficient = F.col("current_row_count") < min_samples
    over = F.transform(
        F.filter(
            F.map_entries(F.coalesce("segment_psi", F.create_map().cast("map<string,double>"))),
            lambda e: ~F.isnan(e["value"]) & (e["value"] > segment_threshold),
        ),
        lambda e: e["key"],
    )
    enough = ~insufficient

    def reason(condition: Column, text: str, *values) -> Column:
        return F.when(condition, F.format_string(text, *values) if values else F.lit(text))

    reasons = F.array(
        reason(F.col("baseline_auc").isNull() & ~baseline_ok, NO_BASELINE),
        reason(~current_ok, ONE_CLASS),
        reason(F.col("max_psi") > psi_threshold, PSI_REASON, "max_psi", F.lit(str(psi_threshold))),
        reason(F.col("auc_delta") > auc_delta_threshold, AUC_REASON, "auc_delta", F.lit(str(auc_delta_threshold))),
        reason(insufficient, FEW_ROWS_REASON, "current_row_count", F.lit(str(min_samples))),
        reason(enough & (F.col("max_calibration_error") > calibration_threshold), CALIBRATION_REASON,
               "max_calibration_error", F.lit(str(calibration_threshold))),
        reason(enough & (F.size("breached_segments") > 0), SEGMENT_REASON, F.lit(str(segment_threshold)),
               F.array_join("breached_segments", ", ")),
    )
    return (
        row.withColumn("breached_segments", F.sort_array(over))
        .withColumn("reasons", F.array_compact(reasons))
        .withColumn("breached", ~insufficient & (F.size("reasons") > 0))
        .withColumn("status", F.when(insufficient, "insufficient_data").when(F.col("breached"), "breached").otherwise("ok"))
        .select(
            F.lit(as_of).cast("timestamp").alias("monitored_at"),
            day(90).alias("baseline_window_start"), day(7).alias("baseline_window_end"),
            day(7).alias("current_window_start"), day(0).alias("current_window_end"),
            "baseline_auc", "baseline_auc_source", "current_auc", "auc_delta", "max_psi", "breached",
            F.when(F.size("reasons") > 0, F.array_join("reasons", "; ")).alias("breached_reasons"),
            "psi_by_feature", "cohort_strategy", "baseline_row_count", "current_row_count", "status", "brier_score",
            "max_calibration_error", "calibration_bins", "score_distribution", "segment_psi", "breached_segments",
            F.col("current_row_count").alias("labeled_sample_count"), F.lit(min_samples).alias("min_sample_threshold"),
        )
    )


def retrain_decision(
    monitoring_log: DataFrame, psi_threshold: float = 0.2, auc_delta_threshold: float = 0.05
) -> DataFrame:
    """Decision from the newest monitoring row; an empty log and insufficient data skip retraining.

    Only feature drift and AUC loss count; calibration and segment breaches do not retrain.
    """
    fields = [c for c in ("status", "breached", "max_psi", "auc_delta", "monitored_at") if c in monitoring_log.columns]
    newest = monitoring_log.agg(F.max_by(F.struct(*fields), "monitored_at").alias("row")).select("row.*")
    by_flag = F.when(F.col("breached"), "breached").otherwise("ok")
    status = F.lower(F.coalesce(F.col("status"), by_flag)) if "status" in fields else by_flag
    drifted = (F.coalesce("max_psi", F.lit(0.0)) > psi_threshold) | F.coalesce(
        F.col("auc_delta") > auc_delta_threshold, F.lit(False)
    )
    empty = F.col("monitored_at").isNull()
    return (
        newest.withColumn("status", F.when(~empty, status))
        .withColumn("should_retrain", ~empty & (F.col("status") != "insufficient_data") & drifted)
        .select(
            "monitored_at", "status", "max_psi", "auc_delta",
            F.coalesce("should_retrain", F.lit(False)).alias("should_retrain"),
            F.when(F.col("should_retrain"), "retrain_if_needed").otherwise("skip_retraining").alias("decision"),
            F.when(empty, "no_monitoring_rows")
            .when(F.col("status") == "insufficient_data", "insufficient_labeled_samples")
            .when(F.col("should_retrain"), "drift_or_degradation")
            .otherwise("within_thresholds").alias("reason"),
        )
    )
