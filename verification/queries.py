"""Registered queries: every operator over the whole derived tables of one data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenura.functions import dates, labels
from tenura.functions.dates import int_from_date
from tenura.operators import (
    attributions, catalog, cleanse, dashboard, errors, explore, fairness, features, latest, modeling, monitoring,
    promotion, quality, resampling, sampling,
)
from tenura.plans import build, bundle, operations, scoring
from tenura.plans import monitoring as plan_monitoring
from tenura.plans import training as training_plans
from tenura.schemas import MODEL_FEATURES, PREDICTION_SCHEMA, RAW_SCHEMAS, VALIDATION_SCHEMA, fields
from tenura.session import checkpointed, scratch_folder
from tenura.sources import csv, tables
from tenura.sources.retail import AS_OF, RetailViews
from verification.compare import presented

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register a function of RetailViews as a query of (spark, folder) with plain output types."""

    def register(build: Callable[[RetailViews], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return presented(build(RetailViews(spark, folder)))

        QUERIES[name] = run
        return build

    return register


def feature_table(v: RetailViews) -> DataFrame:
    return features.customer_features(v.train, v.members, v.transactions, v.user_logs)


# Features and cleansing ------------------------------------------------------------------------------------------


@query("customer_features")
def _(v):
    return feature_table(v)


@query("transaction_features")
def _(v):
    return features.transaction_features(v.transactions)


@query("activity_features")
def _(v):
    return features.activity_features(v.user_logs)


@query("latest_transaction")
def _(v):
    return features.latest_transactions(v.transactions)


@query("raw_layout_features")
def _(v):
    """The feature table from transactions as the loader leaves them, without an id."""
    return features.customer_features(v.train, v.members, v.transactions.drop("txn_id"), v.user_logs)


@query("raw_layout_rollup")
def _(v):
    return cleanse.transaction_rollup(cleanse.merge_rare_payment_methods(v.transactions.drop("txn_id")))


@query("raw_layout_latest")
def _(v):
    return features.latest_transactions(v.transactions.drop("txn_id"))


# Files and stored tables -------------------------------------------------------------------------------------------


def loaded_folder(v: RetailViews) -> str:
    """The raw tables written as CSV and loaded from there."""
    files, folder = {}, scratch_folder(v.spark, "csv")
    for name in ("train", "members", "transactions"):
        csv.write_csv(getattr(v, name), f"{folder}/in/{name}", [n for n, _ in fields(RAW_SCHEMAS[name])])
        files[name] = name
    csv.load_raw(v.spark, f"{folder}/in", f"{folder}/raw", files, AS_OF).collect()
    return f"{folder}/raw"


@query("csv_load")
def _(v):
    return v.spark.read.parquet(f"{loaded_folder(v)}/transactions").drop("ingestion_timestamp")


@query("csv_scan_filter")
def _(v):
    path = f"{scratch_folder(v.spark, 'csv')}/members"
    csv.write_csv(v.members, path)
    return csv.read_matching(v.spark, path, RAW_SCHEMAS["members"], F.col("gender").isNull() & (F.col("bd") > 50))


@query("loaded_layout_features")
def _(v):
    """CSV files, loaded and turned into features without any added column."""
    raw = loaded_folder(v)
    train, members, transactions = [v.spark.read.parquet(f"{raw}/{n}") for n in ("train", "members", "transactions")]
    return features.customer_features(train, members, transactions, v.user_logs)


@query("replaced_table")
def _(v):
    """A table loaded twice: readers see the second version whole."""
    path = f"{scratch_folder(v.spark, 'table')}/members"
    tables.replace_table(v.members.where("bd < 0"), path)
    tables.replace_table(v.members, path)
    return tables.read_current(v.spark, path)


@query("appended_log")
def _(v):
    """A log written in two appends and read with its known layout."""
    path = f"{scratch_folder(v.spark, 'log')}/predictions"
    rows = v.predictions.select("pred_id", "customer_id", "churn_probability", "scored_at")
    for part in (rows.where("pred_id % 2 = 0"), rows.where("pred_id % 2 = 1")):
        tables.append_log(part, path, "scored_at")
    return tables.read_log(v.spark, path, "pred_id bigint, customer_id string, churn_probability double, scored_at timestamp_ntz")


def built(v: RetailViews) -> build.Warehouse:
    """A warehouse with one feature build."""
    warehouse = build.Warehouse(scratch_folder(v.spark, "warehouse"))
    build.build_features(v.spark, warehouse, v.train, v.members, v.transactions, v.user_logs, "r1", AS_OF)
    return warehouse


@query("feature_build")
def _(v):
    """The snapshot log of a build, joined with the rows that the published table has."""
    warehouse = built(v)
    rows = tables.read_current(v.spark, warehouse.path("customer_features")).agg(F.count(F.lit(1)).alias("published")).scalar()
    log = tables.read_log(v.spark, warehouse.path("feature_snapshots"))
    return log.select("status", "pipeline_run_id", "row_count", "feature_count").withColumn("published", rows)


@query("recorded_watermark")
def _(v):
    warehouse = built(v)
    build.record_watermark(v.spark, warehouse, "customer_features", "r1")
    build.record_watermark(v.spark, warehouse, "customer_features", "r2")
    log = tables.read_log(v.spark, warehouse.path("data_watermarks"))
    return log.select("watermark_id", "table_name", "row_count", "pipeline_run_id")


@query("validation_log")
def _(v):
    """Two runs of the default rules over the same tables; the second has the first as its baseline."""
    path, checked = scratch_folder(v.spark, "validation"), rule_tables(v)
    for run in ("a", "b"):
        operations.validate_and_log(v.spark, checked, quality.DEFAULT_RULE_SET, path, run, AS_OF)
    log = tables.read_log(v.spark, path, VALIDATION_SCHEMA)
    return log.groupBy("rule_name", "severity", "status").agg(F.count_distinct("run_id").alias("runs"))


@query("prediction_log")
def _(v):
    """Two scoring runs in the log; the newest one has its top attributions written back."""
    path = scratch_folder(v.spark, "predictions")
    table = checkpointed(feature_table(v))
    model = modeling.fit(table, MODEL_FEATURES, modeling.LOGISTIC)
    made = bundle.bundle(model, table, MODEL_FEATURES, "1", {})
    for day in (0, 1):
        scoring.score_and_append(path, table, made.model, made.input_columns, AS_OF + timedelta(days=day), "snapshot", made.version)
    operations.attribute_newest_scores(v.spark, path, table, table, made)
    log = tables.read_log(v.spark, path, PREDICTION_SCHEMA)
    return log.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.size("shap_values") == 5).alias("explained"))


@query("monitoring_log")
def _(v):
    folder = scratch_folder(v.spark, "monitoring")
    operations.register(v.spark, f"{folder}/versions", "churn", "r1", {"roc_auc": 0.75, "business": None}, None, AS_OF)
    operations.monitor_and_log(
        v.spark, f"{folder}/log", f"{folder}/versions", "churn", v.predictions, feature_table(v), v.train, AS_OF)
    log = tables.read_log(v.spark, f"{folder}/log")
    return log.select("baseline_auc", "current_auc", "baseline_row_count", "current_row_count", "status")


@query("payment_method_recode")
def _(v):
    return cleanse.merge_rare_payment_methods(v.transactions).select("txn_id", "payment_method_id")


@query("age_cleaning")
def _(v):
    return cleanse.clean_age(v.members).select("msno", "bd")


@query("date_parse_and_parts")
def _(v):
    rollup = cleanse.member_transactions(v.train, v.members, v.transactions)
    parts = [p for c in cleanse.DATE_COLUMNS for p in dates.date_parts(c)]
    return rollup.select("msno", *cleanse.DATE_COLUMNS, *parts)


@query("transaction_rollup")
def _(v):
    return cleanse.transaction_rollup(cleanse.merge_rare_payment_methods(v.transactions))


@query("training_table")
def _(v):
    return cleanse.training_table(v.train, v.members, v.transactions)


@query("rule_driven_members")
def _(v):
    return cleanse.apply_rules(v.members, cleanse.DEFAULT_RULES["members"])


@query("rule_driven_train")
def _(v):
    return cleanse.apply_rules(v.train, cleanse.DEFAULT_RULES["train"])


@query("rule_driven_user_logs")
def _(v):
    return cleanse.apply_rules(v.user_logs, cleanse.DEFAULT_RULES["user_logs"])


@query("rule_driven_transactions")
def _(v):
    return cleanse.apply_rules(v.transactions, cleanse.DEFAULT_RULES["transactions"])


# Dashboard ---------------------------------------------------------------------------------------------------------


@query("latest_prediction")
def _(v):
    return latest.latest_predictions(v.predictions)


@query("risk_tier_labels")
def _(v):
    return v.predictions.select(
        "pred_id", labels.risk_tier("churn_probability").alias("risk_tier"),
        labels.score_bucket("churn_probability").alias("bucket"), F.lit("v1").alias("threshold_version"),
    )


@query("segment_labels")
def _(v):
    return feature_table(v).select(
        "msno",
        labels.payment_behavior("latest_is_auto_renew").alias("payment_behavior"),
        labels.cancel_history("cancel_count").alias("cancel_history"),
        labels.usage_intensity("num_active_days").alias("usage_intensity"),
        labels.tenure("transaction_count").alias("tenure"),
        labels.has_cancel_history("cancel_count").alias("has_cancel_history"),
        labels.age_band("bd").alias("age_band"),
    )


@query("lenient_numbers")
def _(v):
    # Priorities such as "1-URGENT" are text; their first character is a number and the whole is not.
    priority = F.col("o_orderpriority")
    return v.read("orders").select(
        "o_orderkey", labels.numeric(priority).alias("whole"), labels.numeric(F.substring(priority, 1, 1)).alias("lead")
    )


@query("lenient_dates")
def _(v):
    code = (F.col("o_orderkey") % 13 * 100 + F.col("o_orderkey") % 32 + 20000000).cast("int")
    return v.read("orders").select("o_orderkey", dates.date_from_int(code, lenient=True).alias("day"))


@query("portfolio_counts")
def _(v):
    return dashboard.portfolio_counts(v.predictions)


@query("score_buckets")
def _(v):
    return dashboard.score_buckets(v.predictions)


@query("segment_breakdown")
def _(v):
    return dashboard.segment_breakdown(v.predictions, feature_table(v))


TOP_FEATURES = ["latest_membership_expire_date", "avg_plan_days", "unlisted_feature"]


@query("retention_queue")
def _(v):
    queue = dashboard.retention_queue(v.predictions, feature_table(v), default_features=TOP_FEATURES)
    rank = F.row_number().over(Window.orderBy(F.col("churn_probability").desc(), "customer_id"))
    return queue.withColumn("rank", rank).select("rank", *QUEUE_COLUMNS)


QUEUE_COLUMNS = [
    "customer_id", "churn_probability", "risk_tier", "scored_at", "customer_segment", "intervention_priority",
    "recommended_action", "business_explanations",
]


@query("retention_queue_filtered")
def _(v):
    return dashboard.retention_queue(
        v.predictions, feature_table(v), "Medium", "Low Engagement", TOP_FEATURES
    ).select(*QUEUE_COLUMNS)


@query("queue_summary")
def _(v):
    return dashboard.queue_summary(dashboard.retention_queue(v.predictions, feature_table(v)))


@query("customer_cards")
def _(v):
    cards = dashboard.customer_cards(v.predictions, feature_table(v), TOP_FEATURES)
    return cards.select(*QUEUE_COLUMNS, *dashboard.CARD_FEATURES)


@query("customer_card")
def _(v):
    newest = v.predictions.agg(F.max_by("customer_id", "pred_id").alias("customer_id")).scalar()
    return dashboard.customer_card(v.predictions, feature_table(v), newest, TOP_FEATURES).select(
        *QUEUE_COLUMNS, *dashboard.CARD_FEATURES
    )


@query("attribution_input")
def _(v):
    joined = dashboard.with_features(latest.latest_predictions(v.predictions), feature_table(v), "inner")
    return joined.select("customer_id", "churn_probability", "risk_tier", "scored_at", *MODEL_FEATURES)


@query("tier_sample_customers")
def _(v):
    return attributions.tier_samples(latest.latest_predictions(v.predictions))


# Exploration -------------------------------------------------------------------------------------------------------


def training(v: RetailViews) -> DataFrame:
    return cleanse.training_table(v.train, v.members, v.transactions)


@query("churn_rate")
def _(v):
    return explore.churn_rate(training(v))


@query("churn_rate_by_city")
def _(v):
    return explore.churn_rate_by(training(v), "city")


@query("churn_rate_by_plan_days")
def _(v):
    return explore.churn_rate_by(training(v).withColumn("avg_plan_days", F.round("avg_plan_days", 6)), "avg_plan_days")


@query("churn_rate_by_payment_method")
def _(v):
    return explore.churn_rate_by(training(v), "payment_method_id")


@query("value_counts_members")
def _(v):
    return explore.value_counts(v.members, ["city", "gender", "registered_via"])


@query("value_counts_payments")
def _(v):
    before = explore.value_counts(v.transactions, ["payment_method_id", "is_auto_renew"]).withColumn("stage", F.lit("before"))
    after = explore.value_counts(cleanse.merge_rare_payment_methods(v.transactions), ["payment_method_id"])
    return before.unionByName(after.withColumn("stage", F.lit("after")))


@query("label_counts")
def _(v):
    return explore.value_counts(v.train, ["is_churn"])


@query("histograms")
def _(v):
    return explore.histogram(v.transactions, ["payment_plan_days", "plan_list_price", "actual_amount_paid"])


@query("box_statistics")
def _(v):
    before = explore.box_statistics(v.members.select("bd"), ["bd"]).withColumn("stage", F.lit("before"))
    after = explore.box_statistics(cleanse.clean_age(v.members).select("bd"), ["bd"]).withColumn("stage", F.lit("after"))
    price = explore.box_statistics(v.transactions, ["plan_list_price"]).withColumn("stage", F.lit("raw"))
    return before.unionByName(after).unionByName(price)


@query("variance_ranking")
def _(v):
    table = training(v)
    ranking = explore.variance_ranking(table, explore.numeric_columns(table, ["is_churn"]))
    return ranking.withColumn("variance", F.round("variance", 2))


CORRELATED = [
    "bd", "last_plan_days", "last_plan_price", "no_of_transactions", "membership_duration_days", "transaction_span_days",
    "avg_plan_price", "avg_plan_days", "amount_due",
]


@query("correlation_matrix")
def _(v):
    return explore.correlation_matrix(training(v), CORRELATED)


@query("null_counts")
def _(v):
    return explore.null_counts(feature_table(v))


@query("duplicate_rows")
def _(v):
    return explore.duplicate_rows(v.transactions, "msno")


@query("describe")
def _(v):
    return explore.describe(v.transactions, ["payment_plan_days", "plan_list_price", "actual_amount_paid", "transaction_date"])


@query("coverage")
def _(v):
    return explore.coverage(v.train, feature_table(v))


# Labelled cases ----------------------------------------------------------------------------------------------------


def cases(v: RetailViews) -> DataFrame:
    """Scored rows of labelled customers with their features; 0.5 separates the predicted classes."""
    joined = dashboard.with_features(v.predictions, feature_table(v), "inner")
    return labels.case_columns(joined, "is_churn", "churn_probability")


@query("prediction_cases")
def _(v):
    return cases(v).select("pred_id", "customer_id", "actual", "predicted", "is_misclassified", "error_type")


def collapsed(v: RetailViews, keys=()) -> DataFrame:
    return errors.collapsed_cases(v.predictions, feature_table(v), keys=keys)


def collapsed_scores(v: RetailViews, keys=()) -> DataFrame:
    """Scored rows of labelled customers collapsed to (customer, score), with ``actual`` and ``n``."""
    counted = v.predictions.groupBy("customer_id", "churn_probability", *keys).agg(F.count(F.lit(1)).alias("n"))
    known = feature_table(v).select(F.col("msno").alias("customer_id"), F.col("is_churn").cast("int").alias("actual"))
    return counted.join(known, "customer_id")


@query("confusion_counts")
def _(v):
    return errors.confusion_counts(collapsed(v), weight="n")


@query("classification_metrics")
def _(v):
    area = monitoring.roc_auc(collapsed_scores(v), "actual", "churn_probability", weight="n", strict=True)
    return errors.classification_metrics(collapsed(v), weight="n").withColumn("roc_auc", area.select("roc_auc").scalar())


@query("class_weights")
def _(v):
    return errors.class_weights(v.train)


PROFILED = ["bd", "transaction_count", "total_amount_paid", "avg_plan_days", "num_active_days", "avg_total_secs"]


@query("numeric_error_profile")
def _(v):
    return errors.numeric_error_profile(collapsed(v), PROFILED, weight="n")


@query("categorical_error_profile")
def _(v):
    return errors.categorical_error_profile(
        collapsed(v), ["city", "gender", "registered_via", "latest_payment_method_id"], weight="n")


@query("error_insights")
def _(v):
    scored = checkpointed(collapsed(v))
    return errors.error_insights(
        errors.numeric_error_profile(scored, PROFILED, weight="n"),
        errors.categorical_error_profile(scored, ["city", "gender"], weight="n"),
        errors.confusion_counts(scored, weight="n"),
    )


@query("fairness_by_gender")
def _(v):
    return fairness.group_fairness(collapsed(v), "gender", weight="n")


@query("fairness_by_age_band")
def _(v):
    return fairness.group_fairness(collapsed(v), "age_band", weight="n")


@query("fairness_gaps")
def _(v):
    scored = checkpointed(collapsed(v))
    gaps = [
        fairness.fairness_gap(fairness.group_fairness(scored, g, weight="n")).select(F.lit(g).alias("group"), "fairness_gap")
        for g in ("gender", "age_band")
    ]
    return gaps[0].unionByName(gaps[1])


@query("training_date_range")
def _(v):
    return fairness.training_date_range(v.predictions, "scored_at")


# Sampling ----------------------------------------------------------------------------------------------------------


@query("stratified_sample")
def _(v):
    return sampling.stratified_sample(v.train, "msno", "is_churn", 0.2, 42)


@query("sampled_transactions")
def _(v):
    chosen = sampling.stratified_sample(v.train, "msno", "is_churn", 0.2, 42)
    return sampling.keep_sampled(v.transactions, chosen).select("txn_id", "msno")


@query("simple_sample")
def _(v):
    return sampling.simple_sample(v.train, 100, "msno")


@query("train_validation_split")
def _(v):
    return sampling.train_validation_split(v.train)


@query("hash_cohorts")
def _(v):
    return v.predictions.select(
        "pred_id", labels.stable_bucket("customer_id").alias("bucket"), sampling.hash_cohort("customer_id").alias("cohort")
    )


@query("monitoring_cohorts")
def _(v):
    scored = monitoring.labelled_predictions(v.predictions, feature_table(v), v.train, extra=("pred_id", "scored_at"))
    windowed = scored.select("pred_id", "msno", sampling.time_cohort("scored_at", AS_OF).alias("window"))
    return sampling.monitoring_cohorts(checkpointed(windowed)).select("pred_id", "msno", "cohort", "cohort_strategy")


# Monitoring --------------------------------------------------------------------------------------------------------


def cohort_frame(v: RetailViews) -> DataFrame:
    return plan_monitoring.cohort_frame(v.predictions, feature_table(v), v.train, AS_OF)


@query("labelled_predictions")
def _(v):
    return monitoring.labelled_predictions(v.predictions, feature_table(v), v.train, extra=("pred_id", "scored_at"))


@query("roc_auc_by_cohort")
def _(v):
    return monitoring.roc_auc(cohort_frame(v), "label", "score", ["cohort"], weight="n")


@query("roc_points")
def _(v):
    return monitoring.roc_points(collapsed_scores(v), "actual", "churn_probability", weight="n")


@query("calibration_bins")
def _(v):
    return monitoring.calibration_bins(collapsed_scores(v), "actual", "churn_probability", weight="n")


@query("max_calibration_error")
def _(v):
    return monitoring.max_calibration_error(monitoring.calibration_bins(collapsed_scores(v), "actual", "churn_probability", weight="n"))


@query("brier_score")
def _(v):
    return monitoring.brier_score(collapsed_scores(v), "actual", "churn_probability", weight="n")


@query("score_distribution")
def _(v):
    return monitoring.score_distribution(v.predictions, "churn_probability")


@query("feature_psi")
def _(v):
    return monitoring.feature_psi(cohort_frame(v), monitoring.DEFAULT_MONITORED_FEATURES, weight="n")


@query("segment_psi")
def _(v):
    return monitoring.segment_psi(cohort_frame(v), weight="n")


@query("max_feature_psi")
def _(v):
    return monitoring.max_finite_psi(monitoring.feature_psi(cohort_frame(v), monitoring.DEFAULT_MONITORED_FEATURES, weight="n"))


@query("breached_segments")
def _(v):
    return monitoring.breached_segments(monitoring.segment_psi(cohort_frame(v), weight="n"), threshold=0.01)


@query("sample_guard")
def _(v):
    return monitoring.insufficient_data(cohort_frame(v), weight="n")


@query("score_psi")
def _(v):
    return monitoring.psi(cohort_frame(v), "score", weight="n")


def verdict_row(v: RetailViews) -> DataFrame:
    return plan_monitoring.monitoring_verdict(v.predictions, feature_table(v), v.train, AS_OF)


@query("monitoring_verdict")
def _(v):
    return verdict_row(v).select(
        "baseline_auc", "baseline_auc_source", "current_auc", "auc_delta", "max_psi", "breached", "breached_reasons",
        "cohort_strategy", "baseline_row_count", "current_row_count", "status", "brier_score", "max_calibration_error",
        "breached_segments", "min_sample_threshold", F.size("calibration_bins").alias("bins"),
    )


@query("retrain_decision")
def _(v):
    return plan_monitoring.retrain_decision(verdict_row(v)).drop("monitored_at")


@query("monitoring_status")
def _(v):
    return dashboard.monitoring_status(verdict_row(v)).withColumn("monitored_at", F.col("monitored_at").cast("timestamp_ntz"))


# Quality rules -----------------------------------------------------------------------------------------------------


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_timestamp", F.lit("2024-01-25 06:00:00").cast("timestamp_ntz"))


def rule_tables(v: RetailViews) -> dict[str, DataFrame]:
    return {
        "processed.customer_features": checkpointed(feature_table(v)).withColumn(
            "feature_created_at", F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")),
        "processed.churn_predictions": v.predictions,
        "processed.feature_snapshots": snapshots(v),
        "raw.members": stamped(v.members),
        "raw.transactions": stamped(v.transactions),
        "raw.user_logs": v.read("events").select(F.col("ts").alias("ingestion_timestamp")),
        "raw.train": stamped(v.train),
    }


@query("quality_rule_set")
def _(v):
    return quality.run_rules(v.spark, rule_tables(v), quality.DEFAULT_RULE_SET, AS_OF).drop("detail")


@query("quality_verdict")
def _(v):
    return quality.verdict(quality.run_rules(v.spark, rule_tables(v), quality.DEFAULT_RULE_SET, AS_OF))


def number(name: str):
    return F.get_json_object("detail", f"$.{name}").cast("double").alias(name)


@query("freshness_rules")
def _(v):
    rule_set = {"freshness": [
        {"table": "predictions", "timestamp_column": "scored_at", "max_age_hours": hours} for hours in (24, 48, 0.5)
    ]}
    rows = quality.run_rules(v.spark, {"predictions": v.predictions}, rule_set, AS_OF)
    return rows.select("position", "rule_name", "severity", "status", number("age_hours"), number("row_count"))


@query("coverage_rules")
def _(v):
    rule_set = {"coverage": [
        {"table": "features", "column": c, "min_non_null_ratio": 0.88}
        for c in ("msno", "city", "gender", "transaction_count", "num_active_days")
    ]}
    rows = quality.run_rules(v.spark, {"features": feature_table(v)}, rule_set, AS_OF)
    return rows.select("rule_name", "status", number("non_null_ratio"), number("non_null_count"))


@query("smoke_rules")
def _(v):
    rule_set = {"smoke": [
        {"rule_name": "rows", "kind": "row_count_positive", "table": "transactions"},
        {"rule_name": "match", "kind": "row_count_match", "left_table": "members", "right_table": "train"},
        {"rule_name": "channel", "kind": "value_in_set", "table": "members", "column": "registered_via", "allowed_values": [3, 4, 7, 9]},
        {"rule_name": "gender", "kind": "value_in_set", "table": "members", "column": "gender", "allowed_values": ["male", "female"]},
        {"rule_name": "unique_member", "kind": "unique_column", "table": "members", "column": "msno"},
        {"rule_name": "unique_payer", "kind": "unique_column", "table": "transactions", "column": "msno"},
        {"rule_name": "age", "kind": "numeric_range", "table": "members", "column": "bd", "min": 18, "max": 90},
        {"rule_name": "paid", "kind": "numeric_range", "table": "transactions", "column": "actual_amount_paid", "min": 0, "allow_null": False},
        {"rule_name": "odd", "kind": "no_such_kind"},
    ]}
    tables = {"transactions": v.transactions, "members": v.members, "train": v.train}
    rows = quality.run_rules(v.spark, tables, rule_set, AS_OF)
    observed = F.coalesce(*[
        F.get_json_object("detail", f"$.{n}") for n in ("violations", "duplicates", "left_count", "row_count")
    ]).cast("bigint")
    return rows.select("position", "rule_name", "severity", "status", observed.alias("observed"))


def half_logs(v: RetailViews, late: bool) -> DataFrame:
    return v.user_logs.where((F.col("date") > 20240115) == F.lit(late))


DRIFT_COLUMNS = ["total_secs", "num_unq", "num_100"]


def drift_log(v: RetailViews) -> DataFrame:
    """A results log written by the rules themselves: the first half of the activity logs as an earlier run."""
    rule_set = {"distribution": {"table": "logs", "numeric_columns": DRIFT_COLUMNS}}
    first = quality.run_rules(v.spark, {"logs": half_logs(v, False)}, rule_set, AS_OF)
    return quality.stamped_results(first, "first", AS_OF)


@query("distribution_rules")
def _(v):
    rule_set = {"distribution": {"table": "logs", "numeric_columns": DRIFT_COLUMNS, "deviation_threshold": 0.01}}
    rows = quality.run_rules(v.spark, {"logs": half_logs(v, True)}, rule_set, AS_OF, drift_log(v))
    return rows.select("rule_name", "status", number("mean"), number("std"), number("n"), number("deviation"))


def daily_results(v: RetailViews) -> DataFrame:
    """A results log with one run per day of predictions: tier and snapshot rules over that day's rows."""
    day = F.to_date("scored_at")
    per_day = v.predictions.groupBy(day.alias("day")).agg(
        F.avg((F.col("risk_tier") == "High").cast("int")).alias("high_share"),
        F.avg(F.col("feature_snapshot_id").isNotNull().cast("int")).alias("linked_share"),
    )
    rules = F.array(
        F.struct(F.lit("high_share").alias("rule_name"), F.lit("blocking").alias("severity"),
                 F.when(F.col("high_share") <= 0.06, "pass").otherwise("fail").alias("status")),
        F.struct(F.lit("linked_share").alias("rule_name"), F.lit("blocking").alias("severity"),
                 F.when(F.col("linked_share") >= 0.85, "pass").otherwise("fail").alias("status")),
        F.struct(F.lit("linked_warning").alias("rule_name"), F.lit("warning").alias("severity"),
                 F.when(F.col("linked_share") >= 0.86, "pass").otherwise("fail").alias("status")),
    )
    return per_day.select(
        F.concat(F.lit("run-"), F.col("day").cast("string")).alias("run_id"),
        F.col("day").cast("timestamp_ntz").alias("created_at"), F.inline(rules),
    )


@query("newest_run_results")
def _(v):
    return quality.newest_run(daily_results(v))


@query("blocking_failure_history")
def _(v):
    return quality.blocking_failure_history(daily_results(v))


@query("run_verdicts")
def _(v):
    return quality.verdict(daily_results(v))


@query("build_checks")
def _(v):
    return quality.build_checks(feature_table(v), v.train)


# Lineage and versions ----------------------------------------------------------------------------------------------


def snapshots(v: RetailViews) -> DataFrame:
    """One snapshot per scored day; a day with few rows failed."""
    return v.predictions.groupBy(int_from_date("scored_at").alias("day")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("scored_at").alias("build_completed_at")
    ).select(
        F.concat(F.lit("snap-"), F.col("day").cast("string")).alias("snapshot_id"), "row_count", "build_completed_at",
        F.when(F.col("day") % 4 == 0, "failed").otherwise("completed").alias("status"),
    )


@query("current_snapshot")
def _(v):
    return catalog.current_snapshot(snapshots(v))


@query("newest_snapshot_row")
def _(v):
    newest = latest.newest_rows(snapshots(v), ["build_completed_at"])
    return newest.withColumn("row_count", F.col("row_count").cast("int"))


def lineage(v: RetailViews) -> DataFrame:
    return catalog.lineage_rows(
        catalog.feature_registry(v.spark), catalog.current_snapshot(snapshots(v)).scalar(),
        snapshots(v).agg(F.max("build_completed_at").alias("at")).scalar(),
    )


@query("lineage_rows")
def _(v):
    return lineage(v)


@query("lineage_completeness")
def _(v):
    """The stored feature table against the stored lineage log."""
    folder = scratch_folder(v.spark, "lineage")
    tables.replace_table(feature_table(v).withColumn("feature_created_at", F.current_timestamp()), f"{folder}/features")
    tables.append_log(lineage(v), f"{folder}/log", "created_at")
    return catalog.lineage_completeness(tables.read_current(v.spark, f"{folder}/features"), tables.read_log(v.spark, f"{folder}/log"))


@query("linked_rows")
def _(v):
    return catalog.linked_rows(lineage(v), v.predictions)


@query("provenance_triples")
def _(v):
    return catalog.provenance_triples(v.predictions, 40)


@query("content_hash")
def _(v):
    return catalog.content_hash(v.transactions)


@query("feature_table_hash")
def _(v):
    return catalog.content_hash(feature_table(v))


@query("attribution_update")
def _(v):
    """A keyed update: new values for customers of the High tier, all other rows as they were."""
    old = v.predictions.withColumn("note", F.lit("old"))
    new = v.predictions.where(F.col("risk_tier") == "High").select(
        "customer_id", "scored_at", F.concat(F.lit("new-"), F.col("model_version")).alias("note")
    ).groupBy("customer_id", "scored_at").agg(F.max("note").alias("note"))
    return tables.keyed_update(old, new, ["customer_id", "scored_at"], ["note"]).select("pred_id", "customer_id", "note")


def version_metrics(v: RetailViews) -> DataFrame:
    """AUC and precision of each model version on its labelled predictions."""
    keys = ["model_version"]
    area = monitoring.roc_auc(collapsed_scores(v, keys), "actual", "churn_probability", keys, weight="n")
    return errors.classification_metrics(collapsed(v, keys), keys, weight="n").join(area, "model_version")


@query("promotion_gate")
def _(v):
    metrics = checkpointed(version_metrics(v).select("model_version", "roc_auc", "precision_churn"))
    champion = metrics.select(
        F.concat(F.lit("v"), (F.substring("model_version", 2, 9).cast("int") + 1).cast("string")).alias("model_version"),
        F.col("roc_auc").alias("champion_auc"), F.col("precision_churn").alias("champion_business"),
    )
    pairs = metrics.withColumnsRenamed({"roc_auc": "challenger_auc", "precision_churn": "challenger_business"})
    return promotion.gate_columns(pairs.join(champion, "model_version", "left"), tolerance=0.001)


@query("current_production_version")
def _(v):
    """A version log with one state per model version and day; the highest version that is live at the end."""
    day = int_from_date("scored_at")
    log = v.predictions.groupBy(
        F.lit("churn").alias("model_name"), F.substring("model_version", 2, 9).cast("int").alias("version"), day.alias("day")
    ).agg(F.max("scored_at").alias("logged_at"), F.avg(F.col("churn_probability").cast("double")).alias("roc_auc")).select(
        "model_name", "version", "logged_at", "roc_auc",
        F.when((F.col("day") + F.col("version")) % 2 == 0, "Production").otherwise("Archived").alias("stage"),
        F.lit("champion").alias("role"), F.concat(F.lit("run-"), F.col("day").cast("string")).alias("run_id"),
    )
    return promotion.current_production(log, "churn")


# Models --------------------------------------------------------------------------------------------------------------

def split(v: RetailViews) -> training_plans.Split:
    return training_plans.split_features(feature_table(v))


@query("imputation_values")
def _(v):
    return modeling.fill_values(feature_table(v), MODEL_FEATURES)


def metrics_of(v: RetailViews, kind: str, **params) -> DataFrame:
    parts = split(v)
    model = modeling.fit(parts.train, MODEL_FEATURES, kind, **params)
    return training_plans.evaluate(model, parts.validation).withColumn("model", F.lit(kind))


@query("logistic_regression")
def _(v):
    return metrics_of(v, modeling.LOGISTIC)


@query("boosted_trees")
def _(v):
    return metrics_of(v, modeling.BOOSTED)


@query("multilayer_perceptron")
def _(v):
    return metrics_of(v, modeling.PERCEPTRON)


@query("forest_importances")
def _(v):
    parts = split(v)
    model = modeling.fit(parts.train, MODEL_FEATURES, modeling.FOREST)
    return modeling.slot_importances(v.spark, model, MODEL_FEATURES)


@query("model_comparison")
def _(v):
    return training_plans.compare_models(split(v), MODEL_FEATURES, [modeling.LOGISTIC, modeling.BOOSTED, modeling.PERCEPTRON])[0]


@query("imbalance_strategies")
def _(v):
    return training_plans.compare_imbalance(split(v), MODEL_FEATURES)


@query("smote_rows")
def _(v):
    """Rows per class after oversampling, and whether new points stay within the span of the minority."""
    point = F.array(F.col("city").cast("double"), F.col("bd").cast("double"))
    labelled = v.members.join(v.train, "msno").select("msno", "is_churn", point.alias("x"))
    bounds = labelled.where("is_churn = 1").agg(F.struct(
        F.min(F.col("x")[1]).alias("low"), F.max(F.col("x")[1]).alias("high"))).scalar()
    made = F.col("msno").contains("#")
    inside = F.col("x")[1].between(bounds["low"], bounds["high"])
    return resampling.smote(labelled, "msno", "x", "is_churn").groupBy(F.col("is_churn").cast("int").alias("is_churn")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(made).alias("synthetic"), F.count_if(made & ~inside).alias("outside"))


@query("smote_neighbours")
def _(v):
    """Minority rows, those with fewer than five neighbours and those whose neighbours are not minority points."""
    point = F.array(F.col("city").cast("double"), F.col("bd").cast("double"))
    minority = checkpointed(v.members.join(v.train.where("is_churn = 1"), "msno").select("msno", point.alias("x")))
    found = resampling.near_neighbours(minority, "msno", "x")
    known = minority.select(F.col("x").alias("y")).distinct()
    strange = found.select(F.explode("neighbours").alias("y")).join(known, "y", "left_anti")
    return found.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.size("neighbours") < 5).alias("short"),
    ).withColumn("strange", strange.agg(F.count(F.lit(1)).alias("n")).scalar())


@query("nearest_on_a_line")
def _(v):
    """Distances of the five nearest rows where vectors have one dimension."""
    rows = v.members.select("msno", F.array(F.col("bd").cast("double")).alias("x"))
    near = resampling.near_neighbours(rows, "msno", "x")
    distances = F.array_sort(F.transform("neighbours", lambda y: F.abs(y[0] - F.col("x")[0])))
    return near.select("msno", distances.alias("distances"))


@query("scaled_numbers")
def _(v):
    """Imputed and standardised numbers of the preprocessing, one row a customer."""
    names = ["bd", "num_active_days", "total_amount_paid"]
    prepared = modeling.prepare(feature_table(v), names)
    values = vector_to_array(modeling.FEATURES)
    return prepared.vectors.select("msno", *[values[i].alias(n) for i, n in enumerate(names)])


@query("fixed_score_importance")
def _(v):
    """Features that a fixed score does not read lose nothing when shuffled."""
    names = ["cancel_count", "num_active_days", "bd"]
    count = F.coalesce(F.col("cancel_count"), F.lit(0)).cast("double")
    found = training_plans.permutation_importance(lambda df: df.withColumn("probability", count / (count + 1)), feature_table(v), names)
    return found.select("feature", (F.abs("perm_importance_mean") < 1e-12).alias("unused"))


@query("batch_score_checks")
def _(v):
    """Rows of a scoring run, those with a probability, with the tier of it and with full provenance."""
    model = modeling.fit(split(v).train, MODEL_FEATURES, modeling.LOGISTIC)
    scored = checkpointed(scoring.score_customers(feature_table(v), model, MODEL_FEATURES, AS_OF, "snapshot", "1"))
    p = F.col("churn_probability")
    tier = F.when(p >= 0.7, "High").when(p >= 0.4, "Medium").otherwise("Low")
    return scored.agg(
        F.count_distinct("customer_id").alias("customers"), F.count_if(p.between(0, 1)).alias("in_range"),
        F.count_if(F.col("risk_tier") == tier).alias("right_tier"),
        F.count_if((F.col("feature_snapshot_id") == "snapshot") & (F.col("model_version") == "1")).alias("with_provenance"),
    )


@query("attribution_checks")
def _(v):
    """Customers whose linear attributions add up to the margin and whose sampled ones add up to the probability."""
    parts = split(v)
    model = modeling.fit(parts.train, MODEL_FEATURES, modeling.LOGISTIC)
    total = F.aggregate("attributions", F.lit(0.0), lambda a, e: a + e["shap_value"])
    margin = training_plans.linear_model_attributions(model, parts.validation, parts.train, MODEL_FEATURES).select("msno", total.alias("sum"))
    p = modeling.with_probability(model, parts.validation).select("msno", "probability")
    offsets = checkpointed(margin.join(p, "msno").select("msno", (F.log(F.col("probability") / (1 - F.col("probability"))) - F.col("sum")).alias("offset")))
    middle = offsets.agg(F.avg("offset").alias("m")).scalar()
    sampled = attributions.sampling_shapley(
        parts.validation, parts.train, "msno", MODEL_FEATURES, lambda df: modeling.with_probability(model, df))
    linear = offsets.agg(F.count_if(F.abs(F.col("offset") - middle) < 1e-6).alias("linear"))
    whole = sampled.agg(F.count_if(F.abs(F.col("base") + total - F.col("probability")) < 1e-9).alias("sampled"))
    return linear.crossJoin(whole)  # one row each


@query("logistic_optimum")
def _(v):
    """Training rows, and whether the penalised weighted loss has no slope left at the fitted coefficients."""
    parts = split(v)
    prepared = modeling.prepare(parts.train, MODEL_FEATURES)
    model = modeling.fit_prepared(prepared, modeling.LOGISTIC).stages[-1]
    rows = sum(prepared.counts.values())
    weighted = modeling.with_class_weight(prepared.vectors, modeling.weights_by_class(prepared.counts))
    x = vector_to_array(modeling.FEATURES)
    beta = F.array(*[F.lit(float(c)) for c in model.coefficients.toArray()])
    margin = F.aggregate(F.zip_with(x, beta, lambda a, b: a * b), F.lit(float(model.intercept)), lambda t, z: t + z)
    slope = F.col(modeling.WEIGHT) * (1 / (1 + F.exp(-margin)) - F.col(modeling.LABEL))
    slots = weighted.select(slope.alias("s"), F.posexplode(x).alias("slot", "value"))
    sums = slots.groupBy("slot").agg((F.sum(F.col("s") * F.col("value")) / rows).alias("g"))
    total = sums.agg(F.max(F.abs(F.col("g") + F.element_at(beta, F.col("slot") + 1) / rows)).alias("g"))
    return total.select(F.lit(rows).cast("bigint").alias("rows"), (F.col("g") < 1e-3).alias("flat"))


@query("permutation_importance")
def _(v):
    parts = split(v)
    model = modeling.fit(parts.train, MODEL_FEATURES, modeling.LOGISTIC)
    return training_plans.model_permutation_importance(model, parts.validation, MODEL_FEATURES)


@query("feature_selection")
def _(v):
    parts = split(v)
    model = modeling.fit(parts.train, MODEL_FEATURES, modeling.LOGISTIC)
    importances = training_plans.model_permutation_importance(model, parts.validation, MODEL_FEATURES)
    return training_plans.select_features(checkpointed(importances), parts.train)


@query("batch_scores")
def _(v):
    table = feature_table(v)
    model = modeling.fit(split(v).train, MODEL_FEATURES, modeling.LOGISTIC)
    scored = scoring.score_customers(table, model, MODEL_FEATURES, AS_OF, "snapshot", "1")
    return scored.drop("shap_values")


@query("linear_attributions")
def _(v):
    parts = split(v)
    model = modeling.fit(parts.train, MODEL_FEATURES, modeling.LOGISTIC)
    values = training_plans.linear_model_attributions(model, parts.validation, parts.train, MODEL_FEATURES)
    top = attributions.top_attributions("attributions", 5)
    return values.select("msno", F.inline(top))


@query("sampling_attributions")
def _(v):
    parts = split(v)
    model = modeling.fit(parts.train, MODEL_FEATURES, modeling.LOGISTIC)
    values = attributions.sampling_shapley(
        parts.validation, parts.train, "msno", MODEL_FEATURES, training_plans.model_score(model, MODEL_FEATURES))
    return attributions.global_importance(values)


@query("model_card")
def _(v):
    parts = split(v)
    model = modeling.fit(parts.train, MODEL_FEATURES, modeling.LOGISTIC)
    scored = modeling.with_probability(model, parts.validation)
    return training_plans.model_card(
        "logistic_regression", parts.train, MODEL_FEATURES, training_plans.evaluate(model, parts.validation), scored)


# Attributions and documents with known results -----------------------------------------------------------------------

SCORE_FEATURES = ["cancel_count", "num_active_days", "transaction_count"]


def known_attributions(v: RetailViews) -> DataFrame:
    """Attributions of a fixed linear score over the latest predictions; two slots belong to one raw feature."""
    rows = dashboard.with_features(latest.latest_predictions(v.predictions), feature_table(v), "inner")
    known = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SCORE_FEATURES]
    vectors = rows.select("customer_id", F.array(*known, F.col("churn_probability").cast("double")).alias("x"))
    slots = ["cancel_count", "num_active_days_a", "num_active_days_b", "transaction_count"]
    per_slot = attributions.linear_attributions(
        vectors.withColumn("x", F.array(F.col("x")[0], F.col("x")[1], F.col("x")[3], F.col("x")[2])),
        "customer_id", "x", [0.75, -0.5, 2.0, -0.125], [0.5, 10.0, 0.25, 8.0], slots)
    members = {"cancel_count": slots[:1], "num_active_days": slots[1:3], "transaction_count": slots[3:]}
    return per_slot.withColumn("attributions", attributions.sum_to_features("attributions", members))


@query("top_attributions")
def _(v):
    top = attributions.top_attributions("attributions", 2)
    return known_attributions(v).select("customer_id", F.posexplode(top).alias("position", "entry")).select(
        "customer_id", "position", "entry.feature", "entry.shap_value")


@query("global_attribution_importance")
def _(v):
    return attributions.global_importance(known_attributions(v))


@query("attribution_explanations")
def _(v):
    top = known_attributions(v).withColumn("shap_values", attributions.top_attributions("attributions", 5))
    return top.select("customer_id", labels.explanations(labels.top_features("shap_values", TOP_FEATURES, 2)).alias("explanations"))


@query("json_documents")
def _(v):
    """Event properties as JSON lists; every fifth text is cut off and every seventh list is empty."""
    whole = F.concat(F.lit("["), F.col("props"), F.lit("]"))
    text = F.when(F.col("event_id") % 5 == 0, F.lit("[{")).when(F.col("event_id") % 7 == 0, F.lit("[]")).otherwise(whole)
    parsed = tables.parsed_list("text", "struct<k:bigint>")
    rows = v.read("events").select("event_id", text.alias("text")).withColumn("parsed", parsed)
    return rows.select("event_id", F.col("parsed")[0]["k"].alias("k"), F.to_json("parsed").alias("written"))


@query("evolved_predictions")
def _(v):
    """Early rows without provenance columns joined with later rows that have them."""
    cut = F.lit("2024-01-10").cast("timestamp_ntz")
    older = v.predictions.where(F.col("scored_at") < cut).select("pred_id", "customer_id", "churn_probability")
    newer = v.predictions.where(F.col("scored_at") >= cut).select(
        "pred_id", "customer_id", "churn_probability", "feature_snapshot_id", "threshold_version")
    return tables.evolved(older, newer, {"threshold_version": "v0"})


from verification import model_queries  # noqa: E402, F401  (registers its queries here)
