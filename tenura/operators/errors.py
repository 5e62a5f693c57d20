"""Classification quality and error profiles of scored, labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.labels import numeric, outcome_columns
from tenura.operators.ordered import moments_of_counts, quantiles_of_counts, value_counts
from tenura.session import checkpointed


def collapsed_cases(
    predictions: DataFrame, features: DataFrame, label: str = "is_churn", threshold: float = 0.5,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Case rows of scored customers with their count ``n``: at most two per customer (and keys).

    The scored rows are counted before they meet the features, so a customer scored very often costs two rows in the join.
    """
    predicted = (F.col("churn_probability") >= threshold).cast("int").alias("predicted")
    counted = (
        predictions.where(F.col("churn_probability").isNotNull())
        .groupBy("customer_id", predicted, *keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return outcome_columns(counted.join(features.withColumnRenamed("msno", "customer_id"), "customer_id"), label)


def _rows(condition: Column, weight: str | None) -> Column:
    """Rows that meet a condition, each counted by its weight."""
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("bigint")


def confusion_counts(cases: DataFrame, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """tn, fp, fn and tp of rows with actual and predicted."""

    def cell(actual: int, predicted: int) -> Column:
        return _rows((F.col("actual") == actual) & (F.col("predicted") == predicted), weight)

    return cases.groupBy(*keys).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def classification_metrics(cases: DataFrame, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Precision, recall and F1 of class 1; each is 0 where its denominator is."""
    return confusion_counts(cases, keys, weight).selectExpr(
        *keys,
        "coalesce(try_divide(cast(tp as double), tp + fp), 0D) as precision_churn",
        "coalesce(try_divide(cast(tp as double), tp + fn), 0D) as recall_churn",
        "coalesce(try_divide(2D * tp, 2 * tp + fp + fn), 0D) as f1_churn",
        "tp + fn as support_churn",
    )


def class_weights(df: DataFrame, label: str = "is_churn") -> DataFrame:
    """Balanced weight n / (classes * n_class) per class, and the negatives per positive."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    overall = counts.agg(
        F.struct(
            F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"),
            F.coalesce(F.sum(F.when(F.col("label") == 0, F.col("n"))), F.lit(0)).alias("negatives"),
            F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("n"))), F.lit(0)).alias("positives"),
        )
    ).scalar()
    return counts.select(
        "label", "n",
        (overall["rows"] / (overall["classes"] * F.col("n"))).alias("weight"),
        (overall["negatives"] / F.greatest(overall["positives"], F.lit(1))).alias("pos_weight"),
    )


def numeric_error_profile(cases: DataFrame, features: Sequence[str], weight: str | None = None) -> DataFrame:
    """Mean and median of each feature among misclassified and correct rows, and their standardised difference.

    The difference is 0 when a side has one row or the pooled deviation is 0. Features without values on a side are
    left out. ``rank`` orders by absolute difference.
    """
    entries = [F.struct(F.lit(f).alias("feature"), numeric(f).alias("value")) for f in features]
    keys = ["feature", "is_misclassified"]
    # The cases are read once, for their distinct values per feature and side.
    rows = F.col(weight) if weight else F.lit(1)
    long = cases.select("is_misclassified", rows.alias("rows"), F.inline(F.array(*entries)))
    counts = checkpointed(value_counts(long, keys, "value", {"n": F.col("rows")}))
    medians = quantiles_of_counts(counts, "value", [0.5], keys).select(*keys, F.col("quantiles")[0].alias("median"))
    sides = moments_of_counts(counts, "value", keys).join(F.broadcast(medians), keys)  # two rows a feature

    def side(flag: int, name: str) -> Column:
        return F.max(F.when(F.col("is_misclassified") == flag, F.col(name)))

    wide = sides.groupBy("feature").agg(
        side(1, "count").alias("n1"), side(0, "count").alias("n0"),
        side(1, "mean").alias("misclassified_mean"), side(0, "mean").alias("correct_mean"),
        side(1, "median").alias("misclassified_median"), side(0, "median").alias("correct_median"),
        side(1, "variance").alias("v1"), side(0, "variance").alias("v0"),
    ).where(F.col("n1").isNotNull() & F.col("n0").isNotNull())
    pooled = F.sqrt((F.col("v1") + F.col("v0")) / 2)
    comparable = (F.col("n1") > 1) & (F.col("n0") > 1) & (pooled > 0)
    difference = F.when(
        comparable, (F.col("misclassified_mean") - F.col("correct_mean")) / pooled
    ).otherwise(0.0)
    # One row per named feature reaches this window.
    order = Window.partitionBy(F.lit(0)).orderBy(F.abs(F.col("std_mean_diff")).desc(), "feature")
    return (
        wide.withColumn("std_mean_diff", difference)
        .withColumn("rank", F.row_number().over(order))
        .drop("n1", "n0", "v1", "v0")
    )


def categorical_error_profile(cases: DataFrame, features: Sequence[str], weight: str | None = None) -> DataFrame:
    """Per feature the category whose share differs most between misclassified and correct rows.

    NULL is the category 'nan'; the first category in sort order wins ties; lift is NULL when the correct share is 0.
    """
    entries = [
        F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f).cast("string"), F.lit("nan")).alias("category"))
        for f in features
    ]
    counts = (
        cases.select("is_misclassified", *([weight] if weight else []), F.inline(F.array(*entries)))
        .groupBy("feature", "category")
        .agg(
            _rows(F.col("is_misclassified") == 1, weight).alias("wrong"),
            _rows(F.col("is_misclassified") == 0, weight).alias("right"),
        )
    )
    # Every row has one category per feature, so the counts give the totals without reading the cases again.
    totals = F.broadcast(
        counts.groupBy("feature").agg(F.sum("wrong").alias("all_wrong"), F.sum("right").alias("all_right"))
    )
    shares = counts.join(totals, "feature").where("all_wrong > 0 and all_right > 0").selectExpr(
        "feature", "category", "wrong / all_wrong as misclassified_share", "right / all_right as correct_share"
    )
    shares = shares.selectExpr(
        "*", "misclassified_share - correct_share as share_diff",
        "if(correct_share > 0, misclassified_share / correct_share, null) as lift",
    )
    # min() keeps the largest difference, then the first category.
    best = F.min(F.struct(
        (-F.round(F.abs("share_diff"), 12)).alias("order"), "category", "misclassified_share", "correct_share",
        "share_diff", "lift",
    ))
    return shares.groupBy("feature").agg(best.alias("best")).select("feature", "best.*").drop("order")


# The insight sentences.
NUMERIC_INSIGHT = (
    "`%s` is materially %s among misclassified cases (misclassified mean=%.2f, correct mean=%.2f). "
    "Action: add bucketized/interaction features for `%s` and re-tune threshold."
)
CATEGORY_INSIGHT = (
    "Category `%s=%s` is over-represented in misclassifications (misclassified share=%.1f%%, correct share=%.1f%%). "
    "Action: introduce category-target interactions or category-specific calibration."
)
MISSED_INSIGHT = (
    "False negatives exceed false positives. Action: lower decision threshold to catch more true churners "
    "and monitor precision trade-off."
)
ALARM_INSIGHT = (
    "False positives are at least as frequent as false negatives. Action: increase decision threshold or "
    "add precision-oriented features to reduce false alarms."
)


def error_insights(numeric_profile: DataFrame, categorical_profile: DataFrame, confusion: DataFrame) -> DataFrame:
    """Insight sentences: the two strongest numeric features, the strongest category and the error balance."""
    direction = F.when(F.col("misclassified_mean") > F.col("correct_mean"), "higher").otherwise("lower")
    strongest = categorical_profile.orderBy(F.abs("share_diff").desc(), "feature").limit(1)
    numeric_line = F.format_string(
        NUMERIC_INSIGHT, "feature", direction, "misclassified_mean", "correct_mean", "feature")
    category_line = F.format_string(
        CATEGORY_INSIGHT, "feature", "category", F.col("misclassified_share") * 100, F.col("correct_share") * 100)
    balance_line = F.when(F.col("fn") > F.col("fp"), MISSED_INSIGHT).otherwise(ALARM_INSIGHT)
    lines = (
        numeric_profile.where(F.col("rank") <= 2).select(F.col("rank").alias("position"), numeric_line.alias("insight"))
        .unionByName(strongest.select(F.lit(3).alias("position"), category_line.alias("insight")))
        .unionByName(confusion.select(F.lit(4).alias("position"), balance_line.alias("insight")))
    )
    return lines.orderBy("position")
