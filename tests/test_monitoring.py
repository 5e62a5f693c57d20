import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.operators import monitoring as m
from tenura.operators.sampling import hash_cohort, monitoring_cohorts, time_cohort
from tenura.plans import monitoring as plan

AS_OF = datetime(2024, 3, 1)


def scored(spark, labels, scores):
    return spark.createDataFrame([(int(y), float(p)) for y, p in zip(labels, scores)], "label int, score double")


def plain_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def plain_psi(base, curr, bins=10):
    base, curr = base[np.isfinite(base)], curr[np.isfinite(curr)]
    if len(base) < 2 or len(curr) < 2:
        return math.nan
    edges = np.unique(np.quantile(base, np.linspace(0, 1, bins + 1)))
    if len(edges) < 2:
        return 0.0
    edges[0], edges[-1] = -np.inf, np.inf
    b = np.histogram(base, edges)[0] / len(base) + 1e-6
    c = np.histogram(curr, edges)[0] / len(curr) + 1e-6
    return float(np.sum((c - b) * np.log(c / b)))


def test_auc_with_ties_weights_and_keys(spark):
    draw = np.random.default_rng(1)
    labels, scores = draw.integers(0, 2, 300), np.round(draw.random(300), 1)
    scores[:100] = 0.4
    df = scored(spark, labels, scores).withColumn("k", F.lit("all")).repartition(6)
    expected = plain_auc(labels, scores)
    assert m.roc_auc(df, "label", "score").first()["roc_auc"] == pytest.approx(expected, abs=1e-12)
    assert m.roc_auc(df, "label", "score", ["k"]).first()["roc_auc"] == pytest.approx(expected, abs=1e-12)
    collapsed = df.groupBy("label", "score").agg(F.count(F.lit(1)).alias("n"))
    assert m.roc_auc(collapsed, "label", "score", weight="n").first()["roc_auc"] == pytest.approx(expected, abs=1e-12)


def test_auc_of_one_class(spark):
    df = scored(spark, [1, 1], [0.2, 0.3])
    assert m.roc_auc(df, "label", "score").first()["roc_auc"] is None
    with pytest.raises(Exception, match="both positive and negative"):
        m.roc_auc(df, "label", "score", strict=True).collect()


def test_roc_points_accumulate(spark):
    rows = m.roc_points(scored(spark, [1, 0, 1, 0], [0.9, 0.9, 0.5, 0.1]), "label", "score").orderBy(F.desc("threshold")).collect()
    assert [(r["threshold"], r["true_positives"], r["false_positives"]) for r in rows] == [(0.9, 1, 1), (0.5, 2, 1), (0.1, 2, 2)]


def test_calibration_limits_belong_to_floating_point_bins(spark):
    # 0.3, 0.6 and 0.7 lie below the products 3 * 0.1, 6 * 0.1 and 7 * 0.1.
    df = scored(spark, [1] * 6, [0.1, 0.3, 0.6, 0.7, 1.0, 1.4])
    counts = {r["bin"]: r["count"] for r in m.calibration_bins(df, "label", "score").collect()}
    assert counts == {0: 0, 1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 1, 7: 0, 8: 0, 9: 2}
    last = [r for r in m.calibration_bins(df, "label", "score").collect() if r["bin"] == 9][0]
    assert last["mean_pred"] == pytest.approx(1.2)  # the mean is not clipped
    empty = [r for r in m.calibration_bins(df, "label", "score").collect() if r["bin"] == 0][0]
    assert empty["mean_pred"] is None and empty["actual_rate"] is None
    with pytest.raises(ValueError):
        m.calibration_bins(df, "label", "score", 0)


def test_calibration_error_brier_and_distribution(spark):
    df = scored(spark, [1, 0, 1, 1], [0.95, 0.92, 0.15, 0.55])
    bins = m.calibration_bins(df, "label", "score")
    assert m.max_calibration_error(bins).first()[0] == pytest.approx(0.85)
    assert m.brier_score(df, "label", "score").first()[0] == pytest.approx((0.0025 + 0.8464 + 0.7225 + 0.2025) / 4)
    shares = {r["bin"]: r["pct"] for r in m.score_distribution(df, "score").collect()}
    assert shares[9] == 0.5 and shares[1] == 0.25 and shares[0] == 0.0
    empty = df.where("false")
    assert math.isnan(m.brier_score(empty, "label", "score").first()[0])
    assert m.max_calibration_error(m.calibration_bins(empty, "label", "score")).first()[0] == 0.0
    assert [r["pct"] for r in m.score_distribution(empty, "score").collect()] == [0.0] * 10


@pytest.mark.parametrize("case", ["drift", "same", "constant", "short", "ties", "infinite"])
def test_psi_equals_numpy(spark, case):
    draw = np.random.default_rng(11)
    base, curr = draw.normal(0, 1, 400), draw.normal(0.5, 1.3, 300)
    if case == "same":
        curr = base.copy()
    elif case == "constant":
        base = np.full(40, 3.0)
    elif case == "short":
        curr = np.array([1.0])
    elif case == "ties":
        base, curr = np.round(base), np.round(curr)
    elif case == "infinite":
        base[:3], curr[:2] = [np.inf, np.nan, -np.inf], [np.nan, np.inf]
    rows = [("x", "baseline", float(v)) for v in base] + [("x", "current", float(v)) for v in curr]
    rows += [("all_null", "baseline", None), ("all_null", "current", None)]
    df = spark.createDataFrame(rows, "k string, cohort string, v double")
    found = {r["k"]: r["psi"] for r in m.psi(df, "v", ["k"]).collect()}
    assert found["x"] == pytest.approx(plain_psi(base, curr), abs=1e-12, nan_ok=True)
    assert math.isnan(found["all_null"])
    alone = m.psi(df.where("k = 'x'"), "v").first()["psi"]
    assert alone == pytest.approx(plain_psi(base, curr), abs=1e-12, nan_ok=True)


def test_segment_psi_missing_columns_and_nulls(spark):
    draw = np.random.default_rng(5)
    rows = [(c, s, float(v)) for c, shift in (("baseline", 0), ("current", 0.4)) for s in (0, 1) for v in draw.random(60) * 0.5 + shift * s]
    rows += [("baseline", None, 0.5), ("current", 2, 0.1)]
    df = spark.createDataFrame(rows, "cohort string, seg int, score double")
    found = {r["segment"]: r["psi"] for r in m.segment_psi(df, ["seg", "absent"]).collect()}
    assert set(found) == {"seg=0", "seg=1", "seg=2", "absent=missing"}
    assert math.isnan(found["seg=2"]) and math.isnan(found["absent=missing"])
    assert found["seg=1"] > 0.2
    assert "seg=1" in m.breached_segments(m.segment_psi(df, ["seg", "absent"])).first()[0]
    with pytest.raises(ValueError):
        m.segment_psi(df, ["seg"], score="nothing")


def test_cohorts_by_time_or_by_hash(spark):
    stamps = [datetime(2024, 2, 28)] * 60 + [datetime(2024, 1, 5)] * 60 + [datetime(2020, 1, 1)] * 9 + [None] * 3
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(stamps)], "msno string, scored_at timestamp")
    df = df.withColumn("window", time_cohort("scored_at", AS_OF))
    by_time = monitoring_cohorts(df)
    assert {(r["cohort"], r["count"]) for r in by_time.groupBy("cohort").count().collect()} == {("current", 60), ("baseline", 60)}
    by_hash = monitoring_cohorts(df, min_rows=61)
    assert by_hash.count() == len(stamps)  # rows of any age, dated or not
    assert by_hash.where("cohort_strategy = 'hash_fallback'").count() == len(stamps)
    assert by_hash.where(F.col("cohort") != hash_cohort("msno")).count() == 0


def tables(spark, n=240, one_class=False):
    train = spark.range(n).selectExpr("cast(id as string) msno", f"cast({'1' if one_class else 'id % 2'} as smallint) is_churn")
    features = spark.range(n).selectExpr(
        "cast(id as string) msno", "cast(id % 3 as smallint) latest_is_auto_renew", "cast(id % 4 as int) cancel_count",
        "id transaction_count", "id * 1.5 total_amount_paid", "id % 7 avg_plan_days", "id % 11 num_active_days", "id % 5 avg_total_secs")
    predictions = spark.range(n).selectExpr(
        "cast(id as string) customer_id", "(id % 10) / 10D churn_probability",
        "if(id % 4 < 2, timestamp'2024-02-27', timestamp'2024-01-10') scored_at")
    return predictions, features, train


def test_verdict_on_too_few_rows_keeps_reasons_but_does_not_breach(spark):
    row = plan.monitoring_verdict(*tables(spark), AS_OF).first()
    assert (row["status"], row["breached"], row["cohort_strategy"]) == ("insufficient_data", False, "time_window")
    assert "Insufficient labelled samples in current window: 120 < 1000" in row["breached_reasons"]
    assert plan.retrain_decision(plan.monitoring_verdict(*tables(spark), AS_OF)).first()["decision"] == "skip_retraining"


def test_verdict_breaches_on_calibration_and_uses_the_reference_auc(spark):
    row = plan.monitoring_verdict(*tables(spark), AS_OF, min_samples=100, reference_auc=0.99).first()
    assert row["baseline_auc"] == 0.99 and row["baseline_auc_source"] == "registry_production"
    assert row["auc_delta"] == pytest.approx(0.99 - row["current_auc"])
    assert row["status"] == "breached" and "AUC degradation threshold breached" in row["breached_reasons"]
    assert "Calibration error exceeds threshold" in row["breached_reasons"]
    assert len(row["calibration_bins"]) == len(row["score_distribution"]) == 10
    assert sum(b["count"] for b in row["calibration_bins"]) == row["current_row_count"]


def test_verdict_of_one_class(spark):
    row = plan.monitoring_verdict(*tables(spark, one_class=True), AS_OF, min_samples=10).first()
    assert row["baseline_auc"] is None and row["current_auc"] is None
    assert "Insufficient baseline class coverage" in row["breached_reasons"]
    assert "Insufficient current class coverage" in row["breached_reasons"] and row["breached"]


def test_verdict_equals_row_level_metrics_for_a_hot_customer(spark):
    predictions, features, train = tables(spark)
    hot = spark.range(400).selectExpr("'7' customer_id", "(id % 3) / 4D churn_probability", "timestamp'2024-02-28' scored_at")
    predictions = predictions.unionByName(hot)
    row = plan.monitoring_verdict(predictions, features, train, AS_OF).first()
    joined = m.labelled_predictions(predictions, features, train).where("scored_at >= timestamp'2024-02-23'").toPandas()
    assert row["current_row_count"] == len(joined)
    assert row["brier_score"] == pytest.approx(((joined.score - joined.label) ** 2).mean())
    assert row["current_auc"] == pytest.approx(plain_auc(joined.label, joined.score))
    frame = m.monitoring_frame(predictions, features, train, AS_OF)
    assert frame.where("msno = '7'").count() <= 6  # collapsed before the join


def test_retrain_decision_reads_the_newest_row(spark):
    schema = "monitored_at timestamp, status string, breached boolean, max_psi double, auc_delta double"
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 8)

    def decide(*rows):
        return plan.retrain_decision(spark.createDataFrame(list(rows), schema)).first()

    assert decide()["decision"] == "skip_retraining"
    assert decide((old, "ok", False, 0.9, 0.0), (new, "ok", False, 0.2, 0.05))["decision"] == "skip_retraining"
    assert decide((new, None, True, 0.21, None))["decision"] == "retrain_if_needed"
    assert decide((new, None, True, 0.21, None))["status"] == "breached"
    assert decide((new, "breached", True, 0.0, 0.0500001))["decision"] == "retrain_if_needed"
    assert decide((new, "breached", True, 0.1, None))["decision"] == "skip_retraining"  # calibration or segments only
    assert decide((new, "insufficient_data", False, 0.9, 0.9))["reason"] == "insufficient_labeled_samples"


def test_monitored_features_fall_back_to_defaults(spark):
    columns = ["msno", "is_churn", "a", "b", "c", "d", "e", "f"]
    table = spark.createDataFrame([(c, float(i)) for i, c in enumerate(["msno", "a", "b", "c", "d", "e", "f", "gone"])],
                                  "feature string, perm_importance_mean double")
    assert m.monitored_features(table, columns) == ["f", "e", "d", "c", "b"]
    assert m.monitored_features(table, columns[:5]) == m.DEFAULT_MONITORED_FEATURES
    assert m.monitored_features(None, columns) == m.DEFAULT_MONITORED_FEATURES
