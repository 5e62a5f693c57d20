import dataclasses
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.functions.labels import case_columns
from tenura.operators import attributions, errors, explore, fairness, modeling, promotion, resampling
from tenura.plans import scoring, training
from tenura.session import even_task_count

NAMES = ["city", "gender", "bd", "transaction_count", "total_amount_paid"]


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(400):
        bd, count = float(draw.normal(40, 10)), int(draw.integers(1, 20))
        churn = int(draw.random() < 1 / (1 + np.exp(-(0.15 * (bd - 45)))))
        rows.append((f"k{i}", churn, int(draw.integers(1, 4)), ["male", "female", None][i % 3], bd, count, float(draw.normal(100, 5))))
    return spark.createDataFrame(
        rows, "msno string, is_churn int, city int, gender string, bd double, transaction_count int, total_amount_paid double"
    ).cache()


@pytest.fixture(scope="module")
def split(table):
    return training.split_features(table)


@pytest.fixture(scope="module")
def logistic(split):
    return modeling.fit(split.train, NAMES, modeling.LOGISTIC)


def test_fill_values(spark):
    df = spark.createDataFrame(
        [(10, "b", 1.0), (9, "b", 2.0), (10, "a", 3.0), (9, "a", 10.0), (None, None, None)], "city int, gender string, bd double")
    rows = {r["feature"]: (r["number"], r["level"]) for r in modeling.fill_values(df, ["city", "gender", "bd"]).collect()}
    assert rows == {"bd": (2.5, None), "city": (None, "9"), "gender": (None, "a")}  # ties: the smallest level


def test_preprocessing_scales_imputes_and_zeroes_unseen_levels(spark, split, logistic):
    head = logistic.stages[:-1]
    slots = modeling.slot_names(logistic, NAMES)
    names = [s for members in slots.values() for s in members]
    odd = split.train.limit(1).select(
        "msno", "is_churn", F.lit(99).alias("city"), F.lit("other").alias("gender"), F.lit(None).cast("double").alias("bd"),
        "transaction_count", "total_amount_paid")
    for stage in head:
        odd = stage.transform(odd)
    vector = dict(zip(names, odd.first()["features"].toArray()))
    assert all(vector[s] == 0 for f in ("city", "gender") for s in slots[f])
    median = np.median([r["bd"] for r in split.train.collect()])
    values = np.array([r["bd"] for r in split.train.collect()])
    assert vector["bd"] == pytest.approx((median - values.mean()) / values.std(ddof=1), abs=1e-9)


def test_logistic_learns_and_scores_with_provenance(spark, split, logistic, table):
    metrics = training.evaluate(logistic, split.validation).first()
    assert metrics["roc_auc"] > 0.65
    rows = scoring.score_customers(table, logistic, NAMES, datetime(2024, 1, 1), "snap", "7").collect()
    assert len(rows) == 400 and all(0 <= r["churn_probability"] <= 1 for r in rows)
    assert {(r["feature_snapshot_id"], r["model_version"], r["threshold_version"]) for r in rows} == {("snap", "7", "v1")}
    assert all((r["risk_tier"] == "High") == (r["churn_probability"] >= 0.7) for r in rows)
    with pytest.raises(ValueError, match="lacks"):
        scoring.score_customers(table.drop("bd"), logistic, NAMES, datetime(2024, 1, 1))


def test_model_survives_saving(tmp_path, split, logistic):
    from pyspark.ml import PipelineModel

    logistic.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    before = modeling.with_probability(logistic, split.validation).orderBy("msno").collect()
    after = modeling.with_probability(loaded, split.validation).orderBy("msno").collect()
    assert [r["probability"] for r in before] == [r["probability"] for r in after]


def test_linear_attributions_add_up_to_the_margin(split, logistic):
    values = training.linear_model_attributions(logistic, split.validation, split.train, NAMES)
    rows = {r["msno"]: sum(a["shap_value"] for a in r["attributions"]) for r in values.collect()}
    margins = {}
    for r in modeling.with_probability(logistic, split.validation).collect():
        margins[r["msno"]] = np.log(r["probability"] / (1 - r["probability"]))
    offsets = {round(margins[k] - rows[k], 6) for k in margins}
    assert len(offsets) == 1  # the same base for every row
    assert [len(r["attributions"]) for r in values.take(1)] == [len(NAMES)]


def test_sampling_attributions_add_up_to_the_prediction(split, logistic):
    some = split.validation.limit(15)
    values = attributions.sampling_shapley(
        some, split.train, "msno", NAMES, lambda df: modeling.with_probability(logistic, df), permutations=3)
    scored = {r["msno"]: r["probability"] for r in modeling.with_probability(logistic, some).collect()}
    rows = values.collect()
    assert len(rows) == 15
    for r in rows:
        assert r["probability"] == pytest.approx(scored[r["msno"]])
        assert r["base"] + sum(a["shap_value"] for a in r["attributions"]) == pytest.approx(scored[r["msno"]])


def test_sampling_attributions_of_a_linear_model_score_no_mixed_rows(split, logistic):
    some = split.validation.limit(15)
    plain = attributions.sampling_shapley(
        some, split.train, "msno", NAMES, lambda df: modeling.with_probability(logistic, df), permutations=3)
    score = training.model_score(logistic, NAMES)

    def refused(df):
        raise AssertionError("a frame of mixed rows was scored")

    by_terms = attributions.AdditiveScore(refused, score.terms, score.start)
    found = {r["msno"]: r for r in attributions.sampling_shapley(some, split.train, "msno", NAMES, by_terms, permutations=3).collect()}
    rows = plain.collect()
    assert len(found) == len(rows) == 15
    for r in rows:
        own = found[r["msno"]]
        assert [a["feature"] for a in own["attributions"]] == [a["feature"] for a in r["attributions"]]
        assert [own["base"], own["probability"]] == pytest.approx([r["base"], r["probability"]], abs=1e-12)
        assert [a["shap_value"] for a in own["attributions"]] == pytest.approx([a["shap_value"] for a in r["attributions"]], abs=1e-12)


def test_linear_terms_add_up_to_the_margin(split, logistic):
    terms = training.linear_terms(logistic, split.validation, NAMES, ["msno"], "t")
    margins = {r["msno"]: r["rawPrediction"][1] for r in logistic.transform(split.validation).collect()}
    for r in terms.collect():
        assert len(r["t"]) == len(NAMES)
        assert sum(r["t"]) + logistic.stages[-1].intercept == pytest.approx(margins[r["msno"]], abs=1e-9)


def test_sampling_attributions_of_a_linear_score_find_the_coefficients(spark):
    rows = spark.createDataFrame([("a", 1.0, 5.0), ("b", -2.0, 0.5)], "k string, x double, y double")
    background = spark.createDataFrame([("z", 0.0, 1.0)], "k string, x double, y double")
    values = attributions.sampling_shapley(
        rows, background, "k", ["x", "y"], lambda df: df.withColumn("probability", 3 * F.col("x") - F.col("y")), permutations=4)
    found = {r["k"]: {a["feature"]: a["shap_value"] for a in r["attributions"]} for r in values.collect()}
    assert found["a"] == pytest.approx({"x": 3.0, "y": -4.0}) and found["b"] == pytest.approx({"x": -6.0, "y": 0.5})


def test_top_and_summed_attributions(spark):
    df = spark.createDataFrame(
        [("a", [("g_m", 0.1), ("g_f", -0.4), ("x", 0.2), ("y", -0.3000004)])], "k string, a array<struct<feature:string,shap_value:double>>")
    summed = df.withColumn("a", attributions.sum_to_features("a", {"g": ["g_m", "g_f"], "x": ["x"], "y": ["y"]}))
    top = summed.select(attributions.top_attributions("a", 2).alias("t")).first()["t"]
    assert [(e["feature"], e["shap_value"]) for e in top] == [("y", -0.3), ("g", -0.3)]
    importance = attributions.global_importance(summed, "a").collect()
    assert importance[0]["feature"] == "y" and importance[-1]["mean_abs_attribution"] == pytest.approx(0.2)


def test_tier_samples(spark):
    rows = [("h1", "High", 0.8), ("h2", "High", 0.9), ("h3", "High", 0.9), ("l1", "Low", 0.1), ("m1", "Medium", 0.45),
            ("m2", "Medium", 0.5), ("m3", "Medium", 0.65)]
    df = spark.createDataFrame(rows, "customer_id string, risk_tier string, churn_probability double")
    assert {(r["tier"], r["customer_id"]) for r in attributions.tier_samples(df).collect()} == {("high", "h2"), ("low", "l1"), ("medium", "m2")}


def test_smote_count_and_betweenness(spark):
    draw = np.random.default_rng(9)
    points = {f"p{i}": draw.normal(0, 1, 2).tolist() for i in range(20)}
    points.update({f"q{i}": [5.0, 5.0] for i in range(10)})  # a third of the minority in one place
    rows = [(k, x, 1) for k, x in points.items()] + [(f"n{i}", draw.normal(3, 1, 2).tolist(), 0) for i in range(201)]
    df = spark.createDataFrame(rows, "k string, x array<double>, y int").repartition(4)
    result = resampling.smote(df, "k", "x", "y").collect()
    made = [r for r in result if "#" in r["k"]]
    assert len(made) == int(0.5 * 201 - 30) and all(r["y"] == 1.0 for r in made)
    others = np.array(list(points.values()))
    for r in made:
        source, new = np.array(points[r["k"].split("#")[0]]), np.array(r["x"])
        spans = others - source
        along = [float((new - source) @ s / (s @ s)) if s @ s else 0.0 for s in spans]
        assert any(np.allclose(source + t * s, new, atol=1e-9) and -1e-9 <= t <= 1 for t, s in zip(along, spans))
    again = {r["k"]: r["x"] for r in resampling.smote(df.repartition(7), "k", "x", "y").collect() if "#" in r["k"]}
    assert set(again) == {r["k"] for r in made}


def test_smote_without_need_changes_nothing(spark):
    df = spark.createDataFrame([("a", [0.0], 1), ("b", [1.0], 0)], "k string, x array<double>, y int")
    assert resampling.smote(df, "k", "x", "y").count() == 2


def test_weighted_resampling_repeats_rows(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 100, 2.5).otherwise(1.0).alias("class_weight"))
    counts = resampled = modeling.resampled_by_weight(df, "id").groupBy("id").count().collect()
    assert len(counts) == 1000
    assert {r["count"] for r in resampled if r["id"] >= 100} == {1}
    assert {r["count"] for r in resampled if r["id"] < 100} == {2, 3}


@pytest.mark.parametrize("kind, params", [(modeling.FOREST, {"trees": 5}), (modeling.BOOSTED, {"rounds": 3})])
def test_trees_of_large_tables_do_not_depend_on_how_rows_came(split, monkeypatch, kind, params):
    monkeypatch.setattr(modeling, "DEALT_ROWS", 100)
    prepared = modeling.prepare(split.train, NAMES)

    def fitted(vectors):
        return modeling.fit_prepared(dataclasses.replace(prepared, vectors=vectors), kind, **params).stages[-1].toDebugString.split("\n", 1)[1]

    assert fitted(prepared.vectors.repartition(3)) == fitted(prepared.vectors.coalesce(1).orderBy(F.desc("msno")))


def test_large_tables_are_dealt_in_whole_rounds_of_tasks(spark, split, monkeypatch):
    vectors = modeling.prepare(split.train, NAMES).vectors.coalesce(1)
    assert modeling.dealt(vectors, "msno", vectors.count()) is vectors  # small ones stay as they came
    monkeypatch.setattr(modeling, "DEALT_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    for rows in (vectors, vectors.withColumn("msno", F.lit(None).cast("string"))):
        dealt = modeling.dealt(rows, "msno", rows.count())
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert dealt.rdd.getNumPartitions() == cores and sum(sizes) == rows.count() and max(sizes) < 2 * rows.count() / cores
    assert [even_task_count(spark, n, 10) for n in (0, 10 * cores, 10 * cores + 1)] == [cores, cores, 2 * cores]


def test_comparison_imbalance_and_tuning(split):
    comparison, models = training.compare_models(split, NAMES, {modeling.LOGISTIC: {}, modeling.FOREST: {"trees": 5}})
    rows = comparison.collect()
    assert len(rows) == len(models) == 2 and rows[0]["best"] and not rows[1]["best"] and rows[0]["roc_auc"] >= rows[1]["roc_auc"]
    strategies = training.compare_imbalance(split, NAMES).collect()
    assert {r["strategy"] for r in strategies} == {"smote", "class_weight_balanced"} and sum(r["chosen"] for r in strategies) == 1
    trials = training.tune_boosted_trees(split, NAMES, trials=2, baseline_auc=0.5, rounds=(2, 3)).collect()
    assert len(trials) == 2 and trials[0]["improvement"] == pytest.approx(trials[0]["roc_auc"] - 0.5)
    assert training.draw_parameters(3) == training.draw_parameters(3) != training.draw_parameters(4)


def test_strategy_ties_go_to_synthetic_rows():
    even = {"f1_churn": 0.5, "recall_churn": 0.4}
    assert training.choose_strategy({"smote": even, "class_weight_balanced": even}) == "smote"
    better = {"f1_churn": 0.5, "recall_churn": 0.41}
    assert training.choose_strategy({"smote": even, "class_weight_balanced": better}) == "class_weight_balanced"


def test_permutation_importance_and_selection(spark, split):
    def score(df):
        return df.withColumn("probability", 1 / (1 + F.exp(-F.col("bd") / 10)))

    table = training.permutation_importance(score, split.validation, NAMES, repeats=3).collect()
    found = {r["feature"]: (r["perm_importance_mean"], r["perm_importance_std"]) for r in table}
    assert table[0]["feature"] == "bd" and found["bd"][0] > 0.05
    assert all(found[n] == pytest.approx((0.0, 0.0)) for n in NAMES if n != "bd")
    importances = spark.createDataFrame([(n, float(v)) for n, v in (("bd", 3), ("gender", 2), ("copy", 1), ("city", -1))],
                                        "feature string, perm_importance_mean double")
    train = split.train.withColumn("copy", 2 * F.col("bd") + 1)
    chosen = {r["feature"]: (r["status"], r["position"]) for r in training.select_features(importances, train, minimum=2).collect()}
    assert chosen == {"bd": ("kept", 2), "gender": ("kept", 1), "copy": ("dropped_correlation", None), "city": ("dropped_importance", None)}


@pytest.mark.parametrize("kind", [modeling.LOGISTIC, modeling.BOOSTED, modeling.FOREST])
def test_importance_by_differences_equals_importance_by_scoring(spark, split, kind):
    params = {modeling.LOGISTIC: {}, modeling.BOOSTED: {"rounds": 4, "depth": 3}, modeling.FOREST: {"trees": 5}}[kind]
    model = modeling.fit(split.train, NAMES, kind, **params)
    whole = training.permutation_importance(lambda df: modeling.with_probability(model, df), split.validation, NAMES, repeats=2).collect()
    found = training.model_permutation_importance(model, split.validation, NAMES, repeats=2).collect()
    expected = {r["feature"]: (r["perm_importance_mean"], r["perm_importance_std"]) for r in whole}
    assert {r["feature"]: pytest.approx((r["perm_importance_mean"], r["perm_importance_std"]), abs=1e-9) for r in found} == expected


@pytest.mark.parametrize("kind", [modeling.LOGISTIC, modeling.BOOSTED, modeling.FOREST, modeling.PERCEPTRON])
def test_attributions_of_any_champion(spark, split, kind):
    params = {modeling.BOOSTED: {"rounds": 3, "depth": 3}, modeling.FOREST: {"trees": 4}, modeling.PERCEPTRON: {"hidden": (4,), "rounds": 5}}.get(kind, {})
    model = modeling.fit(split.train, NAMES, kind, **params)
    rows = training.model_attributions(model, split.validation, split.train, NAMES, permutations=2).collect()
    assert len(rows) == split.validation.count()
    assert all([e["feature"] for e in r["attributions"]] != [] and {e["feature"] for e in r["attributions"]} == set(NAMES) for r in rows)


def test_promotion_gate_decisions(spark):
    rows = [(0.8, None, 0.7, None), (0.8, 0.7, 0.7, 0.7), (0.7, 0.7, 0.7, 0.7), (0.8, 0.7, 0.68, 0.7), (0.8, 0.7, None, 0.7), (0.8, 0.7, 0.695, 0.7)]
    df = spark.createDataFrame(rows, "challenger_auc double, champion_auc double, challenger_business double, champion_business double")
    found = [r["decision"] for r in promotion.gate_columns(df, tolerance=-0.01).collect()]
    assert found == ["promoted_initial_champion", "promoted_over_champion", "kept_existing_champion",
                     "kept_existing_champion_business_regression", "promoted_over_champion", "promoted_over_champion"]


def test_version_log(spark):
    first = promotion.version_changes(spark, "m", 1, "r1", 0.7, True, datetime(2024, 1, 1))
    champion = promotion.current_production(first, "m")
    kept = first.unionByName(promotion.version_changes(spark, "m", 2, "r2", 0.6, False, datetime(2024, 1, 2), champion))
    assert promotion.current_production(kept, "m").first()["version"] == 1
    new = kept.unionByName(promotion.version_changes(spark, "m", 3, "r3", 0.8, True, datetime(2024, 1, 3), promotion.current_production(kept, "m")))
    row = promotion.current_production(new, "m").first()
    assert (row["version"], row["run_id"]) == (3, "r3")
    assert new.where("version = 1 and stage = 'Archived' and role = 'former_champion'").count() == 1
    assert promotion.current_production(first, "other").count() == 0


def test_error_profiles(spark):
    rows = [(1, 0.9, 1.0, "a"), (1, 0.1, 5.0, "b"), (0, 0.8, 7.0, "b"), (0, 0.2, 2.0, None), (0, 0.3, None, "a")]
    cases = case_columns(spark.createDataFrame(rows, "y int, p double, v double, c string"), "y", "p")
    profile = errors.numeric_error_profile(cases.withColumn("empty", F.lit(None).cast("double")), ["v", "empty"]).collect()
    assert len(profile) == 1
    wrong, right = np.array([5.0, 7.0]), np.array([1.0, 2.0])
    pooled = np.sqrt((wrong.var(ddof=1) + right.var(ddof=1)) / 2)
    assert profile[0]["std_mean_diff"] == pytest.approx((wrong.mean() - right.mean()) / pooled)
    best = errors.categorical_error_profile(cases, ["c"]).first()
    assert (best["category"], best["misclassified_share"], best["correct_share"], best["lift"]) == ("b", 1.0, 0.0, None)
    one = errors.numeric_error_profile(cases.where("y = 1"), ["v"]).first()
    assert one["std_mean_diff"] == 0.0  # one row a side
    lines = errors.error_insights(
        errors.numeric_error_profile(cases, ["v"]), errors.categorical_error_profile(cases, ["c"]), errors.confusion_counts(cases)).collect()
    assert [r["position"] for r in lines] == [1, 3, 4] and "higher" in lines[0]["insight"]
    metrics = errors.classification_metrics(cases.where("false")).first()
    assert (metrics["precision_churn"], metrics["recall_churn"], metrics["f1_churn"]) == (0.0, 0.0, 0.0)


def test_explore_edges(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (None, 3.0), (11.0, None)], "a double, b double")
    rows = explore.histogram(df, ["a", "b"], 5).collect()
    assert len(rows) == 10
    assert [r["count"] for r in rows if r["column"] == "a"] == [2, 0, 0, 0, 1]
    assert sum(r["count"] for r in rows if r["column"] == "b") == 3 and min(r["bin_lower"] for r in rows if r["column"] == "b") == 2.5
    matrix = {(r["column_a"], r["column_b"]): r["correlation"] for r in explore.correlation_matrix(df, ["a", "b"]).collect()}
    assert matrix[("a", "a")] == 1.0 and matrix[("b", "b")] is None and matrix[("a", "b")] is None
    keys = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert explore.duplicate_rows(keys, "k").first()["duplicate_rows"] == 2


def test_fairness(spark):
    df = spark.createDataFrame([("", 1, 0.9), (None, 0, 0.1), ("male", 1, 0.4)], "gender string, is_churn int, churn_probability double")
    rows = {r["gender"]: r for r in fairness.group_fairness(df, "gender").collect()}
    assert rows["Unknown"]["sample_size"] == 2 and rows["Unknown"]["predicted_churn_rate"] == 0.5
    assert fairness.fairness_gap(fairness.group_fairness(df, "gender")).first()[0] == 0.5
    assert fairness.group_fairness(df, "age_band").first()["age_band"] == "Unknown"
    assert fairness.fairness_gap(fairness.group_fairness(df.where("false"), "gender")).first()[0] == 0.0
    with pytest.raises(ValueError):
        fairness.group_fairness(df, "city")
