"""Registered queries of fitted models whose values or properties SQL can state."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.operators import catalog, explore, modeling, monitoring, trees
from tenura.operators.boosting import Boosting
from tenura.operators.perceptron import margins
from tenura.plans import build, operations, tuning
from tenura.plans import monitoring as plan_monitoring
from tenura.plans import training as training_plans
from tenura.schemas import CATEGORICAL_FEATURES, MODEL_FEATURES
from tenura.session import checkpointed, scratch_folder
from tenura.sources import files, tables
from tenura.sources.retail import AS_OF, RetailViews
from verification.queries import built, cases, feature_table, query, split, version_metrics

# The node tables of two small trees over three features; covers are measured on the feature table.
FIXED_FEATURES = ["cancel_count", "num_active_days", "transaction_count"]
FIXED_TREES = [
    (0, 0, 1, 2, 0, 0.5, None), (0, 1, 3, 4, 1, 3.5, None), (0, 2, 5, 6, 2, 9.5, None),
    (0, 3, -1, -1, -1, None, 0.5), (0, 4, -1, -1, -1, None, -0.25), (0, 5, -1, -1, -1, None, 1.0), (0, 6, -1, -1, -1, None, 2.0),
    (1, 0, 1, 2, 2, 7.5, None), (1, 1, -1, -1, -1, None, -0.5), (1, 2, 3, 4, 1, 5.5, None),
    (1, 3, -1, -1, -1, None, 0.75), (1, 4, 5, 6, 2, 11.5, None), (1, 5, -1, -1, -1, None, 0.25), (1, 6, -1, -1, -1, None, -1.0),
]
# What categorical features count for in the selection query; numeric ones are measured.
FIXED_IMPORTANCES = {"city": 0.011, "gender": 0.05, "latest_is_auto_renew": 0.0, "latest_payment_method_id": 0.04, "registered_via": 0.03}


def entry_sum(column: str = "attributions"):
    return F.aggregate(column, F.lit(0.0), lambda a, e: a + e["shap_value"])


def explained(values: DataFrame, prediction: DataFrame):
    """Rows whose base and attributions add up to the prediction, and rows whose prediction is the model's own."""
    joined = values.join(prediction, "msno")
    whole = F.abs(F.col("base") + entry_sum() - F.col("prediction")) < 1e-9
    return joined.agg(F.count_if(whole).alias("additive"), F.count_if(F.abs(F.col("prediction") - F.col("own")) < 1e-9).alias("equal"))


@query("tree_attribution_checks")
def _(v: RetailViews):
    """Validation rows that exact attributions of boosted trees and of a forest explain to the last digit."""
    parts = split(v)
    prepared = modeling.prepare(parts.train, MODEL_FEATURES)
    found = None
    for kind in (modeling.BOOSTED, modeling.FOREST):
        model = modeling.fit_prepared(prepared, kind)
        values = training_plans.tree_model_attributions(model, parts.validation, MODEL_FEATURES)
        scored = model.transform(parts.validation)
        # Spark's margin is half the log-odds.
        own = 2 * vector_to_array("rawPrediction")[1] if kind == modeling.BOOSTED else vector_to_array("probability")[1]
        row = explained(values, scored.select("msno", own.alias("own"))).withColumn("model", F.lit(kind))
        found = row if found is None else found.unionByName(row)
    return found


@query("fixed_tree_attributions")
def _(v):
    """Exact attributions of two stated trees, with covers counted on the customers."""
    known = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FIXED_FEATURES]
    rows = checkpointed(feature_table(v).select("msno", F.array(*known).alias("x")))
    nodes = {(t, i): node for t, i, *node in FIXED_TREES}

    def reached(tree: int, node: int):
        above = [(i, side) for (t, i), n in nodes.items() if t == tree for side in (0, 1) if n[side] == node]
        if not above:
            return F.lit(True)
        i, side = above[0]
        below = F.col("x")[nodes[tree, i][2]] <= nodes[tree, i][3]
        return reached(tree, i) & (below if side == 0 else ~below)

    counts = rows.agg(*[F.count_if(reached(t, i)).alias(f"n{t}_{i}") for t, i in nodes]).first()
    table = v.spark.createDataFrame(
        [(t, i, left, right, slot, cut, float(counts[f"n{t}_{i}"]), value) for (t, i), (left, right, slot, cut, value) in nodes.items()], trees.NODES)
    values = trees.path_attributions(rows, "msno", "x", trees.path_table(table), [[f] for f in FIXED_FEATURES], FIXED_FEATURES)
    return values.select("msno", "base", "prediction", *[F.col("attributions")[i]["shap_value"].alias(f) for i, f in enumerate(FIXED_FEATURES)])


@query("penalised_tree_checks")
def _(v):
    """Validation rows that attributions explain, rounds with losses, and whether stored losses equal recomputed ones."""
    parts = split(v)
    inputs = tuning.training_inputs(parts, MODEL_FEATURES)
    model, run = tuning.fit_boosted(inputs, Boosting(), patience=30)
    values = tuning.boosted_attributions(inputs, model, parts.validation)
    p = checkpointed(tuning.boosted_probability(inputs, model, parts.validation))
    joined = values.join(p.withColumn("own", F.log(F.col("probability") / (1 - F.col("probability")))), "msno")
    whole = (F.abs(F.col("base") + entry_sum() - F.col("prediction")) < 1e-9) & (F.abs(F.col("prediction") - F.col("own")) < 1e-6)
    weight = F.when(F.col("is_churn") == 1, inputs.positive_weight).otherwise(1.0)
    q = F.when(F.col("is_churn") == 1, F.col("probability")).otherwise(1 - F.col("probability"))
    loss = p.join(parts.validation.select("msno", "is_churn"), "msno").agg((F.sum(-weight * F.log(q)) / F.sum(weight)).alias("loss")).first()["loss"]
    best = min((r[3], r[1]) for r in run.losses)
    falls = run.losses[0][2] > [r[2] for r in run.losses if r[1] == best[1]][0] or best[1] == 0
    return joined.agg(F.count_if(whole).alias("explained")).select(
        "explained", F.lit(abs(loss - best[0]) < 1e-9).alias("same_loss"), F.lit(falls).alias("train_loss_falls"),
        F.lit(len(model.trees) == best[1]).alias("best_round"))


BASELINE_AUC = 0.5


def search(v: RetailViews) -> tuning.Search:
    return tuning.halving_search(tuning.training_inputs(split(v), MODEL_FEATURES), baseline_auc=BASELINE_AUC)


@query("tuning_trials")
def _(v):
    """All thirty trials of the search, the best first."""
    return search(v).trials.select("trial", F.to_json("params").alias("params"), "rung", "rounds", "best_round", "roc_auc", "improvement")


@query("tuning_checks")
def _(v):
    """Per trial of a search: whether its facts agree with the stored losses of its rounds and with the rungs."""
    found = search(v)
    trials, history = checkpointed(found.trials), checkpointed(found.history)
    least = history.groupBy("trial").agg(
        F.max("round").alias("last"), F.count_distinct("round").alias("n"), F.min_by("round", F.struct("validation_loss", "round")).alias("least"))
    reached = [r["n"] for r in trials.groupBy("rung").agg(F.count(F.lit(1)).alias("n")).orderBy("rung").collect()]
    still = [sum(reached[i:]) for i in range(len(reached))]
    top = trials.orderBy(F.col("rung").desc(), F.col("roc_auc").desc(), "trial").first()["trial"]
    drawn = F.col("params")
    ranges = (
        drawn["rounds"].between(100, 1000) & drawn["depth"].between(3, 10) & drawn["rate"].between(0.01, 0.3)
        & drawn["row_share"].between(0.5, 1) & drawn["column_share"].between(0.5, 1) & drawn["least_child"].between(1, 10)
        & drawn["gamma"].between(0, 5) & drawn["alpha"].between(1e-8, 10) & drawn["penalty"].between(1e-8, 10)
    )
    return trials.join(least, "trial").select(
        "trial", ranges.alias("in_ranges"), (F.col("rounds") == F.col("last")).alias("all_rounds"), (F.col("n") == F.col("last") + 1).alias("no_gap"),
        (F.col("best_round") == F.col("least")).alias("best_round"), (F.abs(F.col("improvement") - (F.col("roc_auc") - BASELINE_AUC)) < 1e-12).alias("improved"),
        ((F.col("trial") == top) == (F.col("trial") == trials.first()["trial"])).alias("ordered"),
        F.lit(",".join(map(str, still))).alias("at_rungs"),
    )


@query("forest_checks")
def _(v):
    """A forest's importances: their sum, that of a constant column, and rows whose probability lies in [0, 1]."""
    parts = split(v)
    features = [*MODEL_FEATURES, "constant"]
    train = parts.train.withColumn("constant", F.lit(7))
    model = modeling.fit(train, features, modeling.FOREST)
    found = checkpointed(modeling.slot_importances(v.spark, model, features))
    scored = modeling.with_probability(model, parts.validation.withColumn("constant", F.lit(7)))
    slots = modeling.slot_names(model, features)
    return scored.agg(F.count_if(F.col("probability").between(0, 1)).alias("in_range")).select(
        "in_range", F.lit(found.agg(F.sum("model_importance")).first()[0]).alias("importance"),
        F.lit(found.where("feature = 'constant'").first()["model_importance"]).alias("constant"),
        F.lit(found.count() == sum(len(s) for s in slots.values())).alias("all_slots"))


@query("perceptron_checks")
def _(v):
    """Validation rows whose probability is that of a pass through the stored weights, and training rows."""
    parts = split(v)
    prepared = modeling.prepare(parts.train, MODEL_FEATURES)
    model = modeling.fit_prepared(prepared, modeling.PERCEPTRON)
    stage = model.stages[-1]
    theta, layers = np.array(stage.getOrDefault("weights")), stage.getOrDefault("layers")
    scored = modeling.with_probability(model, parts.validation).select("msno", "probability")
    vectors = prepared.head.transform(parts.validation).select("msno", vector_to_array(modeling.FEATURES).alias("x"))

    def passed(batches):
        for batch in batches:
            yield batch.assign(own=1 / (1 + np.exp(-margins(theta, layers, np.stack(batch["x"])))) if len(batch) else 0.0)[["msno", "own"]]

    joined = scored.join(vectors.mapInPandas(passed, "msno string, own double"), "msno")
    return joined.agg(F.count_if(F.abs(F.col("own") - F.col("probability")) < 1e-9).alias("equal")).select(
        "equal", F.lit(sum(prepared.counts.values())).cast("bigint").alias("rows"))


@query("comparison_checks")
def _(v):
    """Per compared model whether it is marked best, and whether the marks and metrics agree with each other."""
    table = checkpointed(training_plans.compare_models(split(v), MODEL_FEATURES, [modeling.LOGISTIC, modeling.FOREST])[0])
    most = table.agg(F.max("roc_auc")).first()[0]
    p, r = F.col("precision_churn"), F.col("recall_churn")
    return table.select(
        "model", (F.col("best") == (F.col("roc_auc") == most)).alias("marked"), F.col("roc_auc").between(0, 1).alias("in_range"),
        (F.abs(F.col("f1_churn") - F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))) < 1e-9).alias("agrees"))


@query("selection_from_importances")
def _(v):
    """Feature selection from an importance table: correlation with the label for numbers, stated values for the rest."""
    table = checkpointed(feature_table(v))
    numeric = [f for f in MODEL_FEATURES if f not in CATEGORICAL_FEATURES]
    matrix = explore.correlation_matrix(table, [*numeric, "is_churn"]).where("column_b = 'is_churn' AND column_a <> 'is_churn'")
    measured = matrix.select(F.col("column_a").alias("feature"), F.coalesce(F.abs(F.round("correlation", 6)), F.lit(0.0)).alias("perm_importance_mean"))
    stated = v.spark.createDataFrame(list(FIXED_IMPORTANCES.items()), measured.schema)
    return training_plans.select_features(checkpointed(measured.unionByName(stated)), table, importance_threshold=0.01)


@query("strategy_from_metrics")
def _(v):
    """The strategy that stored metrics choose, with two model versions in the roles of the strategies."""
    names = {"v0": training_plans.SMOTE, "v1": training_plans.CLASS_WEIGHT}
    rows = {r["model_version"]: r.asDict() for r in version_metrics(v).where(F.col("model_version").isin(list(names))).collect()}
    metrics = {names[k]: m for k, m in rows.items()}
    chosen = training_plans.choose_strategy(metrics)
    return v.spark.createDataFrame(
        [(n, m["f1_churn"], m["recall_churn"], n == chosen) for n, m in metrics.items()],
        "strategy string, f1_churn double, recall_churn double, chosen boolean")


@query("model_card_facts")
def _(v):
    """The model card of the stored scores: data, features, metrics and fairness."""
    scored = checkpointed(cases(v).withColumn("probability", F.col("churn_probability").cast("double")))
    metrics = training_plans.errors.classification_metrics(scored)
    area = monitoring.roc_auc(scored, "actual", "churn_probability").select("roc_auc").scalar()
    table = feature_table(v)
    return training_plans.model_card("churn", table, ["bd", "gender", "total_amount_paid"], metrics.withColumn("roc_auc", area), scored)


@query("top_importances_report")
def _(v):
    """The five numeric features that correlate most with the label."""
    numeric = [f for f in MODEL_FEATURES if f not in CATEGORICAL_FEATURES]
    matrix = explore.correlation_matrix(feature_table(v), [*numeric, "is_churn"]).where("column_b = 'is_churn' AND column_a <> 'is_churn'")
    table = matrix.select(F.col("column_a").alias("feature"), F.coalesce(F.abs(F.round("correlation", 6)), F.lit(0.0)).alias("perm_importance_mean"))
    return monitoring.top_importances(table, 5)


@query("projected_features")
def _(v):
    """Requested columns of the feature table in the requested order."""
    return tables.project(feature_table(v), ["total_amount_paid", "msno", "gender", "bd"], ["msno", *MODEL_FEATURES])


@query("registration_log")
def _(v):
    """Three registrations: the first champion, a challenger that stays out, and one that archives the champion."""
    path = f"{scratch_folder(v.spark, 'versions')}/log"
    areas = {r["model_version"]: r["roc_auc"] for r in version_metrics(v).select("model_version", "roc_auc").collect()}
    low, middle, high = sorted(areas.values())[:3]
    for i, area in enumerate((middle, low, high)):
        operations.register(v.spark, path, "churn", f"r{i}", {"roc_auc": area, "business": None}, None, AS_OF + timedelta(days=i))
    log = tables.read_log(v.spark, path)
    return log.select("version", "stage", "role", "run_id", "roc_auc", F.to_date("logged_at").alias("day"))


@query("lineage_log")
def _(v):
    """The lineage log of a build: the registry stamped with the current snapshot."""
    warehouse = built(v)
    build.record_lineage(v.spark, warehouse)
    states = catalog.snapshot_states(v.spark.read.parquet(warehouse.path("feature_snapshots")).drop("run_date"))
    current = catalog.current_snapshot(states).select("snapshot_id").scalar()
    log = tables.read_log(v.spark, warehouse.path("data_lineage"))
    return log.select("feature_name", "source_table", "transformation_rule", (F.col("snapshot_id") == current).alias("current"))


@query("chosen_training")
def _(v):
    """A fit on the stored choices of the steps before: kept features and the strategy, read back from their tables."""
    folder, parts = scratch_folder(v.spark, "choices"), split(v)
    model = modeling.fit(parts.train, MODEL_FEATURES, modeling.LOGISTIC)
    importances = training_plans.model_permutation_importance(model, parts.validation, MODEL_FEATURES)
    tables.replace_table(training_plans.select_features(checkpointed(importances), parts.train), f"{folder}/selection")
    tables.replace_table(training_plans.compare_imbalance(parts, MODEL_FEATURES), f"{folder}/strategies")
    selection, strategies = (tables.read_current(v.spark, f"{folder}/{n}") for n in ("selection", "strategies"))
    features, strategy = tuning.stored_choices(selection, strategies)
    inputs = tuning.training_inputs(parts, features, strategy)
    counts = inputs.rows.agg(F.count_if(~F.col("train")).alias("validation"), F.count_if("train").alias("n"), F.count_if(F.col("train") & (F.col("label") == 0)).alias("zeros"))
    kept = selection.where("status = 'kept'").count()
    smote_rows = strategy == training_plans.SMOTE
    half = F.col("n") - F.col("zeros") == F.floor(0.5 * F.col("zeros")) if smote_rows else F.lit(True)
    return counts.select(
        "validation", F.col("zeros").alias("training_zeros"), F.lit(len(features) == kept).alias("all_kept"), half.alias("balanced"),
        F.lit(abs(inputs.positive_weight - 1.0) < 1e-12).eqNullSafe(F.lit(smote_rows)).alias("weighted"))


@query("monitoring_state_verdict")
def _(v):
    """The verdict from daily counts that were recorded in two parts, the second again."""
    path, table = f"{scratch_folder(v.spark, 'state')}/days", checkpointed(feature_table(v))
    cut = AS_OF.date() - timedelta(days=6)
    for first, last in ((date(2000, 1, 1), cut), (cut, date(2100, 1, 1)), (cut, date(2100, 1, 1))):
        plan_monitoring.record_days(v.spark, path, v.predictions, table, v.train, first, last)
    return plan_monitoring.state_verdict(v.spark, path, AS_OF).select(
        "baseline_auc", "baseline_auc_source", "current_auc", "auc_delta", "max_psi", "breached", "breached_reasons",
        "cohort_strategy", "baseline_row_count", "current_row_count", "status", "brier_score", "max_calibration_error",
        "breached_segments", "min_sample_threshold", F.size("calibration_bins").alias("bins"),
    )


@query("updated_files")
def _(v):
    """Files that an update of a few predictions wrote anew, those it kept, and the rows behind them."""
    path = f"{scratch_folder(v.spark, 'files')}/predictions"
    rows = checkpointed(v.predictions.select("pred_id", "customer_id", "risk_tier", F.lit("old").alias("note")))
    for part in range(8):
        files.append_files(rows.where(F.col("pred_id") % 8 == part).coalesce(1), path)
    changes = rows.where("risk_tier = 'High' AND pred_id % 8 IN (2, 5)").select("pred_id", F.lit("new").alias("note"))
    done = files.update_files(v.spark, path, changes, ["pred_id"], ["note"])
    removed = files.remove_unnamed(v.spark, path)
    return files.read_files(v.spark, path).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("pred_id").alias("ids"), F.count_if(F.col("note") == "new").alias("changed")
    ).select("rows", "ids", "changed", F.lit(done.rewritten).alias("rewritten"), F.lit(done.kept).alias("kept"), F.lit(removed).alias("removed"))


@query("partition_watermark")
def _(v):
    """Digests of a log after two appends and without a change, and how many day folders each was hashed from."""
    folder = scratch_folder(v.spark, "digests")
    rows = v.predictions.select("pred_id", "customer_id", "risk_tier", "scored_at")
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    found = None
    for step, part in enumerate((rows.where(F.col("scored_at") < cut), rows.where(F.col("scored_at") >= cut), None)):
        if part is not None:
            tables.append_log(part, f"{folder}/log", "scored_at")
        digest, hashed = files.partition_digest(v.spark, f"{folder}/log", f"{folder}/sums")
        whole = catalog.content_hash(v.spark.read.parquet(f"{folder}/log")).first()
        row = checkpointed(digest.select(
            F.lit(step).alias("step"), "row_count", (F.col("content_hash") == whole["content_hash"]).alias("equal"), F.lit(len(hashed)).alias("hashed")))
        found = row if found is None else found.unionByName(row)
    return found
