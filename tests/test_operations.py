"""Stored plans from raw CSV files to the retention queue and back into the logs."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.operators import dashboard, latest, modeling, promotion, quality, resampling
from tenura.operators.attributions import sampling_shapley
from tenura.plans import build, operations, scoring, training
from tenura.plans.bundle import bundle, checked_inputs, load_bundle, save_bundle
from tenura.schemas import MODEL_FEATURES, PREDICTION_SCHEMA, RAW_SCHEMAS, VALIDATION_SCHEMA, fields
from tenura.sources import csv, tables
from tenura.sources.retail import AS_OF, RetailViews

NAMES = ["bd", "city", "transaction_count", "cancel_count", "num_active_days"]


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    """CSV files in the loader's layout, loaded and built into a feature table; nothing is added on the way."""
    folder = tmp_path_factory.mktemp("e2e")
    views = RetailViews(spark, "/root/testdata/sf0.001")
    names = ("train", "members", "transactions", "user_logs")
    for name in names:
        csv.write_csv(getattr(views, name), f"{folder}/in/{name}", [n for n, _ in fields(RAW_SCHEMAS[name])])
    csv.load_raw(spark, f"{folder}/in", f"{folder}/raw", {n: n for n in names}).collect()
    warehouse = build.Warehouse(str(folder))
    raw = [spark.read.parquet(f"{folder}/raw/{n}") for n in names]
    assert "txn_id" not in raw[2].columns
    build.build_features(spark, warehouse, *raw, run_id="r1")
    return warehouse


@pytest.fixture(scope="module")
def made(spark, house):
    table = tables.read_current(spark, house.path("customer_features"))
    split = training.split_features(table)
    model = modeling.fit(split.train, NAMES, modeling.LOGISTIC, max_iter=50)
    return bundle(model, table, NAMES, "7", {"roc_auc": 0.7})


def test_from_files_to_the_retention_queue(spark, house, made):
    table = tables.read_current(spark, house.path("customer_features"))
    assert table.count() == 150 and set(MODEL_FEATURES) <= set(table.columns)
    save_bundle(made, f"{house.root}/bundle", spark)
    again = load_bundle(spark, f"{house.root}/bundle")
    assert (again.input_types, again.version, again.metrics) == (made.input_types, "7", {"roc_auc": 0.7})
    log = house.path("churn_predictions")
    for day in (0, 1):
        scoring.score_and_append(log, checked_inputs(table, again), again.model, again.input_columns, AS_OF + timedelta(days=day), "snap", again.version)
    assert operations.attribute_newest_scores(spark, log, table, table, again) == 150
    rows = tables.read_log(spark, log, PREDICTION_SCHEMA)
    assert rows.count() == 300
    newest = latest.latest_predictions(rows)
    filled = rows.groupBy(F.col("shap_values").isNotNull().alias("filled")).count().collect()
    assert {(r["filled"], r["count"]) for r in filled} == {(True, 150), (False, 150)}
    assert newest.where(F.size("shap_values") == 5).count() == 150
    queue = dashboard.retention_queue(newest, table) if hasattr(dashboard, "retention_queue") else newest
    assert queue.count() > 0


def test_contract_is_checked(spark, house, made):
    table = tables.read_current(spark, house.path("customer_features"))
    reordered = table.select("msno", *reversed(NAMES), F.lit(1).alias("extra"))
    assert checked_inputs(reordered, made) is reordered
    with pytest.raises(ValueError, match="breaks the model's contract"):
        checked_inputs(table.drop("bd"), made)
    with pytest.raises(ValueError, match="lack input columns"):
        bundle(made.model, table, [*NAMES, "nothing"], "8", {})
    with pytest.raises(ValueError, match="does not fit"):
        bundle(made.model, table, NAMES[:2], "8", {})


def test_validation_runs_are_logged(spark, house, tmp_path):
    table = tables.read_current(spark, house.path("customer_features"))
    rules = {
        "schema": [{"table": "f", "severity": "blocking", "required_columns": {"msno": "text"}}],
        "distribution": {"table": "f", "severity": "warning", "numeric_columns": ["transaction_count"]},
    }
    first = operations.validate_and_log(spark, {"f": table}, rules, f"{tmp_path}/log", "a", AS_OF).first()
    moved = table.withColumn("transaction_count", F.col("transaction_count") + 1000)
    second = operations.validate_and_log(spark, {"f": moved}, rules, f"{tmp_path}/log", "b", AS_OF + timedelta(days=1)).first()
    assert (first["ok"], second["ok"], second["warning_failures"], second["failing"]) == (2, 1, 1, False)
    assert tables.read_log(spark, f"{tmp_path}/log", VALIDATION_SCHEMA).count() == 4


def test_unknown_severities_never_pass(spark):
    rules = {"schema": [{"table": "f", "severity": "Blocking", "required_columns": {}}]}
    with pytest.raises(ValueError, match="unknown severity"):
        quality.run_rules(spark, {"f": spark.range(1)}, rules, AS_OF)
    with pytest.raises(ValueError, match="unknown severity"):
        quality.run_rules(spark, {}, {"smoke": [{"rule_name": "r", "kind": "new", "severity": "fatal"}]}, AS_OF)
    log = spark.createDataFrame([("a", "Blocking", "fail"), ("b", None, "broken"), ("c", "warning", "fail")], "rule_name string, severity string, status string")
    row = quality.verdict(log).first()
    assert (row["blocking_failures"], row["warning_failures"], row["failing"]) == (2, 1, True)


def test_the_engines_own_tables_meet_the_schema_rules(spark):
    from tenura.schemas import FEATURE_SCHEMA, SNAPSHOT_SCHEMA

    layouts = {
        "processed.customer_features": FEATURE_SCHEMA + ", feature_created_at timestamp",
        "processed.churn_predictions": PREDICTION_SCHEMA, "processed.feature_snapshots": SNAPSHOT_SCHEMA,
    }
    own = {name: spark.createDataFrame([], ddl) for name, ddl in layouts.items()}
    rows = quality.run_rules(spark, own, {"schema": quality.DEFAULT_RULE_SET["schema"]}, AS_OF).collect()
    assert {r["status"] for r in rows} == {"pass"}


def test_registration_and_monitoring_logs(spark, house, tmp_path):
    path = f"{tmp_path}/versions"
    at = datetime(2024, 1, 1)
    first = operations.register(spark, path, "churn", "r1", {"roc_auc": 0.7, "business": 0.5}, None, at).first()
    worse = operations.register(spark, path, "churn", "r2", {"roc_auc": 0.6, "business": 0.5}, 0.5, at + timedelta(days=1)).first()
    better = operations.register(spark, path, "churn", "r3", {"roc_auc": 0.8, "business": 0.6}, 0.5, at + timedelta(days=2)).first()
    assert [(r["version"], r["promote"]) for r in (first, worse, better)] == [(1, True), (2, False), (3, True)]
    log = tables.read_log(spark, path, promotion.VERSION_LOG)
    current = promotion.current_production(log, "churn").first()
    assert (current["version"], current["role"]) == (3, "champion")
    assert log.where("version = 1 AND stage = 'Archived'").count() == 1
    views = RetailViews(spark, "/root/testdata/sf0.001")
    table = tables.read_current(spark, house.path("customer_features"))
    row = operations.monitor_and_log(spark, f"{tmp_path}/monitoring", path, "churn", views.predictions, table, views.train, AS_OF).first()
    assert row["baseline_auc"] == 0.8 and row["status"] == "insufficient_data"
    assert spark.read.parquet(f"{tmp_path}/monitoring").count() == 1


def test_background_draws_follow_its_values(spark):
    rows = spark.range(200).selectExpr("cast(id as string) as k", "1.0D as x")
    background = spark.range(100).selectExpr("cast(id as string) as k", "if(id % 10 = 0, 5.0D, 0.0D) as x")
    values = sampling_shapley(rows, background, "k", ["x"], lambda df: df.withColumn("probability", F.col("x")), permutations=4)
    base = values.agg(F.avg("base").alias("b")).first()["b"]
    assert base == pytest.approx(0.5, abs=0.2)  # a tenth of the background holds 5


def test_neighbours_over_range_borders_and_of_equal_vectors(spark):
    line = spark.range(100).selectExpr("cast(id as string) as k", "array(cast(id as double)) as x")
    rows = resampling.near_neighbours(line, "k", "x", 5).collect()
    for r in rows:
        x = r["x"][0]
        expected = sorted(abs(x - i) for i in range(100) if i != x)[:5]
        assert sorted(abs(x - y[0]) for y in r["neighbours"]) == expected
    same = spark.range(5000).selectExpr("cast(id as string) as k", "array(if(id < 4990, 0.0D, cast(id as double))) as x")
    found = resampling.near_neighbours(same, "k", "x", 5)
    assert found.count() == 5000 and found.where("x[0] = 0 AND neighbours[4][0] = 0").count() == 4990
    assert found.where(F.size("neighbours") < 5).count() == 0


@pytest.mark.parametrize(("width", "rows", "block_rows"), [(2, 300, 20), (2, 3000, 100), (20, 300, 30), (20, 2000, 2000), (20, 2000, 300)])
def test_neighbours_are_the_nearest_of_all(spark, width, rows, block_rows):
    rng = np.random.default_rng(width + rows)
    points = rng.normal(size=(rows, width))
    points[: rows // 10] = points[0] + rng.normal(size=(rows // 10, width)) * 1e-3  # a dense spot
    points[-3:] += 1000.0  # far from all others
    df = spark.createDataFrame([(f"k{i}", [float(v) for v in p]) for i, p in enumerate(points)], "k string, x array<double>")
    found = resampling.near_neighbours(df, "k", "x", block_rows=block_rows).collect()
    assert len(found) == rows
    for r in found:
        i = int(r["k"][1:])
        d = ((points - points[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert [((np.array(y) - points[i]) ** 2).sum() for y in r["neighbours"]] == pytest.approx(np.sort(d)[:5].tolist(), rel=1e-9)


def test_neighbours_of_empty_and_tiny_tables(spark):
    schema = "k string, x array<double>"
    assert resampling.near_neighbours(spark.createDataFrame([], schema), "k", "x").count() == 0
    few = resampling.near_neighbours(spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("c", None)], schema), "k", "x").collect()
    assert {r["k"]: r["neighbours"] for r in few} == {"a": [[2.0]], "b": [[1.0]]}


def test_drawn_trees_split(spark, made, house):
    params = [training.draw_parameters(i) for i in range(40)]
    assert all(1e-6 <= p["minInfoGain"] <= 1e-2 for p in params)
    table = tables.read_current(spark, house.path("customer_features"))
    model = modeling.fit(table, NAMES, modeling.BOOSTED, **{**params[0], "rounds": 3}).stages[-1]
    assert all(t.numNodes > 1 for t in model.trees)


def test_a_level_with_a_backslash_is_filled_in(spark):
    df = spark.createDataFrame([("a", "x\\'y", 1), ("b", "x\\'y", 0), ("c", None, 1)], "msno string, gender string, is_churn int")
    prepared = modeling.prepare(df, ["gender"])
    assert prepared.vectors.select(modeling.FEATURES).distinct().count() == 1
