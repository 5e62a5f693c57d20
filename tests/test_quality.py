import json
from datetime import datetime

import pytest

from tenura.operators import quality

AS_OF = datetime(2024, 5, 1, 12)
SCHEMA = "k string, v int, t timestamp"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def run(spark, df, rule_set, log=None, others=None):
    rows = quality.run_rules(spark, {"t": df, **(others or {})}, rule_set, AS_OF, log).orderBy("position").collect()
    return [(r["rule_name"], r["severity"], r["status"], json.loads(r["detail"])) for r in rows]


def test_schema_rule_names_missing_and_mismatched_columns(spark):
    df = table(spark, [("a", 1, None)])
    wanted = {"k": "TEXT", "v": "integer", "t": "timestamp with time zone"}
    assert run(spark, df, {"schema": [{"table": "t", "required_columns": wanted}]})[0][1:3] == ("blocking", "pass")
    name, _, status, detail = run(spark, df, {"schema": [{"table": "t", "required_columns": {"v": "numeric", "w": "text"}}]})[0]
    assert (name, status, detail["missing_columns"]) == ("schema::t", "fail", ["w"])
    assert "v" in detail["mismatched_types"][0] and detail["actual_column_count"] == 3


def test_freshness_edges(spark):
    rule = {"freshness": [{"table": "t", "timestamp_column": "t", "max_age_hours": 24}]}
    assert run(spark, table(spark, [("a", 1, datetime(2024, 4, 30, 12))]), rule)[0][1:3] == ("warning", "pass")
    late = run(spark, table(spark, [("a", 1, datetime(2024, 4, 30, 11, 59, 59))]), rule)[0]
    assert late[2] == "fail" and late[3]["age_hours"] == 24.0003
    for rows in ([], [("a", 1, None)]):
        status, detail = run(spark, table(spark, rows), rule)[0][2:]
        assert status == "fail" and detail["reason"] == "empty_table_or_null_timestamp"


def test_coverage_edges(spark):
    rule = {"coverage": [{"table": "t", "column": "v", "min_non_null_ratio": 0.5}]}
    assert run(spark, table(spark, [("a", 1, None), ("b", None, None)]), rule)[0][2] == "pass"
    assert run(spark, table(spark, [("a", None, None)]), rule)[0][2] == "fail"
    assert run(spark, table(spark, []), rule)[0][3]["reason"] == "empty_table"


def test_distribution_baseline_is_the_newest_passing_row(spark):
    rule = {"distribution": {"table": "t", "numeric_columns": ["v"]}}
    name = "distribution::t::v"
    log = spark.createDataFrame([
        ("r1", name, "warning", "pass", '{"mean": 10.0, "std": 1.0, "n": 5}', datetime(2024, 1, 1)),
        ("r2", name, "warning", "pass", '{"mean": 4.0, "std": 2.0, "n": 5}', datetime(2024, 1, 2)),
        ("r3", name, "warning", "fail", '{"mean": 99.0, "std": 1.0, "n": 5}', datetime(2024, 1, 3)),
    ], "run_id string, rule_name string, severity string, status string, detail string, created_at timestamp")
    df = table(spark, [("a", 7, None), ("b", 9, None)])
    _, _, status, detail = run(spark, df, rule, log)[0]
    assert (status, detail["deviation"], detail["baseline"]["mean"]) == ("pass", 2.0, 4.0)
    assert run(spark, df, {"distribution": {**rule["distribution"], "deviation_threshold": 1.9}}, log)[0][2] == "fail"
    assert run(spark, df, rule)[0][2] == "pass"  # first run
    assert run(spark, table(spark, [("a", None, None)]), rule, log)[0][2] == "skip"
    flat = log.selectExpr("* except (detail)", "'{\"mean\": 4.0, \"std\": 0.0}' detail")
    assert run(spark, df, rule, flat)[0][3]["deviation"] == 1.0  # scaled by the mean


def test_smoke_rules(spark):
    df = table(spark, [("a", 1, None), ("a", 5, None), ("b", None, None), (None, 2, None)])
    rules = [
        {"rule_name": "some", "kind": "row_count_positive", "table": "t"},
        {"rule_name": "same", "kind": "row_count_match", "left_table": "t", "right_table": "u"},
        {"rule_name": "set", "kind": "value_in_set", "table": "t", "column": "v", "allowed_values": [1, 2]},
        {"rule_name": "unique", "kind": "unique_column", "table": "t", "column": "k"},
        {"rule_name": "range", "kind": "numeric_range", "table": "t", "column": "v", "min": 2, "allow_null": False},
        {"rule_name": "odd", "kind": "guess"},
    ]
    found = run(spark, df, {"smoke": rules}, others={"u": df.limit(3)})
    assert [f[2] for f in found] == ["pass", "fail", "fail", "fail", "fail", "fail"]
    assert found[2][3]["violations"] == 2 and found[3][3]["duplicates"] == 1
    assert found[4][3]["violations"] == 1  # NULL is never out of range
    assert found[5][1] == "warning" and "unknown smoke kind" in found[5][3]["reason"]
    with pytest.raises(ValueError):
        run(spark, df, {"smoke": [{"rule_name": "r", "kind": "numeric_range", "table": "t", "column": "v"}]})


def test_verdict_and_log(spark):
    df = table(spark, [])
    results = quality.run_rules(spark, {"t": df}, {
        "smoke": [{"rule_name": "some", "kind": "row_count_positive", "table": "t"}],
        "coverage": [{"table": "t", "column": "v", "min_non_null_ratio": 0.5}]}, AS_OF)
    verdict = quality.verdict(results).first()
    assert (verdict["rules"], verdict["ok"], verdict["warning_failures"], verdict["blocking_failures"]) == (2, 0, 1, 1)
    assert verdict["failing"]
    old = quality.stamped_results(results, "r1", datetime(2024, 1, 1))
    new = quality.stamped_results(results, "r2", datetime(2024, 2, 1))
    assert {r["run_id"] for r in quality.newest_run(old.unionByName(new)).collect()} == {"r2"}
    history = quality.blocking_failure_history(old.unionByName(new)).collect()
    assert [(r["rule_name"], r["last_failed_at"]) for r in history] == [("some", datetime(2024, 2, 1))]


def test_one_aggregation_per_table(spark):
    rules = {"coverage": [{"table": "t", "column": c, "min_non_null_ratio": 0.1} for c in ("k", "v", "t")]}
    result = quality.run_rules(spark, {"t": spark.range(10).selectExpr("cast(id as string) k", "id v", "id t")}, rules, AS_OF)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_empty_rule_set(spark):
    assert quality.run_rules(spark, {}, {}, AS_OF).count() == 0


def test_build_checks(spark):
    train = spark.createDataFrame([("a", 1), ("b", 0)], "msno string, is_churn int")
    assert quality.build_checks(train, train).first()["passed"]
    broken = spark.createDataFrame([("a", None), (None, 0)], "msno string, is_churn int")
    row = quality.build_checks(broken, train).first()
    assert not row["passed"] and (row["null_msno"], row["null_is_churn"]) == (1, 1)
