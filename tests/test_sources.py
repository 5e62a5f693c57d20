from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tenura.operators import catalog
from tenura.plans import build
from tenura.schemas import RAW_SCHEMAS
from tenura.sources import csv, tables


def test_csv_load_replaces_and_counts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "members.csv").write_text("msno,city,bd,gender,registered_via,registration_init_time\na,1,30,,7,20110911\nb,13,0,male,,20120101\n")
    (tmp_path / "in" / "train.csv").write_text("msno,is_churn\na,1\n")
    stamp = datetime(2024, 1, 1)
    files = {"members": "members.csv", "train": "train.csv"}
    for _ in range(2):  # a second load replaces the first
        counts = csv.load_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"), files, stamp)
        assert {r["table"]: r["rows"] for r in counts.collect()} == {"members": 2, "train": 1}
    rows = {r["msno"]: r for r in spark.read.parquet(str(tmp_path / "raw" / "members")).collect()}
    assert rows["a"]["gender"] is None and rows["b"]["registered_via"] is None and rows["a"]["ingestion_timestamp"] == stamp
    found = csv.read_matching(spark, str(tmp_path / "in" / "members.csv"), RAW_SCHEMAS["members"], F.col("city") > 1)
    assert [r["msno"] for r in found.collect()] == ["b"]


def test_malformed_csv_raises(spark, tmp_path):
    (tmp_path / "t.csv").write_text("msno,is_churn\na,yes\n")
    with pytest.raises(Exception):
        csv.read_csv(spark, str(tmp_path / "t.csv"), RAW_SCHEMAS["train"]).collect()


def test_csv_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], RAW_SCHEMAS["train"])
    csv.write_csv(df, str(tmp_path / "out"), ["is_churn", "msno"])
    assert csv.read_csv(spark, str(tmp_path / "out"), "is_churn smallint, msno string").first()["msno"] == "a"


def test_projection_rejects_unknown_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tables.project(df, ["b"], ["a", "b"]).columns == ["b"]
    with pytest.raises(ValueError, match="unknown"):
        tables.project(df, ["c"], ["a", "b"])
    with pytest.raises(ValueError, match="lacks"):
        tables.project(df, ["c"], ["a", "b", "c"])


def test_replace_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(3), path)
    tables.replace_table(tables.read_current(spark, path).selectExpr("id + 10 id"), path)
    assert sorted(r["id"] for r in tables.read_current(spark, path).collect()) == [10, 11, 12]


def test_logs_grow_and_are_pruned_by_day(spark, tmp_path):
    path = str(tmp_path / "log")
    for day in (1, 2):
        df = spark.createDataFrame([(day, datetime(2024, 1, day))], "v int, created_at timestamp")
        tables.append_log(df, path, "created_at")
    log = tables.read_log(spark, path)
    assert log.count() == 2
    assert "PartitionFilters: [isnotnull(run_date" in log.where("run_date = date'2024-01-02'")._jdf.queryExecution().toString()


def test_keyed_update_and_partition_rewrite(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "old"), ("b", 1, None)], "k string, t int, v string")
    changes = spark.createDataFrame([("a", 2, "new"), ("b", 1, None), ("z", 9, "new")], "k string, t int, v string")
    updated = tables.keyed_update(df, changes, ["k", "t"], ["v"])
    assert {(r["k"], r["t"]): r["v"] for r in updated.collect()} == {("a", 1): "old", ("a", 2): "new", ("b", 1): None}
    path = str(tmp_path / "p")
    df.write.partitionBy("t").parquet(path)
    tables.rewrite_partitions(updated.where("t = 2"), path, "t")
    assert {(r["k"], r["t"]): r["v"] for r in spark.read.parquet(path).collect()} == {("a", 1): "old", ("a", 2): "new", ("b", 1): None}


def test_additive_evolution(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, "x")], "a int, b string")
    rows = {r["a"]: (r["b"], r["c"]) for r in tables.evolved(old, new, {"b": "default", "c": 0}).collect()}
    assert rows == {1: ("default", 0), 2: ("x", 0)}


def test_json_columns(spark):
    df = spark.createDataFrame(
        [("[{\"feature\":\"a\",\"shap_value\":0.5}]",), ("[]",), ("{broken",), ("{\"feature\":\"a\"}",), (None,), ("[1",)], "j string")
    rows = [r[0] for r in df.select(tables.parsed_list("j", "struct<feature:string,shap_value:double>")).collect()]
    assert rows[0][0]["feature"] == "a" and rows[1:] == [None] * 5
    back = tables.with_json(spark.createDataFrame([([("a", 0.5)],)], "j array<struct<feature:string,shap_value:double>>"), ["j"])
    assert back.first()["j"] == "[{\"feature\":\"a\",\"shap_value\":0.5}]"


def test_first_existing(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "b"))
    assert tables.first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).count() == 2
    with pytest.raises(ValueError, match="no table"):
        tables.first_existing(spark, [str(tmp_path / "a")])


def test_content_hash_ignores_order_but_not_content(spark):
    rows = [("a", 1, None), ("b", None, "x"), ("b", None, "x"), ("", 2, "N")]
    ddl = "k string, v int, w string"

    def digest(data, parts=1):
        return catalog.content_hash(spark.createDataFrame(data, ddl).repartition(parts)).first()["content_hash"]

    base = digest(rows)
    assert digest(rows[::-1], 5) == base
    assert digest(rows[:3]) != base and digest(rows + rows[1:2]) != base  # duplicates count
    assert digest([("a", 1, ""), *rows[1:]]) != base  # NULL is not empty text
    assert digest([("a|1", 1, None), *rows[1:]]) != base
    stamped = spark.createDataFrame(rows, ddl).withColumn("feature_created_at", F.current_timestamp())
    assert catalog.content_hash(stamped).first()["content_hash"] == base
    assert catalog.content_hash(spark.createDataFrame([], ddl)).first()["row_count"] == 0


def raw_tables(spark, labels):
    return (
        spark.createDataFrame(labels, RAW_SCHEMAS["train"]),
        spark.createDataFrame([("a", 1, 30, "male", 7, 20110911)], RAW_SCHEMAS["members"]),
        spark.createDataFrame([(1, "a", 41, 30, 149, 149, 1, 20170301, 20170401, 0)], "txn_id bigint, " + RAW_SCHEMAS["transactions"]),
        spark.createDataFrame([], RAW_SCHEMAS["user_logs"]),
    )


def test_build_publishes_snapshots_watermarks_and_lineage(spark, tmp_path):
    house = build.Warehouse(str(tmp_path))
    first = build.build_features(spark, house, *raw_tables(spark, [("a", 1), ("b", 0)]), run_id="r1")
    build.record_watermark(spark, house, "customer_features", "r1")
    build.record_lineage(spark, house)
    second = build.build_features(spark, house, *raw_tables(spark, [("a", 1), ("b", 0)]), run_id="r2")
    states = {r["snapshot_id"]: r for r in catalog.snapshot_states(
        spark.read.parquet(house.path("feature_snapshots"))).collect()}
    assert states[first]["status"] == states[second]["status"] == "completed"
    assert states[first]["content_hash"] == states[second]["content_hash"]  # an identical rebuild
    assert states[first]["source_watermark_id"] is None and states[second]["source_watermark_id"] == 1
    assert states[second]["feature_count"] == 22 and states[second]["row_count"] == 2
    lineage = spark.read.parquet(house.path("data_lineage"))
    assert lineage.count() == 22 and {r[0] for r in lineage.select("snapshot_id").distinct().collect()} == {first}
    table = tables.read_current(spark, house.path("customer_features"))
    complete = catalog.lineage_completeness(table, lineage).first()
    assert (complete["missing_in_lineage"], complete["extra_in_lineage"]) == (0, 0)
    partial = catalog.lineage_completeness(table.drop("city"), lineage.where("feature_name <> 'bd'")).first()
    assert (partial["missing_in_lineage"], partial["extra_in_lineage"]) == (1, 1)


def test_failed_build_keeps_the_former_table(spark, tmp_path):
    house = build.Warehouse(str(tmp_path))
    good = build.build_features(spark, house, *raw_tables(spark, [("a", 1)]))
    with pytest.raises(ValueError, match="checks failed"):
        build.build_features(spark, house, *raw_tables(spark, [("a", 1), (None, 0)]))
    log = spark.read.parquet(house.path("feature_snapshots"))
    states = catalog.snapshot_states(log)
    assert {r["status"] for r in states.collect()} == {"completed", "failed"}
    assert catalog.current_snapshot(states).first()["snapshot_id"] == good
    assert tables.read_current(spark, house.path("customer_features")).count() == 1
