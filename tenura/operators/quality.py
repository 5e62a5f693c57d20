"""Declarative data-quality rules. Every rule yields rule_name, severity, status and a JSON detail.

Rules over one table share one aggregation; only uniqueness needs a grouping of its own. Rule sets are plain dicts:
``{"schema": [...], "freshness": [...], "coverage": [...], "distribution": {...}, "smoke": [...]}``.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.schemas import SQL_TYPE_NAMES

PASS, FAIL, SKIP = "pass", "fail", "skip"
BLOCKING, WARNING = "blocking", "warning"
SEVERITIES = (BLOCKING, WARNING)
TINY = 1e-9

RESULT_COLUMNS = ["position", "rule_name", "severity", "status", "detail"]

# The default rule set.
DEFAULT_RULE_SET: dict = {
    "schema": [
        {
            "table": "processed.customer_features",
            "severity": BLOCKING,
            "required_columns": {
                "msno": "text", "is_churn": "smallint", "transaction_count": "integer", "renewal_count": "integer",
                "cancel_count": "integer", "total_amount_paid": "numeric", "num_active_days": "integer",
                "total_secs": "numeric", "feature_created_at": "timestamp with time zone",
            },
        },
        {
            "table": "processed.churn_predictions",
            "severity": BLOCKING,
            "required_columns": {
                "customer_id": "text", "churn_probability": "numeric", "risk_tier": "character varying",
                "scored_at": "timestamp with time zone",
            },
        },
        {
            "table": "processed.feature_snapshots",
            "severity": WARNING,
            "required_columns": {"snapshot_id": "uuid", "status": "character varying", "row_count": "integer"},
        },
    ],
    "freshness": [
        {"table": "raw.members", "timestamp_column": "ingestion_timestamp", "max_age_hours": 168, "severity": WARNING},
        {"table": "raw.transactions", "timestamp_column": "ingestion_timestamp", "max_age_hours": 168, "severity": WARNING},
        {"table": "raw.user_logs", "timestamp_column": "ingestion_timestamp", "max_age_hours": 168, "severity": WARNING},
        {"table": "raw.train", "timestamp_column": "ingestion_timestamp", "max_age_hours": 720, "severity": WARNING},
    ],
    "coverage": [
        {"table": "processed.customer_features", "column": "msno", "min_non_null_ratio": 1.0, "severity": BLOCKING},
        {"table": "processed.customer_features", "column": "is_churn", "min_non_null_ratio": 1.0, "severity": BLOCKING},
        {"table": "processed.customer_features", "column": "transaction_count", "min_non_null_ratio": 0.95, "severity": BLOCKING},
        {"table": "processed.customer_features", "column": "total_amount_paid", "min_non_null_ratio": 0.85, "severity": WARNING},
        {"table": "processed.customer_features", "column": "latest_payment_method_id", "min_non_null_ratio": 0.85, "severity": WARNING},
        {"table": "processed.customer_features", "column": "num_active_days", "min_non_null_ratio": 0.50, "severity": WARNING},
    ],
    "distribution": {
        "table": "processed.customer_features",
        "severity": WARNING,
        "deviation_threshold": 2.0,
        "numeric_columns": ["transaction_count", "total_amount_paid", "num_active_days", "total_secs"],
    },
    "smoke": [
        {"rule_name": "row_count_positive", "severity": BLOCKING, "kind": "row_count_positive", "table": "processed.customer_features"},
        {"rule_name": "row_count_matches_train", "severity": BLOCKING, "kind": "row_count_match",
         "left_table": "processed.customer_features", "right_table": "raw.train"},
        {"rule_name": "is_churn_binary", "severity": BLOCKING, "kind": "value_in_set",
         "table": "processed.customer_features", "column": "is_churn", "allowed_values": [0, 1]},
        {"rule_name": "no_duplicate_msno", "severity": BLOCKING, "kind": "unique_column",
         "table": "processed.customer_features", "column": "msno"},
        {"rule_name": "bd_in_plausible_range", "severity": WARNING, "kind": "numeric_range",
         "table": "processed.customer_features", "column": "bd", "min": 0, "max": 100, "allow_null": True},
        {"rule_name": "total_amount_paid_non_negative", "severity": BLOCKING, "kind": "numeric_range",
         "table": "processed.customer_features", "column": "total_amount_paid", "min": 0, "allow_null": True},
    ],
}


class TableRules:
    """The rules of one table: aggregates they need and the result row each makes of them."""

    def __init__(self, name: str, df: DataFrame):
        self.name, self.df = name, df
        self.aggregates: dict[str, Column] = {}
        self.results: list[Column] = []

    def measure(self, key: str, aggregate: Column) -> Column:
        self.aggregates.setdefault(key, aggregate)
        return F.col(f"`{key}`")

    def rows(self) -> Column:
        return self.measure("rows", F.count(F.lit(1)))

    def result(self, position: int, rule_name: str, severity: str, status: Column, detail: Mapping[str, Column]) -> None:
        if severity not in SEVERITIES:
            raise ValueError(f"unknown severity {severity!r} of rule {rule_name}")
        document = F.to_json(F.struct(*[value.alias(key) for key, value in detail.items()]))
        self.results.append(F.struct(
            F.lit(position).alias("position"), F.lit(rule_name).alias("rule_name"), F.lit(severity).alias("severity"),
            status.alias("status"), document.alias("detail"),
        ))

    def evaluated(self) -> DataFrame:
        measured = self.df.agg(*[c.alias(k) for k, c in (self.aggregates or {"rows": F.count(F.lit(1))}).items()])
        return measured.select(F.inline(F.array(*self.results)))


def _verdict(ok: Column) -> Column:
    return F.when(ok, PASS).otherwise(FAIL)


def schema_rule(rules: TableRules, position: int, cfg: Mapping) -> None:
    """Missing columns and type mismatches against relational type names; reads no data."""
    actual = {f.name: f.dataType for f in rules.df.schema}
    missing, mismatched = [], []
    for column, wanted in (cfg.get("required_columns") or {}).items():
        if column not in actual:
            missing.append(column)
            continue
        found = actual[column].simpleString().split("(")[0].split("<")[0]
        accepted = SQL_TYPE_NAMES.get(str(wanted).lower(), (str(wanted).lower(),))
        if found not in accepted:
            mismatched.append(f"{column}: expected {wanted}, actual {found}")
    names = F.array(*[F.lit(c) for c in missing]).cast("array<string>")
    kinds = F.array(*[F.lit(c) for c in mismatched]).cast("array<string>")
    rules.result(
        position, f"schema::{cfg['table']}", cfg.get("severity", BLOCKING),
        F.lit(FAIL if missing or mismatched else PASS),
        {"table": F.lit(cfg["table"]), "missing_columns": names, "mismatched_types": kinds,
         "actual_column_count": F.lit(len(actual))},
    )


def freshness_rule(rules: TableRules, position: int, cfg: Mapping, as_of: datetime) -> None:
    """The newest timestamp is at most max_age_hours older than ``as_of``; an empty table fails."""
    column = cfg.get("timestamp_column", "ingestion_timestamp")
    limit = float(cfg["max_age_hours"])
    newest = rules.measure(f"max:{column}", F.max(column))
    # Differences of like types only: both sides become zone-less timestamps.
    age = F.timestamp_diff(
        "MICROSECOND", newest.cast("timestamp_ntz"), F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    ) / 3_600_000_000
    rules.result(
        position, f"freshness::{cfg['table']}", cfg.get("severity", WARNING),
        _verdict((rules.rows() > 0) & newest.isNotNull() & (age <= limit)),
        {"table": F.lit(cfg["table"]),
         "reason": F.when((rules.rows() == 0) | newest.isNull(), "empty_table_or_null_timestamp"),
         "latest": newest.cast("string"), "checked_at": F.lit(as_of.isoformat()),
         "age_hours": F.bround(age, 4), "max_age_hours": F.lit(limit), "row_count": rules.rows()},
    )


def coverage_rule(rules: TableRules, position: int, cfg: Mapping) -> None:
    """The share of non-NULL values reaches the minimum; an empty table fails."""
    column, limit = cfg["column"], float(cfg["min_non_null_ratio"])
    known = rules.measure(f"count:{column}", F.count(column))
    ratio = F.try_divide(known.cast("double"), rules.rows())
    rules.result(
        position, f"coverage::{cfg['table']}::{column}", cfg.get("severity", WARNING),
        _verdict(F.coalesce(ratio >= limit, F.lit(False))),
        {"table": F.lit(cfg["table"]), "column": F.lit(column),
         "reason": F.when(rules.rows() == 0, "empty_table"), "non_null_ratio": F.bround(ratio, 6),
         "min_non_null_ratio": F.lit(limit), "row_count": rules.rows(), "non_null_count": known},
    )


def passing_baselines(results: DataFrame, prefix: str = "distribution::") -> DataFrame:
    """The newest passing detail of each rule in a results log, with its mean, std and n."""
    passed = results.where((F.col("status") == PASS) & F.col("rule_name").startswith(prefix))
    newest = passed.groupBy("rule_name").agg(F.max_by("detail", "created_at").alias("detail"))
    parsed = F.from_json("detail", "mean double, std double, n bigint")
    return newest.select("rule_name", parsed.alias("baseline"))


def distribution_rule(
    rules: TableRules, position: int, cfg: Mapping, column: str, baselines: DataFrame | None
) -> None:
    """The mean moved at most ``threshold`` baseline deviations; without a baseline it passes, without values it skips."""
    threshold = float(cfg.get("deviation_threshold", 2.0))
    name = f"distribution::{cfg['table']}::{column}"
    value = F.col(column).cast("double")
    mean = rules.measure(f"mean:{column}", F.avg(value))
    std = F.coalesce(rules.measure(f"std:{column}", F.stddev_pop(value)), F.lit(0.0))
    n = rules.measure(f"count:{column}", F.count(column))
    if baselines is None:
        base = F.lit(None).cast("struct<mean:double,std:double,n:bigint>")
    else:
        base = baselines.where(F.col("rule_name") == name).agg(F.max("baseline")).scalar()
    base_mean, base_std = F.coalesce(base["mean"], F.lit(0.0)), F.coalesce(base["std"], F.lit(0.0))
    scale = F.when(base_std > TINY, base_std).otherwise(F.greatest(F.abs(base_mean), F.lit(TINY)))
    deviation = F.when(base.isNotNull(), F.abs(mean - base_mean) / scale)
    status = (
        F.when(n == 0, SKIP).when(base.isNull(), PASS).when(deviation <= threshold, PASS).otherwise(FAIL)
    )
    rules.result(
        position, name, cfg.get("severity", WARNING), status,
        {"table": F.lit(cfg["table"]), "column": F.lit(column), "reason": F.when(n == 0, "no_values"),
         "mean": mean, "std": std, "n": n, "threshold": F.lit(threshold), "baseline": base,
         "deviation": F.bround(deviation, 6)},
    )


def row_count_positive(rules: TableRules, position: int, cfg: Mapping, tables: Mapping[str, DataFrame]) -> None:
    rules.result(position, cfg["rule_name"], cfg.get("severity", BLOCKING), _verdict(rules.rows() > 0),
                 {"table": F.lit(cfg["table"]), "row_count": rules.rows()})


def row_count_match(rules: TableRules, position: int, cfg: Mapping, tables: Mapping[str, DataFrame]) -> None:
    other = tables[cfg["right_table"]].agg(F.count(F.lit(1)).alias("n")).scalar()
    rules.result(position, cfg["rule_name"], cfg.get("severity", BLOCKING), _verdict(rules.rows() == other),
                 {"left_table": F.lit(cfg["left_table"]), "left_count": rules.rows(),
                  "right_table": F.lit(cfg["right_table"]), "right_count": other})


def value_in_set(rules: TableRules, position: int, cfg: Mapping, tables: Mapping[str, DataFrame]) -> None:
    """Every value is an allowed one; NULL is a violation."""
    column, allowed = F.col(cfg["column"]), list(cfg["allowed_values"])
    bad = rules.measure(f"{position}:outside", F.count_if(column.isNull() | ~column.isin(allowed)))
    rules.result(position, cfg["rule_name"], cfg.get("severity", BLOCKING), _verdict(bad == 0),
                 {"table": F.lit(cfg["table"]), "column": F.lit(cfg["column"]),
                  "allowed_values": F.array(*[F.lit(a) for a in allowed]), "violations": bad})


def unique_column(rules: TableRules, position: int, cfg: Mapping, tables: Mapping[str, DataFrame]) -> None:
    """Counts the values that occur more than once."""
    repeated = rules.df.groupBy(cfg["column"]).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    duplicates = repeated.agg(F.count(F.lit(1)).alias("n")).scalar()
    rules.result(position, cfg["rule_name"], cfg.get("severity", BLOCKING), _verdict(duplicates == 0),
                 {"table": F.lit(cfg["table"]), "column": F.lit(cfg["column"]), "duplicates": duplicates})


def numeric_range(rules: TableRules, position: int, cfg: Mapping, tables: Mapping[str, DataFrame]) -> None:
    """Values stay within min and max. NULL is never a violation, whatever ``allow_null`` says."""
    if "min" not in cfg and "max" not in cfg:
        raise ValueError("numeric_range rule requires at least one of min/max")
    outside = F.lit(False)
    if "min" in cfg:
        outside = outside | (F.col(cfg["column"]) < cfg["min"])
    if "max" in cfg:
        outside = outside | (F.col(cfg["column"]) > cfg["max"])
    bad = rules.measure(f"{position}:outside", F.count_if(outside))
    rules.result(position, cfg["rule_name"], cfg.get("severity", BLOCKING), _verdict(bad == 0),
                 {"table": F.lit(cfg["table"]), "column": F.lit(cfg["column"]), "min": F.lit(cfg.get("min")),
                  "max": F.lit(cfg.get("max")), "allow_null": F.lit(cfg.get("allow_null", True)), "violations": bad})


SMOKE_RULES = {
    "row_count_positive": row_count_positive,
    "row_count_match": row_count_match,
    "value_in_set": value_in_set,
    "unique_column": unique_column,
    "numeric_range": numeric_range,
}


def run_rules(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    rule_set: Mapping,
    as_of: datetime,
    results_log: DataFrame | None = None,
) -> DataFrame:
    """Evaluate a rule set: schema, freshness, coverage, distribution, smoke, in that order of ``position``."""
    baselines = passing_baselines(results_log) if results_log is not None else None
    per_table: dict[str, TableRules] = {}
    unknown: list[tuple] = []
    position = 0

    def rules_of(table: str) -> TableRules:
        if table not in tables:
            raise KeyError(f"no table {table!r} for the rule set")
        return per_table.setdefault(table, TableRules(table, tables[table]))

    for cfg in rule_set.get("schema") or []:
        schema_rule(rules_of(cfg["table"]), position, cfg)
        position += 1
    for cfg in rule_set.get("freshness") or []:
        freshness_rule(rules_of(cfg["table"]), position, cfg, as_of)
        position += 1
    for cfg in rule_set.get("coverage") or []:
        coverage_rule(rules_of(cfg["table"]), position, cfg)
        position += 1
    drift = rule_set.get("distribution") or {}
    for column in drift.get("numeric_columns") or []:
        distribution_rule(rules_of(drift["table"]), position, drift, column, baselines)
        position += 1
    for cfg in rule_set.get("smoke") or []:
        kind = cfg.get("kind")
        if cfg.get("severity", WARNING) not in SEVERITIES:
            raise ValueError(f"unknown severity {cfg['severity']!r} of rule {cfg.get('rule_name')}")
        if kind in SMOKE_RULES:
            SMOKE_RULES[kind](rules_of(cfg.get("table") or cfg["left_table"]), position, cfg, tables)
        else:
            unknown.append((position, cfg.get("rule_name", f"smoke::{kind}"), cfg.get("severity", WARNING), FAIL,
                            f'{{"reason":"unknown smoke kind: {kind}"}}'))
        position += 1
    parts = [rules.evaluated() for rules in per_table.values()]
    if unknown:
        parts.append(spark.createDataFrame(unknown, "position int, rule_name string, severity string, status string, detail string"))
    if not parts:
        return spark.createDataFrame([], "position int, rule_name string, severity string, status string, detail string")
    return reduce(DataFrame.unionByName, parts)


def verdict(results: DataFrame) -> DataFrame:
    """Counts of ok, warning and blocking outcomes; failing when any blocking rule failed.

    A log may hold what this module never writes: a status other than pass and skip is a failure, and a failure of
    any severity but ``warning`` is a blocking one, so nothing unknown passes.
    """
    failed = ~F.coalesce(F.col("status").isin(PASS, SKIP), F.lit(False))
    minor = F.coalesce(F.col("severity") == WARNING, F.lit(False))
    return results.agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(~failed).alias("ok"),
        F.count_if(failed & minor).alias("warning_failures"),
        F.count_if(failed & ~minor).alias("blocking_failures"),
    ).withColumn("failing", F.col("blocking_failures") > 0)


def stamped_results(results: DataFrame, run_id: str, created_at: datetime) -> DataFrame:
    """Result rows ready to append to the results log."""
    return results.select(
        F.lit(run_id).alias("run_id"), "rule_name", "severity", "status", "detail",
        F.lit(created_at).cast("timestamp").alias("created_at"),
    )


def newest_run(results_log: DataFrame) -> DataFrame:
    """The log rows of the run that wrote the newest row."""
    newest = results_log.agg(F.max_by("run_id", "created_at").alias("run_id")).scalar()
    return results_log.where(F.col("run_id") == newest)


def blocking_failure_history(results_log: DataFrame) -> DataFrame:
    """Rules that ever failed blocking, with their last failure, newest first."""
    failed = results_log.where((F.col("severity") == BLOCKING) & (F.col("status") == FAIL))
    return (
        failed.groupBy("rule_name").agg(F.max("created_at").alias("last_failed_at"))
        .orderBy(F.col("last_failed_at").desc(), "rule_name")
    )


def build_checks(features: DataFrame, train: DataFrame) -> DataFrame:
    """Feature rows against label rows, and NULL keys and labels of the feature table."""
    return features.agg(
        F.count(F.lit(1)).alias("feature_rows"),
        F.count_if(F.col("msno").isNull()).alias("null_msno"),
        F.count_if(F.col("is_churn").isNull()).alias("null_is_churn"),
    ).withColumn("train_rows", train.agg(F.count(F.lit(1)).alias("n")).scalar()).withColumn(
        "passed",
        (F.col("feature_rows") == F.col("train_rows")) & (F.col("null_msno") == 0) & (F.col("null_is_churn") == 0),
    )
