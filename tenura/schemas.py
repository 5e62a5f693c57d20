"""Column layouts of the tables the engine reads and writes."""

from __future__ import annotations

import re


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) of every column of a flat or nested DDL string; commas inside brackets do not separate columns."""
    parts = re.split(r",\s*(?![^<(]*[>)])", ddl)
    return [tuple(part.strip().split(" ", 1)) for part in parts]


RAW_SCHEMAS: dict[str, str] = {
    "train": "msno string, is_churn smallint",
    "members": "msno string, city smallint, bd smallint, gender string, registered_via smallint, registration_init_time int",
    "transactions": ("msno string, payment_method_id smallint, payment_plan_days int, plan_list_price int, "
        "actual_amount_paid int, is_auto_renew smallint, transaction_date int, membership_expire_date int, "
        "is_cancel smallint"),
    "user_logs": ("msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, "
        "total_secs decimal(18,2)"),
}

FEATURE_SCHEMA = ("msno string, is_churn smallint, city smallint, bd smallint, gender string, registered_via smallint, "
    "registration_init_time int, transaction_count int, renewal_count int, cancel_count int, "
    "total_amount_paid decimal(20,2), avg_plan_days decimal(8,2), latest_payment_method_id smallint, "
    "latest_is_auto_renew smallint, latest_membership_expire_date int, num_active_days int, "
    "total_secs decimal(28,2), avg_total_secs decimal(12,4), total_num_songs bigint, avg_num_songs decimal(10,4), "
    "total_num_unq bigint, avg_num_unq decimal(10,4)")
FEATURE_COLUMNS = [name for name, _ in fields(FEATURE_SCHEMA)]
MODEL_FEATURES = [c for c in FEATURE_COLUMNS if c not in ("msno", "is_churn")]
CATEGORICAL_FEATURES = ("city", "gender", "latest_is_auto_renew", "latest_payment_method_id", "registered_via")

PREDICTION_SCHEMA = ("customer_id string, churn_probability double, risk_tier string, scored_at timestamp, "
    "shap_values array<struct<feature:string,shap_value:double>>, feature_snapshot_id string, model_version string, "
    "threshold_version string")
SNAPSHOT_SCHEMA = ("snapshot_id string, pipeline_run_id string, build_started_at timestamp, build_completed_at timestamp, "
    "source_watermark_id bigint, row_count bigint, content_hash string, feature_count int, "
    "feature_names array<string>, status string, created_at timestamp")
WATERMARK_SCHEMA = ("watermark_id bigint, table_name string, row_count bigint, content_hash string, pipeline_run_id string, "
    "created_at timestamp")
LINEAGE_SCHEMA = "feature_name string, source_table string, transformation_rule string, snapshot_id string, created_at timestamp"
VALIDATION_SCHEMA = "run_id string, rule_name string, severity string, status string, detail string, created_at timestamp"

# Relational type names a schema rule may ask for, and the Spark types that satisfy them. The engine's own tables count
# rows as bigint and hold probabilities as double, which are wider than what the default rules name.
SQL_TYPE_NAMES: dict[str, tuple[str, ...]] = {
    "text": ("string",),
    "character varying": ("string", "varchar"),
    "uuid": ("string",),
    "smallint": ("smallint",),
    "integer": ("int", "bigint"),
    "bigint": ("bigint",),
    "numeric": ("decimal", "double"),
    "double precision": ("double",),
    "boolean": ("boolean",),
    "date": ("date",),
    "timestamp with time zone": ("timestamp", "timestamp_ntz"),
    "timestamp without time zone": ("timestamp_ntz",),
    "jsonb": ("string", "struct", "array", "map"),
}
