"""Feature registry, lineage, snapshots, watermarks and content hashes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.latest import newest_rows
from tenura.schemas import SNAPSHOT_SCHEMA, WATERMARK_SCHEMA, fields

# Feature, source table and rule of every column of the feature table.
FEATURE_REGISTRY: list[tuple[str, str, str]] = [
    ("is_churn", "train_v2", "Direct copy of the churn target keyed by msno."),
    ("city", "members_v3", "Direct copy of city keyed by msno."),
    ("bd", "members_v3", "Direct copy of age (bd) keyed by msno; contains outliers and zeros."),
    ("gender", "members_v3", "Direct copy of gender keyed by msno; sparse with many NULLs."),
    ("registered_via", "members_v3", "Direct copy of registered_via (registration channel code) keyed by msno."),
    ("registration_init_time", "members_v3", "Direct copy of registration date as YYYYMMDD integer keyed by msno."),
    ("transaction_count", "transactions_v2", "COUNT(*) of transaction rows grouped by msno."),
    ("renewal_count", "transactions_v2", "SUM(CASE WHEN is_cancel = 0 THEN 1 ELSE 0 END) grouped by msno."),
    ("cancel_count", "transactions_v2", "SUM(is_cancel) grouped by msno."),
    ("total_amount_paid", "transactions_v2", "SUM(actual_amount_paid) grouped by msno."),
    ("avg_plan_days", "transactions_v2", "AVG(payment_plan_days) grouped by msno, rounded to 2 decimal places."),
    ("latest_payment_method_id", "transactions_v2",
     "payment_method_id from the most recent transaction row (by transaction_date) per msno."),
    ("latest_is_auto_renew", "transactions_v2",
     "is_auto_renew from the most recent transaction row (by transaction_date) per msno."),
    ("latest_membership_expire_date", "transactions_v2", "MAX(membership_expire_date) as YYYYMMDD integer per msno."),
    ("num_active_days", "user_logs_v2", "COUNT(DISTINCT date) grouped by msno."),
    ("total_secs", "user_logs_v2", "SUM(total_secs) grouped by msno."),
    ("avg_total_secs", "user_logs_v2", "AVG(total_secs) grouped by msno, rounded to 4 decimal places."),
    ("total_num_songs", "user_logs_v2", "SUM(num_25 + num_50 + num_75 + num_985 + num_100) grouped by msno."),
    ("avg_num_songs", "user_logs_v2",
     "AVG(num_25 + num_50 + num_75 + num_985 + num_100) grouped by msno, rounded to 4 decimal places."),
    ("total_num_unq", "user_logs_v2", "SUM(num_unq) grouped by msno."),
    ("avg_num_unq", "user_logs_v2", "AVG(num_unq) grouped by msno, rounded to 4 decimal places."),
    ("feature_created_at", "processed.customer_features",
     "Auto-populated by DEFAULT NOW() when row is inserted into processed.customer_features."),
]

BUILDING, COMPLETED, FAILED = "building", "completed", "failed"


def feature_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FEATURE_REGISTRY, "feature_name string, source_table string, transformation_rule string")


def lineage_rows(registry: DataFrame, snapshot_id: Column | str | None, created_at: datetime | Column) -> DataFrame:
    """Registry rows stamped with a snapshot and a time, ready to append."""
    snapshot = snapshot_id if isinstance(snapshot_id, Column) else F.lit(snapshot_id).cast("string")
    stamp = created_at if isinstance(created_at, Column) else F.lit(created_at).cast("timestamp")
    return registry.withColumn("snapshot_id", snapshot).withColumn("created_at", stamp)


def lineage_completeness(features: DataFrame, lineage: DataFrame, key: str = "msno") -> DataFrame:
    """How many feature columns the lineage lacks and how many lineage names are no column; names count once."""
    spark = features.sparkSession
    columns = spark.createDataFrame([(c,) for c in features.columns if c != key], "feature_name string")
    named = lineage.select("feature_name").distinct()
    count = F.count(F.lit(1))
    missing = columns.join(named, "feature_name", "left_anti").agg(count.alias("missing_in_lineage"))
    extra = named.join(columns, "feature_name", "left_anti").agg(count.alias("n")).scalar()
    return missing.withColumn("extra_in_lineage", extra)


def _text(name: str, kind: str) -> str:
    """A value as SQL text, or a NULL mark; texts carry their length, so that no two rows read the same."""
    if kind in ("tinyint", "smallint", "int", "bigint", "boolean", "date") or kind.startswith("decimal"):
        return f"coalesce(cast({name} as string), 'N')"
    value = f"cast({name} as string)"
    return f"coalesce(concat(length({value}), ':', {value}), 'N')"


DIGEST_SUMS = [f"w{i}_{j}" for i in range(4) for j in range(3)]


def digest_sums(df: DataFrame, keys: Sequence[str] = (), without: Sequence[str] = ("feature_created_at", "ingestion_timestamp")) -> DataFrame:
    """Per key the row count and the sums that ``combined_digest`` makes a digest of; sums of parts add up to the whole's.

    Each row is hashed with SHA-256 over its columns in name order. Four 60-bit words of the hash are summed over all
    rows, so duplicates count and the sums combine map-side; each word is summed in three 20-bit limbs, whose long sums
    hold for 8 * 10^12 rows and spare decimal arithmetic per row. Keys and load timestamps are left out of the hash.
    """
    kinds = dict(df.dtypes)
    texts = ", ".join(_text(c, kinds[c]) for c in sorted(df.columns) if c not in (*without, *keys))
    hashed = df.selectExpr(*keys, f"sha2(cast(concat_ws('|', {texts}) as binary), 256) as h")
    words = hashed.selectExpr(*keys, *[f"cast(conv(substr(h, {1 + 15 * i}, 15), 16, 10) as bigint) as w{i}" for i in range(4)])
    mask = (1 << 20) - 1
    limbs = [F.expr(f"sum(shiftright(w{i}, {20 * j}) & {mask}) as w{i}_{j}") for i in range(4) for j in range(3)]
    return words.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), *limbs)


def combined_digest(sums: DataFrame) -> DataFrame:
    """(row_count, content_hash) of all rows whose parts' sums these are; the digest hashes the row count and four sums."""
    added = sums.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), *[F.sum(name).alias(name) for name in DIGEST_SUMS])
    whole = [
        " + ".join(f"cast(coalesce(w{i}_{j}, 0) as decimal(20,0)) * {1 << (20 * j)}BD" for j in range(3)) for i in range(4)
    ]
    parts = ", ".join(f"cast(cast({w} as decimal(38,0)) as string)" for w in whole)
    return added.selectExpr(
        "row_count", f"sha2(cast(concat_ws('|', cast(row_count as string), {parts}) as binary), 256) as content_hash"
    )


def content_hash(df: DataFrame, without: Sequence[str] = ("feature_created_at", "ingestion_timestamp")) -> DataFrame:
    """Row count and a digest that does not depend on row order or partitioning; see ``digest_sums``."""
    return combined_digest(digest_sums(df, (), without))


def watermark_rows(
    df: DataFrame, table_name: str, watermark_id: int, created_at: datetime, run_id: str | None = None
) -> DataFrame:
    """One watermark row: the table's row count and content hash, ready to append."""
    rows = content_hash(df).select(
        F.lit(watermark_id).alias("watermark_id"), F.lit(table_name).alias("table_name"), "row_count", "content_hash",
        F.lit(run_id).alias("pipeline_run_id"), F.lit(created_at).alias("created_at"),
    )
    return rows.selectExpr(*[f"cast({name} as {kind}) as {name}" for name, kind in fields(WATERMARK_SCHEMA)])


def newest_watermark(watermarks: DataFrame) -> DataFrame:
    return newest_rows(watermarks, ["created_at", "watermark_id"])


def snapshot_states(snapshot_log: DataFrame) -> DataFrame:
    """The newest state of each snapshot in an append-only log of state changes."""
    state = F.struct(*[c for c in snapshot_log.columns if c != "snapshot_id"])
    return snapshot_log.groupBy("snapshot_id").agg(F.max_by(state, "created_at").alias("state")).select(
        "snapshot_id", "state.*"
    )


def current_snapshot(snapshots: DataFrame) -> DataFrame:
    """The id of the completed snapshot that was built last; NULL when there is none."""
    return snapshots.where(F.col("status") == COMPLETED).agg(
        F.max_by("snapshot_id", "build_completed_at").alias("snapshot_id")
    )


def snapshot_row(spark: SparkSession, **values) -> DataFrame:
    """One state change of a snapshot, to be appended to the snapshot log."""
    return spark.createDataFrame([tuple(values.get(name) for name, _ in fields(SNAPSHOT_SCHEMA))], SNAPSHOT_SCHEMA)


def provenance_triples(predictions: DataFrame, limit: int = 5) -> DataFrame:
    """Distinct model version, threshold version and snapshot of scored rows, in order, NULLs last."""
    columns = ["model_version", "threshold_version", "feature_snapshot_id"]
    return predictions.select(*columns).distinct().orderBy(*[F.col(c).asc_nulls_last() for c in columns]).limit(limit)


def linked_rows(lineage: DataFrame, predictions: DataFrame) -> DataFrame:
    """Lineage and prediction rows that name a feature snapshot."""
    return lineage.agg(F.count("snapshot_id").alias("linked_lineage_rows")).withColumn(
        "linked_prediction_rows", predictions.agg(F.count("feature_snapshot_id").alias("n")).scalar()
    )
