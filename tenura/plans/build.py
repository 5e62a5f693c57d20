"""The feature build: snapshot states, checked rows, content hash, watermark and lineage."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators import catalog, quality
from tenura.operators.features import customer_features
from tenura.schemas import FEATURE_COLUMNS
from tenura.sources.tables import append_log, first_existing, publish_version, read_current, read_version, write_version


@dataclass(frozen=True)
class Warehouse:
    """Folders of the processed tables."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/processed/{name}"


def _newest_watermark_id(spark: SparkSession, warehouse: Warehouse) -> int | None:
    try:
        log = first_existing(spark, [warehouse.path("data_watermarks")])
    except ValueError:
        return None
    row = catalog.newest_watermark(log).first()
    return row["watermark_id"] if row else None


def build_features(
    spark: SparkSession, warehouse: Warehouse, train: DataFrame, members: DataFrame, transactions: DataFrame,
    user_logs: DataFrame, run_id: str | None = None, now: datetime | None = None, tie: str | None = None,
) -> str:
    """Build and publish the feature table; returns the snapshot id.

    The snapshot log gets one row per state: building, then completed or failed. The table is written once, as a new
    version that is checked before the pointer names it, so a failed build leaves the former one in place, and the recorded watermark is the one of the former table.
    """
    started = now or datetime.now(timezone.utc)
    snapshot_id = str(uuid4())
    log = warehouse.path("feature_snapshots")
    names = [c for c in FEATURE_COLUMNS if c != "msno"] + ["feature_created_at"]
    common = {
        "snapshot_id": snapshot_id, "pipeline_run_id": run_id, "build_started_at": started,
        "source_watermark_id": _newest_watermark_id(spark, warehouse), "feature_count": len(names), "feature_names": names,
    }
    append_log(catalog.snapshot_row(spark, **common, status=catalog.BUILDING, created_at=started), log, "created_at")
    try:
        built = customer_features(train, members, transactions, user_logs, tie)
        built = built.withColumn("feature_created_at", F.lit(started).cast("timestamp"))
        target = warehouse.path("customer_features")
        version = write_version(built, target)
        table = read_version(spark, target, version)
        checks = quality.build_checks(table, train).first()
        if not checks["passed"]:
            raise ValueError(f"feature build checks failed: {checks.asDict()}")
        digest = catalog.content_hash(table).first()
        publish_version(spark, target, version)
    except Exception:
        failed = catalog.snapshot_row(spark, **common, status=catalog.FAILED, created_at=now or datetime.now(timezone.utc))
        append_log(failed, log, "created_at")
        raise
    done = datetime.now(timezone.utc)
    append_log(
        catalog.snapshot_row(
            spark, **common, status=catalog.COMPLETED, build_completed_at=done, row_count=digest["row_count"],
            content_hash=digest["content_hash"], created_at=done,
        ),
        log, "created_at",
    )
    return snapshot_id


def record_watermark(spark: SparkSession, warehouse: Warehouse, table: str, run_id: str | None = None) -> None:
    """Append a watermark of the current version of a processed table."""
    newest = _newest_watermark_id(spark, warehouse)
    rows = catalog.watermark_rows(
        read_current(spark, warehouse.path(table)), f"processed.{table}", (newest or 0) + 1, datetime.now(timezone.utc), run_id
    )
    append_log(rows, warehouse.path("data_watermarks"), "created_at")


def record_lineage(spark: SparkSession, warehouse: Warehouse) -> None:
    """Append the registry stamped with the current snapshot."""
    states = catalog.snapshot_states(spark.read.parquet(warehouse.path("feature_snapshots")).drop("run_date"))
    current = catalog.current_snapshot(states).first()["snapshot_id"]
    rows = catalog.lineage_rows(catalog.feature_registry(spark), current, datetime.now(timezone.utc))
    append_log(rows, warehouse.path("data_lineage"), "created_at")
