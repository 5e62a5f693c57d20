"""CSV scans with fixed schemas and CSV sinks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.schemas import RAW_SCHEMAS


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A partitioned scan of CSV files with a header; an empty string is NULL and a malformed row raises."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_raw(spark: SparkSession, path: str, table: str, ingested_at: datetime | None = None) -> DataFrame:
    """One raw table with its ingestion timestamp."""
    stamp = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    return read_csv(spark, path, RAW_SCHEMAS[table]).withColumn("ingestion_timestamp", stamp)


def read_matching(spark: SparkSession, path: str, schema: str, condition: Column) -> DataFrame:
    """The rows of a CSV table that meet a condition. Spark splits the files; there is no chunk loop."""
    return read_csv(spark, path, schema).where(condition)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Write a result as CSV with a header, one file per task."""
    (df.select(*columns) if columns else df).write.mode("overwrite").option("header", True).csv(path)


def load_raw(
    spark: SparkSession, csv_folder: str, target_folder: str, files: dict[str, str],
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Replace every raw table by its CSV file and return the loaded row counts."""
    counts = []
    for table, name in files.items():
        read_raw(spark, f"{csv_folder}/{name}", table, ingested_at).write.mode("overwrite").parquet(f"{target_folder}/{table}")
        loaded = spark.read.parquet(f"{target_folder}/{table}")
        counts.append(loaded.agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("rows")))
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result
