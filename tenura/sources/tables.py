"""Parquet tables: snapshots behind a pointer, append-only logs, keyed updates, additive evolution and JSON columns.

Plain parquet has no transactions. A replaced table is written to a folder of its own and then named by a pointer row, so
readers never see a half-written table and a plan may read the table it replaces. Logs only ever grow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def project(df: DataFrame, columns: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """The requested columns in order; a name outside the allow-list or absent from the table is an error."""
    unknown = sorted(set(columns) - set(allowed))
    if unknown:
        raise ValueError(f"unknown columns rejected: {unknown}")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the table lacks required columns: {missing}")
    return df.select(*columns)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_log(df: DataFrame, path: str, stamp: str) -> None:
    """Append run-stamped rows, partitioned by the day of their stamp."""
    df.withColumn("run_date", F.to_date(stamp)).write.mode("append").partitionBy("run_date").parquet(path)


def read_log(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All rows of a log. With a known schema no footers are opened; without one the layouts of all files are merged."""
    if schema:
        return spark.read.schema(f"{schema}, run_date date").parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def write_version(df: DataFrame, path: str) -> str:
    """Write a new version folder of a table; readers see it only after ``publish_version``."""
    version = uuid4().hex
    df.write.parquet(f"{path}/version={version}")
    return version


def read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def publish_version(spark: SparkSession, path: str, version: str) -> None:
    """Append the pointer row that makes a version the current one."""
    pointer = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("switched_at"))
    pointer.write.mode("append").parquet(f"{path}/_pointer")


def replace_table(df: DataFrame, path: str) -> str:
    """Truncate-and-reload: write a new version folder, then append a pointer row that names it."""
    version = write_version(df, path)
    publish_version(df.sparkSession, path, version)
    return version


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table version the newest pointer row names."""
    newest = spark.read.parquet(f"{path}/_pointer").agg(F.max_by("version", "switched_at")).first()[0]
    return spark.read.parquet(f"{path}/version={newest}")


def keyed_update(df: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows with ``columns`` replaced where the change table, unique by key, has a value; other rows stay as they are."""
    renamed = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(renamed, list(keys), "left")
    return joined.select(*[
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns
    ])


def rewrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Overwrite only the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def evolved(older: DataFrame, newer: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Union of two layouts of a table: absent columns become NULL or their default."""
    merged = older.unionByName(newer, allowMissingColumns=True)
    for column, value in (defaults or {}).items():
        merged = merged.withColumn(
            column, F.coalesce(F.col(column), F.lit(value)) if column in merged.columns else F.lit(value)
        )
    return merged


def with_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nested columns written as JSON text."""
    return df.withColumns({c: F.to_json(c) for c in columns})


def parsed_list(document: Column | str, element: str) -> Column:
    """JSON text to an array; malformed text, other JSON and an empty list become NULL."""
    column = F.col(document) if isinstance(document, str) else document
    entries = F.from_json(column, f"array<{element}>", {"mode": "PERMISSIVE"})
    listed = F.startswith(F.trim(column), F.lit("["))
    return F.when(listed & (F.size(entries) > 0), entries)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first of several parquet folders that exists."""
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    raise ValueError(f"no table found, expected one of {list(paths)}")
