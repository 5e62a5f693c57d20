"""Tables as named lists of files: updates rewrite only files that hold changed keys, digests follow groups of files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.catalog import DIGEST_SUMS, combined_digest, digest_sums
from tenura.session import checkpointed
from tenura.sources.tables import first_existing, keyed_update, read_current, replace_table

# Changed keys up to this many go to all tasks when files are searched for them.
BROADCAST_KEYS = 1_000_000


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified, length) of the Parquet files below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def _relative(column: str):
    return F.regexp_extract(column, "/data/(.+)$", 1)


def named_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files that the newest version of a table consists of, relative to its data folder."""
    return [r["file"] for r in read_current(spark, f"{path}/files").orderBy("file").collect()]


def _publish(spark: SparkSession, path: str, files: Iterable[str]) -> None:
    replace_table(spark.createDataFrame([(f,) for f in sorted(files)], "file string").coalesce(1), f"{path}/files")


def _written(df: DataFrame, path: str) -> list[str]:
    """Write rows into a new folder of the table and return its files' names; no reader sees them yet."""
    folder = f"{path}/data/{uuid4().hex}"
    df.write.parquet(folder)
    return [r["file"] for r in listed(df.sparkSession, folder).select(_relative("path").alias("file")).collect()]


def append_files(df: DataFrame, path: str) -> None:
    """Add rows to a table of files, which is made by the first call."""
    spark = df.sparkSession
    made = _written(df, path)
    try:
        first_existing(spark, [f"{path}/files/_pointer"])
    except ValueError:
        _publish(spark, path, made)
        return
    _publish(spark, path, [*named_files(spark, path), *made])


def read_files(spark: SparkSession, path: str, files: Sequence[str] | None = None) -> DataFrame:
    """The rows of a table's current files, or of some of them."""
    names = named_files(spark, path) if files is None else files
    if not names:
        raise ValueError(f"no files named in {path}")
    return spark.read.parquet(*[f"{path}/data/{name}" for name in names])


@dataclass(frozen=True)
class Rewritten:
    """How many files an update wrote anew and how many it left as they are."""

    rewritten: int
    kept: int


def update_files(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> Rewritten:
    """Replace ``columns`` of the rows whose keys occur in ``changes``, unique by key.

    The key columns alone are read to find the files that hold a changed key. Only these are read whole and written anew;
    a new list then names them in place of the old ones, so readers see the table before or after, never between.
    """
    files = named_files(spark, path)
    wanted = checkpointed(changes.select(*keys).distinct())
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    held = read_files(spark, path, files).select(*keys, _relative("_metadata.file_path").alias("file"))
    touched = sorted(r["file"] for r in held.join(wanted, list(keys), "left_semi").select("file").distinct().collect())
    if not touched:
        return Rewritten(0, len(files))
    updated = keyed_update(read_files(spark, path, touched), changes, keys, columns)
    made = _written(updated.coalesce(len(touched)), path)
    _publish(spark, path, [*set(files).difference(touched), *made])
    return Rewritten(len(touched), len(files) - len(touched))


def remove_unnamed(spark: SparkSession, path: str) -> int:
    """Delete files that the current version does not name, and former lists; returns the number of data files deleted.

    To be run when no reader of a former version is left.
    """
    named = set(named_files(spark, path))
    found = [r["file"] for r in listed(spark, f"{path}/data").select(_relative("path").alias("file")).collect()]
    gone = [name for name in found if name not in named]
    newest = spark.read.parquet(f"{path}/files/_pointer").agg(F.max_by("version", "switched_at")).first()[0]
    lists = [r["path"] for r in listed(spark, f"{path}/files").where(~F.col("path").contains("_pointer")).collect()]
    old = {p.rsplit("/", 1)[0] for p in lists if f"version={newest}" not in p}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for target, whole in [*((f"{path}/data/{name}", False) for name in gone), *((folder, True) for folder in old)]:
        place = spark._jvm.org.apache.hadoop.fs.Path(target)
        place.getFileSystem(conf).delete(place, whole)
    return len(gone)


def partition_digest(spark: SparkSession, path: str, digests_path: str) -> tuple[DataFrame, list[str]]:
    """(row_count, content_hash) of a partitioned table, and the folders that were hashed for it.

    A folder's files are known by path, time and length. Only folders whose files differ from the stored ones are read;
    their sums replace the stored sums, and the digest of the whole is that of all sums together, equal to
    ``content_hash`` of all rows. Folders that are gone leave the store.
    """
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    stamp = F.concat_ws(":", "path", F.unix_micros("modified").cast("string"), F.col("length").cast("string"))
    prints = F.sha2(F.array_join(F.sort_array(F.collect_list(F.sha2(stamp, 256))), "|"), 256)
    now = checkpointed(listed(spark, path).groupBy(folder.alias("folder")).agg(prints.alias("files")))
    try:
        first_existing(spark, [f"{digests_path}/_pointer"])
        stored = read_current(spark, digests_path)
    except ValueError:
        stored = None
    kept = stored.join(now, ["folder", "files"], "left_semi") if stored is not None else None
    changed = now if kept is None else now.join(kept.select("folder", "files"), ["folder", "files"], "left_anti")
    folders = sorted(r["folder"] for r in changed.select("folder").collect())
    if folders:
        rows = spark.read.option("basePath", path).parquet(*folders)
        place = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
        # Both forms of a local path, with one slash and with three, name the same folder.
        plain = F.regexp_replace(place, "^file:/+", "file:/")
        sums = digest_sums(rows.withColumn("_folder", plain), ["_folder"]).withColumnRenamed("_folder", "folder")
        known = now.withColumn("_plain", F.regexp_replace("folder", "^file:/+", "file:/"))
        fresh = sums.withColumnRenamed("folder", "_plain").join(known, "_plain").select("folder", "files", "row_count", *DIGEST_SUMS)
        kept = fresh if kept is None else kept.unionByName(fresh)
    whole = checkpointed(kept)
    replace_table(whole, digests_path)
    return combined_digest(whole), folders
