"""Session helpers: a local session for tests and benches, and reliable checkpoints."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and benches. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tenura")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Call-site capture costs several round trips to the JVM for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Rows of a task that passes over a table again and again: at most so many, and enough to be worth a task.
MOST_TASK_ROWS, LEAST_TASK_ROWS = 50_000, 2_500


def task_count(spark: SparkSession, rows: int) -> int:
    """Partitions for a table of ``rows`` that many jobs read: all cores have work unless that is too little for a task."""
    return max(1, -(-rows // MOST_TASK_ROWS), min(spark.sparkContext.defaultParallelism, -(-rows // LEAST_TASK_ROWS)))


def even_task_count(spark: SparkSession, rows: int, most: int = 100_000) -> int:
    """A whole number of rounds of all cores, with at most ``most`` of ``rows`` in a task of equal parts."""
    cores = spark.sparkContext.defaultParallelism
    return cores * max(1, -(-rows // (cores * most)))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's checkpoint folder, which driver and executors share."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tenura-shared-")
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and return it with a cut lineage.

    The folder is the one the session names in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a folder of its own, because a machine-local folder is lost with its executor.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tenura-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
