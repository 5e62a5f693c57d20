"""Words, hashes and shared steps of the text operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.session import checkpointed, scratch_folder as shared_folder  # driver and executors share it

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows and bytes of text of an Arrow batch that Python works on at once.
SLICE_ROWS = 512
SLICE_BYTES = 8 << 20
# Entries of a per-task word cache. A full cache is emptied, so its size never depends on the input.
CACHE_WORDS = 300_000


# A counted side of at most this many rows goes to all tasks; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A checkpointed side, with a broadcast hint if its count is small. It changes the plan, never the rows.

    The default is for narrow rows (ids, hashes, counts: 100 bytes, so 50 MB at most); sides of wider rows name a lower one.
    """
    stored = checkpointed(df)
    return F.broadcast(stored) if stored.count() <= rows else stored


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2_000) -> Iterator[None]:
    """Jobs inside send Python at most ``rows`` rows at once: a batch of texts is in the JVM and in Python at a time.

    The session's own setting is back afterwards.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cut lineage, narrow columns, pruned reads."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(column: Column | str) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(F.col(column) if isinstance(column, str) else column, UPPER, UPPER.lower())


def ascii_lower_word(word: Column | str) -> Column:
    """``ascii_lower`` for short strings: one of ASCII only takes the fast way of ``lower``."""
    column = F.col(word) if isinstance(word, str) else word
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(ascii_lower(column))


def held_out(doc_id: Column | str) -> Column:
    """Whether a document is kept from all learning: crc32 of its id as text is divisible by 5. A NULL id counts as 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5, F.lit(0)) == 0


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (the finaliser of splitmix64) of an unsigned array."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_KEPT: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by a Python worker for its next tasks; only the last such object is."""
    if key not in _KEPT:
        _KEPT.clear()
        released()
        _KEPT[key] = make()
    return _KEPT[key]


def released() -> None:
    """Give freed memory back to the system: idle Python workers live beside the JVM until the application ends."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, most_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``rows`` rows; a part with several rows has at most ``most_bytes`` of text."""
    for batch in batches:
        start = 0
        if "text" in batch.schema.names:
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths, dtype=np.int64)
        else:
            ends = np.zeros(batch.num_rows, np.int64)
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            fitting = int(np.searchsorted(ends, before + most_bytes, "right"))
            stop = min(max(fitting, start + 1), start + rows)
            yield batch.slice(start, stop - start)
            start = stop


def by_slice(
    work: Callable[[pa.RecordBatch], dict[str, object]], schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that maps each small slice to one batch of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            columns = work(piece)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in schema)],
                schema=schema,
            )
        released()

    return run


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called that, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(columns: Sequence[str]) -> Column:
    """A hash that tells rows of the same id apart."""
    return F.xxhash64(*columns)
