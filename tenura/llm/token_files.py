"""Token-ID output: documents are tokenised, ordered, coded into shard files and read back in parallel."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenura.llm import rans
from tenura.llm.texts import bounded, kept, released, slices, small_batches

SHARDS = "part int, shard int, n_tokens bigint, image binary"
DOCUMENTS = "part int, shard int, place int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"


@dataclass(frozen=True)
class TokenFiles:
    """``tokenizer`` is the path of a vocabulary of the tokenizers library; ``end`` is appended to each document.

    A shard is closed by the document with which it reaches ``shard_tokens``. ``cache_words`` bounds a task's memory of
    encoded words and ``slice_bytes`` the text that it works on at once: smaller values take more time and less memory.
    """

    tokenizer: str
    end: int | None = 1
    shard_tokens: int = 1 << 21
    cache_words: int = 800_000
    slice_bytes: int = 8 << 20
    layout: rans.Layout = field(default_factory=rans.Layout)


class WordEncoder:
    """Encodes texts word by word with a bounded cache of encoded words.

    Only for vocabularies whose tokens never span white space and which drop it, so the ids of a text are those of its
    words. The distinct words of a slice are found by Arrow. New ones are encoded in long strings, with a character
    between them that is one token of its own; the ids of all known words lie in one array.
    """

    MARK = "\x01"
    APART = [("word.", "word ."), ("word, 7.", "word , 7 ."), ("über. 漢, x", "über . 漢 , x"), ("it's, can't. ", "it's , can't .")]
    CHUNK = 2_000

    def __init__(self, path: str, cache_words: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.cache_words = cache_words
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        # Vocabularies that part a sign from the letter before it give the same ids with a space between.
        self.parts = all(self._ids(a) == self._ids(b) for a, b in self.APART)
        mark = self.library.encode(self.MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self._clear()

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.hits = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int32)
        self.ids = np.zeros(0, self.kind)

    def _forget(self) -> None:
        """Keep the words that several slices had, unless they fill half of the cache; the rest rarely comes back."""
        often = self.hits > 1
        if not 0 < int(often.sum()) <= self.cache_words // 2:
            return self._clear()
        words = [w for w, keep in zip(self.known, often) if keep]
        self.ids = self.ids[np.repeat(often, self.sizes)]
        self.sizes = self.sizes[often]
        self.starts = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)
        self.hits = np.ones(len(words), np.int32)
        self.known = dict(zip(words, range(len(words))))

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and the number of each word's."""
        if self.mark is None or any(self.MARK in w for w in words):
            coded = [c.ids for c in self.library.encode_batch_fast(words, add_special_tokens=False)]
            return np.array([i for c in coded for i in c], self.kind), np.array([len(c) for c in coded], np.int64)
        between = f" {self.MARK} "
        texts = [between.join(words[i : i + self.CHUNK]) + between for i in range(0, len(words), self.CHUNK)]
        coded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(c.ids, self.kind) for c in coded])
        ends = np.flatnonzero(ids == self.mark)
        return ids[ids != self.mark], np.diff(ends, prepend=-1) - 1

    def _places(self, words: list[str]) -> np.ndarray:
        """Numbers of distinct words; unknown ones are encoded first."""
        places = list(map(self.known.get, words))
        new = [i for i, place in enumerate(places) if place is None]
        if len(self.known) + len(new) > self.cache_words:
            self._forget()
            if len(self.known) + len(new) > self.cache_words:
                self._clear()
            places = list(map(self.known.get, words))
            new = [i for i, place in enumerate(places) if place is None]
        if new:
            added = [words[i] for i in new]
            ids, sizes = self._encoded(added)
            numbers = range(len(self.known), len(self.known) + len(added))
            self.known.update(zip(added, numbers))
            for i, number in zip(new, numbers):
                places[i] = number
            self.starts = np.concatenate([self.starts, (np.cumsum(sizes) - sizes + len(self.ids)).astype(np.int32)])
            self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids])
            self.hits = np.concatenate([self.hits, np.zeros(len(added), np.int32)])
        found = np.array(places, np.int32)
        self.hits[found] += 1  # the words are distinct
        return found

    def texts(self, texts: list[str | None], end: int | None) -> list[np.ndarray]:
        """Ids of each text, followed by ``end``."""
        # Lower-casing first joins words that the library would lower-case anyway; not where that could change a text.
        plain = [t.lower() if "<|" not in t and "\u03a3" not in t else t for t in (t or "" for t in texts)]
        lines = pc.replace_substring(pa.array(plain, pa.large_string()), "\n", " ")
        if self.parts:
            # A full stop or comma at a word's end becomes a word, so far fewer distinct words are left.
            lines = pc.replace_substring_regex(lines, r"([a-z])([.,])( |$)", r"\1 \2\3")
        lists = pc.split_pattern(lines, " ")
        coded = lists.flatten().dictionary_encode()
        place = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sizes = self.sizes[place]
        stops = np.cumsum(sizes, dtype=np.int64)
        total = int(stops[-1]) if len(stops) else 0
        shift = (self.starts[place] - (stops - sizes)).astype(np.int32)
        ids = self.ids[np.repeat(shift, sizes) + np.arange(total, dtype=np.int32)]
        cuts = np.concatenate([[0], stops])[lists.offsets.to_numpy()]
        tail = np.array([] if end is None else [end], self.kind)
        return [np.concatenate([ids[a:b], tail]) for a, b in zip(cuts[:-1], cuts[1:])]


def _shards(how: TokenFiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept((WordEncoder, how.tokenizer, how.cache_words), lambda: WordEncoder(how.tokenizer, how.cache_words))
        part = TaskContext.get().partitionId()
        shard, ids, names, size = 0, [], [], 0

        def image() -> pa.RecordBatch:
            coded = rans.encode(
                np.concatenate(ids) if ids else np.empty(0, encoder.kind), names, [len(x) for x in ids], how.layout
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([size]), pa.array([coded], pa.binary())],
                names=["part", "shard", "n_tokens", "image"],
            )

        for piece in slices(batches, 4096, how.slice_bytes):
            for name, tokens in zip(piece.column(0).to_pylist(), encoder.texts(piece.column(1).to_pylist(), how.end)):
                names.append(name)
                ids.append(tokens)
                size += len(tokens)
                if size >= how.shard_tokens:
                    yield image()
                    shard, ids, names, size = shard + 1, [], [], 0
        if names:
            yield image()
            ids, names = [], []
        released()

    return run


def write_token_files(docs: DataFrame, path: str, how: TokenFiles) -> None:
    """Write the ids of all documents in ascending doc_id order (NULL first, equal ids by text).

    Ranges of ids are dealt out once with their texts; each task sorts its range, tokenises it as a stream and keeps one
    shard in memory. A row of the files is one shard image; parts and shards of a part are numbered in order.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    with small_batches(docs.sparkSession, 4_000):
        ordered.mapInArrow(_shards(how), SHARDS).write.parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, 1):
        part, shard, image = (piece.column(i)[0].as_py() for i in range(3))
        reader = rans.Shard(image)
        ids = reader.tokens().astype("<u4")
        ends = np.cumsum(reader.doc_sizes)
        before = ends - reader.doc_sizes
        n = len(ends)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * n, pa.int32()), pa.array([shard] * n, pa.int32()), pa.array(range(n), pa.int32()),
                pa.array(reader.doc_ids, pa.int64()), pa.array(before, pa.int64()), pa.array(reader.doc_sizes, pa.int64()),
                pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(before, ends)], pa.int64()),
            ],
            names=["part", "shard", "place", "doc_id", "before", "n_tokens", "ids_crc32"],
        )
    released()


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the files, one shard at a time in a task.

    The tokens before a shard come from the shards' sizes: a running sum in each part and one over the parts.
    """
    files = spark.read.schema(SHARDS).parquet(path)
    sizes = files.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the writing job.
    parts = parts.select("part", F.coalesce(F.sum("n").over(ahead.partitionBy(F.lit(0)).orderBy("part")), F.lit(0)).alias("_part"))
    inside = F.coalesce(F.sum("n_tokens").over(ahead.partitionBy("part").orderBy("shard")), F.lit(0))
    starts = sizes.withColumn("_inside", inside).join(parts, "part").select("part", "shard", (F.col("_part") + F.col("_inside")).alias("_start"))
    rows = files.select("part", "shard", "image").mapInArrow(_decoded, DOCUMENTS)
    return rows.join(bounded(starts), ["part", "shard"]).select(
        "doc_id", (F.col("_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_tokens(spark: SparkSession, path: str, part: int, shard: int, first: int, count: int) -> list[int]:
    """A short run of ids of one shard, decoded from the nearest checkpoints."""
    row = spark.read.schema(SHARDS).parquet(path).where((F.col("part") == part) & (F.col("shard") == shard)).first()
    return rans.Shard(row["image"]).tokens(first, count).tolist()


def token_documents(docs: DataFrame, path: str, how: TokenFiles) -> DataFrame:
    """Write the files and return one row per input row, read back from them: doc_id, start, n_tokens, ids_crc32.

    NULL and empty texts have the end id only. Repeated rows are written as often as they occur; a NULL doc_id is kept
    and comes first. An empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    write_token_files(docs, path, how)
    return read_documents(docs.sparkSession, path)
