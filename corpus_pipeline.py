"""The corpus pipeline: rules, near duplicates, decontamination, mixing and token files over documents.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tenura.llm.fertility import Fertility, kept_documents
from tenura.llm.minhash import NearDuplicates, deduplicated
from tenura.llm.mixing import mixed_documents
from tenura.llm.positions import clean_documents
from tenura.llm.texts import shared_folder, table
from tenura.llm.token_files import TokenFiles, token_documents

# Tokenisation is not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fertility rules keep; see ``fertility.quality_rules`` for NULLs, repeated rows and empty tables."""
    return kept_documents(docs, Fertility(public_tokenizers.path("piece_bpe_32k.model")), table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group by shingles of five words; see ``minhash.deduplicated``."""
    return deduplicated(docs, NearDuplicates(words=5))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark contamination; see ``positions.contamination``."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or repeated; see ``mixing.mix``."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard files of all tokens and one row per written document, read back from them; see ``token_files``.

    Shards, word cache and slices are smaller than the defaults: the executors have run four stages before.
    """
    how = TokenFiles(
        public_tokenizers.path("word_bpe_49k.json"), shard_tokens=1 << 20, cache_words=250_000, slice_bytes=2 << 20
    )
    return token_documents(docs, shared_folder(spark, "token-files"), how)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name.split()[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
