"""Rows with every awkward case: NULLs, empty, blank and long texts, repeated rows and ids, clashing extra columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = [
    "row", "node", "size", "hash", "kept", "n_words", "target", "kind", "score", "features", "label", "item", "pos", "term", "root", "copies", "spans",
    "_gone", "_q_doc", "_q_row", "_bad_doc", "_bad_row", "_mix_source", "_mix_repeats", "_mix_copy", "_again", "_key", "_vertex", "_doc", "_row", "_source",
    "_copy", "source_size", "repeats", "threshold", "_id", "_hash",
]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents (doc_id, text, lang, source) with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], SCHEMA)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})


def messy_rows() -> list[tuple]:
    words = [f"wort{i % 37}ab{i % 11}" for i in range(120)]
    plain = " ".join(words)
    near = " ".join([*words[:60], "neu", *words[61:]])
    return [
        (1, plain, "en", "a"), (2, plain, "en", "b"), (3, near, None, "a"), (4, "", "en", "a"), (5, None, "de", None),
        (6, " \n\t ", None, "b"), (7, "ein", "de", "c"), (8, "EIN", "de", "c"), (None, plain, "en", "a"), (None, None, None, None),
        (9, "Tür zu Tür é ü 日本", "und", "c"), (9, "Tür zu Tür é ü 日本", "und", "c"), (10, "x " * 30_000, "en", "long"),
        (11, "a b c d e f g h", "en", None), (11, "anders als das andere", "de", None), (12, "no_space" * 3_000, "en", "long"),
        (13, " ".join(f"lang{i}" for i in range(25_000)), "en", "long"), (14, plain.upper(), "en", "b"),
    ]
