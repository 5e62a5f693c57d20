"""Bounded, repeatable samples of labelled documents for the fitted models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.texts import bounded, held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, lang, label) of about ``rows`` labelled documents at most that are not held out.

    All are taken when there are no more than ``rows``; else a hash of the id decides, so reruns and other partitions
    give the same sample. Ids and labels that are NULL are left out; of several labels of one id the least counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id"))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.min(F.col(label).cast("int")).alias("label"))
    taken = bounded(drawn(known, "_id", rows))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows_of = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    return rows_of.join(taken, F.col("doc_id") == F.col("_id")).drop("_id")


def drawn(df: DataFrame, key: Column | str, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` by a hash of ``key``; all if there are no more."""
    count = df.count()
    if count <= rows:
        return df
    place = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 40)) / float(1 << 40)
    return df.where(place < rows / count)
