"""Benchmark decontamination with a positional inverted index, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.texts import ascii_lower_word, bounded, free_name, row_key, stored
from tenura.session import checkpointed

# What lies between words: ASCII characters that are neither digits nor letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Windows:
    """``words`` consecutive item words form a window; a document with hits in a share of at least 1/``share`` is contaminated.

    Candidates are found with the ``rarest`` rarest terms of each window.
    """

    words: int = 13
    share: int = 20
    rarest: int = 3


def raw_words(text: Column | str) -> Column:
    """Words of a text as they stand; NULL has none. Splitting costs a third of extracting matches."""
    parts = F.array_remove(F.split(text, BETWEEN, -1), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def benchmark_items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, words) of the distinct word sequences and (item, item_id) for each id; items without words are left out."""
    worded = benchmark.select(F.col("item_id"), F.transform(raw_words("text"), ascii_lower_word).alias("words")).where(F.size("words") > 0)
    keyed = checkpointed(worded.withColumn("item", F.md5(F.concat_ws(" ", "words"))))
    return keyed.groupBy("item").agg(F.first("words").alias("words")), keyed.select("item", "item_id").distinct()


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """The stored index: a row (term, doc_id, row, pos) for each occurrence of a term of ``vocabulary`` (all without one).

    Each document also has one row with a NULL term whose ``pos`` is its number of words. ``row`` tells rows of the same
    doc_id apart. Terms are hashed only after the match of the strings.
    """
    rows = docs.select(F.col("doc_id"), row_key(["doc_id", "text"]).alias("row"), raw_words("text").alias("_w"))
    ended = F.concat("_w", F.array(F.lit(None).cast("string")))
    places = rows.select("doc_id", "row", F.posexplode(ended).alias("pos", "_raw"))
    places = places.select("doc_id", "row", "pos", ascii_lower_word("_raw").alias("word"))
    if vocabulary is not None:
        known = vocabulary.select(F.col("word").alias("_known"))
        places = places.join(known, places["word"] == known["_known"], "left").where("_known IS NOT NULL OR word IS NULL")
    index = places.select(F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"), "doc_id", "row", "pos")
    return stored(index, "positions")


def _rated(items: DataFrame, index: DataFrame, how: Windows) -> DataFrame:
    """(item, start, terms): the ``how.rarest`` rarest terms of each window as (n, offset, term), rarest first.

    A window with a term that the index lacks cannot occur and is left out.
    """
    counts = index.where("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    terms = items.select("item", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word"))
    rated = terms.withColumn("term", F.xxhash64("word")).join(bounded(counts), "term", "left")
    # A window starts at each offset that leaves room for it; an item shorter than a window is one.
    span = F.least("size", F.lit(how.words))
    starts = F.sequence(F.greatest(F.lit(0), F.col("offset") - span + 1), F.least("offset", F.col("size") - span))
    placed = rated.select("item", "offset", "term", "n", F.explode(starts).alias("start"))
    best = placed.groupBy("item", "start").agg(
        F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("_all"),  # a window's words
        F.count_if(F.col("n").isNull()).alias("_absent"),
    )
    return best.where("_absent = 0").select("item", "start", F.slice("_all", 1, how.rarest).alias("terms"))


def _places(rated: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, row, item, shift, found): occurrences of rare terms, adjusted by their offsets and gathered by place."""
    anchors = rated.select("item", F.explode("terms").alias("_t")).select("_t.term", "item", "_t.offset").distinct()
    hits = index.where("term IS NOT NULL").join(bounded(anchors), "term")
    return hits.groupBy("doc_id", "row", "item", (F.col("pos") - F.col("offset")).alias("shift")).agg(
        F.collect_set("offset").alias("found")  # offsets of an item's rare terms
    )


def _candidates(items: DataFrame, index: DataFrame, how: Windows) -> DataFrame:
    """(doc_id, row, item, shift): places where all rarest terms of some window lie as in the item, its first word at ``shift``."""
    rated = checkpointed(_rated(items, index, how))
    needed = rated.groupBy("item").agg(
        F.collect_set(F.col("terms.offset")).alias("_windows"), F.min(F.size("terms")).alias("_least")
    )
    whole = F.exists("_windows", lambda window: F.size(F.array_except(window, F.col("found"))) == 0)
    kept = _places(rated, index).join(bounded(needed), "item").where(F.size("found") >= F.col("_least")).where(whole)
    return checkpointed(kept.select("doc_id", "row", "item", "shift"))


def _of_documents(index: DataFrame, candidates: DataFrame) -> DataFrame:
    """Postings of the documents that have a candidate."""
    wanted = bounded(candidates.select(F.col("doc_id").alias("_d"), F.col("row").alias("_r")).distinct())
    return index.where("term IS NOT NULL").join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r")), "left_semi")


def phrase_matches(items: DataFrame, index: DataFrame, how: Windows = Windows()) -> DataFrame:
    """(doc_id, row, item, first, last): maximal exact runs of item words that hold at least one window.

    The intersected lists of each window's rarest terms give candidates. The lists of all terms of the item are then
    intersected at the adjusted positions, in candidate documents only. Runs of consecutive offsets that reach the
    window's length remain.
    """
    candidates = _candidates(items, index, how)
    terms = items.select("item", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word"))
    wanted = (
        candidates.join(bounded(terms.select("item", "size", "offset", F.xxhash64("word").alias("term"))), "item")
        .select(
            F.col("doc_id").alias("_d"), F.col("row").alias("_r"), "item", "size", "shift", "offset",
            F.col("term").alias("_t"), (F.col("shift") + F.col("offset")).alias("_p"),
        )
        .where("_p >= 0")
    )
    postings = _of_documents(index, candidates).distinct()
    same = (
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r"))
        & (F.col("term") == F.col("_t")) & (F.col("pos") == F.col("_p"))
    )
    alignment = ["doc_id", "row", "item", "shift"]
    matched = postings.join(wanted, same).select(*alignment, "size", "offset")
    run = F.col("offset") - F.row_number().over(Window.partitionBy(*alignment).orderBy("offset"))
    runs = matched.withColumn("_run", run).groupBy(*alignment, "_run").agg(
        F.min("offset").alias("_lo"), F.max("offset").alias("_hi"), F.max("size").alias("size")
    )
    whole = runs.where(F.col("_hi") - F.col("_lo") + 1 >= F.least("size", F.lit(how.words)))
    return whole.select(
        "doc_id", "row", "item", (F.col("shift") + F.col("_lo")).alias("first"), (F.col("shift") + F.col("_hi")).alias("last")
    )


def proximity_matches(
    items: DataFrame, index: DataFrame, slack: int = 3, share: float = 0.8, how: Windows = Windows()
) -> DataFrame:
    """(doc_id, row, item, shift, near): places where a share of an item's terms lies within ``slack`` of where it should be.

    A candidate is a place of any of the rarest terms of a window; of several places that start within ``slack`` words of each
    other the first stays. Positions are joined by blocks of ``slack + 1`` words, so a frequent term meets only its
    surroundings.
    """
    block = slack + 1
    near = Window.partitionBy("doc_id", "row", "item").orderBy("shift")
    places = _places(checkpointed(_rated(items, index, how)), index)
    candidates = checkpointed(places.drop("found")).withColumn("_before", F.lag("shift").over(near))
    starts = candidates.where(F.col("_before").isNull() | (F.col("shift") - F.col("_before") > slack)).drop("_before")
    terms = items.select("item", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word"))
    around = F.explode(F.array(*[F.floor(F.col("_p") / block) + i for i in (-1, 0, 1)]))
    wanted = (
        starts.join(terms.select("item", "size", "offset", F.xxhash64("word").alias("_t")), "item")
        .withColumn("_p", F.col("shift") + F.col("offset"))
        .withColumn("_b", around)
        .withColumnsRenamed({"doc_id": "_d", "row": "_r"})
    )
    postings = _of_documents(index, candidates).distinct().withColumn("_block", F.floor(F.col("pos") / block))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r"))
        & (F.col("term") == F.col("_t")) & (F.col("_block") == F.col("_b"))
    )
    close = postings.join(wanted, same).where(F.abs(F.col("pos") - F.col("_p")) <= slack)
    counted = close.groupBy("doc_id", "row", "item", "shift").agg(
        F.count_distinct("offset").alias("near"), F.max("size").alias("size")
    )
    return counted.where(F.col("near") >= F.lit(share) * F.col("size")).drop("size")


def contamination(docs: DataFrame, benchmark: DataFrame, how: Windows = Windows()) -> DataFrame:
    """One row per input row: doc_id, row, n_words, n_hit, n_items, items (sorted ids, comma-joined) and contaminated.

    NULL and empty texts have no words and are clean. Equal rows give equal results, rows that only share a doc_id
    their own, NULL ids included. An item whose id is NULL is matched but not listed. Empty tables and benchmarks give
    no rows and no hits. Columns other than doc_id, text and item_id are ignored.
    """
    items, ids = benchmark_items(benchmark)
    items = checkpointed(items)
    vocabulary = items.select(F.explode("words").alias("word")).distinct()
    index = build_index(docs, bounded(vocabulary))
    runs = checkpointed(phrase_matches(items, index, how))
    covered = (
        runs.select("doc_id", "row", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
        .groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    named = (
        runs.select("doc_id", "row", "item").distinct().join(ids, "item")
        .select("doc_id", "row", F.col("item_id").cast("string").alias("item_id")).distinct()
        .groupBy("doc_id", "row").agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
    )
    hits = _renamed(covered, "_h").join(_renamed(named, "_i"), F.col("_h_d").eqNullSafe(F.col("_i_d")) & (F.col("_h_r") == F.col("_i_r")), "left")
    ends = index.where("term IS NULL").select("doc_id", "row", F.col("pos").cast("bigint").alias("n_words"))
    joined = ends.join(hits, F.col("doc_id").eqNullSafe(F.col("_h_d")) & (F.col("row") == F.col("_h_r")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return joined.select(
        "doc_id", "row", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce(F.array_join("ids", ","), F.lit("")).alias("items"),
        ((n_hit > 0) & (n_hit * how.share >= F.col("n_words"))).alias("contaminated"),
    )


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({"doc_id": f"{prefix}_d", "row": f"{prefix}_r"})


def clean_documents(docs: DataFrame, benchmark: DataFrame, how: Windows = Windows()) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with their columns as they are."""
    found = contamination(docs, benchmark, how).where("contaminated")
    doc, row = free_name(docs, "_doc"), free_name(docs, "_row")
    bad = bounded(found.select(F.col("doc_id").alias(doc), F.col("row").alias(row)).distinct())
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (row_key(["doc_id", "text"]) == F.col(row))
    return docs.join(bad, same, "left_anti")
