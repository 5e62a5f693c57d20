"""Mixing sources to target weights with hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.texts import BROADCAST_ROWS, bounded, free_name
from tenura.session import checkpointed

SPACE = r"[\x20\x09-\x0D]+"
HASH_BITS = 60


@dataclass(frozen=True)
class Mixture:
    """Sources in code-point order, NULL last, weigh ``weights`` in turn; none gets more than ``limit`` times its size.

    A level of the histogram has 2**``bits`` buckets a source; after level one only boundary buckets are read again.
    """

    weights: Sequence[int] = (1, 2, 3)
    limit: int = 3
    bits: int = 12


def text_size(text: Column | str) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; NULL has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def id_hash(doc_id: Column | str) -> Column:
    """60 bits of the md5 of the id as text; a NULL id is hashed as an empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, how: Mixture = Mixture()) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    The sources are numbered by ranges, so not even their table meets one task. Capping goes on until no target is above
    its limit; each step is one aggregation of the sources.
    """
    totals = checkpointed(sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size")))
    known = totals.where("source IS NOT NULL")
    n = known.count()
    numbered = _ranked(known)
    numbered = numbered.union(totals.where("source IS NULL").select("source", "source_size", F.lit(n).alias("rank")))
    weights = F.array(*[F.lit(int(w)) for w in how.weights])
    weighed = checkpointed(
        numbered.withColumn("weight", F.element_at(weights, (F.col("rank") % len(how.weights) + 1).cast("int")))
    )
    size, weight = F.col("source_size"), F.col("weight")
    total = weighed.agg(F.sum(size)).first()[0] or 0
    share, capped = (0, 1), -1
    while True:
        # A source is above its limit when weight * share > limit * size, compared in whole numbers.
        above = weight.cast("decimal(38,0)") * F.lit(share[0]).cast("decimal(38,0)") > size.cast("decimal(38,0)") * F.lit(share[1] * how.limit).cast("decimal(38,0)")
        row = weighed.agg(
            F.count_if(above), F.sum(F.when(above, size)), F.sum(F.when(~above, weight))
        ).first()
        if row[0] == capped or not row[2]:
            break
        capped, share = row[0], (total - how.limit * (row[1] or 0), row[2])
    each = F.lit(share[0]).cast("double") / F.lit(share[1]).cast("double")
    target = F.when(above, (size * how.limit).cast("double")).otherwise(weight.cast("double") * each)
    return checkpointed(weighed.select("source", "source_size", target.alias("target")))


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank``, counted from 0 in code-point order. Names are spread over ranges by a sample of them."""
    spread = checkpointed(sources.repartitionByRange("source").withColumn("_part", F.spark_partition_id()))
    counts = spread.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the range shuffle.
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("source"))
    return (
        spread.withColumn("_place", place).join(F.broadcast(offsets), "_part")
        .select("source", "source_size", (F.col("_before") + F.col("_place") - 1).alias("rank"))
    )


def hash_thresholds(sized: DataFrame, targets: DataFrame, how: Mixture = Mixture()) -> DataFrame:
    """(source, repeats, threshold): documents are taken ``repeats`` times, those with a hash below the threshold once more.

    With r words left after whole repeats, a hash value is taken when the sizes before it and up to it add up to at most
    2r, so the sum ends as near to r as whole documents allow. Level by level, sizes are summed by source and bucket of
    the next hash bits. The boundary lies in the first bucket whose upper end exceeds r, or right behind it; only the
    documents of that bucket are summed again, with finer buckets.
    """
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    state = checkpointed(
        targets.select(
            "source", full.alias("repeats"), (F.col("target") - full * F.col("source_size")).alias("left"),
            F.lit(0).cast("bigint").alias("base"), F.lit(0).cast("bigint").alias("prefix"),
        )
    )
    for level in range(HASH_BITS // how.bits):
        shift = HASH_BITS - how.bits * (level + 1)
        bounds = bounded(state.select(F.col("source").alias("_s"), "left", "base", "prefix"))
        inside = sized.join(bounds, F.col("source").eqNullSafe(F.col("_s"))).where(
            F.shiftright("hash", shift + how.bits) == F.shiftright("prefix", shift + how.bits)
        )
        sums = inside.groupBy("source", "left", "base", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("n")
        )
        # At most 2**bits rows a source.
        order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        below = F.col("base") + F.coalesce(F.sum("n").over(order), F.lit(0))
        # A bucket of one value is left when its middle exceeds r, a wider one when its end does.
        reach = F.col("below") * 2 + F.col("n") * (2 if shift else 1)
        edge = (
            sums.withColumn("below", below).where(reach > F.col("left") * 2)
            .groupBy("source").agg(F.min(F.struct("bucket", "below")).alias("_e"))
            .select(F.col("source").alias("_s"), "_e")
        )
        end = F.shiftleft(F.shiftright("prefix", shift + how.bits) + 1, shift + how.bits)
        found = F.col("_e").isNotNull()
        state = checkpointed(
            state.join(edge, F.col("source").eqNullSafe(F.col("_s")), "left").select(
                "source", "repeats", "left", F.coalesce("_e.below", "base").alias("base"),
                F.when(found, F.shiftleft("_e.bucket", shift)).otherwise(end).alias("prefix"),
            )
        )
    return state.select("source", "repeats", F.col("prefix").alias("threshold"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), text_size("text").alias("size"),
        id_hash("doc_id").alias("hash"),
    )


def source_cuts(sized: DataFrame, how: Mixture = Mixture()) -> DataFrame:
    """(_source, source_size, target, repeats, threshold): all that decides what is taken, one row a source."""
    targets = source_targets(sized, how)
    cuts = hash_thresholds(sized, targets, how).withColumnRenamed("source", "_source")
    return bounded(targets.join(cuts, F.col("source").eqNullSafe(F.col("_source"))).drop("source"))


def mix(docs: DataFrame, how: Mixture = Mixture()) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies and taken (= copies * size).

    NULL texts and texts without words have size 0 and add nothing. A source without words has target 0. Which documents
    are taken depends on their ids alone: reruns agree, equal ids stand or fall together, NULL ids count as one id.
    An empty table gives no rows. Columns other than doc_id, text and source are ignored.
    """
    sized = checkpointed(_sized(docs))
    joined = sized.join(source_cuts(sized, how), F.col("source").eqNullSafe(F.col("_source")))
    copies = F.col("repeats") + (F.col("hash") < F.col("threshold")).cast("bigint")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, how: Mixture = Mixture()) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, with their columns as they are; texts are not moved."""
    names = {c: free_name(docs, c) for c in ("_source", "source_size", "target", "repeats", "threshold", "_copy")}
    source, repeats, threshold, copy = (names[c] for c in ("_source", "repeats", "threshold", "_copy"))
    cuts = source_cuts(checkpointed(_sized(docs)), how).withColumnsRenamed(names)
    copies = F.col(repeats) + (id_hash(docs["doc_id"]) < F.col(threshold)).cast("bigint")
    joined = docs.join(F.broadcast(cuts) if cuts.count() <= BROADCAST_ROWS else cuts, F.col("source").cast("string").eqNullSafe(F.col(source)))
    taken = joined.where(copies > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
