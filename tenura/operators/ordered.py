"""Exact order statistics and running totals without a global sort on one task.

Every operator first reduces its input to one row per distinct value with a count (partial aggregation removes hot
values before the shuffle), then spreads those rows over value ranges. Each range is sorted on its own; only one
small row per range is combined across ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.session import checkpointed

# A value range holds about this many distinct values; the limits' sketch allows at most MOST_RANGES per key.
RANGE_ROWS = 1_000_000
MOST_RANGES = 4096
# Per-key tables up to this many rows are sent to all tasks; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str, measures: dict[str, Column] | None = None
) -> DataFrame:
    """One row per (keys, value) with summed measures; NULL and NaN values are left out."""
    measures = measures or {"n": F.lit(1)}
    known = F.col(value).isNotNull()
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        known = known & ~F.isnan(value)
    totals = [F.sum(column).alias(name) for name, column in measures.items()]
    return df.where(known).groupBy(*keys, value).agg(*totals)


def matched(left: DataFrame, right: DataFrame, columns: Sequence[str], small: bool) -> DataFrame:
    """Inner join in which a NULL key matches a NULL key; ``small`` says the right side was measured as small."""
    renamed = right.withColumnsRenamed({c: f"_j{i}" for i, c in enumerate(columns)})
    same = [F.col(c).eqNullSafe(F.col(f"_j{i}")) for i, c in enumerate(columns)]
    joined = left.join(F.broadcast(renamed) if small else renamed, same)
    return joined.drop(*[f"_j{i}" for i in range(len(columns))])


def range_count(counts: DataFrame) -> int:
    """Ranges for a checkpointed table: 8 for a small one, more in proportion to its rows."""
    return max(8, min(MOST_RANGES, -(-counts.count() // RANGE_ROWS)))


def ranged(counts: DataFrame, keys: Sequence[str], value: str, ranges: int | None = None) -> tuple[DataFrame, bool]:
    """Add ``_range``, a non-decreasing function of the value that balances distinct values within each key.

    The limits come from a mergeable quantile sketch of fixed size per key. They are written once, so every use of the
    result sees the same ranges; they balance the work and never change a result. Their number follows the rows of
    ``counts``, which should be checkpointed. Also returns whether per-key tables are small enough to broadcast.
    """
    ranges = ranges or range_count(counts)
    fractions = [i / ranges for i in range(1, ranges)]
    limits = F.percentile_approx(value, fractions, ranges * 20).alias("_limits")
    sketch = checkpointed(counts.groupBy(*keys).agg(limits))
    if keys:
        small = sketch.count() * ranges <= BROADCAST_ROWS
        spread = matched(counts, sketch, keys, small)
    else:
        small = True
        spread = counts.withColumn("_limits", sketch.scalar())
    index = F.size(F.filter("_limits", lambda limit: limit <= F.col(value)))
    return spread.withColumn("_range", index).drop("_limits"), small


def range_totals(spread: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per range: the total of each measure and what all lower ranges of the same key add up to."""
    totals = spread.groupBy(*keys, "_range").agg(*[F.sum(m).alias(f"_{m}_total") for m in measures])
    # At most MOST_RANGES rows per key reach this window.
    below = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({f"_{m}_below": F.coalesce(F.sum(f"_{m}_total").over(below), F.lit(0)) for m in measures})


def running_totals(
    counts: DataFrame, keys: Sequence[str], value: str, measures: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Add ``<measure>_cum`` to distinct-value rows: the total of all rows of the key up to this value.

    Pass a checkpointed table: it is read twice.
    """
    spread, small = ranged(counts, keys, value, ranges)
    joined = matched(spread, range_totals(spread, keys, measures), [*keys, "_range"], small)
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cumulated = [(F.col(f"_{m}_below") + F.sum(m).over(inside)).alias(f"{m}_cum") for m in measures]
    return joined.select(*keys, value, *measures, *cumulated)


def bounded_domain(kind: T.DataType) -> bool:
    """Types with so few possible values that one task can hold them all."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.BooleanType)):
        return True
    return isinstance(kind, T.DecimalType) and kind.precision <= 5


def quantiles_of_counts(
    counts: DataFrame, value: str, fractions: Sequence[float], keys: Sequence[str] = (), n: str = "n",
    ranges: int | None = None, into: str = "quantiles",
) -> DataFrame:
    """Exact interpolated quantiles of a distinct-value table: per key the row count ``n`` and an array of doubles.

    Only the ranges that hold a wanted rank are sorted. Pass a checkpointed table: it is read twice.
    """
    keys = list(keys)
    spread, small = ranged(counts.select(*keys, value, F.col(n).alias("n")), keys, value, ranges)
    totals = range_totals(spread, keys, ["n"])
    everything = Window.partitionBy(*(keys or [F.lit(0)]))
    places = F.array(*[F.lit(float(f)) for f in fractions])
    wanted = F.transform(places, lambda f: (F.col("size") - 1) * f)
    ranks = F.array_distinct(F.flatten(F.transform(wanted, lambda h: F.array(F.floor(h), F.ceil(h)))))
    start = F.col("_n_below")
    located = (
        totals.withColumn("size", F.sum("_n_total").over(everything))
        .withColumn("_ranks", F.filter(ranks, lambda r: (r >= start) & (r < start + F.col("_n_total"))))
        .where(F.size("_ranks") > 0)
        .select(*keys, "_range", "size", "_n_below", "_ranks")
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    here = F.filter("_ranks", lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("n")))
    hits = (
        matched(spread, located, [*keys, "_range"], small)
        .withColumn("_upto", F.col("_n_below") + F.sum("n").over(inside))
        .withColumn("_rank", F.explode(here))
        .groupBy(*keys)
        .agg(
            F.max("size").cast("bigint").alias("n"),
            F.map_from_entries(F.collect_list(F.struct("_rank", F.col(value).cast("double").alias("v")))).alias("_at"),
        )
    )

    def interpolated(fraction: Column) -> Column:
        h = (F.col("n") - 1) * fraction
        low, high = F.try_element_at("_at", F.floor(h)), F.try_element_at("_at", F.ceil(h))
        return low + (high - low) * (h - F.floor(h))

    return hits.select(*keys, "n", F.transform(places, interpolated).alias(into))


def exact_quantiles(
    df: DataFrame,
    value: str,
    fractions: Sequence[float],
    keys: Sequence[str] = (),
    weight: str | None = None,
    ranges: int | None = None,
    into: str = "quantiles",
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per key with ``n`` and an array of doubles.

    Values of a narrow type (16-bit integers, short decimals) go through the built-in aggregate, whose buffer is then
    bounded. All others are ranked by range, so neither the number of rows nor of distinct values meets a single task.
    """
    keys = list(keys)
    weights = F.col(weight) if weight else F.lit(1).cast("bigint")
    if bounded_domain(df.schema[value].dataType):
        exact = F.percentile(F.col(value).cast("double"), list(fractions), weights)
        return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
            F.sum(weights).cast("bigint").alias("n"), exact.alias(into)
        )
    counts = checkpointed(value_counts(df, keys, value, {"n": weights}))
    return quantiles_of_counts(counts, value, fractions, keys, ranges=ranges, into=into)


def moments_of_counts(counts: DataFrame, value: str, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Count, mean, sample variance, minimum and maximum per key of a distinct-value table with finite values.

    The variance is taken around the mean in a second pass, which loses no digits. Keys name columns or groups, so the
    table of means is small.
    """
    v, w = F.col(value).cast("double"), F.col(n)
    means = counts.groupBy(*keys).agg(F.sum(w).alias("_rows"), (F.sum(w * v) / F.sum(w)).alias("mean"))
    around = matched(counts, means, list(keys), small=True)
    return around.groupBy(*keys).agg(
        F.max("_rows").cast("bigint").alias("count"),
        F.max("mean").alias("mean"),
        F.try_divide(F.sum(w * (v - F.col("mean")) * (v - F.col("mean"))), F.max("_rows") - 1).alias("variance"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )


def hash_positions(df: DataFrame, key: str, salt: str, into: str, prefix_bits: int = 12) -> DataFrame:
    """Number all rows 0..n-1 in the order of a salted hash of ``key``; the numbers do not depend on partitioning.

    The hash prefix spreads rows evenly over ranges, so no range sorts more than its share.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(salt), F.col(key).cast("string")))
    spread = hashed.withColumn("_range", F.shiftright("_hash", 64 - prefix_bits))
    totals = spread.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    below = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_below", F.coalesce(F.sum("_rows").over(below), F.lit(0))).drop("_rows")
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_hash", key))
    return (
        spread.withColumn("_place", place)
        .join(F.broadcast(offsets), "_range")  # at most 2 ** prefix_bits rows
        .withColumn(into, F.col("_below") + F.col("_place") - 1)
        .drop("_hash", "_range", "_place", "_below")
    )
