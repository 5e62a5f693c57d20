"""Shards of near-equal bytes: sampled splitters, range partitions, and subdivision of ranges that are too full."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.texts import free_name
from tenura.session import checkpointed

LEAST = -(1 << 63)
KEY = "struct<h:bigint,id:bigint,serial:bigint>"
Key = tuple[int, int, int]


@dataclass(frozen=True)
class Sharding:
    """``ranges`` are cut at first; one for every ``range_rows`` rows where that is more, at most ``most_ranges``.

    ``draws`` sampled keys stand for a range. A row larger than 1 / ``heavy`` of a shard's share is dealt on its own;
    there are at most ``heavy * shards`` of them. ``ranges``, ``range_rows`` and ``draws`` balance the work, they never
    change a result.
    """

    shards: int = 8
    ranges: int = 512
    range_rows: int = 200_000
    most_ranges: int = 8192
    draws: int = 16
    heavy: int = 100


def text_hash(text: Column) -> Column:
    """60 bits of the md5 of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key): equal texts have neighbouring keys; a stored row's serial ends all ties."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(
        doc_id.alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), text_hash(text).alias("h"), F.monotonically_increasing_id().alias("serial"),
    )
    key = F.struct("h", F.coalesce("doc_id", F.lit(LEAST)).alias("id"), "serial")
    return checkpointed(rows.select("doc_id", "size", "text_crc32", key.alias("key")))


def located(rows: DataFrame, lowers: list[Key]) -> DataFrame:
    """Rows with ``range``: the place of the last of the sorted ``lowers`` that is not above the key, by binary search.

    A key below all of them belongs to the first.
    """
    steps = [1 << k for k in range(max(len(lowers) - 1, 0).bit_length())][::-1]
    bounds = rows.sparkSession.createDataFrame([(lowers,)], f"b array<{KEY}>")

    def jump(at: Column, by: Column) -> Column:
        to = at + by
        return F.when((to < len(lowers)) & (F.get("_bounds", to) <= F.col("key")), to).otherwise(at)

    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), jump) if steps else F.lit(0)
    return rows.withColumn("_bounds", bounds.scalar()).withColumn("range", found).drop("_bounds")


@dataclass
class _Ranges:
    """Bytes and rows of each range by its lower bound; a table of bounded size on the driver."""

    how: Sharding
    mean: float
    measured: dict[Key, tuple[int, int]]

    def weight(self, lower: Key) -> float:
        size, rows = self.measured[lower]
        return size + rows * self.mean

    def splitters(self, rows: DataFrame, lowers: list[Key], parts: int, level: int) -> list[Key]:
        """Keys that cut each of some ranges into about ``parts``.

        Keys are drawn with a chance in proportion to the row's size plus the mean size, so that neither bytes nor
        rows crowd a part; of every ``draws`` drawn keys in order one becomes a bound. Of a range with at most ``parts``
        rows all keys do. The draw is a hash of the key, so it does not change with partitions or retries.
        """
        how = self.how
        facts = rows.sparkSession.createDataFrame(
            [(i, self.measured[k][1], parts * how.draws / self.weight(k)) for i, k in enumerate(lowers)], "range int, _rows bigint, _chance double")
        unit = F.pmod(F.xxhash64(F.lit(level), "key"), F.lit(1 << 40)) / float(1 << 40)
        copies = F.when(F.col("_rows") <= parts, how.draws).otherwise(
            F.floor((F.col("size") + self.mean) * F.col("_chance") + unit)).cast("int")
        drawn = (
            located(rows, lowers).join(F.broadcast(facts), "range").withColumn("_copies", copies).where("_copies > 0")
            .select("range", "key.*", "_copies")
        )
        # About parts * draws keys for each of the ranges.
        found, upto, range_ = [], 0, None
        for r in sorted((r["range"], r["h"], r["id"], r["serial"], r["_copies"]) for r in drawn.collect()):
            upto = 0 if r[0] != range_ else upto
            range_ = r[0]
            if (upto + r[4]) // how.draws > upto // how.draws:
                found.append(r[1:4])
            upto += r[4]
        return found

    def cut(self, rows: DataFrame, cuts: list[int]) -> None:
        """Subdivide until no range is too full and none with several rows crosses a cut of the running bytes.

        The whole table is read for the first ranges; then only rows of ranges to be subdivided, from a table of those.
        """
        count = sum(n for _, n in self.measured.values())
        parts = max(self.how.ranges, min(self.how.most_ranges, -(-count // self.how.range_rows)))
        full_rows, full_weight = max(4 * count // parts, 4 * self.how.ranges), 8 * self.mean * count / parts
        todo, level = list(self.measured), 0
        while todo:
            bounds = self.splitters(rows, todo, parts, level)
            lowers = sorted({*todo, *bounds})
            totals = located(rows, lowers).groupBy("range").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
            found = {lowers[r["range"]]: (r["size"], r["n"]) for r in totals.collect()}
            for lower in todo:
                self.measured.pop(lower)
            self.measured.update(found)
            starts = self.starts()
            todo = sorted(
                k for k, (size, n) in found.items() if n > 1 and (
                    any(starts[k] < c < starts[k] + size for c in cuts)
                    or n > full_rows or n > self.how.ranges and self.weight(k) > full_weight
                )
            )
            if todo:
                again = [i for i, k in enumerate(lowers) if k in set(todo)]
                rows = checkpointed(located(rows, lowers).where(F.col("range").isin(again)).drop("range"))
            parts, level = self.how.ranges, level + 1

    def starts(self) -> dict[Key, int]:
        """Bytes of all lower ranges."""
        lowers = sorted(self.measured)
        sums = accumulate((self.measured[k][0] for k in lowers), initial=0)
        return dict(zip(lowers, sums))


def levelled(loads: list[int], rest: int) -> list[int]:
    """How much more each shard takes so that ``rest`` fills all to the same level, or leaves those above it alone."""
    lowest = list(accumulate(sorted(loads)))
    level = min(-(-(rest + total) // (j + 1)) for j, total in enumerate(lowest))
    return [max(0, level - load) for load in loads]


def shards(docs: DataFrame, how: Sharding | None = None) -> DataFrame:
    """One row per row: doc_id, size, text_crc32, shard and slot (0, 1, ... in each shard).

    Sizes are UTF-8 bytes of the text plus 1. Rows larger than 1 / ``heavy`` of a shard's share go one by one, the largest
    first, to the shard with the fewest bytes; the others fill all shards up to one level, in the order of a hash of the
    text and then of doc_id, so equal texts lie together and a crowded text is cut where a shard is full. A row goes
    where its middle byte lies, so a shard misses the level by less than one light row at either end. Slots count the
    heavy rows first, then the others in key order.

    NULL and empty texts have size 1 and crc32 0; a NULL doc_id comes before all others. Repeated rows are placed each;
    among wholly equal ones the stored table's order decides. An empty table gives no rows; other columns are ignored.
    """
    how = how or Sharding()
    rows = sized(docs)
    spark = docs.sparkSession
    whole = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count(F.lit(1)).alias("n")).first()
    heavy = F.col("size") * (how.heavy * how.shards) > whole["size"]
    # Fewer than heavy * shards rows can be that large.
    large = rows.where(heavy).orderBy(F.col("size").desc(), "key").select("size", "key.serial").collect()
    loads, counts, dealt = [0] * how.shards, [0] * how.shards, []
    for row in large:
        shard = loads.index(min(loads))
        dealt.append((row["serial"], shard, counts[shard]))
        loads[shard] += row["size"]
        counts[shard] += 1
    rest = whole["size"] - sum(loads)
    light = rows.where(~heavy)
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    singly = spark.createDataFrame(dealt, "serial bigint, shard int, slot bigint")
    result = rows.withColumn("serial", F.col("key.serial")).join(F.broadcast(singly), "serial").select(*columns)
    if len(large) == whole["n"]:
        return result
    cuts = list(accumulate(levelled(loads, rest)))
    ranges = _Ranges(how, rest / (whole["n"] - len(large)), {(LEAST, LEAST, LEAST): (rest, whole["n"] - len(large))})
    ranges.cut(light, cuts[:-1])
    lowers, starts, places = sorted(ranges.measured), ranges.starts(), []
    for i, lower in enumerate(lowers):
        size, n = ranges.measured[lower]
        shard = sum(2 * c <= 2 * starts[lower] + size for c in cuts[:-1])
        places.append((i, shard, counts[shard]))
        counts[shard] += n
    ordered = Window.partitionBy("range").orderBy("key")
    known = spark.createDataFrame(places, "range int, shard int, _base bigint")  # one row a range
    filled = located(light, lowers).withColumn("_place", F.row_number().over(ordered)).join(F.broadcast(known), "range")
    return result.unionByName(filled.withColumn("slot", F.col("_base") + F.col("_place") - 1).select(*columns))


def write_shards(docs: DataFrame, path: str, how: Sharding | None = None) -> None:
    """Write the whole rows below ``path``, one folder ``shard=k`` a shard, with their ``slot`` as an added column.

    Rows and places meet by doc_id and text hash, repeated ones by their number. Columns of ``docs`` that are called
    shard or slot are replaced.
    """
    rows = docs.drop("shard", "slot")
    doc_id, crc, nth = (free_name(rows, name) for name in ("_id", "_crc", "_nth"))

    def numbered(df: DataFrame, text_crc32: Column, order: list) -> DataFrame:
        keyed = df.withColumns({doc_id: F.col("doc_id").cast("bigint"), crc: text_crc32})
        return keyed.withColumn(nth, F.row_number().over(Window.partitionBy(doc_id, crc).orderBy(*order)))

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    placed = numbered(shards(docs, how), F.col("text_crc32"), ["shard", "slot"]).select(doc_id, crc, nth, "shard", "slot")
    rows = numbered(rows, F.crc32(text), [F.xxhash64(text), F.col("text").isNull()])
    joined = rows.join(placed, [rows[c].eqNullSafe(placed[c]) for c in (doc_id, crc, nth)]).drop(doc_id, crc, nth)
    joined.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
