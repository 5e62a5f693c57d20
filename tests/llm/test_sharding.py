"""Shards against brute force on the sorted rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tenura.llm.sharding import LEAST, Sharding, levelled, shards, write_shards
from tests.llm.samples import CLASHES, SCHEMA, documents, messy_rows


def brute_force(rows, how):
    """Sorted (doc_id, size, crc32, shard, slot) of rows (doc_id, text)."""
    keyed = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        h = int(hashlib.md5(raw).hexdigest()[:15], 16)
        keyed.append((h, LEAST if doc_id is None else doc_id, len(raw) + 1, zlib.crc32(raw), doc_id))
    total = sum(r[2] for r in keyed)
    heavy = sorted((r for r in keyed if r[2] * how.heavy * how.shards > total), key=lambda r: (-r[2], r))
    light = sorted(r for r in keyed if r[2] * how.heavy * how.shards <= total)
    loads, counts, out = [0] * how.shards, [0] * how.shards, []

    def put(row, k):
        out.append((repr(row[4]), row[2], row[3], k, counts[k]))
        loads[k] += row[2]
        counts[k] += 1

    for row in heavy:
        put(row, loads.index(min(loads)))
    level = 0
    rest = sum(r[2] for r in light)
    while sum(max(0, level - x) for x in loads) < rest:
        level += 1
    ends, upto = [], 0
    for x in loads:
        upto += max(0, level - x)
        ends.append(upto)
    before = 0
    for row in light:
        put(row, min(sum(2 * e <= 2 * before + row[2] for e in ends), how.shards - 1))
        before += row[2]
    return sorted(out)


def found(df):
    return sorted((repr(r.doc_id), r.size, r.text_crc32, r.shard, r.slot) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)


SMALL = Sharding(shards=4, ranges=4, range_rows=10, most_ranges=8, draws=4, heavy=5)


@pytest.mark.parametrize("how", [SMALL, Sharding(), Sharding(shards=3, ranges=2, range_rows=50, draws=2)])
def test_same_as_brute_force(spark, how):
    rows = [(i, f"word{i} " * (i * 7919 % 23) + ("long " * 400 if i % 97 == 0 else "")) for i in range(600)]
    assert found(shards(table(spark, rows), how)) == brute_force(rows, how)


def test_a_crowded_text_is_cut_where_a_shard_is_full(spark):
    rows = [(i, "the same text") for i in range(500)] + [(1000 + i, f"other {i}") for i in range(300)] + [(5000 + i, None) for i in range(400)]
    result = shards(table(spark, rows), SMALL)
    assert found(result) == brute_force(rows, SMALL)
    sizes = [r["size"] for r in result.groupBy("shard").agg(F.sum("size").alias("size")).collect()]
    assert max(sizes) - min(sizes) <= 2 * 14


def test_wholly_equal_rows(spark):
    rows = [(1, "twin")] * 300 + [(None, "")] * 100
    assert found(shards(table(spark, rows), SMALL)) == brute_force(rows, SMALL)


def test_messy_rows(spark):
    rows = messy_rows()
    docs = documents(spark, rows).withColumns({c: F.lit("x") for c in ("shard", "slot", "key", "range", "h", "id", "serial", "_bounds", "_place")})
    plain = [r[:2] for r in rows]
    assert found(shards(docs, SMALL)) == brute_force(plain, SMALL)


@pytest.mark.parametrize("rows", [[], [(1, "a")], [(None, None)], [(1, "x" * 1000), (2, "y" * 1000)]])
def test_few_or_no_rows(spark, rows):
    result = shards(table(spark, rows))
    assert result.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert found(result) == brute_force(rows, Sharding())


def test_level():
    assert levelled([0, 0, 0], 10) == [4, 4, 4]
    assert levelled([9, 0, 2], 4) == [0, 3, 1]
    assert levelled([5, 5], 0) == [0, 0]


def test_written_shards_hold_the_rows(spark, tmp_path):
    rows = messy_rows()
    docs = documents(spark, rows).withColumns({"_id": F.lit(1), "_CRC": F.lit(2), "slot": F.lit("old")})
    write_shards(docs, str(tmp_path / "out"), SMALL)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*SCHEMA.replace(",", "").split()[::2], *CLASHES, "_id", "_CRC", "shard", "slot"}
    assert sorted(repr((r.doc_id, r.text)) for r in back.collect()) == sorted(repr(r[:2]) for r in rows)
    places = sorted((repr(r.doc_id), r.shard, r.slot) for r in back.collect())
    assert places == sorted((repr(r.doc_id), r.shard, r.slot) for r in shards(docs, SMALL).collect())
