import pytest
from pyspark.sql import functions as F

from tenura.operators import sampling


def labelled(spark, parts=3):
    return spark.range(2000).select(
        F.col("id").cast("string").alias("msno"), (F.col("id") % 9 == 0).cast("int").alias("is_churn")).repartition(parts)


@pytest.mark.parametrize("fraction", [0.0, 0.0003, 0.2, 0.5, 1.0])
def test_exact_counts_per_stratum(spark, fraction):
    df = labelled(spark)
    sizes = {r["is_churn"]: r["count"] for r in df.groupBy("is_churn").count().collect()}
    taken = sampling.stratified_sample(df, "msno", "is_churn", fraction)
    found = {r["is_churn"]: r["count"] for r in taken.groupBy("is_churn").count().collect()}
    assert found == {k: round(fraction * n) for k, n in sizes.items() if round(fraction * n)}
    assert taken.select("msno").distinct().count() == taken.count()


def test_draws_depend_on_the_seed_only(spark):
    def keys(parts, seed):
        return {r["msno"] for r in sampling.stratified_sample(labelled(spark, parts), "msno", "is_churn", 0.1, seed).collect()}

    assert keys(2, 1) == keys(9, 1) != keys(2, 2)


def test_the_lowest_hashes_are_taken(spark):
    df = labelled(spark).where("is_churn = 1").withColumn("h", sampling.seeded_hash("msno", 42))
    taken = {r["msno"] for r in sampling.stratified_sample(df, "msno", "is_churn", 0.25).collect()}
    rows = sorted((r["h"], r["msno"]) for r in df.collect())
    assert taken == {k for _, k in rows[: round(0.25 * len(rows))]}


def test_null_stratum_is_a_stratum(spark):
    df = spark.range(40).select(F.col("id").alias("msno"), F.when(F.col("id") < 20, 1).alias("is_churn"))
    taken = sampling.stratified_sample(df, "msno", "is_churn", 0.5)
    assert {(r["is_churn"], r["count"]) for r in taken.groupBy("is_churn").count().collect()} == {(None, 10), (1, 10)}


def test_split_covers_every_row_once(spark):
    df = labelled(spark)
    split = sampling.train_validation_split(df)
    assert split.count() == 2000
    assert {(r["is_churn"], r["count"]) for r in split.where("split = 'validation'").groupBy("is_churn").count().collect()} == {
        (0, round(0.2 * 1777)), (1, round(0.2 * 223))}


def test_related_rows_and_simple_sample(spark):
    df = labelled(spark)
    chosen = sampling.stratified_sample(df, "msno", "is_churn", 0.01)
    related = df.select("msno").unionByName(df.select("msno"))
    assert sampling.keep_sampled(related, chosen).count() == 2 * chosen.count()
    assert 30 < sampling.simple_sample(df, 100, "msno").count() < 200
    assert sampling.simple_sample(df, 10_000, "msno").count() == 2000
    with pytest.raises(ValueError):
        sampling.simple_sample(df, 0, "msno")
    assert sampling.approximate_stratified_sample(df, "is_churn", {0: 0.0, 1: 1.0}).count() == 223
