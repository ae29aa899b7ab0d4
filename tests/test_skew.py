import pytest
from pyspark.sql import functions as F

from threadloom.operators.skew import heavy_keys, lookup_join


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a sixth without key, the rest spread out."""
    key = (
        F.when(F.col("id") % 6 < 2, F.lit(7))
        .when(F.col("id") % 6 == 2, F.lit(None))
        .otherwise(F.col("id") % 500)
    )
    return spark.range(12_000).select("id", key.cast("bigint").alias("k"))


def test_heavy_keys_finds_the_hot_one(spark, facts):
    # 4000 rows of its own and the 12 ordinary rows with this number
    assert [tuple(r) for r in heavy_keys(facts, "k", rows=100).collect()] == [(7, 41)]
    assert heavy_keys(facts, "k", rows=10_000).count() == 0
    # Rows per key decide, however many rows there are in all.
    assert heavy_keys(facts.union(spark.range(50_000).selectExpr("id + 10000", "id + 10000")), "k", rows=100).count() == 1


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_same_result_as_the_plain_join(spark, facts, how, threshold):
    lookup = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        salted = lookup_join(facts, lookup, "k", ["id"], how, rows=500)
        plain = facts.join(lookup, "k", how)
        columns = ["id", "k", "v"]
        assert sorted(map(str, salted.select(columns).collect())) == sorted(
            map(str, plain.select(columns).collect())
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_rows_are_dealt_out(spark, facts):
    lookup = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(facts, lookup, "k", ["id"], rows=500)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 12_000 / 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_other_joins_are_refused(facts):
    with pytest.raises(ValueError):
        lookup_join(facts, facts, "k", ["id"], how="full")
