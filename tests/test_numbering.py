import pytest
from pyspark.sql import functions as F

from threadloom.operators.numbering import number_rows, number_stored


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
@pytest.mark.parametrize("partitions", [None, 1, 13])
def test_dense_and_ordered(spark, n, partitions):
    df = spark.range(n).select((F.col("id") * 7919 % 5003).alias("k"), "id")
    got = number_rows(df, ["k", "id"], partitions=partitions).orderBy("k", "id").collect()
    assert [r.rn for r in got] == list(range(n))


def test_one_heavy_key_is_split_by_the_tie_break(spark):
    df = spark.range(6000).select(F.lit(1).alias("k"), "id")
    numbered = number_rows(df, ["k", "id"], partitions=6)
    rows = numbered.withColumn("part", F.expr("rn div 1000")).collect()
    assert all(r.rn == r.id for r in rows)


def test_nulls_last(spark):
    df = spark.createDataFrame(
        [(2, "b"), (1, "b"), (None, "a"), (1, None)], "d INT, u STRING"
    )
    order = [F.asc_nulls_last("d"), F.asc_nulls_last("u")]
    got = number_rows(df, order).orderBy("rn").select("d", "u").collect()
    assert [tuple(r) for r in got] == [(1, "b"), (1, None), (2, "b"), (None, "a")]


def test_no_row_passes_through_one_task(spark):
    df = number_rows(spark.range(1000).select("id"), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step sums the row counts, one per partition.
    before_single = plan.split("SinglePartition")
    assert len(before_single) == 2
    assert "HashAggregate" in before_single[1]


def test_a_span_opens_only_its_ranges(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("k"))
    stored = number_stored(df, ["k"], partitions=8)
    assert stored.rows == 10_000 and len(stored.starts) == 8
    for first, last in ((0, 100), (4_000, 4_500), (9_990, 10_000), (0, 10_000), (5, 5)):
        got = [r.k for r in stored.numbered(first, last).orderBy("rn").collect()]
        assert got == list(range(first, last))
    opened = {r.f for r in stored.numbered(4_000, 4_500).select(F.input_file_name().alias("f")).distinct().collect()}
    assert 1 <= len(opened) <= 2
    plan = stored.numbered(4_000, 4_500)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan and "Sort " not in plan
    # A series of spans opens every file once, and those at a border twice.
    spans = [stored.numbered(k, k + 1_000) for k in range(0, 10_000, 1_000)]
    files = [f for s in spans for f in {r.f for r in s.select(F.input_file_name().alias("f")).distinct().collect()}]
    assert len(files) <= 8 + len(spans)


def test_empty_span_and_empty_table(spark):
    stored = number_stored(spark.range(0).select("id"), ["id"])
    assert stored.rows == 0 and stored.numbered().collect() == [] and stored.plain().collect() == []
