"""Rejected rows, their reasons and counts."""

import pytest
from pyspark.sql import functions as F

from threadloom.operators import progress, threads
from threadloom.operators.rejects import null_rules, split_rejects

ROWS = [(1, "a", "x"), (2, None, "y"), (None, None, "z"), (4, "d", None), (5, "e", "w")]


def test_first_reason_counts_and_rows(spark):
    df = spark.createDataFrame(ROWS, "id long, text string, handle string")
    split = split_rejects(df, null_rules(id="id", text="text", handle="handle"))
    assert sorted(r.id for r in split.kept.collect()) == [1, 5] and split.kept.columns == df.columns
    assert sorted(map(tuple, split.rejected.collect()), key=str) == sorted(
        [(2, None, "y", "null text"), (None, None, "z", "null id"), (4, "d", None, "null handle")], key=str
    )
    assert split.counts == {"rows": 5, "null id": 1, "null text": 1, "null handle": 1}


def test_rows_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(100).mapInArrow(touch, "id long")
    split = split_rejects(df, [("even", F.col("id") % 2 == 0), ("unknown", F.lit(None).cast("boolean"))])
    assert (split.kept.count(), split.rejected.count()) == (50, 50)
    assert split.counts == {"rows": 100, "even": 50, "unknown": 0} and seen.value == 100


def test_empty_and_clashing(spark):
    empty = split_rejects(spark.createDataFrame([], "id long"), null_rules(id="id"))
    assert empty.counts == {"rows": 0, "null id": 0}
    assert empty.kept.collect() == empty.rejected.collect() == []
    with pytest.raises(ValueError):
        split_rejects(spark.range(1).withColumn("reason", F.lit("x")), null_rules(id="id"))


def test_summaries(spark):
    log = spark.createDataFrame([(1, 1), (1, None), (2, 0), (3, None), (4, 1)], "row long, scraped int")
    assert tuple(progress.log_summary(log).first()) == (4, 2, 1, 1)
    names = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "username string")
    assert tuple(threads.author_summary(names).first()) == (4, 1, 2)
