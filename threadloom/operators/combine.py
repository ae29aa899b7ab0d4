"""Union of partial collections: profile, duplicates, keep-first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union aligned by column name; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def file_counts(df: DataFrame, file: str = "file") -> DataFrame:
    """Rows per file and, with a null file, in total."""
    return df.rollup(file).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_stats(df: DataFrame, key: str = "url") -> DataFrame:
    """Rows, rows that repeat an earlier key, rows left. Nulls equal each other."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
        F.count(F.lit(1)).alias("n_kept"),
    )


def keep_first(df: DataFrame, key: str = "url", order_by: Sequence[str | Column] = ("file", "pos")) -> DataFrame:
    """First row per key along ``order_by``, nulls last; null keys are one key.

    Each input task keeps one row per key before the shuffle, so a key that
    fills a third of the table still reaches its task as one row per input task.
    """
    order = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order_by]
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") == 1).drop("_nth")
