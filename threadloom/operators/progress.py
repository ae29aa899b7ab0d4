"""Sharding, resume from a progress log, and log maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.functions.keys import shard_of, shuffle_key
from threadloom.operators.numbering import number_rows

# Number of shards, seed of the shuffle.
SHARDS = 10
SEED = 42


def with_shard(df: DataFrame, key: str = "row", shards: int = SHARDS) -> DataFrame:
    return df.withColumn("shard", shard_of(F.col(key), shards))


def shard_rows(df: DataFrame, seed: int, key: str = "row", shards: int = SHARDS) -> DataFrame:
    """The rows worker ``seed`` takes; the shards together are the whole."""
    return df.where(shard_of(F.col(key), shards) == seed)


def seeded_order(df: DataFrame, key: str = "row", seed: int = SEED) -> DataFrame:
    """Repeatable shuffle: ``position`` 0, 1, 2, ... in seeded hash order."""
    ordered = df.withColumn("_shuffle", shuffle_key(F.col(key), seed))
    return number_rows(ordered, ["_shuffle", key], name="position").drop("_shuffle")


def min_replies(posts: DataFrame, at_least: int | None = None) -> DataFrame:
    """Optional inclusion rule on the reply count; off by default."""
    return posts if at_least is None else posts.where(F.col("reply_count") >= at_least)


def done_rows(log: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Distinct rows not to be tried again; failures count unless retried."""
    done = F.col("scraped") == 1 if retry_failed else F.col("scraped").isin(0, 1)
    return log.where(done).select("row").distinct()


def pending_posts(posts: DataFrame, log: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Posts the log does not call done."""
    return posts.join(done_rows(log, retry_failed), "row", "left_anti")


def latest_outcomes(outcomes: DataFrame, at: str) -> DataFrame:
    """One outcome per row: the one with the greatest ``at``."""
    values = [c for c in outcomes.columns if c not in ("row", at)]
    return (
        outcomes.groupBy("row")
        .agg(F.max_by(F.struct(*values), F.col(at)).alias("_last"))
        .select("row", "_last.*")
    )


def outcome_text(outcomes: DataFrame) -> DataFrame:
    """Typed outcomes -> log columns: ``output`` is the count or the error text."""
    return outcomes.select(
        "row", "scraped", F.coalesce(F.col("n_replies").cast("string"), "error").alias("output")
    )


def update_log(log: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Overwrite ``scraped`` and ``output`` where an outcome (one per row) exists.

    Rows the log does not have are ignored; all its rows of a key are updated.
    """
    news = outcomes.select(
        "row",
        F.lit(True).alias("_new"),
        F.col("scraped").alias("_scraped"),
        F.col("output").alias("_output"),
    )
    kept = [c for c in log.columns if c not in ("scraped", "output")]
    return log.join(news, "row", "left").select(
        *kept,
        F.when(F.col("_new"), F.col("_scraped")).otherwise(F.col("scraped")).alias("scraped"),
        F.when(F.col("_new"), F.col("_output")).otherwise(F.col("output")).alias("output"),
    )


def merge_logs(parts: DataFrame, order: str) -> DataFrame:
    """One log line per row: first non-null value of each column along ``order``.

    ``parts`` is the union of all logs. The two columns are filled separately,
    each by one aggregate with map-side partials, so a row repeated in every
    part costs nothing extra.
    """

    def first_value(name: str):
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name)

    return parts.groupBy("row").agg(first_value("scraped"), first_value("output"))


def log_summary(log: DataFrame) -> DataFrame:
    """One row: n_rows, n_done, n_failed and n_open, by the distinct rows of a log."""
    state = log.groupBy("row").agg(F.max("scraped").alias("scraped"))
    return state.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("scraped") == 1).alias("n_done"),
        F.count_if(F.col("scraped") == 0).alias("n_failed"),
        F.count_if(F.col("scraped").isNull()).alias("n_open"),
    )
