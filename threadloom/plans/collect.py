"""Collection jobs over landed data: threads, authors, union, logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from threadloom import schemas
from threadloom.operators import combine, progress, threads
from threadloom.operators.skew import lookup_join
from threadloom.session import store
from threadloom.sources.readers import FILE_ORDER, read_files


# What the log says of a post whose page is neither a list of replies nor an error object.
UNREADABLE = "page not readable"


@dataclass(frozen=True)
class Collected:
    """What one collection run yields: frames over the matched replies."""

    replies: DataFrame
    authors: DataFrame
    outcomes: DataFrame


def get_comments(
    posts: DataFrame, pages: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reply rows, author rows, replies per post) of the posts' landed replies.

    ``posts`` has unique ``post_url``; ``pages`` has (post_url, page), a page
    being a list of reply objects, as JSON text or parsed. Posts are matched to
    pages before a page is parsed, and what matched is stored once, because
    each of the three results reads other columns of it.

    A post with a page that cannot be read fails as a whole: it gives no rows,
    a null count and the page's own error text, if it has one.
    """
    matched = lookup_join(pages, posts.select("post_url"), "post_url", ["page"], how="inner")
    parsed = store(
        threads.parse_pages(matched, error="_error")
        .withColumn("_readable", F.col("page").isNotNull())
        .withColumn("_replies", F.coalesce(F.size("page"), F.lit(0))),
        "pages",
    )
    totals = parsed.groupBy("post_url").agg(
        F.sum("_replies").alias("_n"),
        F.bool_and("_readable").alias("_good"),
        F.min(F.when(~F.col("_readable"), F.coalesce("_error", F.lit(UNREADABLE)))).alias("error"),
    )
    counts = posts.select("post_url").join(totals, "post_url", "left").select(
        "post_url",
        F.when(F.coalesce("_good", F.lit(True)), F.coalesce("_n", F.lit(0))).alias("n_replies"),
        "error",
    )
    readable = parsed.select("post_url", "page")
    broken = parsed.where(~F.col("_readable")).select("post_url")
    readable = readable.join(broken, "post_url", "left_anti")
    objects = threads.unnest_page(readable)
    return threads.reply_rows(objects), threads.author_rows(objects), counts


def compile_thread(
    posts: DataFrame,
    log: DataFrame,
    pages: DataFrame,
    landed: DataFrame,
    seed: int | None = None,
    shards: int = progress.SHARDS,
    at_least: int | None = None,
    retry_failed: bool = False,
) -> Collected:
    """Collect the threads of all pending posts, or of those in shard ``seed``.

    ``landed`` has one row per fetched post, (post_url, error). A post not
    landed, landed with an error or not readable gives a failed outcome and no
    replies; any other gives its reply count. A ``row`` is tried once per run.
    """
    if seed is not None:
        posts = progress.shard_rows(posts, seed, shards=shards)
    pending = progress.pending_posts(progress.min_replies(posts, at_least), log, retry_failed)
    tried = (
        combine.keep_first(pending.select("row", F.col("url").alias("post_url")), "row", ["post_url"])
        .join(landed.select("post_url", "error", F.lit(True).alias("_landed")), "post_url", "left")
        .withColumn(
            "error", F.when(F.col("_landed").isNull(), "thread not landed").otherwise(F.col("error"))
        )
        .drop("_landed")
    )
    tried = store(tried, "tried")  # three narrow columns, used three times below
    good = tried.where(F.col("error").isNull()).select("post_url").distinct()
    replies, authors, counts = get_comments(good, pages)
    outcomes = (
        tried.join(counts.withColumnRenamed("error", "_page_error"), "post_url", "left")
        .withColumn("error", F.coalesce("error", "_page_error"))
        .select(
            "row",
            F.when(F.col("error").isNull(), 1).otherwise(0).alias("scraped"),
            "n_replies",
            "error",
        )
    )
    return Collected(replies, authors, outcomes)


@dataclass(frozen=True)
class Combined:
    rows: DataFrame
    per_file: DataFrame
    duplicates: DataFrame


def combine_frame(df: DataFrame, key: str = "url", order_by=FILE_ORDER) -> Combined:
    """Profile and keep-first of rows that carry their file and place."""
    kept = combine.keep_first(df, key, order_by)
    return Combined(
        kept,
        combine.file_counts(df, order_by[0]),
        combine.duplicate_stats(df, key),
    )


def combine_threads(
    spark: SparkSession,
    paths,
    schema: T.StructType = schemas.REPLY_ROW,
    fmt: str = "parquet",
    key: str = "url",
) -> Combined:
    """Union all files by name and keep the first row per URL.

    Works for reply files and, with ``schemas.AUTHOR_ROW``, for author files;
    CSV files of replies have ``schemas.REPLY_TEXT_ROW``.
    Write the result outside ``paths``, or the next run reads it as input.
    """
    return combine_frame(read_files(spark, paths, schema, fmt), key)


def merge_scrape_logs(spark: SparkSession, paths, fmt: str = "parquet") -> DataFrame:
    """Merge the shards' logs by ``row``; the first file with a value wins."""
    parts = read_files(spark, paths, schemas.PROGRESS_LOG, fmt)
    return progress.merge_logs(parts.withColumn("_order", F.struct(*FILE_ORDER)), "_order")


def collect_authors(
    usernames: DataFrame, profiles: DataFrame, name: str = "username"
) -> tuple[DataFrame, DataFrame]:
    """(author rows of all known usernames, usernames without a profile)."""
    found = threads.distinct_authors(usernames, name).join(profiles, name)
    return (
        threads.project_fields(found, schemas.AUTHOR_ROW),
        threads.missing_authors(usernames, profiles, name),
    )
