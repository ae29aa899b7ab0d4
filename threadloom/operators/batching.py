"""From rows to request batches: who is pending, in which order, in which prompt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.functions.text import fill, item_line, prompt_text, safe_id
from threadloom.templates import ARGUMENT_USER, STANCE_USER

# Posts and replies per request.
ARGUMENT_BATCH = 20
STANCE_BATCH = 25


def is_pending(result: str) -> Column:
    return F.col(result).isNull() | (F.col(result) == "")


def with_result_column(df: DataFrame, result: str) -> DataFrame:
    return df if result in df.columns else df.withColumn(result, F.lit(None).cast("string"))


def pending_arguments(posts: DataFrame, result: str = "AM_output") -> DataFrame:
    """Posts without an argument result, or with an empty one."""
    return with_result_column(posts, result).where(is_pending(result))


def pending_stances(
    replies: DataFrame, only_missing: bool = False, result: str = "SD_output"
) -> DataFrame:
    """All replies; with ``only_missing`` those without a stance result."""
    replies = with_result_column(replies, result)
    return replies.where(is_pending(result)) if only_missing else replies


def eligible_counts(df: DataFrame, result: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(is_pending(result)).alias("n_pending")
    )


def split_ids(df: DataFrame, item_id: str = "external_id") -> tuple[DataFrame, DataFrame]:
    """(rows with a BIGINT id, rejected rows with the id as it came)."""
    cast = safe_id(F.col(item_id).cast("string"))
    return (
        df.where(cast.isNotNull()).withColumn(item_id, cast),
        df.where(cast.isNull()),
    )


def stance_order(tie_break: str = "external_id") -> list[Column]:
    """By depth, then parent URL, nulls last; the id makes it unique."""
    return [
        F.asc_nulls_last("reply_depth"),
        F.asc_nulls_last("PARENT_URL"),
        F.asc_nulls_last(tie_break),
    ]


def with_batch(numbered: DataFrame, size: int) -> DataFrame:
    """``batch_id``: fixed-size chunks of the dense number ``rn``."""
    return numbered.withColumn("batch_id", F.expr(f"rn div {int(size)}"))


def parent_runs(
    batched: DataFrame, parent: str = "PARENT_content", null_text: str | None = "nan"
) -> DataFrame:
    """Flag the first row of every run of equal parent text inside a batch."""
    w = Window.partitionBy("batch_id").orderBy("rn")
    text = prompt_text(F.col(parent), null_text)
    return batched.withColumn("parent_text", text).withColumn(
        "run_start", ~F.col("parent_text").eqNullSafe(F.lag("parent_text").over(w))
        | (F.row_number().over(w) == 1)
    )


def batch_ids(batched: DataFrame, item_id: str = "external_id") -> DataFrame:
    """Per batch: its ids in order, and the distinct ones."""
    return (
        batched.groupBy("batch_id")
        .agg(F.array_sort(F.collect_list(F.struct("rn", item_id))).alias("_items"))
        .select("batch_id", F.col(f"_items.{item_id}").alias("ids"))
        .withColumn("distinct_ids", F.array_distinct("ids"))
    )


def _packed(pieces: DataFrame, item_id: str) -> DataFrame:
    """Concatenate the pieces of each batch in row order.

    A group is one batch, 20 or 25 rows, however the data are skewed.
    """
    return (
        pieces.groupBy("batch_id")
        .agg(F.array_sort(F.collect_list(F.struct("rn", item_id, "piece"))).alias("_items"))
        .select(
            "batch_id",
            F.col(f"_items.{item_id}").alias("ids"),
            F.array_join("_items.piece", "").alias("body"),
        )
    )


def argument_requests(
    batched: DataFrame,
    user_template: str = ARGUMENT_USER,
    tasks: int | None = None,
    item_id: str = "external_id",
    text: str = "content",
    null_text: str | None = "nan",
) -> DataFrame:
    """(batch_id, ids, prompt): the item lines of a batch in the user template."""
    pieces = _dealt(batched, tasks).select(
        "batch_id",
        "rn",
        item_id,
        item_line(F.col(item_id), prompt_text(F.col(text), null_text)).alias("piece"),
    )
    return _packed(pieces, item_id).select(
        "batch_id", "ids", fill(user_template, F.col("body")).alias("prompt")
    )


def stance_requests(
    batched: DataFrame,
    user_template: str = STANCE_USER,
    tasks: int | None = None,
    item_id: str = "external_id",
    text: str = "content",
    parent: str = "PARENT_content",
    null_text: str | None = "nan",
) -> DataFrame:
    """(batch_id, ids, prompt): replies grouped under their parent's text.

    A parent is named once per run; the brackets are a fixed format.
    """
    runs = parent_runs(_dealt(batched, tasks), parent, null_text)
    first_in_batch = F.row_number().over(Window.partitionBy("batch_id").orderBy("rn")) == 1
    opening = F.concat(F.lit('[Tweet: "'), "parent_text", F.lit('", Replies: [\n'))
    pieces = runs.withColumn("_first", first_in_batch).select(
        "batch_id",
        "rn",
        item_id,
        F.concat(
            F.when(F.col("run_start") & ~F.col("_first"), F.lit("]],\n")).otherwise(""),
            F.when(F.col("run_start"), opening).otherwise(""),
            item_line(F.col(item_id), prompt_text(F.col(text), null_text)),
        ).alias("piece"),
    )
    body = F.concat(F.lit("["), "body", F.lit("]]]"))
    return _packed(pieces, item_id).select(
        "batch_id", "ids", fill(user_template, body).alias("prompt")
    )


def _dealt(batched: DataFrame, tasks: int | None) -> DataFrame:
    """Deal whole batches to a set number of tasks.

    Run detection, packing and the model call then share this one shuffle, and
    AQE, which would merge small partitions by bytes, cannot put thousands of
    slow model calls into one task.
    """
    return batched if tasks is None else batched.repartition(tasks, "batch_id")
