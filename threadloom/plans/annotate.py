"""Annotation jobs: argument mining on posts, stance detection on replies."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from threadloom.operators import batching, threads
from threadloom.operators.annotation import Calls, ModelFactory, call_model, stored_answers
from threadloom.operators.extraction import attach, extract
from threadloom.operators.numbering import number_stored
from threadloom.operators.skew import lookup_join
from threadloom.session import store
from threadloom.templates import (
    ARGUMENT_SYSTEM,
    ARGUMENT_USER,
    STANCE_SYSTEM,
    STANCE_USER,
    STRATEGIES,
)

# Model calls per task: what a lost task has to repeat.
REQUESTS_PER_TASK = 50
# Tasks of one Spark job; a larger run is a series of jobs that each store answers.
TASKS_PER_JOB = 20_000


def task_count(n_rows: int, batch_size: int, requests_per_task: int = REQUESTS_PER_TASK) -> int:
    requests = math.ceil(n_rows / batch_size)
    return max(1, math.ceil(requests / requests_per_task))


def prepare_stances(replies: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """Collected reply rows -> input of ``stance_detect``.

    Adds depth and the direct parent's URL and text and renames the columns.
    ``posts`` (external_id, url, content) are the threads' opening posts, when
    they are not among the replies; they serve as parents only. Both are read
    several times, a few columns each: pass tables, not costly frames.
    """
    columns = ["id", "in_reply_to_id", "url", "content"]
    nodes = replies.select(*columns, F.lit(True).alias("_reply"))
    if posts is not None:
        openings = posts.select(
            F.col("external_id").alias("id"),
            F.lit(None).cast("bigint").alias("in_reply_to_id"),
            "url",
            "content",
            F.lit(False).alias("_reply"),
        )
        nodes = nodes.unionByName(openings)
    depths = threads.thread_depth(nodes).select("id", F.col("reply_depth").cast("int"))
    linked = threads.link_parents(nodes).where("_reply").drop("_reply")
    return threads.rename_for_annotation(linked.join(depths, "id", "left"))


def answered_items(
    spark: SparkSession, responses_path: str, run_id: str | None, mode: str = "strict"
) -> DataFrame:
    """(external_id, _known): one stored result per item of an earlier run."""
    return (
        extract(stored_answers(spark, responses_path, run_id), mode)
        .where(F.col("result").isNotNull() & F.col("id").isNotNull())
        .groupBy(F.col("id").alias("external_id"))
        .agg(F.min(F.struct("batch_id", "pos", "result"))["result"].alias("_known"))
    )


def _annotate(
    df: DataFrame,
    wanted: Column,
    order_by: Sequence[str | Column],
    size: int,
    requests_of: Callable[..., DataFrame],
    user_template: str,
    system_prompt: str,
    model: ModelFactory | str | Column,
    result: str,
    mode: str,
    texts: Sequence[str],
    null_text: str | None,
    carry_rest: bool,
    run_id: str | None,
    responses_path: str | None,
    requests_per_task: int,
    parallelism: int | None,
    models: Mapping[str, ModelFactory] | None,
    calls: Calls,
) -> DataFrame:
    if model is None:
        raise ValueError("a model factory is needed")
    named = isinstance(model, (str, Column))
    if named and models is None:
        raise ValueError("a model's name needs the mapping ``models``")
    name_of = F.lit(model) if isinstance(model, str) else model
    if df.schema["external_id"].dataType != T.LongType():
        raise TypeError("external_id must be BIGINT; see batching.split_ids")
    sendable = F.col("external_id").isNotNull()
    if null_text is None:
        for text in texts:
            sendable &= F.col(text).isNotNull()
    chosen = F.coalesce(wanted & sendable, F.lit(False))
    if responses_path is not None:
        # What an earlier run of this id got for an item is not asked again.
        known = answered_items(df.sparkSession, responses_path, run_id, mode)
        known = store(known, "known")
        df = lookup_join(df, known, "external_id", spread_by=texts).withColumn(
            result, F.when(chosen, F.coalesce("_known", F.col(result))).otherwise(F.col(result))
        )
        chosen = chosen & F.col("_known").isNull()
        frame = df.withColumn("_chosen", chosen).drop("_known")
        df, chosen = frame, F.col("_chosen")
    if carry_rest:
        # Few rows stay behind: they are stored after the others, and ``df``,
        # which may hold a wide join, is computed once.
        stored = number_stored(df.withColumn("_sent", chosen), [F.desc("_sent"), *order_by])
        n_rows = stored.stored.where("_sent").count()
        rest = stored.plain().where(~F.col("_sent")).select(df.columns)
    else:
        # Many rows may be done already: they are only filtered, not moved.
        stored = number_stored(df.where(chosen), order_by)
        n_rows = stored.rows
        rest = df.where(~chosen)
    per_job = TASKS_PER_JOB * requests_per_task
    responses = None
    for first in range(0, max(1, math.ceil(n_rows / size)), per_job):
        # A job reads only the ranges of the stored table that its batches lie in.
        last = min(n_rows, (first + per_job) * size)
        requests = requests_of(
            batching.with_batch(stored.numbered(first * size, last), size),
            user_template=user_template,
            tasks=max(task_count(last - first * size, size, requests_per_task), parallelism or 1),
            null_text=null_text,
        )
        if named:
            requests = requests.withColumn("model", name_of)
        answers = call_model(requests, models if named else model, system_prompt, run_id, responses_path, calls)
        responses = answers if responses is None else responses.unionByName(answers)
    numbered = stored.numbered(0, n_rows).drop("_sent")
    done = attach(numbered, extract(responses, mode), size, result).drop("rn")
    return done.unionByName(rest).drop("_chosen")


def argument_mine(
    df: DataFrame,
    prompting_method: str = "AM_Shots_CoT",
    model: ModelFactory | str | Column | None = None,
    order_by: Sequence[str | Column] = ("external_id",),
    mode: str = "strict",
    null_text: str | None = None,
    user_template: str = ARGUMENT_USER,
    system_template: str = ARGUMENT_SYSTEM,
    strategies: dict[str, str] = STRATEGIES,
    run_id: str | None = None,
    responses_path: str | None = None,
    requests_per_task: int = REQUESTS_PER_TASK,
    parallelism: int | None = None,
    models: Mapping[str, ModelFactory] | None = None,
    calls: Calls = Calls(),
) -> DataFrame:
    """``df`` with AM_output filled for the posts that had none.

    Runs the model at once (answers are stored), the rest when read. Rows with
    a null id, or null text unless ``null_text`` names it, keep their null.
    ``order_by`` must order the rows uniquely; it stands for the row order.

    ``model`` is a factory, or with ``models`` a name in that mapping, or a column
    over ``batch_id`` that names the model of each batch; a batch whose name is
    unknown fails. ``calls`` says how many requests a task has under way and how
    often one that fails is tried.
    """
    df = batching.with_result_column(df, "AM_output")
    return _annotate(
        df,
        batching.is_pending("AM_output"),
        order_by,
        batching.ARGUMENT_BATCH,
        batching.argument_requests,
        user_template,
        system_template.replace("{}", strategies[prompting_method]),
        model,
        "AM_output",
        mode,
        ["content"],
        null_text,
        False,
        run_id,
        responses_path,
        requests_per_task,
        parallelism,
        models,
        calls,
    )


def stance_detect(
    df: DataFrame,
    prompting_method: str = "SD_Shots_CoT",
    model: ModelFactory | str | Column | None = None,
    only_missing: bool = False,
    mode: str = "strict",
    null_text: str | None = None,
    user_template: str = STANCE_USER,
    system_template: str = STANCE_SYSTEM,
    strategies: dict[str, str] = STRATEGIES,
    tie_break: str = "external_id",
    run_id: str | None = None,
    responses_path: str | None = None,
    requests_per_task: int = REQUESTS_PER_TASK,
    parallelism: int | None = None,
    models: Mapping[str, ModelFactory] | None = None,
    calls: Calls = Calls(),
) -> DataFrame:
    """``df`` with SD_output: the stance of each reply to its parent's text.

    All replies are annotated, those with a result again, unless
    ``only_missing``. Replies are sent by depth and parent URL, so that a
    parent's text is sent once per run of its replies. A reply whose own or
    parent's text is null is not sent unless ``null_text`` names it. ``model``,
    ``models`` and ``calls`` are those of ``argument_mine``.
    """
    df = batching.with_result_column(df, "SD_output")
    return _annotate(
        df,
        batching.is_pending("SD_output") if only_missing else F.lit(True),
        batching.stance_order(tie_break),
        batching.STANCE_BATCH,
        batching.stance_requests,
        user_template,
        system_template.replace("{}", strategies[prompting_method]),
        model,
        "SD_output",
        mode,
        ["content", "PARENT_content"],
        null_text,
        not only_missing,
        run_id,
        responses_path,
        requests_per_task,
        parallelism,
        models,
        calls,
    )
