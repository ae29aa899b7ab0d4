"""Incremental versions of the jobs, as Structured Streaming queries.

All use ``availableNow``: process what has landed since the checkpoint, stop,
and carry on from there next time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from threadloom.operators import threads
from threadloom.session import store


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of the files that arrive in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files is not None:
        reader = reader.option("pathGlobFilter", files)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def append_stream(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append rows as they arrive; the checkpoint makes restarts exact."""
    return (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def first_seen(
    rows: DataFrame, keys: Sequence[str], event_time: str, delay: str = "1 day"
) -> DataFrame:
    """Drop repeats of already seen keys, and nothing else.

    The state is bounded: a key is forgotten once newer files have landed more
    than ``delay`` after it; if it lands again later still, it passes again. The
    watermark stands on the time of the micro-batch, which never runs backwards,
    so a row whose key was not seen is never late, however old its
    ``event_time`` is. That column is only cast to a zoned timestamp.
    """
    landed = "_landed_at"
    while landed in rows.columns:
        landed = f"_{landed}"
    return (
        rows.withColumn(event_time, rows[event_time].cast("timestamp"))
        .withColumn(landed, F.current_timestamp())
        .withWatermark(landed, delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop(landed)
    )


def collect_stream(
    pages: DataFrame, replies_path: str, authors_path: str, rejects_path: str, checkpoint: str
) -> StreamingQuery:
    """Flatten landed pages as they arrive into reply rows and author rows.

    ``pages`` has (post_url, page) as in ``get_comments``. Pages that cannot be
    read go to ``rejects_path`` as they came. Each micro-batch owns one folder
    of every table and replaces it when repeated.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        parsed = threads.parse_pages(batch.withColumn("_raw", F.col("page")))
        parsed = store(parsed, "landed")
        objects = threads.unnest_page(parsed.drop("_raw"))
        rejects = parsed.where(F.col("page").isNull()).select("post_url", F.col("_raw").alias("page"))
        for rows, path in (
            (threads.reply_rows(objects), replies_path),
            (threads.author_rows(objects), authors_path),
            (rejects, rejects_path),
        ):
            rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (
        pages.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _result_schema(result: str, item_id: str) -> T.StructType:
    return T.StructType(
        [T.StructField(item_id, T.LongType()), T.StructField(result, T.StringType())]
    )


def _table_at(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of folders ``epoch=...``, made if it is not there."""
    by_epoch = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
    spark.createDataFrame([], by_epoch).write.mode("append").partitionBy("epoch").parquet(path)
    return spark.read.schema(by_epoch).parquet(path)


def latest_results(
    spark: SparkSession, results_path: str, result: str, item_id: str = "external_id"
) -> DataFrame:
    """One row per item: its latest result that is not empty, else null."""
    rows = _table_at(spark, f"{results_path}/results", _result_schema(result, item_id))
    filled = F.when(F.col(result) != "", F.col(result))
    return rows.groupBy(item_id).agg(
        F.max(F.when(filled.isNotNull(), F.struct(F.col("epoch"), filled.alias("value"))))["value"]
        .alias(result)
    )


def _annotate_epoch(
    fresh: DataFrame,
    annotate: Callable[[DataFrame], DataFrame],
    results_path: str,
    epoch: int,
    result: str,
    item_id: str,
) -> None:
    """Results of one epoch, and the rows that got none, each in a folder it replaces."""
    spark = fresh.sparkSession
    fresh.write.mode("overwrite").parquet(f"{results_path}/sent/epoch={epoch}")
    sent = spark.read.schema(fresh.schema).parquet(f"{results_path}/sent/epoch={epoch}")
    annotate(sent).select(item_id, result).write.mode("overwrite").parquet(
        f"{results_path}/results/epoch={epoch}"
    )
    done = spark.read.schema(_result_schema(result, item_id)).parquet(
        f"{results_path}/results/epoch={epoch}"
    ).where(F.col(result).isNotNull() & (F.col(result) != ""))
    sent.join(done, item_id, "left_anti").write.mode("overwrite").parquet(
        f"{results_path}/open/epoch={epoch}"
    )


def open_rows(
    spark: SparkSession,
    results_path: str,
    result: str,
    schema: T.StructType,
    item_id: str = "external_id",
) -> DataFrame:
    """One row per item that no epoch has answered: the one that landed last.

    What retries left open are copies of rows that the stream left open, so only
    the stream's epochs are read. Of several rows of one epoch that of the largest
    hash stays. Empty before anything landed.
    """
    rows = _table_at(spark, f"{results_path}/open", schema).where("epoch >= 0")
    answered = latest_results(spark, results_path, result, item_id).where(F.col(result).isNotNull())
    rank = F.struct(F.col("epoch"), F.xxhash64(*schema.names).alias("hash"))
    last = rows.groupBy(item_id).agg(F.max(rank).alias("_last"))
    kept = rows.withColumn("_rank", rank).join(last.where(F.col(item_id).isNotNull()), item_id)
    return (
        kept.where(F.col("_rank") == F.col("_last"))
        .drop("_rank", "_last", "epoch")
        .join(answered, item_id, "left_anti")
        .dropDuplicates([item_id])
        .select(schema.names)
    )


def retry_open(
    spark: SparkSession,
    annotate: Callable[[DataFrame], DataFrame],
    results_path: str,
    result: str,
    item_id: str = "external_id",
    schema: T.StructType | None = None,
    texts: Sequence[str] = (),
) -> DataFrame:
    """Send the rows again that no epoch has answered, whether new files came or not.

    Retries are epochs below zero, counted down, so they never meet a stream's. An
    item that landed with several texts is sent with its last. ``schema`` is that of
    the stream's rows; without it, it is read from the open rows, if there are any.
    Rows whose ``texts`` hold a null can never be sent: they go to
    ``unsendable/epoch=...`` once, are not open any more, and come back from here.
    """
    if schema is None:
        try:
            found = spark.read.option("mergeSchema", "true").parquet(f"{results_path}/open").schema
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return spark.createDataFrame([], T.StructType([T.StructField(item_id, T.LongType())]))
        schema = T.StructType([field for field in found if field.name != "epoch"])
    epochs = _table_at(spark, f"{results_path}/results", _result_schema(result, item_id))
    lowest = epochs.agg(F.min("epoch")).first()[0]
    epoch = min(0, lowest if lowest is not None else 0) - 1
    given_up = _table_at(spark, f"{results_path}/unsendable", schema).select(item_id)
    still_open = store(
        open_rows(spark, results_path, result, schema, item_id).join(given_up, item_id, "left_anti"), "open"
    )
    lost = F.lit(False)
    for text in texts:
        lost = lost | F.col(text).isNull()
    still_open.where(lost).write.mode("overwrite").parquet(f"{results_path}/unsendable/epoch={epoch}")
    _annotate_epoch(still_open.where(~lost), annotate, results_path, epoch, result, item_id)
    return spark.read.schema(schema).parquet(f"{results_path}/unsendable/epoch={epoch}")


def annotate_stream(
    rows: DataFrame,
    annotate: Callable[[DataFrame], DataFrame],
    results_path: str,
    checkpoint: str,
    result: str,
    item_id: str = "external_id",
    event_time: str | None = None,
    delay: str = "1 day",
) -> StreamingQuery:
    """Annotate each micro-batch's rows; rows without an answer stay open.

    ``annotate`` is a job on a DataFrame, such as ``stance_detect`` with its
    model bound. A micro-batch owns one folder of ``results``, ``sent`` and
    ``open`` under ``results_path`` and replaces it when repeated, so a restart
    neither loses nor doubles results. Open rows are sent again by
    ``retry_open``; ``latest_results`` has one row per item.

    Items that land again are not sent again: with ``event_time`` by bounded
    state (see ``first_seen``), without it by the ids of all earlier answers,
    which a micro-batch then reads.
    """
    if event_time is not None:
        rows = first_seen(rows, [item_id], event_time, delay)

    def run(batch: DataFrame, epoch: int) -> None:
        if event_time is None:
            earlier = _table_at(
                batch.sparkSession, f"{results_path}/results", _result_schema(result, item_id)
            )
            answered = earlier.where((F.col("epoch") != epoch) & (F.col(result) != ""))
            batch = batch.join(answered.select(item_id), item_id, "left_anti")
        _annotate_epoch(batch, annotate, results_path, epoch, result, item_id)

    return (
        rows.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
