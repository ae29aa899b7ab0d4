"""Streams give what the batch jobs give, in one go, piecemeal and after restarts."""

import pytest
from pyspark.sql import functions as F

from threadloom.bindings import stub, tables
from threadloom.operators import threads
from threadloom.operators.skew import lookup_join
from threadloom.plans.annotate import stance_detect
from threadloom.streaming import jobs


@pytest.fixture(scope="module")
def conversations(spark, small):
    return tables.table(spark, small, "conversations")


def test_append_stream_carries_on_after_restart(spark, tmp_path, conversations):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = jobs.landed_stream(spark, landed, conversations.schema, max_files_per_trigger=1)
        rows = tables.as_replies(stream)
        jobs.append_stream(rows, out, state).awaitTermination()
        return spark.read.parquet(out).count()

    even, odd = (conversations.where(F.col("conv_id") % 2 == k) for k in (0, 1))
    even.repartition(3).write.mode("append").parquet(landed)
    assert run() == even.count()
    assert run() == even.count()
    odd.repartition(2).write.mode("append").parquet(landed)
    assert run() == conversations.count()
    assert spark.read.parquet(out).select("id").distinct().count() == conversations.count()


def test_first_seen_drops_repeats_across_files(spark, tmp_path, conversations):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for _ in range(2):
        conversations.coalesce(1).write.mode("append").parquet(landed)
    stream = jobs.landed_stream(spark, landed, conversations.schema, max_files_per_trigger=1)
    rows = tables.as_replies(stream).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    jobs.append_stream(jobs.first_seen(rows, ["id"], "created_at"), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == conversations.count()


def aged(conversations, days, where="true"):
    """Replies of some threads, all so many days older."""
    return tables.as_replies(conversations.where(where)).withColumn(
        "created_at", F.col("created_at").cast("timestamp") - F.expr(f"INTERVAL {days} DAYS")
    )


def test_first_seen_keeps_unseen_rows_of_any_age(spark, tmp_path, conversations):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = aged(conversations, 0).schema

    def run(rows):
        rows.coalesce(1).write.mode("append").parquet(landed)
        stream = jobs.landed_stream(spark, landed, schema, max_files_per_trigger=1)
        fresh = jobs.first_seen(stream, ["id"], "created_at")
        jobs.append_stream(fresh, out, state).awaitTermination()
        return sorted(r.id for r in spark.read.schema(fresh.schema).parquet(out).collect())

    run(aged(conversations, 0, "conv_id % 2 = 0"))
    want = sorted(r.id for r in aged(conversations, 0).collect())
    # Older threads land in one more file, after a restart, with rows seen before.
    assert run(aged(conversations, 2000)) == want
    assert run(aged(conversations, 4000)) == want


def test_annotate_stream_answers_older_threads_that_land_later(spark, tmp_path, conversations):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = aged(conversations, 0).schema
    for days, where in ((0, "conv_id % 2 = 0"), (2000, "true")):
        aged(conversations, days, where).coalesce(1).write.mode("append").parquet(landed)
        stream = jobs.landed_stream(spark, landed, schema, max_files_per_trigger=1)
        jobs.annotate_stream(
            stream.withColumnRenamed("id", "external_id"),
            lambda batch: batch.withColumn("SD_output", F.lit("x")),
            out, state, "SD_output", event_time="created_at",
        ).awaitTermination()
    assert spark.read.parquet(f"{out}/results").count() == conversations.count()


@pytest.mark.parametrize("event_time", [None, "created_at"])
def test_annotate_stream_answers_each_row_once(spark, tmp_path, conversations, event_time):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    parents = tables.as_replies(conversations).select(
        F.col("id").alias("in_reply_to_id"),
        F.col("url").alias("PARENT_URL"),
        F.col("content").alias("PARENT_content"),
    )

    def annotate(batch):
        linked = lookup_join(batch, parents, "in_reply_to_id", ["external_id"])
        return stance_detect(linked, model=stub.stance_model, null_text="nan")

    def run():
        stream = jobs.landed_stream(spark, landed, conversations.schema, max_files_per_trigger=1)
        rows = tables.as_replies(stream).withColumnRenamed("id", "external_id")
        jobs.annotate_stream(
            rows, annotate, out, state, "SD_output", event_time=event_time
        ).awaitTermination()
        got = jobs.latest_results(spark, out, "SD_output").collect()
        return {r.external_id: r.SD_output for r in got}

    conversations.where("conv_id < 5").coalesce(1).write.mode("append").parquet(landed)
    first = run()
    conversations.coalesce(1).write.mode("append").parquet(landed)
    both = run()
    whole = stance_detect(
        tables.as_replies(conversations)
        .join(parents, "in_reply_to_id", "left")
        .withColumnRenamed("id", "external_id"),
        model=stub.stance_model,
        null_text="nan",
    )
    assert both == {r.external_id: r.SD_output for r in whole.collect()}
    assert first.items() <= both.items()
    assert spark.read.parquet(f"{out}/results").count() == conversations.count()


def test_failed_rows_are_sent_again(spark, tmp_path, conversations):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows_of = lambda: tables.as_replies(
        jobs.landed_stream(spark, landed, conversations.schema)
    ).select(
        F.col("id").alias("external_id"), "content", "reply_depth",
        F.lit("u").alias("PARENT_URL"), F.lit("P").alias("PARENT_content"),
    )

    def failing():
        def call(prompt, system):
            raise TimeoutError

        return call

    def run(model):
        jobs.annotate_stream(
            rows_of(), lambda df: stance_detect(df, model=model), out, state, "SD_output"
        ).awaitTermination()

    conversations.coalesce(1).write.mode("append").parquet(landed)
    run(failing)
    assert jobs.latest_results(spark, out, "SD_output").where("SD_output IS NOT NULL").count() == 0
    # A restart without new files has nothing to do; the open rows are retried.
    run(failing)
    jobs.retry_open(spark, lambda df: stance_detect(df, model=failing), out, "SD_output")
    jobs.retry_open(spark, lambda df: stance_detect(df, model=stub.stance_model), out, "SD_output")
    got = jobs.latest_results(spark, out, "SD_output")
    assert got.count() == got.select("external_id").distinct().count() == conversations.count()
    assert got.where("SD_output IS NULL").count() == 0
    # Nothing is left to ask for.
    jobs.retry_open(spark, lambda df: stance_detect(df, model=failing), out, "SD_output")
    assert jobs.latest_results(spark, out, "SD_output").where("SD_output IS NULL").count() == 0


def test_collect_stream_equals_the_batch_job(spark, tmp_path, small):
    landed, replies, authors, rejects, state = (
        str(tmp_path / n) for n in ("in", "r", "a", "bad", "state")
    )
    pages = tables.reply_pages(spark, small)

    def run():
        stream = jobs.landed_stream(spark, landed, pages.schema, max_files_per_trigger=1)
        jobs.collect_stream(stream, replies, authors, rejects, state).awaitTermination()

    half = F.xxhash64("post_url") % 2 == 0
    broken = spark.createDataFrame([("u", "[{broken")], pages.schema)
    for part in (pages.where(half), pages.where(~half), broken):
        part.repartition(2).write.mode("append").parquet(landed)
        run()
    whole = threads.reply_objects(pages)
    for path, rows in ((replies, threads.reply_rows(whole)), (authors, threads.author_rows(whole))):
        got = spark.read.parquet(path).drop("epoch")
        assert got.columns == rows.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, rows.collect()))
    assert [(r.post_url, r.page) for r in spark.read.parquet(rejects).collect()] == [("u", "[{broken")]


def test_retries_send_the_last_text_and_set_aside_what_cannot_go(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = "external_id long, content string"
    asked = []

    def annotate(df):
        asked.append(sorted(map(tuple, df.select("external_id", "content").collect()), key=str))
        return df.select("external_id", F.lit(None).cast("string").alias("AM_output"))

    # Nothing has landed yet.
    assert jobs.retry_open(spark, annotate, out, "AM_output").collect() == [] and asked == []
    schema = spark.createDataFrame([], rows).schema
    assert jobs.retry_open(spark, annotate, out, "AM_output", schema=schema).collect() == []
    for epoch, landed in enumerate(([(1, "old"), (2, None), (3, "x")], [(1, "new"), (3, "x")], [(4, None)])):
        jobs._annotate_epoch(spark.createDataFrame(landed, rows), annotate, out, epoch, "AM_output", "external_id")
    asked.clear()
    lost = jobs.retry_open(spark, annotate, out, "AM_output", texts=["content"]).collect()
    assert asked == [[(1, "new"), (3, "x")]] and sorted(map(tuple, lost)) == [(2, None), (4, None)]
    # A newer text that lands after a retry wins; what was set aside stays there.
    newer = spark.createDataFrame([(3, "y")], rows)
    jobs._annotate_epoch(newer, annotate, out, 3, "AM_output", "external_id")
    asked.clear()
    assert jobs.retry_open(spark, annotate, out, "AM_output", texts=["content"]).collect() == []
    assert asked == [[(1, "new"), (3, "y")]]
