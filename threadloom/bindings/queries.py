"""One query per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom import schemas
from threadloom.bindings import stub, tables
from threadloom.functions.text import (
    argument_label,
    fill,
    item_line,
    prompt_text,
    stance_label,
    system_prompt,
    url_tail,
)
from threadloom.operators import batching, combine, progress, rejects, threads
from threadloom.operators.annotation import Calls, call_model
from threadloom.operators.extraction import extract
from threadloom.operators.numbering import number_rows
from threadloom.operators.skew import lookup_join
from threadloom.plans import collect
from threadloom.plans.annotate import argument_mine, stance_detect
from threadloom.plans.annotate import prepare_stances as prepare
from threadloom.session import runtime_conf, scratch_path, store
from threadloom.sources import manifest
from threadloom.sources.readers import read_csv, read_table
from threadloom.sources.writers import append_results, append_rows, result_projection
from threadloom.streaming import jobs, keyed
from threadloom.templates import ARGUMENT_SYSTEM, ARGUMENT_USER, STANCE_SYSTEM, STRATEGIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return run


# --- scans and sinks -------------------------------------------------------


@query
def scan_posts(spark, d):
    """Posts landed as Parquet, read with an explicit schema."""
    landed = scratch_path(spark, "posts")
    append_rows(tables.documents_as_posts(spark, d), landed)
    schema = schemas._struct(row=schemas.L, url=schemas.S, content=schemas.S, file=schemas.S, n_chars=schemas.L)
    return read_table(spark, landed, schema)


@query
def scan_typed(spark, d):
    landed = scratch_path(spark, "typed")
    stance = tables.replies(spark, d).select(
        F.col("id").cast("string").alias("external_id"), "content", "reply_depth"
    )
    append_rows(stance, landed, "json")
    typed = read_table(spark, landed, schemas.ANNOTATION_INPUT, "json")
    return typed.select("external_id", "content", F.col("reply_depth").cast("bigint"))


@query
def snapshot_commit(spark, d):
    """A snapshot, a write that dies before its commit, a new snapshot, one run added twice."""
    rows = tables.documents_as_posts(spark, d).select("row", "content", "file")
    path = scratch_path(spark, "snapshot")
    manifest.publish(rows.where("row % 2 = 0"), path, replace=True)
    rows.write.parquet(f"{path}/data/lost")
    manifest.publish(rows, path, replace=True)
    for _ in range(2):
        manifest.publish(rows.withColumn("row", -F.col("row")), path, run_id="r1")
    return manifest.read_published(spark, path, rows.schema)


@query
def scan_files_union(spark, d):
    """CSV files with two column orders, one without ``lang``, read back by name."""
    docs = tables.documents_as_posts(spark, d)
    landed = scratch_path(spark, "union")
    short = F.length("file") == 4
    append_rows(docs.where(short).select("row", "content", "lang", "file"), f"{landed}/a", "csv")
    append_rows(docs.where(~short).select("file", "row", "content"), f"{landed}/b", "csv")
    schema = schemas._struct(row=schemas.L, content=schemas.S, lang=schemas.S, file=schemas.S)
    return read_csv(spark, f"{landed}/*/*.csv", schema)


@query
def scan_csv_blocks(spark, d):
    """The same files, each read by as many tasks as it has blocks."""
    docs = tables.documents_as_posts(spark, d)
    landed = scratch_path(spark, "blocks")
    short = F.length("file") == 4
    append_rows(docs.where(short).select("row", "content", "lang", "file"), f"{landed}/a", "csv")
    append_rows(docs.where(~short).select("file", "row", "content"), f"{landed}/b", "csv")
    schema = schemas._struct(row=schemas.L, content=schemas.S, lang=schemas.S, file=schemas.S)
    with runtime_conf(spark, spark__sql__files__maxPartitionBytes="1m"):
        return store(read_csv(spark, f"{landed}/*/*.csv", schema, splittable=True), "read")


@query
def annotation_file(spark, d):
    """Results appended run by run, read back as one table."""
    landed = scratch_path(spark, "annotations")
    frame = tables.argument_frame(spark, d)
    pending = batching.pending_arguments(frame)
    append_results(result_projection(pending.fillna("", ["AM_output"]), "AM_output"), landed, "r1")
    done = frame.join(pending.select("external_id"), "external_id", "left_anti")
    append_results(result_projection(done, "AM_output"), landed, "r2")
    return spark.read.schema("external_id BIGINT, AM_output STRING, run_id STRING").parquet(landed)


# --- projections -----------------------------------------------------------


@query
def flatten_replies(spark, d):
    rows = threads.reply_rows(tables.reply_objects(spark, d))
    return rows.select(
        "id",
        "in_reply_to_id",
        F.unix_seconds("created_at").alias("created_at"),
        F.unix_seconds("edited_at").alias("edited_at"),
        "url",
        "replies_count",
        "favourites_count",
        "content",
        "sensitive",
        F.col("mentions")[0]["id"].alias("first_mention"),
        F.size("mentions").cast("bigint").alias("n_mentions"),
        F.col("card.url").alias("card_url"),
        "PARENT_ID",
    )


@query
def flatten_authors(spark, d):
    authors = threads.author_rows(tables.reply_objects(spark, d))
    return authors.withColumn("created_at", F.unix_seconds("created_at"))


@query
def nested_to_json(spark, d):
    rows = threads.nested_as_json(threads.reply_rows(tables.reply_objects(spark, d)))
    return rows.select("id", "mentions", "tags", "card", "PARENT_ID")


@query
def json_field(spark, d):
    return tables.table(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )


@query
def url_tail_(spark, d):
    return tables.table(spark, d, "pages").select("page_id", url_tail(F.col("url")).alias("tail"))


@query
def id_cast(spark, d):
    """Rows whose URL ends in an id, and the rejected ones, told apart."""
    pages = tables.table(spark, d, "pages").select(
        "page_id", url_tail(F.col("url")).alias("external_id")
    )
    good, bad = batching.split_ids(pages)
    return good.select("page_id", "external_id", F.lit(True).alias("valid")).unionByName(
        bad.select(
            "page_id", F.lit(None).cast("bigint").alias("external_id"), F.lit(False).alias("valid")
        )
    )


@query
def renamed_replies(spark, d):
    rows = threads.reply_rows(tables.reply_objects(spark, d))
    return threads.rename_for_annotation(rows).select("external_id", "reply_count", "like_count")


@query
def prepare_stances(spark, d):
    """Collected replies and the opening posts -> depth and parent of each reply."""
    opening = tables.thread_posts(spark, d).withColumnRenamed("id", "external_id")
    once = threads.reply_rows(tables.reply_objects(spark, d))
    landed = store(once.unionByName(once), "landed")
    return prepare(landed, opening).select(
        "external_id",
        "content",
        F.col("reply_depth").cast("bigint").alias("reply_depth"),
        "PARENT_URL",
        "PARENT_content",
    )


@query
def prompt_lines(spark, d):
    docs = tables.table(spark, d, "documents")
    return docs.select(
        "doc_id", item_line(F.col("doc_id"), prompt_text(F.col("text"))).alias("line")
    )


@query
def prompt_template(spark, d):
    docs = tables.table(spark, d, "documents")
    return docs.select("doc_id", fill(ARGUMENT_USER, prompt_text(F.col("text"))).alias("prompt"))


@query
def strategy_join(spark, d):
    lang = F.col("lang")
    docs = tables.table(spark, d, "documents").select(
        "doc_id",
        F.when(lang == "en", "AM_Shots").when(lang == "de", "AM_CoT")
        .when(lang == "fr", "AM_Shots_CoT").otherwise("SD_Shots_CoT").alias("strategy"),
    )
    prompt = system_prompt(F.col("strategy"), ARGUMENT_SYSTEM)
    return docs.select("doc_id", "strategy", prompt.alias("system_prompt"))


# --- filters, progress, logs -----------------------------------------------


@query
def am_pending(spark, d):
    return batching.pending_arguments(tables.argument_frame(spark, d)).select("external_id")


@query
def sd_pending(spark, d):
    """All replies, then only those the argument step gave no result."""
    frame = tables.argument_frame(spark, d).withColumnRenamed("AM_output", "SD_output")
    everything = batching.pending_stances(frame).select("external_id", F.lit("all").alias("rule"))
    missing = batching.pending_stances(frame, only_missing=True)
    return everything.unionByName(missing.select("external_id", F.lit("missing").alias("rule")))


@query
def eligible_counts(spark, d):
    return batching.eligible_counts(tables.argument_frame(spark, d), "AM_output")


@query
def shard_assign(spark, d):
    posts = tables.documents_as_posts(spark, d)
    return progress.with_shard(posts).select("row", F.col("shard").cast("bigint").alias("shard"))


@query
def seeded_order(spark, d):
    posts = tables.documents_as_posts(spark, d).select("row")
    return progress.seeded_order(posts).select("row", "position")


@query
def min_replies(spark, d):
    counted = threads.reply_counts(
        tables.thread_posts(spark, d), tables.answers_only(tables.replies(spark, d))
    ).withColumnRenamed("n_replies", "reply_count")
    return progress.min_replies(counted, 3).select("id", "reply_count")


@query
def pending_posts(spark, d):
    posts = tables.documents_as_posts(spark, d)
    return progress.pending_posts(posts, tables.merged_log(spark, d)).select("row", "url")


@query
def log_update(spark, d):
    counts = threads.reply_counts(
        tables.thread_posts(spark, d), tables.answers_only(tables.replies(spark, d))
    )
    outcomes = counts.select(
        F.expr("root_id div 1000").alias("row"),
        F.lit(1).alias("scraped"),
        "n_replies",
        F.lit(None).cast("string").alias("error"),
    )
    updated = progress.update_log(tables.merged_log(spark, d), progress.outcome_text(outcomes))
    return updated.select("row", F.col("scraped").cast("bigint").alias("scraped"), "output")


@query
def merge_logs(spark, d):
    merged = tables.merged_log(spark, d)
    return merged.select("row", F.col("scraped").cast("bigint").alias("scraped"), "output")


# --- union and duplicates --------------------------------------------------


@query
def file_counts(spark, d):
    return combine.file_counts(tables.documents_as_posts(spark, d))


@query
def dup_count(spark, d):
    return combine.duplicate_stats(tables.documents_as_posts(spark, d), "content")


@query
def dedup_first(spark, d):
    posts = tables.documents_as_posts(spark, d)
    return combine.keep_first(posts, "content", ("file", "row")).select("row", "file", "content")


@query
def combine_threads(spark, d):
    """Landed folders of ordered files, one folder per source, united and deduplicated by text."""
    landed = scratch_path(spark, "parts")
    (
        tables.documents_as_posts(spark, d)
        .select("row", "content", F.col("file").alias("part"))
        .repartitionByRange("part", "row")
        .sortWithinPartitions("part", "row")
        .write.partitionBy("part")
        .parquet(landed)
    )
    schema = schemas._struct(row=schemas.L, content=schemas.S, part=schemas.S)
    combined = collect.combine_threads(spark, landed, schema, key="content")
    folder = F.regexp_extract("file", "part=(\\w+)", 1).alias("file")
    kept = combined.rows.groupBy(folder).agg(F.count(F.lit(1)).alias("n_kept"))
    return (
        combined.per_file.where(F.col("file").isNotNull())
        .groupBy(folder)
        .agg(F.sum("n_rows").alias("n_rows"))
        .join(kept, "file", "left")
        .select("file", "n_rows", F.coalesce("n_kept", F.lit(0).cast("bigint")).alias("n_kept"))
    )


# --- authors ---------------------------------------------------------------


def _customers(spark, d):
    return tables.table(spark, d, "orders").select(F.col("o_custkey").alias("username"))


@query
def distinct_authors(spark, d):
    return threads.distinct_authors(_customers(spark, d))


@query
def author_lookup(spark, d):
    profiles = tables.table(spark, d, "customer").withColumnRenamed("c_custkey", "username")
    return threads.author_lookup(_customers(spark, d), profiles)


@query
def missing_authors(spark, d):
    users = tables.table(spark, d, "orders").select(F.col("o_custkey").alias("username"))
    profiles = tables.table(spark, d, "supplier").withColumnRenamed("s_suppkey", "username")
    return threads.missing_authors(users, profiles)


@query
def collect_authors(spark, d):
    """Profiles of the known customers as author rows, absent fields null."""
    profiles = tables.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("username"),
        F.col("s_nationkey").cast("bigint").alias("followers_count"),
    )
    users = _customers(spark, d).withColumnRenamed("username", "key")
    found, missed = collect.collect_authors(users, profiles, "key")
    return found.groupBy("username", "followers_count", "note").agg(
        F.count(F.lit(1)).alias("n")
    ).unionByName(
        missed.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("not found").alias("username"),
            F.lit(None).cast("bigint").alias("followers_count"),
            F.lit(None).cast("string").alias("note"),
            "n",
        )
    )


# --- threads ---------------------------------------------------------------


@query
def post_replies(spark, d):
    posts = tables.thread_posts(spark, d).select("root_id", F.col("url").alias("post_url"))
    found = threads.thread_replies(posts, tables.answers_only(tables.replies(spark, d)))
    return found.select("post_url", "id", "content")


@query
def reply_counts(spark, d):
    posts = tables.documents_as_posts(spark, d).select("root_id", "row")
    return threads.reply_counts(posts, tables.answers_only(tables.replies(spark, d)))


@query
def direct_replies(spark, d):
    rows = tables.replies(spark, d)
    return threads.direct_replies(rows, F.col("root_id")).select("root_id", "id")


@query
def oldest_n(spark, d):
    rows = tables.answers_only(tables.replies(spark, d))
    return threads.oldest_n(rows, 3).select("root_id", "id", "content")


@query
def pull_replies(spark, d):
    posts = tables.documents_as_posts(spark, d)
    rows = tables.replies(spark, d).drop("url")
    posts, rows = posts.unionByName(posts), rows.unionByName(rows)
    return threads.pull_comments(posts, rows, top_num=2).select("post_url", "id", "content")


@query
def link_parents(spark, d):
    """Every reply landed twice; each counts once."""
    rows = tables.replies(spark, d)
    linked = threads.link_parents(rows.unionByName(rows))
    return linked.select("id", "in_reply_to_id", "PARENT_URL", "PARENT_content")


@query
def thread_depth(spark, d):
    """Every reply landed twice; each counts once."""
    rows = tables.replies(spark, d)
    return threads.thread_depth(rows.unionByName(rows))


@query
def compile_thread(spark, d):
    """Outcomes of all pending posts: reply count, or why there is none."""
    landed = tables.thread_posts(spark, d).select(
        F.col("url").alias("post_url"), F.lit(None).cast("string").alias("error")
    )
    collected = collect.compile_thread(
        tables.documents_as_posts(spark, d),
        tables.merged_log(spark, d),
        tables.reply_pages(spark, d),
        landed,
    )
    return progress.outcome_text(collected.outcomes).withColumn(
        "scraped", F.col("scraped").cast("bigint")
    )


@query
def collected_replies(spark, d):
    """Reply rows of all pending posts, ready for the append sink."""
    landed = tables.thread_posts(spark, d).select(
        F.col("url").alias("post_url"), F.lit(None).cast("string").alias("error")
    )
    collected = collect.compile_thread(
        tables.documents_as_posts(spark, d),
        tables.merged_log(spark, d),
        tables.reply_pages(spark, d),
        landed,
    )
    return collected.replies.select("id", "PARENT_ID", "content")


# --- order, batches, prompts -----------------------------------------------


def _numbered_stances(spark, d):
    return number_rows(tables.stance_frame(spark, d), batching.stance_order())


def _stance_batches(spark, d):
    return batching.with_batch(_numbered_stances(spark, d), batching.STANCE_BATCH)


def _argument_batches(spark, d):
    pending = batching.pending_arguments(tables.argument_frame(spark, d))
    return batching.with_batch(number_rows(pending, ["external_id"]), batching.ARGUMENT_BATCH)


@query
def sd_order(spark, d):
    return _numbered_stances(spark, d).select("external_id", "reply_depth", "PARENT_URL", "rn")


@query
def dense_number(spark, d):
    posts = tables.documents_as_posts(spark, d)
    return number_rows(posts.select("file", "row"), ["file", "row"]).select("file", "row", "rn")


@query
def am_batches(spark, d):
    return _argument_batches(spark, d).select("external_id", "rn", "batch_id")


@query
def sd_batches(spark, d):
    return _stance_batches(spark, d).select("external_id", "rn", "batch_id")


@query
def batch_ids(spark, d):
    ids = batching.batch_ids(_stance_batches(spark, d))
    return ids.select(
        "batch_id",
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        F.size("distinct_ids").cast("bigint").alias("n_ids"),
    )


@query
def sd_runs(spark, d):
    runs = batching.parent_runs(_stance_batches(spark, d))
    return runs.select("batch_id", "rn", "external_id", "run_start")


@query
def am_prompts(spark, d):
    return batching.argument_requests(_argument_batches(spark, d)).select("batch_id", "prompt")


@query
def sd_prompts(spark, d):
    return batching.stance_requests(_stance_batches(spark, d)).select("batch_id", "prompt")


@query
def input_rejects(spark, d):
    """Rejected rows with their reason, and the counts of the same pass (without an id)."""
    linked = threads.link_parents(tables.replies(spark, d)).select(
        F.col("id").alias("external_id"), "content", "PARENT_content",
        F.nullif("username", F.lit("system")).alias("username"),
    )
    rules = rejects.null_rules(id="external_id", text="content", parent="PARENT_content", handle="username")
    split = rejects.split_rejects(linked, rules)
    counted = spark.createDataFrame(list(split.counts.items()), "reason string, n bigint")
    return (
        split.rejected.select("external_id", "reason", F.lit(1).cast("bigint").alias("n"))
        .unionByName(counted.withColumn("external_id", F.lit(None).cast("bigint")))
        .unionByName(
            split.kept.agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(None).cast("bigint").alias("external_id"), F.lit("kept").alias("reason"), "n")
        )
    )


@query
def progress_counts(spark, d):
    """What a run reports: rows done, failed and open, names, authors and null names."""
    names = tables.table(spark, d, "orders").select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("username")
    )
    summaries = [progress.log_summary(tables.merged_log(spark, d)), threads.author_summary(names)]
    long = [one.unpivot([], one.columns, "what", "n") for one in summaries]
    return long[0].unionByName(long[1])


# --- model, answers, labels ------------------------------------------------


def _stance_answers(spark, d):
    requests = batching.stance_requests(_stance_batches(spark, d))
    system = STANCE_SYSTEM.replace("{}", STRATEGIES["SD_CoT"])
    return call_model(requests, stub.stance_model, system)


@query
def extract_compat(spark, d):
    return extract(_stance_answers(spark, d), "compat").select("batch_id", "id", "result")


@query
def extract_strict(spark, d):
    return extract(_stance_answers(spark, d), "strict").select("batch_id", "id", "result")


@query
def extract_nested(spark, d):
    """Answers whose justifications hold brackets, quotes and items of their own."""
    i = F.col("id")
    inner = [
        F.concat(F.lit('FOR because: see ["x'), i, F.lit('"] and more')),
        F.concat(F.lit('AGAINST because: they quote "[id: '), i + 1, F.lit(', annotation: x]" here')),
        F.lit("NEUTRAL because: [sic] and\na new line"),
        F.lit("FOR because: open [ bracket"),
        F.lit("AGAINST because: shut ] bracket"),
    ]
    value = F.get(F.array(*inner), (i % 6).cast("int"))
    item = F.concat(F.lit("[id: "), i, F.lit(', annotation: "'), value, F.lit('"]'))
    answers = (
        tables.replies(spark, d)
        .select(F.expr("id div 20").alias("batch_id"), "id", item.alias("item"))
        .groupBy("batch_id")
        .agg(F.sort_array(F.collect_list(F.struct("id", "item"))).alias("asked"))  # at most 20 ids
        .select(
            "batch_id",
            F.col("asked.id").alias("ids"),
            F.concat(F.lit("["), F.array_join("asked.item", ",\n"), F.lit("]\nThat is all [of them].")).alias("output"),
            F.lit(None).cast("string").alias("error"),
        )
    )
    return extract(answers).select("batch_id", "id", "result")


@query
def am_label(spark, d):
    done = argument_mine(
        tables.argument_frame(spark, d), model=stub.argument_model, null_text="nan"
    )
    return done.select("external_id", argument_label(F.col("AM_output")).alias("AM_label"))


@query
def sd_label(spark, d):
    results = extract(_stance_answers(spark, d))
    return results.select(
        F.col("id").alias("external_id"), stance_label(F.col("result")).alias("SD_label")
    )


@query
def annotate_arguments(spark, d):
    frame = tables.argument_frame(spark, d)
    return argument_mine(frame, model=stub.argument_model).select("external_id", "AM_output")


@query
def annotate_with_failures(spark, d):
    frame = tables.argument_frame(spark, d)
    done = argument_mine(frame, model=stub.failing_argument_model)
    return done.select("external_id", "AM_output")


@query
def routed_arguments(spark, d):
    """Batches in turn to two models and to a name that no model has."""
    name = F.get(F.array(F.lit("full"), F.lit("brief"), F.lit("none")), (F.col("batch_id") % 3).cast("int"))
    models = {"full": stub.argument_model, "brief": stub.brief_argument_model}
    done = argument_mine(tables.argument_frame(spark, d), model=name, models=models, calls=Calls(in_flight=4))
    return done.select("external_id", "AM_output")


@query
def resume_arguments(spark, d):
    """A run in which batches fail, then the same run over the rows that are left.

    The second run asks only for what has no answer; no row stays without one.
    """
    keep = {"run_id": "r", "responses_path": scratch_path(spark, "answers")}
    frame = tables.argument_frame(spark, d)
    first = store(argument_mine(frame, model=stub.failing_argument_model, **keep), "first")
    second = argument_mine(first, model=stub.argument_model, **keep)
    return second.select("external_id", "AM_output")


@query
def reply_rejects(spark, d):
    """Pages that are an error object, hold a null or an element without id: outcome and error."""
    pages = tables.reply_pages(spark, d)
    rows = tables.thread_posts(spark, d).select(
        F.col("url").alias("post_url"), F.expr("root_id div 1000 % 4").alias("kind")
    )
    broken = rows.where("kind > 0").select(
        "post_url",
        F.when(F.col("kind") == 1, F.lit('{"error": "Record not found"}'))
        .when(F.col("kind") == 2, F.lit("[null]"))
        .otherwise(F.lit('[{"content": "no id"}]')).alias("page"),
    )
    good = pages.join(rows.where("kind = 0").select("post_url"), "post_url", "left_semi")
    _, _, counts = collect.get_comments(rows, good.unionByName(broken))
    return counts.select("post_url", "n_replies", "error")


@query
def am_output_projection(spark, d):
    frame = tables.argument_frame(spark, d)
    done = argument_mine(frame, "AM_CoT", stub.argument_model, mode="compat")
    return result_projection(done, "AM_output")


@query
def annotate_stance(spark, d):
    """The whole annotation half: parents, order, batches, model, answers, labels."""
    frame = tables.stance_frame(spark, d)
    done = stance_detect(frame, model=stub.stance_model, null_text="nan")
    return done.select(
        "external_id", "SD_output", stance_label(F.col("SD_output")).alias("SD_label")
    )


# --- streaming -------------------------------------------------------------


# As a pattern it names a table that is one file as well as one that is a folder.
_PARQUET = ".parque[t]"


def _conversation_stream(spark, d):
    schema = tables.table(spark, d, "conversations").schema
    return tables.as_replies(
        jobs.landed_stream(spark, f"{d}/conversations{_PARQUET}", schema)
    )


@query
def stream_replies(spark, d):
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    rows = jobs.first_seen(_conversation_stream(spark, d), ["id"], "created_at")
    jobs.append_stream(rows, out, checkpoint).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out).select("id", "in_reply_to_id", "content")


@query
def stream_collect(spark, d):
    """Pages landed as files, flattened incrementally into replies and authors."""
    landed = scratch_path(spark, "pages")
    pages = tables.reply_pages(spark, d)
    append_rows(pages, landed)
    replies, authors = scratch_path(spark, "stream"), scratch_path(spark, "stream")
    jobs.collect_stream(
        jobs.landed_stream(spark, landed, pages.schema),
        replies,
        authors,
        scratch_path(spark, "rejects"),
        scratch_path(spark, "stream-checkpoint"),
    ).awaitTermination()
    return (
        spark.read.parquet(replies)
        .select("PARENT_ID", F.lit("reply").alias("kind"), F.col("content").alias("name"))
        .unionByName(
            spark.read.parquet(authors).select(
                F.lit(None).cast("string").alias("PARENT_ID"),
                F.lit("author").alias("kind"),
                F.col("username").alias("name"),
            )
        )
    )


@query
def stream_annotate(spark, d):
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    parents = tables.replies(spark, d).select(
        F.col("id").alias("in_reply_to_id"),
        F.col("url").alias("PARENT_URL"),
        F.col("content").alias("PARENT_content"),
    )

    def annotate(batch: DataFrame) -> DataFrame:
        linked = lookup_join(batch, parents, "in_reply_to_id", ["external_id"])
        return stance_detect(linked, model=stub.stance_model, null_text="nan")

    rows = _conversation_stream(spark, d).withColumnRenamed("id", "external_id")
    jobs.annotate_stream(
        rows, annotate, out, checkpoint, "SD_output", event_time="created_at"
    ).awaitTermination()
    return jobs.latest_results(spark, out, "SD_output").select("external_id", "SD_output")


@query
def stream_retry(spark, d):
    """A stream whose model fails for some batches; open rows are sent again without new files."""
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    schema = tables.table(spark, d, "documents").schema
    rows = jobs.landed_stream(spark, f"{d}/documents{_PARQUET}", schema).select(
        F.col("doc_id").alias("external_id"), F.col("text").alias("content")
    )

    def annotate_with(model):
        return lambda batch: argument_mine(batch, model=model, null_text="nan")

    jobs.annotate_stream(
        rows, annotate_with(stub.failing_argument_model), out, checkpoint, "AM_output"
    ).awaitTermination()
    jobs.retry_open(spark, annotate_with(stub.argument_model), out, "AM_output")
    return jobs.latest_results(spark, out, "AM_output").select("external_id", "AM_output")


@query
def stream_items(spark, d):
    """Items in keyed state: a model that fails for some batches, then, by timer alone, one that answers."""
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    schema = tables.table(spark, d, "documents").schema

    def run(model):
        rows = jobs.landed_stream(spark, f"{d}/documents{_PARQUET}", schema).select(
            F.col("doc_id").alias("external_id"), F.col("text").alias("content")
        )
        keyed.annotate_items(
            rows, lambda batch: argument_mine(batch, model=model, null_text="nan"),
            out, checkpoint, "AM_output", retry_after=timedelta(0), skew=timedelta(0),
        ).awaitTermination()

    run(stub.failing_argument_model)
    run(stub.argument_model)
    return jobs.latest_results(spark, out, "AM_output").select("external_id", "AM_output")


@query
def stream_late_parents(spark, d):
    """Replies that land a run before the posts they answer."""
    landed, out, checkpoint = (scratch_path(spark, "stream") for _ in range(3))
    rows = tables.replies(spark, d)
    for half in (F.col("reply_depth") % 2 == 1, F.col("reply_depth") % 2 == 0):
        rows.where(half).write.mode("append").parquet(landed)
        found = keyed.late_parents(jobs.landed_stream(spark, landed, rows.schema))
        sink = found.writeStream.format("parquet").option("path", out)
        keyed.start(sink.option("checkpointLocation", checkpoint), spark).awaitTermination()
    return spark.read.schema(found.schema).parquet(out).select(
        "id", "in_reply_to_id", "PARENT_URL", "PARENT_content"
    )
