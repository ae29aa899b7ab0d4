"""The given tables seen as posts, replies, authors and logs.

Each view is a projection or join of whole tables; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.operators import threads
from threadloom.operators.progress import merge_logs

SITE = "https://social.example/posts/"
EPOCH = 1_704_067_200
TURNS_PER_PAGE = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def post_url(post_id: Column) -> Column:
    """Fixed-width id in the URL: string order is id order."""
    return F.concat(F.lit(SITE), F.lpad(post_id.cast("string"), 18, "0"))


def as_replies(conversations: DataFrame) -> DataFrame:
    post_id = F.col("conv_id") * 1000 + F.col("turn")
    return conversations.select(
        post_id.alias("id"),
        F.when(F.col("turn") > 0, post_id - 1).alias("in_reply_to_id"),
        (F.col("conv_id") * 1000).alias("root_id"),
        F.col("turn").alias("reply_depth"),
        post_url(post_id).alias("url"),
        F.col("text").alias("content"),
        F.col("role").alias("username"),
        F.timestamp_seconds(F.lit(EPOCH) + post_id).alias("created_at"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation; turn 0 is the post, the rest its replies."""
    return as_replies(table(spark, sf_dir, "conversations"))


def answers_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("id") != F.col("root_id"))


def thread_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The opening post of every conversation."""
    return replies(spark, sf_dir).where(F.col("id") == F.col("root_id"))


def reply_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages: JSON lists of at most TURNS_PER_PAGE nested reply objects."""
    rows = answers_only(replies(spark, sf_dir))
    role = F.col("username")
    account = F.struct(
        F.concat(F.lit("account-"), role).alias("id"),
        role.alias("username"),
        F.concat(F.lit("https://social.example/@"), role).alias("url"),
        F.concat(F.lit('<p>I am "'), role, F.lit('"</p>')).alias("note"),
        (F.col("root_id") / 1000).cast("bigint").alias("followers_count"),
        F.col("reply_depth").alias("following_count"),
        F.lit("2024-01-01T00:00:00.000Z").alias("created_at"),
        (role == "system").alias("bot"),
        (role == "assistant").alias("verified"),
        F.lit("left out").alias("display_name"),
    )
    mention = F.struct(
        F.col("in_reply_to_id").cast("string").alias("id"), F.lit("parent").alias("username")
    )
    reply = F.struct(
        F.col("id").cast("string").alias("id"),
        F.col("in_reply_to_id").cast("string").alias("in_reply_to_id"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
        F.col("url"),
        F.col("content"),
        F.col("reply_depth").alias("replies_count"),
        F.char_length("content").cast("bigint").alias("favourites_count"),
        (role == "system").alias("sensitive"),
        F.array(mention).alias("mentions"),
        account.alias("account"),
        F.lit(True).alias("pinned"),
    )
    page = F.expr(f"reply_depth div {TURNS_PER_PAGE}").alias("page_no")
    return (
        rows.groupBy("root_id", page)
        .agg(F.to_json(F.collect_list(reply)).alias("page"))
        .select(post_url(F.col("root_id")).alias("post_url"), "page")
    )


def reply_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.reply_objects(reply_pages(spark, sf_dir))


def documents_as_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row"),
        post_url(F.col("doc_id") * 1000).alias("url"),
        (F.col("doc_id") * 1000).alias("root_id"),
        F.col("text").alias("content"),
        "lang",
        F.col("source").alias("file"),
        "n_chars",
    )


def argument_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the results so far: labelled good ones are done."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").alias("external_id"),
            F.col("text").alias("content"),
            F.when(F.col("quality") == 1, "argumentative")
            .when(F.col("quality") == 0, "")
            .alias("AM_output"),
        )
    )


def stance_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns with the turn they answer; openings have no parent."""
    return threads.link_parents(replies(spark, sf_dir)).select(
        F.col("id").alias("external_id"), "content", "reply_depth", "PARENT_URL", "PARENT_content"
    )


def log_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five shard logs: four consecutive events are the lines of one row."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.expr("event_id div 4").alias("row"),
        F.struct(
            F.expr("event_id % 5").alias("file_rank"), F.col("event_id").alias("pos")
        ).alias("order"),
        F.when(kind == "error", 0).when(kind == "purchase", 1).alias("scraped"),
        F.when(kind == "error", "no answer")
        .when(kind.isin("purchase", "click"), F.get_json_object("props", "$.k"))
        .alias("output"),
    )


def merged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_logs(log_parts(spark, sf_dir), "order")
