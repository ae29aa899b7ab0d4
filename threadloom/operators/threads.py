"""Reply objects, reply trees and author lookup over landed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from threadloom import schemas
from threadloom.functions.text import url_tail
from threadloom.operators.combine import keep_first
from threadloom.operators.skew import lookup_join
from threadloom.session import store

# ISO-8601 as the social API writes it.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSS]X"


def parse_pages(
    pages: DataFrame,
    page: str = "page",
    schema: T.DataType = schemas.REPLY_PAGE,
    error: str | None = None,
) -> DataFrame:
    """JSON text of a page -> list of reply objects; null when not readable.

    A page is readable when it is a JSON list and each of its elements is an
    object with an id; an error object, a null element or a reply without id
    makes the page unreadable as a whole. Absent keys become null and unknown
    keys are dropped, both by the schema. Pages that are lists already are
    checked in the same way. ``error`` names a column for the page's own error
    text, if it is an error object.
    """
    text = isinstance(pages.schema[page].dataType, T.StringType)
    raw = F.col(page)
    parsed = F.from_json(raw, schema, {"timestampFormat": TIMESTAMP_FORMAT}) if text else raw
    whole = F.forall(parsed, lambda reply: reply.isNotNull() & reply["id"].isNotNull() & (reply["id"] != ""))
    if text:
        whole &= F.ltrim(raw).startswith("[")
    columns = {page: F.when(whole, parsed)}
    if error is not None:
        columns[error] = F.get_json_object(raw, "$.error") if text else F.lit(None).cast("string")
    return pages.withColumns(columns)


def unnest_page(pages: DataFrame, page: str = "page") -> DataFrame:
    """Parsed pages -> one row per reply, beside the page's other columns."""
    others = [name for name in pages.columns if name != page]
    return pages.select(*others, F.explode(page).alias("_reply")).select(*others, "_reply.*")


def reply_objects(pages: DataFrame, page: str = "page") -> DataFrame:
    """Pages, as JSON text or parsed -> one nested row per reply."""
    return unnest_page(parse_pages(pages, page), page)


def project_fields(df: DataFrame, fields: T.StructType) -> DataFrame:
    """Exactly ``fields``, in their order and types; absent ones are null.

    Text that is not a value of the wanted type, such as a bad id, gives null.
    """
    present = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if present[field.name] == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in fields.fields])


def add_parent_id(df: DataFrame, post_url: Column) -> DataFrame:
    """PARENT_ID = URL of the post the thread was collected for, null when empty."""
    return df.withColumn("PARENT_ID", F.when(post_url != "", post_url))


def reply_rows(objects: DataFrame, post_url: str = "post_url") -> DataFrame:
    """Reply objects -> flat reply rows with PARENT_ID."""
    return project_fields(add_parent_id(objects, F.col(post_url)), schemas.REPLY_ROW)


def author_rows(objects: DataFrame) -> DataFrame:
    """Embedded accounts -> author rows. Repeats stay; combining drops them."""
    return project_fields(objects.select("account.*"), schemas.AUTHOR_ROW)


def nested_as_json(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as JSON text, for text sinks."""
    return df.select(
        *[
            F.to_json(f.name).alias(f.name)
            if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def rename_for_annotation(replies: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Collector column names -> annotator column names."""
    return replies.withColumnsRenamed(
        names
        or {
            "id": "external_id",
            "replies_count": "reply_count",
            "favourites_count": "like_count",
        }
    )


def direct_replies(replies: DataFrame, post_id: Column, only_first: bool = True) -> DataFrame:
    """Replies to the post itself; all descendants when ``only_first`` is off."""
    return replies.where(F.col("in_reply_to_id") == post_id) if only_first else replies


def one_per_id(rows: DataFrame, key: str = "id") -> DataFrame:
    """One row per non-null ``key``; of different rows always the same one.

    Landed tables repeat rows by design. Rows without a key all stay. The keys that
    repeat are found on two numbers per row and stored with the hash of the row that
    stays, so Spark knows their size; only their rows are shuffled whole, the others
    are filtered where they are.
    """
    digest = F.xxhash64(*[F.col(c) for c in rows.columns])
    repeated = store(
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(digest).alias("_first"))
        .where("_rows > 1")
        .select(key, "_first"),
        "repeated",
    )
    single = rows.join(repeated.select(key), key, "left_anti")
    several = (
        rows.withColumn("_digest", digest)
        .join(repeated, key)
        .where(F.col("_digest") == F.col("_first"))
        .dropDuplicates([key])
    )
    return single.select(rows.columns).unionByName(several.select(rows.columns))


def oldest_n(
    replies: DataFrame,
    n: int | None = 40,
    post: str = "root_id",
    order_by: Sequence[str] = ("created_at", "id"),
    salts: int = 1024,
) -> DataFrame:
    """The ``n`` oldest rows per post, all when ``n`` is None, none below 1.

    Nulls come last. The rows are chosen on narrow columns, per post and salt
    and then per post, so a hot post is thinned in many tasks; only the chosen
    rows are then fetched with all their columns.
    """
    if n is None:
        return replies
    if n < 1:
        return replies.limit(0)
    order = [F.asc_nulls_last(c) for c in order_by]

    def first_rows(df: DataFrame, *keys: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= n).drop("_nth")

    names = list(dict.fromkeys([post, *order_by]))
    narrow = replies.select(*names).withColumn(
        "_salt", F.pmod(F.xxhash64(*order_by), F.lit(salts)).cast("int")
    )
    chosen = first_rows(first_rows(narrow, post, "_salt"), post).select(
        *[F.col(c).alias(f"_{c}") for c in names]
    ).distinct()
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    # Equal rows are all fetched, so they are counted once more.
    return first_rows(replies.join(chosen, match, "left_semi"), post)


def thread_replies(posts: DataFrame, replies: DataFrame, post: str = "root_id") -> DataFrame:
    """Posts joined to their landed descendants.

    ``posts`` has one row per ``post``; its other columns are put beside each
    reply. One viral post does not slow the join down.
    """
    return lookup_join(replies, posts, post, spread_by=["id"], how="inner")


def pull_comments(
    posts: DataFrame,
    replies: DataFrame,
    include_all: bool = False,
    only_first: bool = False,
    top_num: int = 40,
    url: str = "url",
) -> DataFrame:
    """Replies per post: the first ``top_num`` by time, or all of them.

    The post id is the last segment of the post's URL. ``replies`` carries
    ``root_id``, the id of the thread's first post. A post that is listed more
    than once counts once, and so does a reply that landed more than once.
    """
    if top_num < 1:
        return pull_comments(posts, replies, True, only_first, url=url).limit(0)
    keyed = posts.select(
        url_tail(F.col(url)).try_cast("bigint").alias("root_id"), F.col(url).alias("post_url")
    ).where(F.col("root_id").isNotNull()).groupBy("root_id").agg(F.min("post_url").alias("post_url"))
    descendants = one_per_id(replies.where(F.col("id") != F.col("root_id")))
    if only_first:
        descendants = direct_replies(descendants, F.col("root_id"))
    pulled = thread_replies(keyed, descendants)
    return pulled if include_all else oldest_n(pulled, top_num)


def reply_counts(posts: DataFrame, replies: DataFrame, post: str = "root_id") -> DataFrame:
    """Number of replies per post, zero included; counted before the join."""
    counts = replies.groupBy(post).agg(F.count(F.lit(1)).alias("n_replies"))
    return posts.join(counts, post, "left").withColumn(
        "n_replies", F.coalesce("n_replies", F.lit(0).cast("bigint"))
    )


def link_parents(replies: DataFrame, **skew) -> DataFrame:
    """Add PARENT_URL and PARENT_content of the directly answered post.

    A post that landed more than once counts once.
    """
    replies = one_per_id(replies)
    parents = replies.select(
        F.col("id").alias("in_reply_to_id"),
        F.col("url").alias("PARENT_URL"),
        F.col("content").alias("PARENT_content"),
    ).where(F.col("in_reply_to_id").isNotNull())
    return lookup_join(replies, parents, "in_reply_to_id", spread_by=["id"], **skew)


def thread_depth(links: DataFrame, **skew) -> DataFrame:
    """Thread root and depth of every post, from (id, in_reply_to_id).

    Every open row points at an ancestor; each round replaces the pointer by
    the ancestor's own pointer, so the distance covered doubles and a thread of
    depth d takes log2(d) rounds of one equi-join over three numbers per row.
    Rows that reached their root take no further part. Each round stores only
    the rows it moved, which keeps plans short and survives lost executors.

    Returns id, root_id, reply_depth and ``status``: ``root`` or ``reply``;
    ``orphan`` when the parent is not in the table, which makes the post a root
    of its own; ``cycle`` (null root and depth) when the pointers never end. An
    id that landed more than once counts once.
    """
    links = store(one_per_id(links.select("id", "in_reply_to_id")), "depth-links")
    known = links.where(F.col("id").isNotNull()).select(
        F.col("id").alias("in_reply_to_id"), F.lit(True).alias("_known")
    )
    first = lookup_join(links, known, "in_reply_to_id", spread_by=["id"], **skew)
    is_top = F.col("_known").isNull()
    last = store(
        first.select(
            "id",
            F.when(is_top, F.col("id")).otherwise(F.col("in_reply_to_id")).alias("up"),
            F.when(is_top, 0).otherwise(1).cast("bigint").alias("steps"),
            is_top.alias("done"),
            (is_top & F.col("in_reply_to_id").isNotNull()).alias("orphan"),
        ),
        "depth",
    )
    state = last
    open_before, open_now = None, last.where(~F.col("done")).count()
    # Below a row without cycle there is always one that finishes next round,
    # so an unchanged count means only cycles are left.
    while open_now not in (0, open_before):
        above = state.select(
            F.col("id").alias("up"),
            F.col("up").alias("up_up"),
            F.col("steps").alias("up_steps"),
            F.col("done").alias("up_done"),
        )
        moved = lookup_join(
            last.where(~F.col("done")), above, "up", ["id"], "inner", **skew
        ).select(
            "id",
            F.col("up_up").alias("up"),
            (F.col("steps") + F.col("up_steps")).alias("steps"),
            F.col("up_done").alias("done"),
            "orphan",
        )
        finished = state.where("done")
        last = store(moved, "depth")
        state = finished.unionByName(last)
        open_before, open_now = open_now, last.where(~F.col("done")).count()
    return state.select(
        "id",
        F.when(F.col("done"), F.col("up")).alias("root_id"),
        F.when(F.col("done"), F.col("steps")).alias("reply_depth"),
        F.when(~F.col("done"), "cycle")
        .when(F.col("orphan"), "orphan")
        .when(F.col("steps") == 0, "root")
        .otherwise("reply")
        .alias("status"),
    )


def distinct_authors(usernames: DataFrame, name: str = "username") -> DataFrame:
    """Distinct non-null usernames."""
    return usernames.select(name).where(F.col(name).isNotNull()).distinct()


def author_summary(usernames: DataFrame, name: str = "username") -> DataFrame:
    """One row: n_names, n_null and n_authors, the number of distinct names."""
    return usernames.agg(
        F.count(F.lit(1)).alias("n_names"),
        F.count_if(F.col(name).isNull()).alias("n_null"),
        F.count_distinct(name).alias("n_authors"),
    )


def lookup(profiles: DataFrame, user_handle: str, name: str = "username") -> DataFrame:
    """The profile of one user."""
    if user_handle is None:
        raise ValueError("a user handle is needed")
    return profiles.where(F.col(name) == user_handle)


def author_lookup(usernames: DataFrame, profiles: DataFrame, name: str = "username") -> DataFrame:
    """Profile of every distinct username; unknown ones keep null fields."""
    return distinct_authors(usernames, name).join(profiles, name, "left")


def missing_authors(usernames: DataFrame, profiles: DataFrame, name: str = "username") -> DataFrame:
    """Distinct usernames without a landed profile."""
    return distinct_authors(usernames, name).join(profiles.select(name), name, "left_anti")
