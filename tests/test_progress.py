from pyspark.sql import functions as F

from threadloom.operators import combine, progress

LOG = "row BIGINT, scraped INT, output STRING"


def test_shards_make_the_whole(spark):
    posts = spark.range(500).withColumnRenamed("id", "row")
    parts = [progress.shard_rows(posts, s) for s in range(progress.SHARDS)]
    got = sorted(r.row for p in parts for r in p.collect())
    assert got == list(range(500))


def test_failures_count_as_done_unless_retried(spark):
    log = spark.createDataFrame([(1, 1, "3"), (2, 0, "no"), (3, None, None), (1, 1, "3")], LOG)
    posts = spark.range(5).withColumnRenamed("id", "row")
    assert sorted(r.row for r in progress.pending_posts(posts, log).collect()) == [0, 3, 4]
    retried = progress.pending_posts(posts, log, retry_failed=True)
    assert sorted(r.row for r in retried.collect()) == [0, 2, 3, 4]


def test_update_keeps_unknown_rows_out_and_updates_all_copies(spark):
    log = spark.createDataFrame([(1, None, None), (1, None, None), (2, 1, "5")], LOG)
    outcomes = spark.createDataFrame(
        [(1, 0, None, "no answer"), (9, 1, 4, None)],
        "row BIGINT, scraped INT, n_replies BIGINT, error STRING",
    )
    got = progress.update_log(log, progress.outcome_text(outcomes)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, "no answer"), (1, 0, "no answer"), (2, 1, "5")]


def test_latest_outcome(spark):
    runs = spark.createDataFrame(
        [(1, 0, "e", 1), (1, 1, "7", 2), (2, 1, "0", 1)], LOG + ", at INT"
    )
    got = progress.latest_outcomes(runs, "at").collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, "7"), (2, 1, "0")]


def test_merge_is_keyed_and_fills_columns_apart(spark):
    parts = spark.createDataFrame(
        [(1, None, "x", 1), (2, 0, None, 1), (1, 1, "y", 2), (2, 1, "z", 2), (3, 1, None, 2)],
        LOG + ", o INT",
    )
    merged = progress.merge_logs(parts, "o")
    assert sorted(tuple(r) for r in merged.collect()) == [(1, 1, "x"), (2, 0, "z"), (3, 1, None)]
    again = progress.merge_logs(merged.withColumn("o", F.lit(1)), "o")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_min_replies_is_optional(spark):
    posts = spark.createDataFrame([(1, 2), (2, 3), (3, None)], "row BIGINT, reply_count BIGINT")
    assert progress.min_replies(posts).count() == 3
    assert [r.row for r in progress.min_replies(posts, 3).collect()] == [2]


def test_seeded_order_is_a_permutation(spark):
    posts = spark.range(300).withColumnRenamed("id", "row")
    got = {r.row: r.position for r in progress.seeded_order(posts).collect()}
    assert sorted(got.values()) == list(range(300))
    other = {r.row: r.position for r in progress.seeded_order(posts, seed=1).collect()}
    assert got != other


def test_keep_first_and_duplicates_treat_nulls_as_one_key(spark):
    rows = [(0, None), (1, None), (2, "a"), (3, "a")]
    df = spark.createDataFrame(rows, "pos INT, url STRING")
    assert sorted(r.pos for r in combine.keep_first(df, "url", ["pos"]).collect()) == [0, 2]
    assert tuple(combine.duplicate_stats(df).first()) == (4, 2, 2)
    assert tuple(combine.duplicate_stats(df.limit(0)).first()) == (0, 0, 0)


def test_keep_first_is_idempotent(spark):
    df = spark.range(100).select((F.col("id") % 9).alias("url"), F.col("id").alias("pos"))
    once = combine.keep_first(df, "url", ["pos"])
    assert sorted(combine.keep_first(once, "url", ["pos"]).collect()) == sorted(once.collect())


def test_hot_key_is_thinned_before_the_shuffle(spark):
    url = F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(1000).select(url.alias("url"), F.col("id").alias("pos"))
    plan = combine.keep_first(df, "url", ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]
