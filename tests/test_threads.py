import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators import threads


def links(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id BIGINT, in_reply_to_id BIGINT")


def depth(df, **skew):
    return {
        r.id: (r.root_id, r.reply_depth, r.status) for r in threads.thread_depth(df, **skew).collect()
    }


def test_depth_of_a_tree(spark):
    got = depth(links(spark, (1, None), (2, 1), (3, 1), (4, 3), (5, 4), (6, None)))
    assert got == {
        1: (1, 0, "root"),
        2: (1, 1, "reply"),
        3: (1, 1, "reply"),
        4: (1, 2, "reply"),
        5: (1, 3, "reply"),
        6: (6, 0, "root"),
    }


def test_orphans_become_roots_and_cycles_are_flagged(spark):
    got = depth(links(spark, (1, 99), (2, 1), (3, 2), (10, 11), (11, 12), (12, 10), (13, 12), (20, 20)))
    assert got == {
        1: (1, 0, "orphan"),
        2: (1, 1, "reply"),
        3: (1, 2, "reply"),
        10: (None, None, "cycle"),
        11: (None, None, "cycle"),
        12: (None, None, "cycle"),
        13: (None, None, "cycle"),
        20: (None, None, "cycle"),
    }


def test_deep_chain_takes_few_rounds(spark):
    n = 700
    chain = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("in_reply_to_id"))
    got = depth(chain)
    assert all(got[i][:2] == (0, i) for i in range(n))


def test_viral_post(spark):
    star = spark.range(4000).select(
        "id",
        F.when(F.col("id") == 0, None)
        .when(F.col("id") % 3 == 0, 0)
        .otherwise(F.col("id") - 1)
        .cast("bigint")
        .alias("in_reply_to_id"),
    )
    assert depth(star, rows=50) == depth(star)


def test_empty_links(spark):
    assert depth(links(spark)) == {}


def test_pages_keep_known_keys_and_null_the_rest(spark):
    page = (
        '[{"id": "113456789012345679", "content": "a", "created_at": "2024-01-02T03:04:05.678Z",'
        ' "account": {"username": "u", "bot": false}, "surprise": 1, "mentions": [{"id": "9"}]}]'
    )
    df = spark.createDataFrame([("url", page), ("none", "[]")], "post_url STRING, page STRING")
    rows = threads.reply_objects(df)
    reply = threads.reply_rows(rows).collect()
    assert len(reply) == 1
    assert list(reply[0].asDict()) == schemas.REPLY_FIELDS
    assert reply[0].id == 113456789012345679 and reply[0].PARENT_ID == "url"
    assert reply[0].url is None and reply[0].mentions[0].id == "9"
    author = threads.author_rows(rows).collect()[0].asDict()
    assert list(author) == schemas.AUTHOR_FIELDS
    assert (author["username"], author["bot"], author["verified"]) == ("u", False, None)
    as_text = threads.nested_as_json(threads.reply_rows(rows)).first()
    assert as_text.mentions == '[{"id":"9"}]' and as_text.card is None


def test_empty_parent_url_gives_null(spark):
    df = threads.add_parent_id(spark.createDataFrame([("",), ("u",)], "p STRING"), F.col("p"))
    assert sorted([r.PARENT_ID for r in df.collect()], key=str) == [None, "u"]


REPLIES = "root_id BIGINT, id BIGINT, in_reply_to_id BIGINT, created_at INT"


@pytest.fixture(scope="module")
def replies(spark):
    rows = [(1, 1, None, 0)] + [(1, i, 1 if i % 2 else i - 1, 100 - i) for i in range(2, 12)]
    rows += [(20, 20, None, 0), (20, 21, 20, 5), (20, 22, 20, 5)]
    return spark.createDataFrame(rows, REPLIES)


def test_oldest_n(spark, replies):
    def pick(n, **kw):
        return sorted((r.root_id, r.id) for r in threads.oldest_n(replies, n, **kw).collect())

    assert pick(2) == [(1, 1), (1, 11), (20, 20), (20, 21)]
    assert pick(0) == pick(-3) == []
    assert len(pick(None)) == replies.count()
    assert pick(2000, salts=3) == pick(None)


def test_large_n_agrees_with_the_window(spark):
    df = spark.range(5000).select(
        (F.col("id") % 2).alias("root_id"), "id", (F.col("id") * 31 % 997).alias("created_at")
    )
    got = {r.id for r in threads.oldest_n(df, 1500, salts=5).select("id").collect()}
    rows = sorted((r.root_id, r.created_at, r.id) for r in df.collect())
    want = {r[2] for root in (0, 1) for r in [x for x in rows if x[0] == root][:1500]}
    assert got == want


def test_pull_comments(spark, replies):
    posts = spark.createDataFrame(
        [("https://x/1",), ("https://x/20",), ("https://x/77",), ("https://x/",)], "url STRING"
    )

    def ids(**kw):
        return sorted(r.id for r in threads.pull_comments(posts, replies, **kw).collect())

    assert ids() == list(range(2, 12)) + [21, 22]
    assert ids(top_num=1) == [11, 21]
    assert ids(top_num=1, include_all=True) == list(range(2, 12)) + [21, 22]
    assert ids(only_first=True) == [2, 3, 5, 7, 9, 11, 21, 22]
    assert ids(top_num=0) == []


def test_reply_counts_include_zero(spark, replies):
    posts = spark.createDataFrame([(1,), (20,), (77,)], "root_id BIGINT")
    got = {r.root_id: r.n_replies for r in threads.reply_counts(posts, replies).collect()}
    assert got == {1: 11, 20: 3, 77: 0}


def test_authors(spark):
    names = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "username STRING")
    profiles = spark.createDataFrame([("a", "x")], "username STRING, note STRING")
    assert threads.author_lookup(names, profiles).count() == 2
    assert [r.username for r in threads.missing_authors(names, profiles).collect()] == ["b"]


def test_lookup_of_one_user(spark):
    profiles = spark.createDataFrame([("a", "x"), ("b", "y")], "username STRING, note STRING")
    assert [r.note for r in threads.lookup(profiles, "b").collect()] == ["y"]
    with pytest.raises(ValueError):
        threads.lookup(profiles, None)


def test_pages_that_are_no_lists_of_replies(spark):
    pages = [
        '[{"id": "1", "content": "a"}]', "[]", ' [ {"id": 2} ]', '{"error": "Record not found"}', "[null]",
        '[{"id": "3"}, {"content": "b"}]', '[{"id": ""}]', "nonsense", None, "7",
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, page string")
    rows = threads.parse_pages(df, error="why").orderBy("i").collect()
    assert [r.page is not None for r in rows] == [True, True, True] + [False] * 7
    assert [r.why for r in rows if r.why] == ["Record not found"]


def test_repeats_count_once(spark):
    rows = [(1, None, "u1", "a"), (2, 1, "u2", "b"), (3, 2, "u3", "c"), (None, 1, "u4", "d")]
    df = spark.createDataFrame(rows, "id long, in_reply_to_id long, url string, content string")
    twice = df.unionByName(df.where("id IS NOT NULL")).unionByName(df.where("id = 2").withColumn("content", F.lit("other")))
    linked = threads.link_parents(twice).collect()
    assert sorted((r.id or 0, r.PARENT_URL) for r in linked) == [(0, "u1"), (1, None), (2, "u1"), (3, "u2")] or sorted(
        (r.id or 0, r.PARENT_URL or "") for r in linked
    ) == [(0, "u1"), (1, ""), (2, "u1"), (3, "u2")]
    depth = threads.thread_depth(twice.where("id IS NOT NULL")).collect()
    assert sorted((r.id, r.reply_depth) for r in depth) == [(1, 0), (2, 1), (3, 2)]


def test_listed_twice_is_pulled_once(spark):
    posts = spark.createDataFrame([("http://x/10",), ("http://x/10",)], "url string")
    rows = spark.createDataFrame(
        [(10 + i, 10, 10, i) for i in range(1, 7)] * 2, "id long, root_id long, in_reply_to_id long, created_at int"
    )
    got = threads.pull_comments(posts, rows, top_num=4).collect()
    assert sorted(r.id for r in got) == [11, 12, 13, 14]


def test_rows_without_time_come_last(spark):
    rows = spark.createDataFrame([(1, 5, None), (2, 5, 9), (3, 5, 8)], "id long, root_id long, created_at int")
    assert sorted(r.id for r in threads.oldest_n(rows, 2).collect()) == [2, 3]


def test_one_plan_for_any_number_of_replies(spark):
    rows = spark.range(100).selectExpr("id", "id % 3 AS root_id", "id AS created_at", "'x' AS content")
    plans = [
        threads.oldest_n(rows, n)._jdf.queryExecution().optimizedPlan().toString().count("Window ") for n in (40, 5000)
    ]
    assert plans[0] == plans[1] > 0
