import pytest

from threadloom import schemas
from threadloom.operators.progress import outcome_text
from threadloom.plans import collect

POSTS = "row BIGINT, url STRING, reply_count BIGINT"


@pytest.fixture(scope="module")
def landed(spark):
    pages = spark.createDataFrame(
        [
            ("u1", '[{"id": "11", "account": {"username": "a"}}, {"id": "12", "account": {"username": "b"}}]'),
            ("u1", '[{"id": "13", "account": {"username": "a"}}]'),
            ("u4", '[{"id": "41", "account": {"username": "c"}}]'),
            ("u9", '[{"id": "91", "account": {"username": "d"}}]'),
        ],
        "post_url STRING, page STRING",
    )
    fetched = spark.createDataFrame(
        [("u1", None), ("u2", None), ("u4", "timed out"), ("u9", None)], "post_url STRING, error STRING"
    )
    posts = spark.createDataFrame(
        [(1, "u1", 5), (2, "u2", 0), (3, "u3", 9), (4, "u4", 1), (5, "u5", 1)], POSTS
    )
    log = spark.createDataFrame([(5, 0, "no")], schemas.PROGRESS_LOG)
    return posts, log, pages, fetched


def outcomes(out):
    return sorted(tuple(r) for r in outcome_text(out.outcomes).collect())


def test_replies_authors_and_outcomes(landed):
    out = collect.compile_thread(*landed)
    assert outcomes(out) == [
        (1, 1, "3"), (2, 1, "0"), (3, 0, "thread not landed"), (4, 0, "timed out"),
    ]
    assert sorted((r.id, r.PARENT_ID) for r in out.replies.collect()) == [
        (11, "u1"), (12, "u1"), (13, "u1"),
    ]
    assert sorted(r.username for r in out.authors.collect()) == ["a", "a", "b"]


def test_parsed_pages_do_as_well(spark, landed):
    posts, log, pages, fetched = landed
    parsed = spark.createDataFrame(
        [("u1", [{"id": "11"}, {"id": "12"}])],
        schemas.T.StructType(
            [schemas.T.StructField("post_url", schemas.S), schemas.T.StructField("page", schemas.REPLY_PAGE)]
        ),
    )
    out = collect.compile_thread(posts, log, parsed, fetched)
    assert outcomes(out)[0] == (1, 1, "2")


def test_options(landed):
    assert outcomes(collect.compile_thread(*landed, at_least=5)) == [(1, 1, "3"), (3, 0, "thread not landed")]
    assert len(outcomes(collect.compile_thread(*landed, retry_failed=True))) == 5


def test_shards_together_are_the_whole(landed):
    parts = [outcomes(collect.compile_thread(*landed, seed=s, shards=3)) for s in range(3)]
    assert sorted(sum(parts, [])) == outcomes(collect.compile_thread(*landed))


def test_authors_found_and_missed(spark):
    names = spark.createDataFrame([("a",), ("z",), ("a",)], "username STRING")
    profiles = spark.createDataFrame([("a", True, 1)], "username STRING, bot BOOLEAN, other INT")
    found, missed = collect.collect_authors(names, profiles)
    assert found.columns == schemas.AUTHOR_FIELDS
    assert [(r.username, r.bot, r.note) for r in found.collect()] == [("a", True, None)]
    assert [r.username for r in missed.collect()] == ["z"]


def test_a_post_with_an_unreadable_page_fails_as_a_whole(spark, landed):
    posts, log, pages, fetched = landed
    broken = pages.unionByName(
        spark.createDataFrame([("u1", "[{broken")], "post_url STRING, page STRING")
    )
    more = broken.unionByName(
        spark.createDataFrame([("u2", '[{"id": "21"}]')], "post_url STRING, page STRING")
    )
    out = collect.compile_thread(posts, log, more, fetched)
    assert outcomes(out)[:2] == [(1, 0, "page not readable"), (2, 1, "1")]
    assert [r.id for r in out.replies.collect()] == [21]


def test_a_row_is_tried_once(spark, landed):
    posts, log, pages, fetched = landed
    twice = posts.unionByName(spark.createDataFrame([(1, "u3", 1)], POSTS))
    assert outcomes(collect.compile_thread(twice, log, pages, fetched))[0] == (1, 1, "3")
