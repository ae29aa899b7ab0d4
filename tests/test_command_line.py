import pytest

from threadloom import schemas
from threadloom.__main__ import main
from threadloom.sources.writers import append_rows


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def test_collect_combine_and_logs(spark, folder):
    append_rows(
        spark.createDataFrame([(1, "u1"), (2, "u2")], "row BIGINT, url STRING").selectExpr(
            "*", "0L AS external_id", "0L AS reply_count", "0L AS like_count", "'' AS content"
        ),
        folder("posts"),
    )
    append_rows(spark.createDataFrame([(1, None, None), (2, None, None)], schemas.PROGRESS_LOG), folder("log"))
    append_rows(
        spark.createDataFrame(
            [("u1", '[{"id": "11", "url": "r11"}, {"id": "12", "url": "r12"}]')], "post_url STRING, page STRING"
        ),
        folder("pages"),
    )
    append_rows(spark.createDataFrame([("u1", None)], "post_url STRING, error STRING"), folder("landed"))
    main(["collect", *(f"--{n}={folder(n)}" for n in ("posts", "log", "pages", "landed", "out"))])
    log = spark.read.parquet(folder("out/log")).collect()
    assert sorted(map(tuple, log)) == [(1, 1, "2"), (2, 0, "thread not landed")]
    main(["logs", f"--files={folder('out/log')}", f"--out={folder('merged')}", "--format=parquet"])
    assert spark.read.parquet(folder("merged")).count() == 2

    replies = spark.read.parquet(folder("out/replies"))
    assert sorted(r.id for r in replies.collect()) == [11, 12]
    append_rows(replies, folder("parts/a"), "csv")
    append_rows(replies, folder("parts/b"), "csv")
    main(["combine", f"--files={folder('parts/*')}", "--kind=replies", f"--out={folder('all')}", "--format=csv"])
    combined = spark.read.csv(folder("all"), header=True)
    assert combined.columns == schemas.REPLY_FIELDS and combined.count() == 2


def test_stances(spark, folder):
    rows = spark.createDataFrame(
        [(1, "x", 1, "u", "P"), (2, "y", 1, "u", "P")],
        "external_id BIGINT, content STRING, reply_depth INT, PARENT_URL STRING, PARENT_content STRING",
    ).selectExpr("*", "string(null) AS AM_output", "string(null) AS SD_output")
    append_rows(rows, folder("in"))
    main(["stances", f"--input={folder('in')}", f"--out={folder('out')}", "--model=test_annotation:echo"])
    got = spark.read.parquet(folder("out")).collect()
    assert sorted(map(tuple, got)) == [(1, "of 2"), (2, "of 2")]


def test_run_is_taken_up_again(spark, folder):
    rows = spark.createDataFrame(
        [(1, "x"), (2, None)], "external_id BIGINT, content STRING"
    ).selectExpr(
        "*", "string(null) AS AM_output", "string(null) AS SD_output", "1 AS reply_depth", "'u' AS PARENT_URL",
        "'P' AS PARENT_content",
    )
    append_rows(rows, folder("in"))
    keep = ["--run-id=r", f"--responses-path={folder('answers')}", "--null-text=nan", "--parallelism=2"]
    for out in ("a", "b"):
        main(["arguments", f"--input={folder('in')}", f"--out={folder(out)}", "--model=test_annotation:echo", *keep])
    got = [sorted(map(tuple, spark.read.parquet(folder(out)).collect())) for out in ("a", "b")]
    assert got[0] == got[1] == [(1, "of 2"), (2, "of 2")]
    assert spark.read.parquet(folder("answers")).count() == 1


def test_authors(spark, folder):
    append_rows(spark.createDataFrame([("a",), ("b",)], "username STRING"), folder("names"))
    append_rows(spark.createDataFrame([{"username": "a"}], schemas.AUTHOR_ROW), folder("profiles"))
    main(["authors", f"--usernames={folder('names')}", f"--profiles={folder('profiles')}", f"--out={folder('o')}"])
    assert [r.username for r in spark.read.parquet(folder("o/missing")).collect()] == ["b"]


def test_collect_to_stances(spark, folder):
    """The halves fit together: replies and posts -> prepared input -> results."""
    replies = spark.createDataFrame(
        [{"id": 2, "in_reply_to_id": 1, "url": "r2", "content": "a"},
         {"id": 3, "in_reply_to_id": 2, "url": "r3", "content": "b"},
         {"id": 9, "in_reply_to_id": 8, "url": "r9", "content": "c"}],
        schemas.REPLY_ROW,
    )
    posts = spark.createDataFrame(
        [{"row": 0, "url": "p1", "external_id": 1, "content": "P"}], schemas.POST
    )
    append_rows(replies, folder("replies"))
    append_rows(posts, folder("posts"))
    main(["prepare", f"--input={folder('replies')}", f"--posts={folder('posts')}", f"--out={folder('in')}"])
    rows = spark.read.parquet(folder("in")).orderBy("external_id").collect()
    assert [(r.external_id, r.reply_depth, r.PARENT_URL, r.PARENT_content) for r in rows] == [
        (2, 1, "p1", "P"), (3, 2, "r2", "a"), (9, 0, None, None),
    ]
    main(["stances", f"--input={folder('in')}", f"--out={folder('out')}", "--model=test_annotation:echo"])
    got = spark.read.parquet(folder("out")).collect()
    assert sorted(map(tuple, got)) == [(2, "of 2"), (3, "of 2"), (9, None)]
