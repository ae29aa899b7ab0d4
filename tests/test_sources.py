import pathlib

import pytest

from threadloom import schemas
from threadloom.operators.threads import nested_as_json
from threadloom.plans import collect
from threadloom.sources import readers, writers

PAIR = schemas._struct(url=schemas.S, n=schemas.L)


def test_csv_columns_align_by_name(spark, tmp_path):
    (tmp_path / "a-1.csv").write_text("url,n\nx,1\n")
    (tmp_path / "a-2.csv").write_text("n,url\n2,y\n")
    (tmp_path / "a-3.csv").write_text("url,extra\nz,?\n")
    got = readers.read_csv(spark, f"{tmp_path}/a-*.csv", PAIR).collect()
    assert sorted(map(tuple, got), key=str) == [("x", 1), ("y", 2), ("z", None)]


def test_csv_cells_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('url,n\n"say ""hi""\nthere, you",1\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path), PAIR).collect()] == [
        ('say "hi"\nthere, you', 1)
    ]


def test_file_order_follows_names_then_rows(spark, tmp_path):
    (tmp_path / "log-10.csv").write_text("row,scraped,output\n1,0,ten\n2,,\n")
    (tmp_path / "log-2.csv").write_text("row,scraped,output\n1,1,two\n2,1,two\n3,1,two\n")
    merged = collect.merge_scrape_logs(spark, f"{tmp_path}/log-*.csv", "csv").collect()
    assert sorted(tuple(r) for r in merged) == [(1, 0, "ten"), (2, 1, "two"), (3, 1, "two")]


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_combine_threads_over_files(spark, tmp_path, fmt):
    first = spark.createDataFrame([("u1", 1), ("u2", 2), ("u1", 3)], PAIR)
    second = spark.createDataFrame([("u2", 4), ("u3", 5)], PAIR)
    for name, df in (("p1", first), ("p2", second)):
        writers.append_rows(df.coalesce(1), f"{tmp_path}/{name}", fmt)
    out = collect.combine_threads(spark, f"{tmp_path}/*", PAIR, fmt)
    assert sorted((r.url, r.n) for r in out.rows.collect()) == [("u1", 1), ("u2", 2), ("u3", 5)]
    assert tuple(out.duplicates.first()) == (5, 2, 3)
    assert sorted(r.n_rows for r in out.per_file.collect()) == [2, 3, 5]


def test_csv_round_trip_keeps_text_whole(spark, tmp_path):
    rows = [('  padded "x"\n ', 1), ("tab\there, é", 2), (None, 3)]
    writers.append_rows(spark.createDataFrame(rows, PAIR), f"{tmp_path}/t", "csv")
    back = readers.read_table(spark, f"{tmp_path}/t", PAIR, "csv").collect()
    assert sorted(map(tuple, back), key=lambda r: r[1]) == rows


def test_json_ids_as_text_or_number_stay_exact(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"external_id": "113456789012345679", "content": "a"}\n'
        '{"external_id": 113456789012345679, "content": "b"}\n'
    )
    df = readers.read_table(spark, str(tmp_path), schemas.ANNOTATION_INPUT, "json")
    assert {r.external_id for r in df.collect()} == {113456789012345679}
    assert df.columns == schemas.ANNOTATION_INPUT.names


def test_landed_pages(spark, tmp_path):
    (tmp_path / "pages.json").write_text(
        '{"post_url": "u", "page": [{"id": "1", "account": {"username": "a"}}, {"id": "2"}]}\n'
        '{"post_url": "v", "page": []}\n'
    )
    rows = readers.read_reply_pages(spark, str(tmp_path)).collect()
    assert [(r.post_url, r.id) for r in rows] == [("u", "1"), ("u", "2")]
    assert rows[0].account.username == "a"


def test_snapshot_is_replaced_and_append_appends(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], PAIR)
    for _ in range(2):
        writers.append_rows(df, f"{tmp_path}/a")
        writers.replace_snapshot(df, f"{tmp_path}/s")
    assert spark.read.parquet(f"{tmp_path}/a").count() == 2
    assert spark.read.parquet(f"{tmp_path}/s").count() == 1


def test_every_csv_file_has_its_header(spark, tmp_path):
    writers.append_rows(spark.createDataFrame([("x", 1)], PAIR), f"{tmp_path}/c", "csv")
    parts = list(pathlib.Path(f"{tmp_path}/c").glob("*.csv"))
    assert parts and all(p.read_text().startswith("url,n\n") for p in parts)


def test_results_by_run(spark, tmp_path):
    results = spark.createDataFrame([(1, "a")], "external_id BIGINT, SD_output STRING")
    writers.append_results(results, f"{tmp_path}/r", "one")
    writers.append_results(results, f"{tmp_path}/r", "two")
    assert spark.read.parquet(f"{tmp_path}/r").where("run_id = 'one'").count() == 1


def test_nested_columns_become_json(spark):
    df = spark.sql("SELECT array(1, 2) AS a, named_struct('x', 'é\"') AS s, 3 AS n")
    assert tuple(nested_as_json(df).first()) == ("[1,2]", '{"x":"é\\""}', 3)


def test_empty_files_give_no_rows(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    got = readers.read_csv(spark, f"{tmp_path}/*.csv", PAIR)
    assert got.columns == PAIR.names and got.count() == 0


def test_number_of_jobs_does_not_grow_with_files(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            head = "a,b\n1,x\n" if i % 2 else "b,a\nx,1\n"
            (folder / f"{i:03d}.csv").write_text(head)
        schema = schemas._struct(a=schemas.L, b=schemas.S)
        spark.sparkContext.setJobGroup(f"csv{n}", "")
        df = readers.read_csv(spark, str(folder), schema)
        found = len(tracker.getJobIdsForGroup(f"csv{n}"))
        assert {(r.a, r.b) for r in df.collect()} == {(1, "x")} and df.count() == n
        return found

    assert jobs(3) == jobs(40)
