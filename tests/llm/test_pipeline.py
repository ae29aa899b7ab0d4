"""Each stage on its own input, against plain decisions; and the whole run."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontaminate import plain
from test_mixing import check
from test_near_dup import brute

import corpus_pipeline as pipeline
from threadloom.llm import quality
from threadloom.llm.pii import PATTERN


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def test_quality_stage(spark, small, docs):
    kept = pipeline.keep_good(spark, docs, small)
    assert kept.columns == docs.columns
    model = quality.learn(docs, spark.read.parquet(f"{small}/labels.parquet"))
    rows = docs.toArrow()
    good = quality.apply_model(quality.style(rows.column("text").combine_chunks()), model) >= 0.7
    assert sorted(r.doc_id for r in kept.collect()) == sorted(np.array(rows.column("doc_id"))[good].tolist())


def test_near_duplicate_stage(spark, small, docs):
    extra = docs.limit(3).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    out = pipeline.drop_near_duplicates(spark, docs.unionByName(extra), small)
    assert out.columns == docs.columns
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, (_, c) in want.items() if i == c)
    assert ids.count(None) == 1


def test_near_duplicate_stage_decides_per_row(spark, small, docs):
    words = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    a, b, c, d, e = (words(x) for x in "abcde")
    near = lambda t: t + " more"
    rows = [
        (3, b), (5, a), (5, b),  # only the copy of 3 goes, not the other text of its id
        (7, c), (7, near(c)), (7, c),  # near copies under one id
        (None, d), (None, near(d)), (None, d), (None, e),  # copies without an id
        (8, ""), (9, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    out = pipeline.drop_near_duplicates(spark, df, small)
    assert out.columns == df.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    known = sorted(r for r in got if r[0] is not None and r[0] != 7)
    assert known == [(3, b), (5, a), (8, ""), (9, "")]
    assert [t in (c, near(c)) for i, t in got if i == 7] == [True]
    unnamed = [t for i, t in got if i is None]
    assert len(unnamed) == 2 and e in unnamed and (d in unnamed or near(d) in unnamed)


def test_benchmark_stage(spark, small, docs):
    out = pipeline.drop_benchmark(spark, docs.withColumn("hits", F.lit(1)), small)
    assert out.columns == [*docs.columns, "hits"]
    passages = [plain(r.text).strip() for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in docs.collect() if not any(p in plain(r.text) for p in passages)}
    ids = {r.doc_id for r in out.collect()}
    assert ids <= clean and len(clean - ids) <= 2


def test_private_stage(spark, small, docs):
    out = pipeline.hide_private(spark, docs, small)
    assert out.columns == docs.columns and out.count() == docs.count()
    both = out.alias("a").join(docs.alias("b"), "doc_id")
    assert both.where("a.text <> b.text").count() == docs.where(F.col("text").rlike(PATTERN)).count() > 0
    assert both.where("a.n_chars <> char_length(a.text)").count() == 0


def test_mix_stage(spark, small, docs):
    clash = docs.withColumn("size", F.lit("x")).withColumn("row_key", F.lit(1)).unionByName(
        docs.limit(2).withColumn("size", F.lit("x")).withColumn("row_key", F.lit(1))
    )
    out = pipeline.mix(spark, clash, small)
    assert out.columns == [
        *docs.columns, "row_key", "size", "source_size", "target", "copies", "taken"
    ]
    rows = pipeline.mix(spark, docs, small).collect()
    assert all(r.copies > 0 and r.taken == r.copies * r.size for r in rows)
    taken, target, largest = {}, {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in taken)


def test_run_is_the_stages_in_order(spark, small):
    out = pipeline.run(spark, small)
    assert [name for name, _ in pipeline.STAGES] == [
        "quality", "near_duplicates", "benchmark", "private", "mix"
    ]
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) > 50


def test_empty_and_odd_tables(spark, small, docs):
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)], docs.schema
    )
    for start in (docs.limit(0), odd):
        df = start
        for _, stage in pipeline.STAGES:
            df = stage(spark, df, small)
        assert df.count() == 0


def test_checked_by_mixing_rules(spark, small, docs):
    from threadloom.llm.queries import QUERIES

    check(QUERIES["op1_source_mix"](spark, small).collect())


def test_the_row_that_stays_does_not_depend_on_the_order(spark):
    text = "one text of quite enough words to make some shingles"
    rows = [(7, text, "b", "en", 1), (7, text, "a", "fr", 2), (7, text, "a", "en", 3), (7, text, "a", "en", 3), (8, "other words", None, "en", 4)]
    rows += [(None, "no id", "z", "en", 5), (None, "no id", "y", "en", 6), (9, None, "c", "en", 7), (9, None, None, "en", 8)]
    schema = "doc_id long, text string, source string, lang string, row_hash int"
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        for parts in (1, 4):
            docs = spark.createDataFrame(order, schema).repartition(parts)
            got = pipeline.drop_near_duplicates(spark, docs, "")
            assert got.columns == docs.columns
            assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[2], rows[4], rows[6], rows[8]], key=str)
