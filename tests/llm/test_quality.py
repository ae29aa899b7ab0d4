"""Held-out accuracy of the quality classifier, and its risk."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from threadloom.llm import common, quality
from threadloom.llm.queries import QUERIES


def test_held_out_accuracy_and_columns(spark):
    sf_dir = "/root/testdata/sf0.01"
    out = QUERIES["op7_quality_classifier"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert {(r.predicted, r.score >= 0.7) for r in rows} == {(0, False), (1, True)}
    assert out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_labels_of_held_out_rows_are_not_used(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    turned = labels.withColumn(
        "quality", F.when(quality.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a, b = quality.learn(docs, labels), quality.learn(docs, turned)
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_defined_cases(spark, small):
    model = quality.learn(
        spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    )
    rows = [(1, None, 5), (2, "", 6), (None, " \n", 7), (3, "a" * 3_000_000, 8), (3, "x y", 9), (3, "x y", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    out = quality.quality_scores(df, model).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert out[0].score == out[1].score == out[2].score and out[4] == out[5]
    assert quality.quality_scores(df.limit(0), model).collect() == []


def test_learning_from_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    assert quality.apply_model(quality.style(pa.array(["x", None])), model).tolist() == [0.5, 0.5]


def test_risk_separates_without_negative_labels():
    rng = np.random.default_rng(1)
    good = rng.normal(size=(16_000, quality.FEATURES))
    bad = rng.normal(size=(4800, quality.FEATURES)) + np.r_[2.5, 2.5, np.zeros(quality.FEATURES - 2)]
    model = quality.fit(good[:8000], np.concatenate([good[8000:], bad[:2400]]), prior=8000 / 10_400)
    assert (quality.apply_model(good, model) >= 0.7).mean() > 0.95
    assert (quality.apply_model(bad[2400:], model) < 0.7).mean() > 0.8


def test_style_reads_whole_texts():
    tail = ["plain words here " * 1000, "plain words here " * 1000 + "!!! $$$ " * 500]
    found = quality.style(pa.array(tail))
    assert not np.allclose(found[0], found[1])


def test_rows_of_a_repeated_id_do_not_grow_the_fit(spark):
    texts = [(k, f"text {k}, of a few words.") for k in range(30)]
    docs = spark.createDataFrame(texts + [(5, "the same row, again and again")] * 400, "doc_id long, text string")
    ids = spark.createDataFrame([(k,) for k in range(20)], "doc_id long")
    x = quality._features(docs, ids, 10)
    assert x.shape == (10, quality.FEATURES)
    assert quality._features(docs, ids, 100).shape[0] == 21


def test_smallest_is_a_sorted_limit(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    rank = F.xxhash64("k")
    for n in (1, 10, 700, 6000):
        want = {r.k for r in df.orderBy(rank, "k").limit(n).collect()}
        assert {r.k for r in common.smallest(df, rank, ["k"], n).collect()} == want
    assert common.smallest(df.limit(0), rank, ["k"], 5).collect() == []
