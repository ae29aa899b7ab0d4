"""Targets against a plain loop; pivotal rounding by its invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import mixing
from threadloom.llm.common import word_count
from threadloom.llm.mixing import mix_sources, settle


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """sizes: {source: words}; shares out, cuts, shares the excess until nothing is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + (
        [None] if None in sizes else []
    )
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), share * sum(sizes.values()), list(order)
    while open_ and left > 1e-9:
        total = sum(w[s] for s in open_)
        for s in open_:
            target[s] += left * w[s] / total
        left = 0.0
        for s in open_:
            left += max(0.0, target[s] - cap * sizes[s])
            target[s] = min(target[s], cap * sizes[s])
        open_ = [s for s in open_ if target[s] < cap * sizes[s]]
    return target


def check(rows):
    sizes, largest = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - want[source]) <= largest[source]


def test_whole_table_and_reruns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select(
        "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    rows = mix_sources(docs).collect()
    check(rows)
    again = mix_sources(docs.repartition(5, "size")).collect()
    assert {(r.doc_id, r.copies) for r in rows} == {(r.doc_id, r.copies) for r in again}
    other = mix_sources(docs, seed=99).collect()
    assert {(r.doc_id, r.copies) for r in rows} != {(r.doc_id, r.copies) for r in other}


def test_many_levels_of_the_tree(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        (F.col("id") * 7919 % 100).alias("size"),
    )
    check(mix_sources(df, group=10).collect())


def test_defined_cases(spark):
    rows = [
        (1, "b", 10, "x"), (2, None, 5, "y"), (None, "a", 3, "z"), (3, "a", None, "q"), (4, "é", 0, ""),
        (5, "b", 10, ""), (5, "b", 10, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, target string")
    got = mix_sources(df).collect()
    assert len(got) == 7
    check(got)
    assert mix_sources(df.limit(0)).collect() == []


def test_settle_keeps_the_weighted_sum_and_the_odds():
    rng = np.random.default_rng(4)
    w = rng.integers(1, 50, 200).astype(float)
    p = rng.random(200)
    mean = np.zeros(200)
    for seed in range(400):
        out = settle(p, w, np.random.default_rng(seed))
        assert ((out > 0) & (out < 1)).sum() <= 1
        assert (w * out).sum() == pytest.approx((w * p).sum())
        mean += settle(p, w, np.random.default_rng(seed), last=True) / 400
    assert np.abs(mean - p).max() < 0.13
    assert mixing.settle(np.zeros(0), np.zeros(0), rng).size == 0
