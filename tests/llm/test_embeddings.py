"""Embedding links against all products."""

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import embeddings
from threadloom.llm.embeddings import _classes, cells_of, embedding_duplicates, fit_axes, fit_cells, folded, slack


def brute(x, ids, cosine=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    label = ids.copy()
    while True:
        new = np.array([min([label[i], *label[linked[i]]]) for i in range(len(x))])
        if (new == label).all():
            return {int(i): (int(n), int(c)) for i, n, c in zip(ids, linked.sum(1), label, strict=True)}
        label = new


def clustered(seed=0, n=900, d=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, d))
    x = centres[rng.integers(0, 40, n)] + rng.normal(size=(n, d)) * rng.choice([0.02, 0.15, 0.3], (n, 1))
    x[50:80] = x[50]
    return x.astype(np.float32)


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in embedding_duplicates(df).collect()}


@pytest.mark.parametrize(("per_cell", "block"), [(512, 8192), (30, 40), (100_000, 100)])
def test_cells_and_blocks_lose_no_link(spark, monkeypatch, per_cell, block):
    monkeypatch.setattr(embeddings, "PER_CELL", per_cell)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    x = clustered()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    assert result(df) == brute(x.astype(float), np.arange(len(x)))


def test_whole_table(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = df.orderBy("vec_id").toPandas()
    assert result(df) == brute(np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy())


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], "a"), (2, [2.0, 0.0], "b"), (3, [1.0, 0.0], "c"), (4, None, "d"), (5, [0.0, 0.0], "e"),
        (6, [nan, 1.0], "f"), (7, [inf, 1.0], "g"), (8, [None, 1.0], "h"), (9, [], "i"), (None, [1.0, 0.0], "j"),
        (10, [1.0, 0.0, 0.0], "k"), (11, [0.0, 1.0], "l"), (11, [0.0, 1.0], "l"), (-5, [1.0, 0.01], "m"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept string")
    got = sorted(map(tuple, embedding_duplicates(df).collect()), key=str)
    linked = [(i, 3, -5, i == -5) for i in (1, 2, 3, -5)]
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10)]
    assert got == sorted([*linked, *alone, (None, 0, None, False), (11, 1, 11, True), (11, 1, 11, True)], key=str)
    assert embedding_duplicates(df.limit(0)).collect() == []


def test_every_near_pair_meets_in_a_cell():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8))
    y = x + rng.normal(size=x.shape) * 0.15
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    centres = fit_cells(x, 25)
    (hx, mx), (hy, my) = cells_of(x, centres, 0.95), cells_of(y, centres, 0.95)
    near = (x * y).sum(axis=1) >= 0.95
    assert near.sum() > 100
    rows = np.arange(len(x))
    assert ((hx == hy) | mx[rows, hy] | my[rows, hx])[near].all()


def test_vectors_of_any_magnitude(spark):
    near = [[1.0, 1.0], [1.0, 1.01], [1.0, -1.0], [1.0, -1.02]]
    scales = [1e200, 1e300, 1.0, 1e-200, 1e-310, 1e-30]
    x = [[c * scales[i % 6] for c in near[i % 4]] for i in range(24)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert result(df) == brute(np.array([near[i % 4] for i in range(24)]), np.arange(24))


def test_vectors_are_not_copied_to_further_cells(spark, monkeypatch):
    """Each vector is stored as it came and once more by cell, however many cells lie near it."""
    monkeypatch.setattr(embeddings, "PER_CELL", 20)
    tables, store = [], embeddings.store

    def recording(df, *args, **kwargs):
        tables.append(store(df, *args, **kwargs))
        return tables[-1]

    monkeypatch.setattr(embeddings, "store", recording)
    x = np.random.default_rng(4).normal(size=(600, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert result(df) == brute(x, np.arange(len(x)))
    written = sum(t.count() for t in tables if "vector" in t.columns)
    written += sum(r.rows for t in tables if "rows" in t.columns for r in t.collect())
    assert written == 2 * len(x)


def wide(seed=6, n=1500, d=40):
    """Unlike vectors, one large group of near copies, a chain, and repeated vectors."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[100:600] = x[100] + 0.1 * rng.normal(size=(500, d))
    x[600:700] = x[600] + np.arange(100)[:, None] * 0.05 * rng.normal(size=d)
    x[700:900] = x[rng.integers(0, 700, 200)]
    return x[rng.permutation(n)]


@pytest.mark.parametrize(
    ("per_cell", "block", "group"), [(2048, 8192, 65536), (50, 8192, 300), (50, 7, 30), (10**6, 90, 90)]
)
def test_groups_lose_no_link(spark, monkeypatch, per_cell, block, group):
    for name, value in (("PER_CELL", per_cell), ("BLOCK", block), ("GROUP", group)):
        monkeypatch.setattr(embeddings, name, value)
    x = wide()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got, wanted = result(df), brute(x, np.arange(len(x)))
    assert got == wanted
    assert max(n for n, _ in wanted.values()) > 400


def test_lengths_the_sample_does_not_hold(spark, monkeypatch):
    """Their vectors share one cell and are held against each other only."""
    monkeypatch.setattr(embeddings, "SAMPLE", 1)
    x = clustered(n=60, d=3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100 + i, [*v.tolist(), 1.0]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    longer = np.hstack([x.astype(float), np.ones((60, 1))])
    assert result(df) == brute(x.astype(float), np.arange(60)) | brute(longer, np.arange(100, 160))


def test_folded_products_bound_products():
    rng = np.random.default_rng(8)
    wide, narrow = rng.normal(size=(300, 64)), rng.normal(size=(300, 5))
    flat = rng.normal(size=(300, 200)) * 0.9 ** np.arange(200)
    for x in (wide, flat, narrow):
        x = np.vstack([x, x[:50] + 1e-4 * rng.normal(size=(50, x.shape[1]))])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        kept = folded(x.astype(np.float32), fit_axes(x).astype(np.float32))
        assert kept.shape[1] <= x.shape[1] + 1
        assert (kept @ kept.T >= x @ x.T - slack(x.shape[1])).all()


def test_one_class_over_many_batches():
    """Rows of a class that are apart in their batches become one; blocks hold no more than asked."""
    node = np.repeat(np.arange(9), 5)
    x = np.random.default_rng(1).normal(size=(9, 4))
    few = [node[i : i + 4] for i in range(0, 45, 4)]
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(n), pa.array(np.full(len(n), 2)), pa.array(x[n].tolist()), pa.array((n // 7).astype(np.int32))],
            ["node", "copies", "vector", "cell"],
        )
        for n in few
    ]
    found = [(cell, rows["node"].tolist(), rows["copies"].tolist()) for cell, rows in _classes(iter(batches), "<f8", 3)]
    assert [(c, n) for c, n, _ in found] == [(0, [0, 1, 2]), (0, [3, 4, 5]), (0, [6]), (1, [7, 8])]
    assert all(copies == [10] * len(n) for _, n, copies in found)
