"""Hard negatives against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm.hard_negatives import _Best, _Cells, fit_words, hard_negatives, nearest_word


def brute(rows, anchors, positives=5, negatives=10, low=30, high=90):
    """rows: (id, label, whole-number vector as a tuple), no repeats."""
    out = []
    for a, label, q in rows:
        if not anchors(a):
            continue
        scored = [(-sum(x * y for x, y in zip(q, v, strict=True)), i, lab) for i, lab, v in rows if i != a and len(v) == len(q)]
        scored.sort()
        for minus, p, lab in [s for s in scored if s[2] == label][:positives]:
            score = -minus
            fits = [(-m, i) for m, i, other in scored if other != label and low * score <= -100 * m <= high * score]
            out += [(a, p, rank, i, score, s) for rank, (s, i) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def clustered(seed, n=700, d=9, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, d))
    x = centres[rng.integers(0, 25, n)] + rng.normal(size=(n, d)) * spread
    return x, rng.integers(0, 4, n)


def as_rows(x, labels):
    return [(i, int(b), tuple(int(v) for v in np.floor(256 * a))) for i, (a, b) in enumerate(zip(x, labels, strict=True))]


@pytest.mark.parametrize(("per_cell", "group", "spread"), [(512, 256, 0.2), (8, 3, 0.05), (40, 10, 1.0)])
def test_every_window_is_exact(spark, per_cell, group, spread):
    x, labels = clustered(3, spread=spread)
    x[50:70] = x[50]
    df = spark.createDataFrame(
        [(i, v.tolist(), int(b)) for i, (v, b) in enumerate(zip(x, labels, strict=True))],
        "vec_id long, embedding array<double>, label int",
    )
    got = hard_negatives(df, F.col("vec_id") % 10 == 0, per_cell=per_cell, group=group).collect()
    assert sorted(map(tuple, got)) == brute(as_rows(x, labels), lambda i: i % 10 == 0)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(k, [1.0 + k % 5, 0.5 * (k % 7), -1.0], k % 3) for k in range(40)]
    bad = [
        (100, None, 1), (110, [nan, 1.0, 1.0], 1), (120, [inf, 1.0, 1.0], 1), (130, [None, 1.0, 1.0], 1),
        (140, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (150, [1e30, 1.0, 1.0], 1),
    ]
    other = [(200, [2.0], 0), (201, [3.0], 0), (202, [1.0], 1), (210, [], 0), (211, [], 0), (212, [], 1)]
    rows = [(*r, "x", 5) for r in good + good[:9] + bad + other + [(10, [9.0, 9.0, 9.0], 2)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rank string, anchor_id int")
    kept = good + other + [(10, [9.0, 9.0, 9.0], 2)]
    plain = [(i, lab, tuple(int(np.floor(256 * c)) for c in v)) for i, v, lab in kept]
    got = hard_negatives(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == brute(plain, lambda i: i % 10 == 0)
    assert hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives(df, F.lit(None).cast("boolean")).collect() == []


def test_large_components_stay_whole_numbers(spark):
    rng = np.random.default_rng(8)
    whole = rng.integers(-(2**28), 2**28, (60, 4))
    whole[30:] = whole[:30] + rng.integers(-2, 3, (30, 4))
    df = spark.createDataFrame(
        [(i, [float(c) / 256 for c in v], i % 3) for i, v in enumerate(whole.tolist())],
        "vec_id long, embedding array<double>, label int",
    )
    rows = [(i, i % 3, tuple(v)) for i, v in enumerate(whole.tolist())]
    got = hard_negatives(df, F.col("vec_id") < 20, low=10, high=100).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i < 20, low=10, high=100)


def make_cells(x, words=6):
    half = x.shape[1] // 2
    left, right = fit_words(x[:, :half], words), fit_words(x[:, half:], words)
    i, j = nearest_word(x[:, :half], left), nearest_word(x[:, half:], right)
    runs = []
    for a, b in sorted(set(zip(i.tolist(), j.tolist(), strict=True))):
        here = x[(i == a) & (j == b)]
        runs.append((a, b, "f", 0, len(here), np.linalg.norm(here[:, :half] - left[a], axis=1).max(),
                     np.linalg.norm(here[:, half:] - right[b], axis=1).max(), np.linalg.norm(here, axis=1).max()))
    return _Cells(x.shape[1], (left, right), runs), i, j


def test_walk_is_sorted_whole_and_bounds_hold():
    x = 256 * clustered(5)[0]
    cells, i, j = make_cells(x)
    for q in x[:20]:
        seen = list(cells.visits(q))
        assert [b for b, *_ in seen] == sorted((b for b, *_ in seen), reverse=True)
        assert sorted((a, b) for _, a, b in seen) == sorted(cells.runs)
        for bound, a, b in seen:
            scores = x[(i == a) & (j == b)] @ q
            (run,) = cells.runs[a, b]
            low, high = cells.range_of(q, a, b, run)
            assert low <= scores.min() and scores.max() <= high <= bound + 1e-6


def test_clusters_close_windows_early():
    x = 256 * clustered(6, spread=0.02)[0]
    cells, *_ = make_cells(x, 25)
    q, closed = x[0], 0
    best = _Best(5)
    for bound, a, b in cells.visits(q):
        if best.certain(bound):
            break
        closed += 1
        i = nearest_word(x[:, : cells.half], cells.left), nearest_word(x[:, cells.half :], cells.right)
        here = np.flatnonzero((i[0] == a) & (i[1] == b))
        best.offer(np.floor(x[here] @ q).astype(np.int64), here)
    assert closed < len(cells.runs) / 3


def test_best_keeps_smaller_ids_of_equal_scores():
    best = _Best(3, low=2, high=9)
    best.offer(np.array([5, 5, 10, 1]), np.array([7, 4, 1, 2]))
    best.offer(np.array([5, 5, 6]), np.array([3, 9, 8]))
    assert list(zip(best.scores, best.ids, strict=True)) == [(6, 8), (5, 3), (5, 4)]
    assert best.certain(4) and not best.certain(5)
