"""Near-duplicates against brute force over all shingle sets."""

import collections
import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom import session
from threadloom.llm import common, near_dup
from threadloom.llm.components import components
from threadloom.session import runtime_conf, shared_dir

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """{id: (n_shingles, smallest reachable id)} of (id, text) with unique ids."""
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = collections.defaultdict(list)
    for i in sorted(sets):
        seen = collections.Counter(j for s in sets[i] for j in holders[s])
        for j, n in seen.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                up[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df).collect()}


def near_copies(seed=1, groups=6, copies=25):
    """Groups whose members have all similarities around the threshold."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(9)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(words)))
    return rows


def test_groups_around_the_threshold(spark):
    rows = near_copies()
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_small_blocks_and_one_hub_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 5)
    monkeypatch.setattr(near_dup, "NODES", 4)
    monkeypatch.setattr(near_dup, "SHINGLES", 900)
    monkeypatch.setattr(near_dup, "HUBS", 1)
    rows = near_copies(seed=2, groups=3)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_defined_cases(spark):
    rows = [
        (9, "One two\tthree", 1), (4, "one TWO three", 2), (5, None, 3), (6, "", 4), (7, " \n", 5),
        (None, "one two three", 6), (8, "É b c d e f", 7), (3, "é b c d e f", 8),
        (20, "a b c d e f g h", 9), (20, "a b c d e f g h", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(map(tuple, near_dup.near_duplicates(df).collect()), key=str)
    assert sorted(got, key=str) == sorted(
        [
            (9, 1, 4, False), (4, 1, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True),
            (None, 1, None, False), (8, 2, 8, True), (3, 2, 3, True),
            (20, 4, 20, True), (20, 4, 20, True),
        ],
        key=str,
    )
    assert near_dup.near_duplicates(df.limit(0)).collect() == []


def test_very_long_text_and_long_word(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, long), (2, long + " end"), (3, "x" * 3_000_000), (4, "x" * 3_000_000)]
    got = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == {1: (199_996, 1), 2: (199_997, 1), 3: (1, 3), 4: (1, 3)}


def test_pruning_keeps_what_reaches_the_threshold():
    least = near_dup.least_matches()
    assert list(least) == sorted(least)
    rng = np.random.default_rng(0)
    left = rng.integers(0, 256, (4000, near_dup.HASHES), dtype=np.uint8)
    right = np.where(rng.random(left.shape) < 0.75, left, left + np.uint8(1))
    assert len(near_dup.likely(left, right, least)) == 4000
    assert len(near_dup.likely(left, left[::-1], least)) == 0


@pytest.mark.parametrize("seed", range(2))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [
        (i + 1000, i + 1001) for i in range(60)
    ]
    up = {i: i for link in links for i in link}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {
        i: top(i) for a, b in links if a != b for i in (a, b)
    }
    assert len(got) == len({r.node for r in got})


def test_likely_pairs_that_are_no_links_stay_in_their_task():
    """Texts of one group, none of them linked, nearly all of them likely: at most a row per text."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(80)]
    sets, sigs = [], []
    for k in range(150):
        words = list(base)
        for at in rng.choice(16, 3, replace=False):
            words[5 * at] = f"x{k}-{at}"
        (found,) = near_dup.shingle_sets(pa.array([" ".join(words)]))
        sets.append(found)
        sigs.append(near_dup.signature(found).astype(np.uint8).tobytes())
    n = len(sets)
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([1] * n), pa.array([0] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.array(range(n)),
            pa.array(range(n)), pa.array([0] * n, pa.int32()), pa.array(sigs, pa.binary()),
            pa.array([s.tobytes() for s in sets], pa.binary()),
        ],
        ["bucket", "_i", "_j", "key", "root", "_side", "sig", "shingles"],
    )
    table = np.stack([np.frombuffer(s, np.uint8) for s in sigs])
    least = near_dup.least_matches()
    pairs = sum(len(near_dup.likely(np.broadcast_to(t, table.shape), table, least)) - 1 for t in table) // 2
    assert pairs > 3 * n
    (met,) = near_dup._meet([batch])
    assert met.num_rows < n
    (links,) = near_dup._verify([batch.rename_columns(["cluster", *batch.schema.names[1:]])])

    def linked(x, y):
        shared = len(np.intersect1d(sets[x], sets[y]))
        return 100 * shared >= 75 * (len(sets[x]) + len(sets[y]) - shared)

    top = list(range(n))
    for x in range(n):
        for y in range(x):
            if linked(x, y) and top[x] != top[y]:
                top = [top[y] if t == top[x] else t for t in top]
    joined = list(range(n))
    for x, y in zip(*(c.to_pylist() for c in links.columns), strict=True):
        assert linked(x, y)
        joined = [joined[y] if t == joined[x] else t for t in joined]
    same = {(x, y) for x in range(n) for y in range(n) if top[x] == top[y]}
    assert same == {(x, y) for x in range(n) for y in range(n) if joined[x] == joined[y]}


def test_rounds_of_small_components_write_few_files(spark):
    """Every file of a small table costs an executor its set-up, whatever its size."""
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    before = set(Path(shared_dir(spark).removeprefix("file:")).glob("links-*"))
    with runtime_conf(
        spark, spark__sql__shuffle__partitions="40", spark__sql__adaptive__coalescePartitions__enabled="false"
    ):
        found = components(links)
        assert found.groupBy("root").count().collect() == [(0, 201)]
    rounds = set(Path(shared_dir(spark).removeprefix("file:")).glob("links-*")) - before
    files = sorted(len(list(path.glob("part-*"))) for path in rounds)
    # The first table is written as its links come, its size not being known.
    assert len(files) > 2 and files[-2] <= 2


def test_stored_rows_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_FILE", 10)
    many = session.store(spark.range(0, 100, 1, 30), "many", rows=100)
    assert many.count() == 100 and len(many.inputFiles()) == 10
    few = session.store(spark.range(0, 100, 1, 30), "few", rows=0)
    assert few.count() == 100 and len(few.inputFiles()) == 2


def test_hashes_of_words_need_no_large_tables():
    assert sum(table.nbytes for table in common._tables()) <= 1 << 23
