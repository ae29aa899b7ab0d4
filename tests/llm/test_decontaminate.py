"""Benchmark passages against full edit-distance tables."""

import random

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import decontaminate
from threadloom.llm.decontaminate import RATE, benchmark_hits, budget, normalised


def plain(text):
    return normalised(np.frombuffer((text or "").encode(), np.uint8))[0].tobytes()


def distance(item, text):
    """Fewest edits that turn the item into some stretch of the text."""
    above = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j - 1] + (a != b), above[j] + 1, row[-1] + 1))
        above = row
    return min(above)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(text)), rng.randrange(3)
        if kind == 0:
            text[at] = rng.choice("abcé ")
        elif kind == 1:
            text.insert(at, rng.choice("abcé "))
        else:
            del text[at]
    return "".join(text)


def test_edits_around_the_budget(spark):
    rng = random.Random(1)
    words = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7))) for _ in range(n))
    items = [(i, words(14)) for i in range(12)]
    docs = []
    for i, item in items * 5:
        most = budget(len(plain(item)))
        docs.append((len(docs), f"{words(9)} {edited(rng, item, rng.randrange(most + 4))} {words(9)}"))
    found = benchmark_hits(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    for row in found:
        want = {}
        for i, item in items:
            item = plain(item).strip()
            edits = distance(item, plain(row.text))
            if edits <= budget(len(item)):
                want[i] = edits
        assert {h.item_id: h.edits for h in row.hits} == want


def test_whole_table_holds_every_exact_passage(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    passages = {r.item_id: plain(r.text).strip() for r in items.collect()}
    rows = benchmark_hits(docs, items).collect()
    assert len(rows) == docs.count()
    for row in rows:
        exact = {i for i, p in passages.items() if p in plain(row.text)}
        assert exact == {h.item_id for h in row.hits if h.edits == 0}
        for h in row.hits:
            edits = distance(passages[h.item_id], plain(row.text[h.start : h.stop]))
            assert edits <= h.edits <= RATE * len(passages[h.item_id])


@pytest.mark.parametrize("shard", [1 << 22, 60])
def test_defined_cases(spark, shard):
    item = "The quick brown fox jumps over the lazy dog near the river"
    docs = [
        (1, f"x  THE quick\n\nbrown fox jumps over the lazy dog near the river. {item}", "a"), (2, None, "b"),
        (3, "", "c"), (None, item, "d"), (4, item[:-30], "e"), (4, item[:-30], "e"), (5, "ééé " * 300_000 + item, "f"),
    ]
    items = [(1, item), (2, item), (3, None), (4, ""), (5, "short"), (None, "an item without any identifier")]
    out = benchmark_hits(
        spark.createDataFrame(docs, "doc_id long, text string, hits string"),
        spark.createDataFrame(items, "item_id long, text string"),
        shard=shard,
    )
    rows = out.collect()
    assert [sorted(h.item_id for h in r.hits) for r in rows] == [[1, 2], [], [], [1, 2], [], [], [1, 2]]
    assert rows[0].hits[0].start == 3
    hit = rows[6].hits[0]
    assert (hit.start, hit.stop, hit.edits) == (1_200_000, 1_200_000 + len(item), 0)
    empty = out.sparkSession.createDataFrame([], "item_id long, text string")
    assert all(r.hits == [] for r in benchmark_hits(out.drop("hits"), empty).collect())
    assert benchmark_hits(out.limit(0), empty).collect() == []


def test_pieces_of_a_long_text_overlap(monkeypatch):
    monkeypatch.setattr(decontaminate, "_PIECE", 100)
    rng = random.Random(2)
    item = "".join(rng.choice("abcdefgh ") for _ in range(90)).strip()
    find = decontaminate._finder([(7, item)], RATE)
    for lead in range(60, 130):
        text = "z" * lead + item + "y" * 150
        (hit,) = find(pa.array([text]))[0].as_py()
        assert (hit["start"], hit["stop"]) == (lead, lead + len(item))


@pytest.mark.parametrize("run", [1, 2, 20, 60, 1000])
def test_white_space_does_not_part_a_passage(monkeypatch, run):
    """A passage whose words stand far apart, begun at every offset around a border."""
    monkeypatch.setattr(decontaminate, "_PIECE", 500)
    rng = random.Random(run)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(12)]
    find = decontaminate._finder([(7, " ".join(words))], RATE)
    item = "".join(w + (" " if k % 2 else "\n") * run for k, w in enumerate(words)).strip()
    for lead in [*range(440, 510, 7 if run > 100 else 1), 900, 999, 1000, 1001]:
        text = "z" * lead + " " + item + " " + "y" * 1500
        (hit,) = find(pa.array([text]))[0].as_py()
        assert (hit["start"], hit["stop"], hit["edits"]) == (lead + 1, lead + 1 + len(item), 0)


def test_pieces_cover_a_text():
    data = np.frombuffer(b"ab " * 50 + b" " * 3000 + b"word " * 100, np.uint8)
    found = list(decontaminate.pieces(data, 40, 100))
    assert [lo for lo, _ in found] == list(range(0, len(data), 100)) and found[-1][1] == len(data)
    for lo, hi in found:
        assert hi == len(data) or len(decontaminate.normalised(data[min(len(data), lo + 100) : hi])[0]) >= 40
