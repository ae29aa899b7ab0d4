"""Benchmark decontamination: q-gram lemma filter in diagonal bands, banded alignment."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from threadloom.llm.common import LOWER, SPACE, blocks, flat

Q = 8  # bytes of a gram; eight fit one integer, so grams are compared exactly
RATE = 0.08  # edits allowed per byte of a passage
SHARD = 4 << 20  # bytes of passages that one pass over the documents looks for
_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20
_APART = 0xFF  # never a byte of UTF-8

HITS = "array<struct<item_id:bigint,start:bigint,stop:bigint,edits:int>>"


def normalised(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, index of each in ``data``): A-Z as a-z, a run of white space as one blank."""
    space = SPACE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    at = np.flatnonzero(keep)
    return np.where(space[at], np.uint8(0x20), LOWER[data[at]]), at


def pieces(data: np.ndarray, overlap: int, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of a long text, each going on for ``overlap`` normalised bytes into the next.

    A stretch of that many normalised bytes lies whole in the range it begins in,
    however much white space it holds.
    """
    for lo in range(0, len(data), size):
        end = hi = min(len(data), lo + size)
        held = 0
        while held < overlap and end < len(data):
            more = data[end - 1 : min(len(data), end + max(overlap, 4096))]
            space = SPACE[more]
            held += int((~(space[1:] & space[:-1])).sum())
            end += len(more) - 1
        yield lo, max(hi, end)


def grams(data: np.ndarray) -> np.ndarray:
    """Every window of Q bytes as an integer."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    return np.ndarray((len(data) - Q + 1,), "<u8", data, 0, (1,)).astype(np.uint64)


def budget(length: int, rate: float = RATE) -> int:
    """Edits allowed for a passage; at least one gram must survive them."""
    return max(0, min(int(rate * length), (length - Q) // Q))


class Passages:
    """The passages of one shard with their gram index."""

    def __init__(self, items: Sequence[tuple[int, str]], rate: float):
        self.ids, self.texts = [], []
        for item_id, text in items:
            found = normalised(np.frombuffer((text or "").encode(), np.uint8))[0]
            found = np.frombuffer(found.tobytes().strip(b" "), np.uint8)
            if len(found) >= Q:
                self.ids.append(item_id)
                self.texts.append(found)
        self.edits = np.array([budget(len(t), rate) for t in self.texts], np.int64)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.sizes = sizes
        # An occurrence with e edits keeps this many of the passage's grams.
        self.least = sizes - Q + 1 - Q * self.edits
        codes = [grams(t) for t in self.texts]
        owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else owner
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.code, self.first = np.unique(code[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(code)))
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self.spread(self.code)] = True
        self.overlap = int((sizes + 2 * self.edits).max(initial=0)) + Q

    @staticmethod
    def spread(code: np.ndarray) -> np.ndarray:
        return ((code * _SPREAD) >> np.uint64(64 - _BITS)).astype(np.int64)

    def regions(self, data: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """(doc, passage, lowest diagonal, highest diagonal) of regions worth aligning.

        The grams an occurrence with e edits shares with its passage lie within
        2e + 1 neighbouring diagonals. Bands are twice as wide and overlap by
        half, so one band holds them all; bands with fewer different grams of the
        passage than the lemma asks for are dropped.
        """
        code = grams(data)
        at = np.flatnonzero(self.maybe[self.spread(code)])
        slot = np.searchsorted(self.code, code[at])
        slot[slot == len(self.code)] = 0
        real = self.code[slot] == code[at]
        at, slot = at[real], slot[real]
        count = self.count[slot]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        entry = np.repeat(self.first[slot], count) + step
        item = self.owner[entry]
        diagonal = np.repeat(at, count) - self.place[entry]
        owner = np.repeat(doc[at], count)
        width = 2 * self.edits[item] + 1
        band = np.floor_divide(diagonal, width)
        place = self.place[entry]
        # A pair of text and passage with too few grams in all has no such band.
        pair = owner * len(self.ids) + item
        _, group, total = np.unique(pair, return_inverse=True, return_counts=True)
        near = total[group] >= self.least[item]
        item, owner, diagonal, band, place = (
            x[near] for x in (item, owner, diagonal, band, place)
        )
        item, owner, place = np.tile(item, 2), np.tile(owner, 2), np.tile(place, 2)
        diagonal = np.tile(diagonal, 2)
        band = np.concatenate([band, band - 1])
        order = np.lexsort((place, band, item, owner))
        if not len(order):
            return np.zeros((0, 4), np.int64)
        item, owner, band = item[order], owner[order], band[order]
        diagonal, place = diagonal[order], place[order]
        new = np.ones(len(order), bool)
        new[1:] = (item[1:] != item[:-1]) | (owner[1:] != owner[:-1]) | (band[1:] != band[:-1])
        first = np.flatnonzero(new)
        other = new.copy()
        other[1:] |= place[1:] != place[:-1]
        number = np.add.reduceat(other.astype(np.int64), first)
        low = np.minimum.reduceat(diagonal, first)
        high = np.maximum.reduceat(diagonal, first)
        good = number >= self.least[item[first]]
        return np.stack([owner[first], item[first], low, high], axis=1)[good]

    def align(self, k: int, text: np.ndarray, low: int, high: int) -> tuple[int, int, int] | None:
        """(edits, start, stop) of the best occurrence of passage k around these diagonals.

        Cell (i, j) of the band holds the fewest edits between the first i bytes
        of the passage and a stretch of the text that ends at diagonal j; it may
        begin anywhere. Null when the budget is exceeded.
        """
        item, most = self.texts[k], int(self.edits[k])
        begin = max(0, low)
        exact = text[begin : high + len(item)].tobytes().find(item.tobytes())
        if exact >= 0:
            return 0, begin + exact, begin + exact + len(item)
        base, n = low - most, high - low + 2 * most + 1
        diagonals = base + np.arange(n)
        step = np.arange(n)
        far = np.int64(1 << 30)
        padded = np.full(n + len(item), _APART, np.int64)
        lo, hi = max(0, base), min(len(text), base + len(padded))
        padded[lo - base : hi - base] = text[lo:hi]
        inside = (diagonals >= 0) & (diagonals <= len(text))
        cost, start = np.where(inside, 0, far), diagonals.copy()
        drop, moved = np.full(n, far), np.zeros(n, np.int64)
        for i, byte in enumerate(item.tolist()):
            # Diagonal d at row i + 1 ends before text byte d + i + 1.
            same = cost + (padded[i : i + n] != byte)
            drop[:-1] = cost[1:] + 1
            moved[:-1] = start[1:]
            better = drop < same
            cost = np.where(better, drop, same)
            start = np.where(better, moved, start)
            end = diagonals + i + 1
            cost = np.where((end < 0) | (end > len(text)), far, cost)
            reach = np.minimum.accumulate(cost - step)
            source = np.maximum.accumulate(np.where(cost - step == reach, step, 0))
            cost, start = reach + step, start[source]
        best = int(cost.argmin())
        if cost[best] > most:
            return None
        return int(cost[best]), int(start[best]), int(diagonals[best] + len(item))


def _finder(items: Sequence[tuple[int, str]], rate: float):
    held: list[Passages] = []

    def apply(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Passages(items, rate))
        passages = held[0]
        data, offsets = flat(texts)
        found: list[dict] = [{} for _ in range(len(texts))]
        for first, last in blocks(offsets):
            begin, end = int(offsets[first]), int(offsets[last])
            if end - begin <= 2 * _PIECE:
                _look(passages, data, offsets, first, last, begin, end, found)
                continue
            for lo, hi in pieces(data[begin:end], 4 * passages.overlap, _PIECE):  # one long text
                _look(passages, data, offsets, first, last, begin + lo, begin + hi, found)
        return _as_hits(found, texts)

    return apply


def _look(passages, data, offsets, first, last, lo, hi, found) -> None:
    parts, places, docs = [], [], []
    for row in range(first, last):
        a, b = max(int(offsets[row]), lo), min(int(offsets[row + 1]), hi)
        if b - a < Q:
            continue
        text, at = normalised(data[a:b])
        parts += [text, np.array([_APART], np.uint8)]
        places.append((row, text, at + a - offsets[row]))
        docs.append(len(text) + 1)
    if not parts:
        return
    joined = np.concatenate(parts)
    starts = np.cumsum(docs) - docs
    owner = np.repeat(np.arange(len(docs)), docs)
    for doc, item, low, high in passages.regions(joined, owner).tolist():
        row, text, at = places[doc]
        best = found[row].get((item, passages.ids[item]))
        if best is not None and best[2] == 0:
            continue  # regions come in text order, so no other beats it
        if len(text) < passages.sizes[item] - passages.edits[item]:
            continue
        hit = passages.align(item, text, low - int(starts[doc]), high - int(starts[doc]))
        if hit is None:
            continue
        edits, start, stop = hit
        start = int(at[start]) if start < len(at) else int(at[-1])
        stop = int(at[stop - 1]) + 1 if stop else 0
        item_id = passages.ids[item]
        best = found[row].get((item, item_id))
        if best is None or (edits, start) < (best[2], best[0]):
            found[row][item, item_id] = (start, stop, edits)


def _as_hits(found: list[dict], texts: pa.Array) -> pa.Array:
    """Byte positions to code points, and the lists of hits."""
    out = []
    for row, hits in enumerate(found):
        if hits:
            raw = texts[row].as_buffer().to_pybytes()
            hits = [
                {
                    "item_id": item_id,
                    "start": len(raw[:start].decode(errors="ignore")),
                    "stop": len(raw[:stop].decode(errors="ignore")),
                    "edits": edits,
                }
                for (_, item_id), (start, stop, edits) in sorted(
                    hits.items(), key=lambda hit: (hit[1], hit[0][0])
                )
            ]
        out.append(hits or [])
    fields = [("item_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("edits", pa.int32())]
    return pa.array(out, pa.list_(pa.struct(fields)))


def benchmark_hits(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    name: str = "hits",
    rate: float = RATE,
    shard: int = SHARD,
) -> DataFrame:
    """``documents`` with the passages of ``benchmark`` (item_id, text) that each text holds.

    A passage is found where a stretch of the text is within ``rate`` edits per
    byte of the whole passage, after A-Z became a-z and runs of white space one
    blank; every such text is found. Each hit has item_id, start and stop (code
    points of the text) and the number of edits; of several occurrences of one
    passage the best, then the first, is reported.

    The passages are sent to the tasks in shards of about ``shard`` bytes; more
    passages mean more passes over the text, never a larger table in a task.
    Null texts and texts shorter than a passage hold none; null, empty and
    passages of fewer than 8 bytes are never found; equal passages are all
    reported. A column called ``name`` is replaced; other columns and repeated
    rows stay.
    """
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard))
    out = documents.withColumn(name, F.array().cast(HITS))
    for k in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k)
        rows = [(row.item_id, row.text) for row in part.orderBy("item_id", "text").toLocalIterator()]
        if rows:
            find = arrow_udf(_finder(rows, rate), HITS)
            more = find(F.col(text).cast("string"))
            out = out.withColumn(name, more if shards == 1 else F.concat(name, more))
    return out


def contaminated(hits: str = "hits"):
    return F.size(hits) > 0
