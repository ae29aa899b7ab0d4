"""Toxicity severity by cumulative-link ordinal regression on sparse word features."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from threadloom.llm.common import LOWER, blocks, flat, mix, smallest, word_hashes, word_spans
from threadloom.session import store

SAMPLE = 40_000  # most labelled documents to learn from
MOST_FEATURES = 4096  # strongest features kept
SUPPORT = 5  # toxic documents that must hold a feature
Z = 5.0  # how far its rate must be from that of the other documents
GRADES = 3  # grades above 0
PREFIXES = (4, 5, 6, 8)
STEPS = 600
RATE = 0.1
DECAY = 1e-5

# Letters, digits and non-ASCII bytes make words here; the rest reads as a blank.
_WORD = np.full(256, 0x20, np.uint8)
for _b in (*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)):
    _WORD[_b] = LOWER[_b]


def _hashed(texts: pa.Array):
    """(row, feature hashes, hash of the whole word each is of) of every text."""
    data, offsets = flat(texts)
    for first, last in blocks(offsets):
        part = _WORD[data[offsets[first] : offsets[last]]]
        edges = offsets[first : last + 1] - offsets[first]
        starts, ends = word_spans(part, edges)
        hashes = [word_hashes(part, starts, ends)]
        long_enough = [np.arange(len(starts))]
        for n in PREFIXES:
            cut = np.flatnonzero(ends - starts > n)
            stops = starts[cut] + n
            hashes.append(mix(_prefix_hashes(part, starts[cut], stops) + np.uint64(n)))
            long_enough.append(cut)
        for k in range(last - first):
            lo, hi = np.searchsorted(starts, edges[k]), np.searchsorted(starts, edges[k + 1])
            spans = [slice(np.searchsorted(c, lo), np.searchsorted(c, hi)) for c in long_enough]
            own = [h[span] for h, span in zip(hashes, spans, strict=True)]
            words = [hashes[0][c[span]] for c, span in zip(long_enough, spans, strict=True)]
            yield first + k, np.concatenate(own), np.concatenate(words)


def features(texts: pa.Array):
    """(row, sorted distinct feature hashes) of every text: words and their beginnings."""
    for row, own, _ in _hashed(texts):
        yield row, np.unique(own)


_PLACE = mix(np.arange(max(PREFIXES), dtype=np.uint64)) | np.uint64(1)


def _prefix_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for j in range(int((stops - starts).max(initial=0))):
        out += (data[starts + j].astype(np.uint64) + np.uint64(1)) * _PLACE[j]
    return out


def _counted(batches):
    """(feature, toxic, clean): documents that hold it, summed within a batch."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        found = {0: [], 1: []}
        for row, own in features(batch.column("text")):
            found[int(toxic[row])].append(own)
        names, kinds = [], []
        for kind, lists in found.items():
            if lists:
                every = np.concatenate(lists)
                names.append(every)
                kinds.append(np.full(len(every), kind))
        if names:
            value, at = np.unique(np.concatenate(names), return_inverse=True)
            kind = np.concatenate(kinds)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(value.view(np.int64)),
                    pa.array(np.bincount(at, kind, minlength=len(value)).astype(np.int64)),
                    pa.array(np.bincount(at, 1 - kind, minlength=len(value)).astype(np.int64)),
                ],
                ["feature", "toxic", "clean"],
            )


_PRESENT = "struct<x:array<int>,words:int>"


def _present(chosen: np.ndarray):
    """Text -> indices of the chosen features it holds, number of distinct words they are of.

    A word counts once, however many of its beginnings are chosen.
    """

    def apply(texts: pa.Array) -> pa.Array:
        out: list[np.ndarray] = [None] * len(texts)
        marked = np.zeros(len(texts), np.int32)
        for row, own, words in _hashed(texts):
            at = np.searchsorted(chosen, own)
            at[at == len(chosen)] = 0
            hit = chosen[at] == own if len(chosen) else np.zeros(len(own), bool)
            out[row] = np.unique(at[hit])
            marked[row] = len(np.unique(words[hit]))
        sizes = np.array([len(x) for x in out], np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        flat_ = np.concatenate(out) if out else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(flat_.astype(np.int32)))
        return pa.StructArray.from_arrays([lists, pa.array(marked)], ["x", "words"])

    return apply


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of P(grade > k) = sigmoid(x . w - thresholds[k]).

    All thresholds share the weights; they stay in order because each is the one
    before plus a positive step.
    """
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate(rows).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    over = np.array([(grades > k).mean() if len(grades) else 0 for k in range(GRADES)])
    base = -np.log(np.clip(over, 1e-4, 1 - 1e-4) / (1 - np.clip(over, 1e-4, 1 - 1e-4)))
    w = np.zeros(n)
    t = np.concatenate([base[:1], np.log(np.maximum(np.diff(base), 0.05))])
    state = [np.zeros(n + GRADES), np.zeros(n + GRADES)]
    size = max(1, len(rows))
    for step in range(1, STEPS + 1):
        theta = t[0] + np.concatenate([[0], np.cumsum(np.exp(t[1:]))])
        f = np.bincount(owner, w[index], minlength=len(rows))
        above = _sigmoid(f[:, None] - theta[None, :])
        # P(grade = g) = above[g - 1] - above[g]
        edge = np.hstack([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))])
        slope = np.hstack([np.zeros((len(rows), 1)), above * (1 - above), np.zeros((len(rows), 1))])
        at = np.arange(len(rows))
        p = np.maximum(edge[at, grades] - edge[at, grades + 1], 1e-9)
        up, down = slope[at, grades] / p, slope[at, grades + 1] / p
        df = -(up - down)
        gw = np.bincount(index, df[owner], minlength=n) / size + DECAY * w
        gt = np.zeros(GRADES)
        for k in range(GRADES):
            gt[k] = (up * (grades == k + 1) - down * (grades == k)).sum() / size
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([gw, tail[:1], tail[1:] * np.exp(t[1:])])
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.999 * state[1] + 0.001 * g * g
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w, t = w - move[:n], t - move[n:]
    return w, t[0] + np.concatenate([[0], np.cumsum(np.exp(t[1:]))])


class Model:
    def __init__(self, chosen: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.chosen, self.weights, self.thresholds = chosen, weights, thresholds

    def above(self, texts: pa.Array) -> np.ndarray:
        """P(grade > k) of every text."""
        f = np.zeros(len(texts))
        for row, own in features(texts):
            if len(self.chosen):
                at = np.searchsorted(self.chosen, own)
                at[at == len(self.chosen)] = 0
                f[row] = self.weights[at[self.chosen[at] == own]].sum()
        return _sigmoid(f[:, None] - self.thresholds[None, :])


def learn(documents: DataFrame, labels: DataFrame) -> Model:
    """A model from texts and (doc_id, toxic), on at most ``SAMPLE`` labelled documents.

    The documents are those of smallest hash, and as many different texts where
    ids repeat. Document counts of all their words
    and word beginnings are summed in Spark; the features whose rate among toxic
    documents differs most stay (at least ``SUPPORT`` toxic documents, ``Z``
    deviations). Labels only say toxic or not, so the grade of a toxic document
    is 1 to 3 by the number of different marked words it holds (up to 1, up to 3,
    more). A marked word is one that is chosen or begins like a chosen feature.
    Labels without a text and texts without an id are passed over.
    """
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    known = smallest(known, F.xxhash64("doc_id"), ["doc_id"], SAMPLE)
    known = known.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    # At most SAMPLE pairs of numbers, so sending them to every task is safe.
    hashed = docs.withColumn("h", F.xxhash64("text"))
    texts = hashed.join(F.broadcast(known), "doc_id").select("doc_id", "h", "toxic").distinct()
    chosen = store(smallest(texts, F.xxhash64("doc_id", "h"), ["doc_id", "h"], SAMPLE), "chosen")
    sample = store(
        hashed.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).drop("h"), "labelled"
    )
    n1, n = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    n1, n0 = float(max(n1, 1)), float(max(n - n1, 1))
    counts = (
        sample.select("toxic", "text")
        .mapInArrow(_counted, "feature bigint, toxic bigint, clean bigint")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    a, b = F.col("toxic") / n1, F.col("clean") / n0
    both = (F.col("toxic") + F.col("clean")) / (n1 + n0)
    z = (a - b) / F.sqrt(both * (1 - both) * (1 / n1 + 1 / n0) + 1e-12)
    strong = (
        counts.where(F.col("toxic") >= SUPPORT).withColumn("z", z).where(F.col("z") >= Z)
        .orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).select("feature", "z").toArrow()
    )
    chosen = np.sort(strong.column("feature").to_numpy().view(np.uint64))
    rows = (
        sample.select(
            "doc_id", "toxic", F.xxhash64("text").alias("h"),
            arrow_udf(_present(chosen), _PRESENT)(F.col("text")).alias("p"),
        ).select("doc_id", "toxic", "h", "p.x", "p.words").toArrow().sort_by([("doc_id", "ascending"), ("h", "ascending")])
    )
    held = [x.values.to_numpy(zero_copy_only=False) if len(x) else np.zeros(0, np.int32) for x in rows.column("x")]
    toxic = rows.column("toxic").to_numpy()
    number = rows.column("words").to_numpy()
    grades = np.where(toxic > 0, 1 + (number > 1).astype(int) + (number > 3), 0)
    return Model(chosen, *fit(held, grades, len(chosen)))


_SEVERITY = "struct<severity:double,grade:int,toxic:boolean>"


def toxicity(
    documents: DataFrame, model: Model, text: str = "text", name: str = "toxicity"
) -> DataFrame:
    """``documents`` with expected severity (0 to 3), likeliest grade and a flag.

    The expected severity is the sum of P(grade > k); ``toxic`` says that
    P(grade > 0) is at least a half. Whole texts are read. Null and empty texts
    hold no feature. A column called ``name`` is replaced; others and repeated
    rows stay; an empty table gives no rows.
    """

    def score(texts: pa.Array) -> pa.Array:
        above = model.above(texts)
        grade = (above >= 0.5).sum(axis=1).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(above.sum(axis=1)), pa.array(grade), pa.array(grade > 0)],
            ["severity", "grade", "toxic"],
        )

    return documents.withColumn(name, arrow_udf(score, _SEVERITY)(F.col(text).cast("string")))
