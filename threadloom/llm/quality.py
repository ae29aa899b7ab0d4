"""Quality classifier by positive-unlabelled learning on style features of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from threadloom.llm.common import blocks, flat, smallest, word_hashes, word_spans
from threadloom.session import store

POSITIVES = 20_000  # most trusted positives to learn from
UNLABELLED = 20_000  # most unlabelled texts to learn from
STEPS = 400
RATE = 0.05
DECAY = 1e-4
THRESHOLD = 0.7

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_OTHER = 14
FEATURES = len(_MARKS) + _OTHER


def style(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES numbers per text, zeros where a text has no word.

    Shares of bytes (each ASCII mark, digits, capitals, non-ASCII, blanks, line
    ends) as square roots, and word figures: length, variety, immediate repeats,
    share of the commonest word, words without letters, in capitals or ending in
    a mark, words and lines in all on a log scale.
    """
    data, offsets = flat(texts)
    out = np.zeros((len(texts), FEATURES))
    for first, last in blocks(offsets):
        part = data[offsets[first] : offsets[last]]
        edges = offsets[first : last + 1] - offsets[first]
        starts, ends = word_spans(part, edges)
        words = word_hashes(part, starts, ends)
        letters = np.concatenate([[0], np.cumsum(_LETTER[part])])
        capitals = np.concatenate([[0], np.cumsum(_UPPER[part])])
        lettered = letters[ends] - letters[starts]
        capital = capitals[ends] - capitals[starts]
        marked = ~_LETTER[part[ends - 1]] if len(ends) else np.zeros(0, bool)
        at = np.searchsorted(starts, edges)
        for k in range(last - first):
            lo, hi = int(at[k]), int(at[k + 1])
            if lo == hi:
                continue
            text = part[edges[k] : edges[k + 1]]
            count = np.bincount(text, minlength=256)
            n, w = len(text), hi - lo
            own = words[lo:hi]
            _, times = np.unique(own, return_counts=True)
            row = out[first + k]
            row[: len(_MARKS)] = np.sqrt(count[_MARKS] / n)
            row[len(_MARKS) :] = (
                np.sqrt(count[48:58].sum() / n),
                np.sqrt(count[65:91].sum() / n),
                np.sqrt(count[128:].sum() / n),
                np.sqrt(count[32] / n),
                np.sqrt(count[10] / n),
                np.log((ends[lo:hi] - starts[lo:hi]).mean()),
                len(times) / w,
                np.sqrt((own[1:] == own[:-1]).sum() / w),
                np.sqrt(times.max() / w),
                np.sqrt((lettered[lo:hi] == 0).sum() / w),
                np.sqrt(((capital[lo:hi] > 1) & (capital[lo:hi] == lettered[lo:hi])).sum() / w),
                np.sqrt(marked[lo:hi].sum() / w),
                np.log1p(w) / 10,
                np.log1p(count[10]) / 10,
            )
    return out


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> dict[str, np.ndarray]:
    """Weights that minimise the non-negative positive-unlabelled logistic risk.

    risk = prior * E+[loss(+f)] + max(0, Eu[loss(-f)] - prior * E+[loss(-f)]).
    Where the part in the bracket is negative the step goes back along it, so
    that the risk of the unseen negatives is not driven below zero. Features are
    scaled by the mean and deviation of both samples.
    """
    both = np.concatenate([positive, unlabelled])
    if not len(both):
        return {"mean": np.zeros(FEATURES), "scale": np.ones(FEATURES), "w": np.zeros(FEATURES + 1)}
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    del both

    def scaled(x: np.ndarray) -> np.ndarray:
        out = np.ones((len(x), FEATURES + 1))
        np.clip((x - mean) / scale, -8, 8, out=out[:, :-1])
        return out

    p, u = scaled(positive), scaled(unlabelled)
    w = np.zeros(FEATURES + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        fp, fu = p @ w, u @ w
        sp, su = _sigmoid(fp), _sigmoid(fu)
        up = -prior * ((1 - sp) @ p) / max(1, len(p))
        down = (su @ u) / max(1, len(u)) - prior * (sp @ p) / max(1, len(p))
        negative = np.logaddexp(0, fu).sum() / max(1, len(u)) - prior * np.logaddexp(
            0, fp
        ).sum() / max(1, len(p))
        gradient = up + down if negative >= 0 else -down
        gradient = gradient + DECAY * np.append(w[:-1], 0)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w = w - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return {"mean": mean, "scale": scale, "w": w}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def apply_model(features: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    scaled = np.clip((features - model["mean"]) / model["scale"], -8, 8)
    return _sigmoid(scaled @ model["w"][:-1] + model["w"][-1])


def _styled(texts: pa.Array) -> pa.Array:
    found = style(texts)
    edges = pa.array((np.arange(len(found) + 1) * FEATURES).astype(np.int32))
    return pa.ListArray.from_arrays(edges, pa.array(found.reshape(-1)))


def _scorer(model: dict[str, np.ndarray]):
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(apply_model(style(texts), model))

    return score


def is_held_out(doc_id: str = "doc_id"):
    """Rows whose labels are kept for the test: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(documents: DataFrame, ids: DataFrame, most: int) -> np.ndarray:
    """Features of at most ``most`` different texts of the documents in ``ids``, itself as bounded."""
    hashed = documents.withColumn("h", F.xxhash64("text"))
    texts = hashed.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "h").distinct()
    chosen = store(smallest(texts, F.xxhash64("doc_id", "h"), ["doc_id", "h"], most), "chosen")
    rows = (
        hashed.join(F.broadcast(chosen), ["doc_id", "h"], "left_semi")
        .select("doc_id", "h", arrow_udf(_styled, "array<double>")(F.col("text")).alias("x"))
        .dropDuplicates(["doc_id", "h"])
        .toArrow().sort_by([("doc_id", "ascending"), ("h", "ascending")])
    )
    x = rows.column("x").combine_chunks()
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), FEATURES)


def learn(documents: DataFrame, labels: DataFrame) -> dict[str, np.ndarray]:
    """A model from texts and (doc_id, quality), without the held-out rows.

    Trusted positives are at most ``POSITIVES`` documents labelled 1, unlabelled
    texts at most ``UNLABELLED`` others or the same, both those of smallest hash,
    and as many different texts where ids repeat; no label of the latter is used. The class prior is the share of 1 among all
    labels that may be learnt from. Documents with conflicting labels count as
    both. Labels without a text and texts without an id are passed over.
    """
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    known = labels.where(~is_held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    share = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    prior = min(0.98, max(0.02, share if share is not None else 0.5))
    positives = known.where("quality = 1").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    trusted = smallest(positives, F.xxhash64("doc_id", F.lit("rank")), ["doc_id"], POSITIVES)
    others = docs.where(~is_held_out() & F.col("doc_id").isNotNull()).select("doc_id")
    drawn = smallest(others, F.xxhash64("doc_id", F.lit("draw")), ["doc_id"], UNLABELLED).distinct()
    model = fit(_features(docs, trusted, POSITIVES), _features(docs, drawn, UNLABELLED), prior)
    pa.default_memory_pool().release_unused()
    return model


def quality_scores(
    documents: DataFrame, model: dict[str, np.ndarray], text: str = "text", name: str = "score"
) -> DataFrame:
    """``documents`` with the chance that a whole text is of good quality.

    Nothing but the text is read. Null, empty and blank texts get the score of a
    text without any mark or word. A column called ``name`` is replaced; others
    and repeated rows stay; an empty table gives no rows.
    """
    score = arrow_udf(_scorer(model), "double")
    return documents.withColumn(name, score(F.col(text).cast("string")))
