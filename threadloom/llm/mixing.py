"""Mixing sources to target weights by weighted pivotal rounding in a reduction tree."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import runs
from threadloom.operators.numbering import number_rows
from threadloom.session import store

WEIGHTS = (3, 1, 2)  # by the order of the sources, repeating
SHARE = 1.5  # words of the mix to words of the input
CAP = 2.0  # no source is taken more often than this
GROUP = 50_000  # rows that one node of the reduction tree settles


def settle(
    p: np.ndarray, w: np.ndarray, rng: np.random.Generator, last: bool = False
) -> np.ndarray:
    """Make all but one of the probabilities ``p`` 0 or 1 while sum(w * p) stays.

    Neighbours are paired; weighted mass moves from one to the other, either way
    with the odds that keep each expectation, until one of them is 0 or 1. What
    is left of every pair meets in the next round. ``last`` also rounds the one
    that remains. Weights are positive.
    """
    p = p.copy()
    alive = np.flatnonzero((p > 0) & (p < 1))
    while len(alive) > 1:
        even = len(alive) // 2 * 2
        i, j = alive[0:even:2], alive[1:even:2]
        up_i, down_j = w[i] * (1 - p[i]), w[j] * p[j]
        down_i, up_j = w[i] * p[i], w[j] * (1 - p[j])
        to_i, to_j = np.minimum(up_i, down_j), np.minimum(down_i, up_j)
        first = rng.random(len(i)) * (to_i + to_j) < to_j
        move = np.where(first, to_i, -to_j)
        new_i, new_j = p[i] + move / w[i], p[j] - move / w[j]
        # Exactly, whatever the rounding of the divisions.
        new_i = np.where(first & (up_i <= down_j), 1.0, new_i)
        new_j = np.where(first & (down_j <= up_i), 0.0, new_j)
        new_i = np.where(~first & (down_i <= up_j), 0.0, new_i)
        new_j = np.where(~first & (up_j <= down_i), 1.0, new_j)
        p[i], p[j] = np.clip(new_i, 0, 1), np.clip(new_j, 0, 1)
        alive = alive[(p[alive] > 0) & (p[alive] < 1)]
    if last and len(alive):
        p[alive] = rng.random(1) < p[alive]
    return p


def _settler(seed: int, level: int, last: bool):
    def apply(batches):
        for rows in runs(batches, ["_nth", "_g"]):
            key = [rows.column(c)[0].as_py() for c in ("_nth", "_g")]
            rng = np.random.default_rng([seed, level, *key])
            p = settle(
                rows.column("_p").to_numpy(), rows.column("size").to_numpy().astype(float), rng, last
            )
            at = rows.column_names.index("_p")
            for batch in rows.set_column(at, "_p", pa.array(p)).to_batches():
                yield batch

    return apply


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """source, source_size, target, n and ``_nth`` of every source of (source, size).

    Sources in code-point order, null last, get the weights in turn. A target
    above ``cap`` times its source's size is cut to that, and the rest goes to
    the others by weight until none is above: each round is one aggregate over
    the sources, and only three sums come to the driver.
    """
    per_source = number_rows(
        sizes.groupBy("source").agg(
            F.sum("size").cast("bigint").alias("source_size"), F.count(F.lit(1)).alias("n")
        ),
        [F.col("source").asc_nulls_last()],
        "_nth",
        partitions=1 + len(weights),
    )
    turn = F.array(*[F.lit(float(x)) for x in weights])
    weighed = store(
        per_source.withColumn(
            "_w", F.element_at(turn, (F.col("_nth") % len(weights) + 1).cast("int"))
        ),
        "sources",
    )
    limit = F.col("source_size") * F.lit(float(cap))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    rate, capped_before = 0.0, None
    while True:
        above = F.col("_w") * F.lit(rate) > limit
        full, open_weight, capped = weighed.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("_w"))), F.lit(0.0)),
            F.count_if(above),
        ).first()
        if capped == capped_before or not open_weight:
            break
        rate, capped_before = (share * total - full) / open_weight, capped
    target = F.least(F.col("_w") * F.lit(rate), limit)
    return weighed.select("source", "source_size", target.alias("target"), "n", "_nth")


def mix_sources(
    rows: DataFrame,
    ids: Sequence[str] = ("doc_id",),
    source: str = "source",
    size: str = "size",
    seed: int = 17,
    group: int = GROUP,
    **targets,
) -> DataFrame:
    """ids, source, size, source_size, target, copies and taken of every row.

    A row of a source with target t and size s is wanted t / s times: the whole
    part for sure, the fraction as a probability. Rows are dealt by hash to
    groups of about ``group``; each group settles its fractions by ``settle``,
    and the one fraction a group leaves meets those of the other groups of its
    source on the next level, until each source has one, which is drawn. The
    words taken from a source so miss its target by less than one row's size.
    Groups, their order and their random numbers depend on the data and
    ``seed`` alone, so reruns agree.

    A null source is a source of its own, ordered last; null or zero sizes count
    as 0 and take nothing; null ids stay; equal rows are separate and share their
    random number's place, so either may be the one that is drawn. An empty table
    gives no rows. Columns that are not named are dropped.
    """
    rows = rows.select(
        *ids,
        F.col(source).alias("source"),
        F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("size"),
    )
    aims = source_targets(rows.select("source", "size"), **targets)
    aims = store(aims, "targets")
    largest = aims.agg(F.max("n")).first()[0] or 0
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    dealt = (
        rows.withColumn("_null", F.col("source").isNull())
        .withColumn("source", F.coalesce("source", F.lit("")))
        .join(
            aims.withColumn("_null", F.col("source").isNull()).withColumn(
                "source", F.coalesce("source", F.lit(""))
            ),
            ["source", "_null"],
        )
        .withColumn("source", F.when(~F.col("_null"), F.col("source")))
        .drop("_null")
        .withColumn("_base", F.floor(wanted))
        .withColumn("_p", F.when(F.col("size") > 0, wanted - F.col("_base")).otherwise(0.0))
        .withColumn("_h", F.xxhash64(F.lit(seed), *ids, "size"))
        .withColumn("_groups", F.ceil(F.col("n") / F.lit(group)))
        .drop("n")
    )
    done, level, groups = [], 0, largest
    while True:
        last = groups <= group
        placed = dealt.withColumn("_g", F.pmod(F.col("_h"), F.col("_groups")))
        dealt = store(
            placed.repartition("_nth", "_g")
            .sortWithinPartitions("_nth", "_g", "_h", *ids, "size")
            .mapInArrow(_settler(seed, level, last), placed.schema),
            "mixed",
        )
        settled = F.col("_p").isin(0.0, 1.0)
        done.append(dealt.where(settled))
        if last:
            break
        dealt = dealt.where(~settled).withColumn(
            "_groups", F.ceil(F.col("_groups") / F.lit(group))
        ).drop("_g")
        groups, level = -(-groups // group), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("_base") + F.col("_p")).cast("bigint")
    return out.select(
        *ids, "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )
