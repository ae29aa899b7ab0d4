"""Rows that cannot go on, kept with the reason and counted in the same pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from threadloom.session import store


@dataclass(frozen=True)
class Split:
    kept: DataFrame
    rejected: DataFrame  # the rows as they came, and ``reason``
    counts: dict[str, int]  # rows in all, and rows rejected for each reason


def null_rules(**columns: str) -> list[tuple[str, Column]]:
    """A rule per column that must not be null: null_rules(handle="username") rejects as "null handle"."""
    return [(f"null {what}", F.col(name).isNull()) for what, name in columns.items()]


def split_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]], reason: str = "reason") -> Split:
    """Split ``df`` by the first rule (reason, condition) that a row meets.

    ``df`` is computed once: kept and rejected rows go to two folders of one stored
    table, and the counts are observed while it is written. A condition that is
    null is not met.
    """
    if reason in df.columns:
        raise ValueError(f"the rows already have a column {reason}")
    met = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in rules], F.lit(None).cast("string"))
    observed = Observation()
    tagged = df.withColumn(reason, met).observe(
        observed,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(reason) == name).alias(name) for name, _ in rules],
    )
    stored = store(tagged.withColumn("_kept", F.col(reason).isNull()), "split", partition_by="_kept")
    counts = {"rows": 0, **{name: 0 for name, _ in rules}, **{k: v for k, v in observed.get.items() if v}}
    return Split(
        stored.where("_kept").drop("_kept", reason), stored.where("NOT _kept").drop("_kept"), counts
    )
