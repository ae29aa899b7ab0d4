"""Joins against a table with unique keys when one fact key may hold a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from threadloom.session import store

# Rows of one key that one task takes without trouble.
HEAVY_ROWS = 500_000
# Null keys match nothing; they are only kept from piling up in one task.
_NULL_FAN = 1 << 16


def heavy_keys(df: DataFrame, key: str, rows: int = HEAVY_ROWS) -> DataFrame:
    """(key, _fan): keys of more than ``rows`` rows, and the tasks each needs.

    Counted with map-side partial sums over the key column alone. There are at
    most count(df) / rows of them.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > rows)
        .select(key, F.ceil(F.col("_rows") / rows).cast("int").alias("_fan"))
    )


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "left",
    rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Join ``facts`` to ``lookup``, whose ``key`` is unique, without hot tasks.

    Rows of a heavy key are dealt to as many salts as it fills tasks, by a hash
    of ``spread_by``, and only that key's single lookup row is copied to every
    salt: all copies together are at most count(facts) / rows. The result is
    that of the plain equi-join on ``key``. The list of heavy keys is stored
    first, so Spark knows its true size when it decides whether to broadcast
    it; the same holds for a lookup table that it can measure.
    """
    if how not in ("left", "inner"):
        raise ValueError("lookup_join does left and inner joins")
    heavy = store(heavy_keys(facts, key, rows), "heavy")
    spread = F.xxhash64(*spread_by)
    salted = (
        facts.join(heavy, key, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_fan").isNotNull(), F.pmod(spread, F.col("_fan")))
            .when(F.col(key).isNull(), F.pmod(spread, F.lit(_NULL_FAN)))
            .otherwise(0)
            .cast("int"),
        )
        .drop("_fan")
    )
    copies = (
        lookup.join(heavy, key, "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_fan").isNotNull(), F.sequence(F.lit(0), F.col("_fan") - 1))
                .otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("_fan")
    )
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
