"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.session import store


def _digest(links: DataFrame):
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")
    ).first()
    return row["n"], row["x"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node reachable.

    Each round joins every node's neighbours to the smallest one, first upwards,
    then downwards; the number of rounds grows with the logarithm of the longest
    path. Minima are pre-aggregated, so a node with a third of all links costs
    no task more than its share, and the joins back have a unique side. Every
    round is written to the shared folder. Only a count and a checksum come to
    the driver. Links that hold null are dropped; an empty table gives no rows.
    """
    current = store(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    seen = _digest(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = store(
            small.where(F.col("u") != F.col("v"))
            .unionByName(down.select("u", F.col("m").alias("v")))
            .distinct(),
            "links",
            # A round never has many more links than the one before.
            rows=seen[0],
        )
        now = _digest(new)
        if now == seen:
            break
        current, seen = new, now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
