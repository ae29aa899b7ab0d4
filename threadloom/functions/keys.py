"""Hash-based shard and shuffle keys that other engines can reproduce."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def shard_of(key: Column, shards: int = 10) -> Column:
    """Stable shard of a row: the first 32 bits of md5(key), modulo ``shards``."""
    word = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(word, F.lit(shards)).cast("int")


def shuffle_key(key: Column, seed: int = 42) -> Column:
    """Sort key of a repeatable shuffle: same seed, same order, on any cluster."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), key.cast("string")))
