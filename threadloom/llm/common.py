"""What several of these operators share: words, hashes, blocks of a batch, grouped runs."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_BYTES = np.arange(256, dtype=np.uint8)
SPACE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 18  # bytes hashed at once; a worker keeps tables of 32 times that


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text as a bigint, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def smallest(df: DataFrame, rank: Column, ties: list[str], n: int) -> DataFrame:
    """The ``n`` rows of smallest ``rank``, a 64-bit hash; ties by the columns ``ties``.

    Rows are counted first and only those below the hash that n rows are expected
    to stay under, with a margin of eight deviations, are sorted. So the tasks
    together send little more than n rows, however many there are.
    """
    total = df.count()
    share = (n + 8 * n**0.5 + 16) / max(total, 1)
    if share < 1:
        df = df.where(rank < F.lit(int(share * 2**64) - 2**63).cast("bigint"))
    return df.orderBy(rank, *ties).limit(n)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until ``df`` has no column of that name."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = pc.fill_null(values, b"" if pa.types.is_binary(values.type) else "")
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        values.offset : values.offset + len(values) + 1
    ].astype(np.int64)
    if data is None or not len(values):
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    found = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return found, offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = _PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Made where words are hashed, not in a driver that only imports this."""
    return _powers(_BASE, 2 * _PIECE), _powers(_BASE_INVERSE, 2 * _PIECE)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of all words of a block of texts; no word crosses two texts."""
    inside = ~SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] |= inside[edges]
    ends[edges - 1] |= inside[edges - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word (A-Z as a-z), in pieces of bounded size."""
    out = np.empty(len(starts), np.uint64)
    powers_, inverses_ = _tables()
    first = 0
    while first < len(starts):
        begin = int(starts[first])
        last = int(np.searchsorted(ends, begin + _PIECE, "right"))
        last = max(last, first + 1)
        end = int(ends[last - 1])
        n = end - begin
        # A single word may be longer than the tables.
        powers = powers_ if n < len(powers_) else _powers(_BASE, n + 1)
        inverses = inverses_ if n < len(inverses_) else _powers(_BASE_INVERSE, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(
            (LOWER[data[begin:end]].astype(np.uint64) + np.uint64(1)) * powers[:n], out=total[1:]
        )
        a, b = starts[first:last] - begin, ends[first:last] - begin
        out[first:last] = mix((total[b] - total[a]) * inverses[a])
        first = last
    return out


def runs(
    batches: Iterator[pa.RecordBatch], keys: list[str], head: int | None = None
) -> Iterator[pa.Table]:
    """Tables of equal ``keys`` from batches sorted by them.

    The caller bounds the rows of a key, so only one bounded group is held.
    """
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[lo] for c in columns)
            if key != held_key and held:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def block_pairs(
    df: DataFrame, group: str, by: str, rows: int, weight: Column | None = None, limit: int = 0
) -> DataFrame:
    """Copies of the rows of a group for every pair of its blocks.

    Adds ``_i`` <= ``_j`` (a pair of blocks) and ``_side``: 0 when the row is in
    block ``_i``, 1 in block ``_j``; for ``_i`` = ``_j`` the side is 0. Rows are
    dealt to ceil(count / rows) blocks by a hash of ``by``, so a task compares
    about ``rows`` x ``rows`` however large the group is. With ``weight``, a
    block also has a sum of weights of about ``limit``. The counts are joined
    without a hint and keep hot groups splittable by AQE.
    """
    number = F.ceil(F.count(F.lit(1)) / F.lit(rows))
    if weight is not None:
        number = F.greatest(number, F.ceil(F.sum(weight) / F.lit(limit)))
    counts = df.groupBy(group).agg(number.cast("int").alias("_n"))
    block = F.pmod(F.xxhash64(by), F.col("_n")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_o")
    return (
        df.join(counts, group)
        .withColumn("_b", block)
        .select("*", other)
        .select(
            *df.columns,
            F.least("_b", "_o").alias("_i"),
            F.greatest("_b", "_o").alias("_j"),
            (F.col("_b") > F.col("_o")).cast("int").alias("_side"),
        )
    )
