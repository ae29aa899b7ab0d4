"""Exact dense row numbers in a global order, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.session import store

# monotonically_increasing_id() keeps the partition above bit 33 and the
# position inside the partition below it.
_POSITION_BITS = 33
_INSIDE = (1 << _POSITION_BITS) - 1


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "rn",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... along ``order_by``, which must be unique.

    Rows are range-partitioned and sorted, each gets its place inside its
    partition, and the frame is stored once so that place and partition cannot
    change between the two uses below. Only the row counts, one per partition,
    are then summed up and broadcast.
    """
    placed = _sorted(df, order_by, partitions).withColumn("_place", F.monotonically_increasing_id())
    stored = store(placed, "numbered")
    part = F.shiftright("_place", _POSITION_BITS)
    starts = _starts(stored.select(part.alias("_part"))).select("_part", F.col("_before").alias("_offset"))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place").bitwiseAND(_INSIDE))
        .drop("_part", "_place", "_offset")
    )


def _sorted(df: DataFrame, order_by: Sequence[str | Column], partitions: int | None) -> DataFrame:
    """The rows in ranges of the order, each sorted."""
    ranged = (
        df.repartitionByRange(*order_by)
        if partitions is None
        else df.repartitionByRange(partitions, *order_by)
    )
    return ranged.sortWithinPartitions(*order_by)


def _placed(df: DataFrame, order_by: Sequence[str | Column], partitions: int | None) -> DataFrame:
    """The sorted rows, each with its range and its place inside."""
    inside = F.monotonically_increasing_id().bitwiseAND(_INSIDE)
    return _sorted(df, order_by, partitions).select(
        "*", inside.alias("_place"), F.spark_partition_id().alias("_part")
    )


def _starts(stored: DataFrame) -> DataFrame:
    """(_part, _before, _rows): one row per range, with the rows before it."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        stored.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), "_rows")
    )


@dataclass(frozen=True)
class Numbered:
    """A stored table in a global order: a folder per range of it, and where each range begins."""

    stored: DataFrame  # with _part, the folder, and _place, the position inside it
    starts: list[tuple[int, int, int]]  # (_part, rows before it, its rows), one per range partition
    name: str

    @property
    def rows(self) -> int:
        return sum(rows for _, _, rows in self.starts)

    def numbered(self, first: int = 0, last: int | None = None) -> DataFrame:
        """The rows numbered ``first`` to ``last`` - 1; only the folders that hold any are opened."""
        last = self.rows if last is None else last
        within = [(part, before) for part, before, rows in self.starts if before < last and before + rows > first]
        parts = [part for part, _ in within]
        low, high = (min(parts), max(parts)) if parts else (0, -1)
        # One small row per range partition of the span.
        offsets = self.stored.sparkSession.createDataFrame(within, "_part int, _offset bigint")
        number = F.col("_offset") + F.col("_place")
        out = (
            self.stored.where(F.col("_part").between(low, high))
            .join(F.broadcast(offsets), "_part")
            .withColumn(self.name, number)
            .drop("_part", "_place", "_offset")
        )
        return out if (first, last) == (0, self.rows) else out.where(F.col(self.name).between(first, last - 1))

    def plain(self) -> DataFrame:
        """The stored rows as they came, without numbers."""
        return self.stored.drop("_part", "_place")


def number_stored(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "rn",
    partitions: int | None = None,
) -> Numbered:
    """Sort and store once, a folder per range, to be read by spans of numbers; see ``number_rows``."""
    stored = store(_placed(df, order_by, partitions), "numbered", partition_by="_part")
    return Numbered(stored, [tuple(row) for row in _starts(stored).collect()], name)
