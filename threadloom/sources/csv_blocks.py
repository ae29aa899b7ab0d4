"""CSV files with line breaks inside cells, read by many tasks a file.

A line begins a record when an even number of quotes stands before it in its file.
So quotes are counted per block first, their parity is summed up over the blocks of
a file, and then every block finds its own records. Only the pieces of records that
cross a block border are shuffled.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from threadloom.session import store

WHOLE, HEAD, OPEN = 0, 1, 2  # a record, the end of an earlier block's record, a record that goes on
_RECORDS = "file string, block bigint, first boolean, header int, pos bigint, kind int, text string"


class _Block:
    """The lines of one block, in order, cut into records."""

    def __init__(self, odd: int):
        self.odd = odd  # parity of the quotes so far
        self.kind = HEAD if odd else WHOLE
        self.lines: list[str] = []
        self.pos = 0
        self.out: list[tuple[int, int, str]] = []

    def _end(self, kind: int) -> None:
        text = "\n".join(self.lines)
        if kind != WHOLE or text.strip("\r"):  # blank lines are no records
            self.out.append((self.pos, kind, text.removesuffix("\r") if kind == WHOLE else text))
            self.pos += 1
        self.lines = []

    def add(self, values: pa.Array) -> None:
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
        after = (self.odd + np.cumsum(quotes)) & 1
        lines = values.to_pylist()
        begun = 0
        for end in (np.flatnonzero(after == 0) + 1).tolist():
            self.lines += lines[begun:end]
            self._end(self.kind)
            self.kind, begun = WHOLE, end
        if begun < len(lines):
            self.lines += lines[begun:]
        self.odd = int(after[-1])

    def close(self) -> list[tuple[int, int, str]]:
        if self.lines:  # inside a quote: an open record, or a block within one
            self._end(HEAD if self.kind == HEAD else OPEN)
        out, self.out = self.out, []
        return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, block = None, None

    def found(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        n = len(rows)
        pos, kinds, texts = zip(*rows, strict=True) if rows else ((), (), ())
        file, at, first, header = place
        return pa.RecordBatch.from_arrays(
            [
                pa.array([file] * n, pa.string()), pa.array([at] * n, pa.int64()), pa.array([first] * n, pa.bool_()),
                pa.array([header] * n, pa.int32()), pa.array(pos, pa.int64()), pa.array(kinds, pa.int32()),
                pa.array(texts, pa.string()),
            ],
            ["file", "block", "first", "header", "pos", "kind", "text"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        files, at = batch.column("file").dictionary_encode().indices.to_numpy(), batch.column("block").to_numpy()
        cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(at) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
            here = tuple(batch.column(c)[lo].as_py() for c in ("file", "block", "first", "header"))
            if here != place:
                if block is not None:
                    yield found(block.close())
                place, block = here, _Block(batch.column("odd")[lo].as_py())
            block.add(batch.column("value").slice(lo, hi - lo))
        if block.out:
            rows, block.out = block.out, []
            yield found(rows)
    if block is not None:
        yield found(block.close())


def _whole(pieces: DataFrame) -> DataFrame:
    """Records of the pieces that block borders cut; a piece or two per block."""
    order = Window.partitionBy("file").orderBy("block", "pos").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("_record", F.sum((F.col("kind") == OPEN).cast("long")).over(order))
    part = F.struct("block", "pos", "header", "first", "text")
    return (
        numbered.groupBy("file", "_record")
        .agg(F.sort_array(F.collect_list(part)).alias("_parts"))
        .select(
            "file", F.col("_parts")[0]["block"].alias("block"), F.col("_parts")[0]["first"].alias("first"),
            F.col("_parts")[0]["header"].alias("header"), F.col("_parts")[0]["pos"].alias("pos"),
            F.rtrim(F.array_join(F.col("_parts.text"), "\n"), F.lit("\r")).alias("text"),
        )
    )


def read_blocks(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    options: dict[str, str],
    dialect: type[csv.Dialect],
) -> DataFrame:
    """(_file, _block, _pos, and the columns of ``schema``) of all records.

    Columns are aligned by the header of each file, whose distinct texts alone come
    to the driver. Cells that hold a quote must be quoted, as CSV writers do; blank
    lines are no records; a header is one line.
    """
    lines = spark.read.text(list(paths), lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    blank = F.rtrim(F.col("value"), F.lit("\r")) == ""
    placed = lines.withColumn("_id", F.monotonically_increasing_id())
    place = F.when(~blank, F.col("_id"))
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = store(
        placed.groupBy("file", "block").agg(
            F.sum(quotes).alias("quotes"), F.min_by("value", place).alias("line"), F.min(place).alias("place")
        ),
        "blocks",
    )
    in_file = Window.partitionBy("file").orderBy("block")
    header = F.first(F.when(F.col("place").isNotNull(), F.col("line")), ignorenulls=True)
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.select(
        "file", "block",
        F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)), F.lit(2)).cast("int").alias("odd"),
        header.over(in_file.rowsBetween(Window.unboundedPreceding, 0)).alias("line"),
        (F.col("place").isNotNull() & (F.coalesce(F.count("place").over(earlier), F.lit(0)) == 0)).alias("first"),
    )
    headers = [r.line for r in blocks.where("line is not null").select("line").distinct().orderBy("line").collect()]
    if not headers:
        return spark.createDataFrame([], T.StructType([*_places(), *schema.fields]))
    number = F.array_position(F.array(*[F.lit(line) for line in headers]), F.col("line")).cast("int")
    known = blocks.where("line is not null").select("file", "block", "odd", "first", number.alias("header"))
    # One narrow row per block; Spark decides by its size whether to broadcast it.
    cut = store(lines.join(store(known, "parity"), ["file", "block"]).mapInArrow(_cut, _RECORDS), "records")
    names = ["file", "block", "first", "header", "pos", "text"]
    records = cut.where(F.col("kind") == WHOLE).select(names).unionByName(_whole(cut.where(F.col("kind") != WHOLE)))
    records = records.where(~(F.col("first") & (F.col("pos") == 0)))
    parsed = F.coalesce(
        *[F.when(F.col("header") == k, _aligned(line, schema, options, dialect)) for k, line in enumerate(headers, 1)]
    )
    places = [F.col(name).alias(f"_{name}") for name in ("file", "block", "pos")]
    return records.select(*places, parsed.alias("_row")).select("_file", "_block", "_pos", "_row.*")


def _places() -> list[T.StructField]:
    kinds = {"_file": T.StringType(), "_block": T.LongType(), "_pos": T.LongType()}
    return [T.StructField(name, kind) for name, kind in kinds.items()]


def _aligned(line: str, schema: T.StructType, options: dict[str, str], dialect: type[csv.Dialect]) -> Column:
    """A record of files with this header as a struct of ``schema``, parsed once."""
    names = next(csv.reader([line.removeprefix("﻿").removesuffix("\r")], dialect), [])
    types = {f.name: f.dataType for f in schema.fields}
    kinds = [types.get(name, T.StringType()) for name in names]
    # Cells are named by place, so any header will do.
    ddl = ", ".join(f"c{k} {kind.simpleString()}" for k, kind in enumerate(kinds))
    given = {k: v for k, v in options.items() if k not in ("header", "multiLine")}
    row = F.from_csv(F.col("text"), ddl, given)
    place = {name: f"c{k}" for k, name in reversed(list(enumerate(names)))}

    def project(r: Column) -> Column:
        return F.struct(
            *[
                (r[place[f.name]] if f.name in place else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )

    return F.get(F.transform(F.array(row), project), F.lit(0))
