"""Typed scans. Every reader takes an explicit schema and aligns columns by name."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from threadloom import schemas
from threadloom.functions.text import safe_id
from threadloom.operators.combine import union_by_name
from threadloom.operators.threads import TIMESTAMP_FORMAT, project_fields, unnest_page
from threadloom.sources.csv_blocks import read_blocks

# Text cells may hold line breaks and doubled quotes.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}

# Columns that restore the order "file by file, row by row".
FILE_ORDER = ("file", "block", "pos")
_PLACES = [
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("pos", T.LongType()),
]


def read_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = schemas.POST,
    fmt: str = "parquet",
) -> DataFrame:
    """Parquet, ORC, JSON lines or CSV with exactly the columns of ``schema``."""
    if fmt == "csv":
        return read_csv(spark, paths, schema)
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt != "json":
        return spark.read.format(fmt).schema(schema).load(paths)
    # JSON holds ids as strings or as numbers; text takes both without loss.
    numbers = [f.name for f in schema.fields if isinstance(f.dataType, T.LongType)]
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in numbers else f.dataType) for f in schema]
    )
    return (
        spark.read.schema(as_text)
        .json(paths)
        .withColumns({name: safe_id(F.col(name)) for name in numbers})
    )


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    file_order: bool = False,
    splittable: bool = False,
    **options: str,
) -> DataFrame:
    """CSV files or globs with a header each, aligned by column name.

    One Spark reader takes the column order of a single header for all files,
    so files are grouped by header and each group gets its own reader. One job
    over all files finds the headers, however many files there are; there is a
    reader per different header. A header is one line.

    ``file_order`` adds ``file``, ``block`` and ``pos`` for keep-first rules.

    ``splittable`` lets many tasks read one file although cells hold line breaks,
    for large files whose cells with quotes are quoted; see ``csv_blocks``. Without
    it a task reads a whole file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    options = {**CSV_OPTIONS, **options}
    if splittable:
        found = read_blocks(spark, paths, schema, options, _dialect(options))
        places = [F.col(f"_{name}").alias(name) for name in FILE_ORDER] if file_order else []
        return found.select(*[f.name for f in schema.fields], *places)
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file, line in _first_lines(spark, paths):
        header = tuple(next(csv.reader([line.removeprefix("\ufeff")], _dialect(options)), ()))
        if header:  # an empty file has none
            by_header[header].append(file)
    types = {f.name: f.dataType for f in schema.fields}
    target = T.StructType(schema.fields + (_PLACES if file_order else []))
    frames = [spark.createDataFrame([], target)] if not by_header else []
    for header, members in by_header.items():
        in_file = T.StructType(
            [T.StructField(name, types.get(name, T.StringType())) for name in header]
        )
        frame = spark.read.options(**options).schema(in_file).csv(members)
        if file_order:
            frame = frame.select("*", *_places("csv"))
        frames.append(project_fields(frame, target))
    return union_by_name(frames)


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str]]:
    """(file, first line) of every file that is not empty; one row per file."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), place.alias("place"), "value"
    )
    first = lines.where(F.col("value") != "").groupBy("file").agg(F.min_by("value", "place").alias("line"))
    return [tuple(row) for row in first.orderBy("file").collect()]


def _dialect(options: dict[str, str]) -> type[csv.Dialect]:
    class Header(csv.excel):
        delimiter = options.get("sep", options.get("delimiter", ","))
        quotechar = options.get("quote", '"')

    return Header


def read_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    fmt: str = "parquet",
) -> DataFrame:
    """Several files as one table with their names and row order kept."""
    if fmt == "csv":
        return read_csv(spark, paths, schema, file_order=True)
    return read_table(spark, paths, schema, fmt).select("*", *_places(fmt))


def read_reply_pages(
    spark: SparkSession, paths: str | Sequence[str], post_url: str = "post_url"
) -> DataFrame:
    """Landed JSON lines {"post_url": ..., "page": [...]} -> one row per reply."""
    schema = T.StructType(
        [T.StructField(post_url, T.StringType()), T.StructField("page", schemas.REPLY_PAGE)]
    )
    paths = [paths] if isinstance(paths, str) else list(paths)
    pages = spark.read.schema(schema).json(paths, timestampFormat=TIMESTAMP_FORMAT)
    return unnest_page(pages, "page")


def _places(fmt: str) -> list:
    row = (
        F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
    )
    block = F.lit(0).cast("bigint") if fmt == "parquet" else F.col("_metadata.file_block_start")
    return [
        F.col("_metadata.file_path").alias("file"), block.alias("block"), row.alias("pos")
    ]
