"""Tables that are what their manifest says, replaced or added to in one step.

Rows go to a new folder under ``data``; the step that makes them count is one small
file under ``manifest``, which Spark's commit renames into place. A job that dies
earlier leaves a folder that no manifest names, and readers keep what they had.
Nothing is overwritten, so a reader that has begun is not disturbed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

ENTRY = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("replaces", T.BooleanType()),
    ]
)
ATTEMPTS = 20  # other writers that may take a version before ours


def history(spark: SparkSession, path: str) -> list[tuple]:
    """(version, run_id, folder, replaces) of every commit, oldest first; one row each."""
    try:
        rows = spark.read.schema(ENTRY).json(f"{path.rstrip('/')}/manifest/*").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((tuple(row) for row in rows), key=lambda e: (e[0], e[2]))


def publish(df: DataFrame, path: str, run_id: str | None = None, replace: bool = False) -> int:
    """Add ``df`` to the table at ``path``, or with ``replace`` put it in place of all rows.

    Rows of a ``run_id`` count once: a run that is repeated takes the place of what
    it added before. Returns the version. Two writers that commit at the same time
    both count, in the order of their versions, then folder names.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    for _ in range(ATTEMPTS):
        version = max((entry[0] for entry in history(spark, path)), default=0) + 1
        entry = spark.createDataFrame([(version, run_id, folder, replace)], ENTRY)
        try:
            entry.coalesce(1).write.mode("errorifexists").json(f"{path}/manifest/{version:012d}")
        except AnalysisException as taken:
            if taken.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        else:
            return version
    raise RuntimeError(f"no free version of {path}")


def current_folders(entries: list[tuple]) -> list[str]:
    """The folders that make up the table after these commits."""
    held: dict[str, str] = {}
    for version, run_id, folder, replaces in entries:
        if replaces:
            held = {}
        held[folder if run_id is None else f"run {run_id}"] = folder
    return list(held.values())


def read_published(
    spark: SparkSession, path: str, schema: T.StructType, version: int | None = None
) -> DataFrame:
    """The table as of ``version``, by default the latest; empty before the first commit."""
    entries = [e for e in history(spark, path) if version is None or e[0] <= version]
    folders = [f"{path.rstrip('/')}/{folder}" for folder in current_folders(entries)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)
