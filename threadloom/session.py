"""Session settings and the shared scratch area for intermediate tables."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows of a stored file at least, where a table's rows are known beforehand.
ROWS_PER_FILE = 4096

# Runtime settings every job here relies on. Shuffle width is left to the
# cluster: AQE coalesces small partitions and splits skewed join partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app_name: str = "threadloom",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def runtime_conf(spark: SparkSession, **settings: str):
    """Set runtime options for one action and put the old values back.

    Dots in option names are written as double underscores.
    """
    names = {name.replace("__", "."): value for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    Only a local master gets a temporary folder when nothing is configured; a
    cluster without a shared folder is refused, because tables written to one
    machine's disk are lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="threadloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def store(
    df: DataFrame, label: str, partition_by: str | None = None, rows: int | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder once and return a scan of it.

    Used where a frame must not be computed twice (costly or not repeatable
    work) and to cut lineage: what is written survives the loss of executors,
    and later readers prune columns as in any Parquet table. ``partition_by``, the
    last column, gets a folder per value, so readers prune those too. With ``rows``,
    about how many there are, a small table is not written as hundreds of tiny files,
    each of which costs executors a file's set-up: whole partitions share a task, but
    never fewer than two tasks write.
    """
    if rows is not None:
        df = df.coalesce(max(2, math.ceil(rows / ROWS_PER_FILE)))
    path = scratch_path(df.sparkSession, label)
    if partition_by is None:
        df.write.parquet(path)
    else:
        # A few folders may be open at once, so rows need no sort by folder.
        with runtime_conf(df.sparkSession, spark__sql__maxConcurrentOutputFileWriters="2"):
            df.write.partitionBy(partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
