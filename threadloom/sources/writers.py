"""Sinks: append per job, replace a snapshot, keep results by run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.operators.threads import nested_as_json
from threadloom.sources.readers import CSV_OPTIONS

# The CSV writer trims cells unless told not to.
_CSV_WRITE = {
    **{name: CSV_OPTIONS[name] for name in ("header", "quote", "escape")},
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    if fmt == "csv":
        nested_as_json(df).write.mode(mode).options(**_CSV_WRITE).csv(path)
    else:
        df.write.mode(mode).format(fmt).save(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows to a table, once per job. CSV files each carry their header."""
    _write(df, path, fmt, "append")


def replace_snapshot(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Rewrite a result table; ``path`` must not be an input of ``df``."""
    _write(df, path, fmt, "overwrite")


def result_projection(df: DataFrame, result: str, item_id: str = "external_id") -> DataFrame:
    """Only the id and the result column."""
    return df.select(item_id, result)


def append_results(results: DataFrame, path: str, run_id: str) -> None:
    """Add one run's results under ``run_id=...``; other runs are not touched."""
    results.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(
        path
    )
