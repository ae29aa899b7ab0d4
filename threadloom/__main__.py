"""Command line of the batch jobs, for spark-submit or ``python -m threadloom``.

    collect   --posts P --log L --pages G --landed F --out O [--seed K] [--retry-failed]
    combine   --files GLOB --kind replies|authors --out O
    logs      --files GLOB --out O
    authors   --usernames U --profiles P --out O
    prepare   --input REPLIES --posts P --out O
    arguments --input I --out O --model module:factory [--run-id R --responses-path A]
    stances   --input I --out O --model module:factory [--run-id R --responses-path A]

Every table is read and written in ``--format`` (parquet unless given). ``--out``
is a new folder; inputs are never rewritten.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession, types as T

from threadloom import schemas
from threadloom.operators import progress
from threadloom.operators.annotation import Calls
from threadloom.plans import annotate, collect
from threadloom.session import build_session
from threadloom.sources.readers import read_table
from threadloom.sources.writers import append_rows, replace_snapshot, result_projection

LANDED = T.StructType(
    [T.StructField("post_url", T.StringType()), T.StructField("error", T.StringType())]
)
PAGES = T.StructType(
    [T.StructField("post_url", T.StringType()), T.StructField("page", T.StringType())]
)
USERNAMES = T.StructType([T.StructField("username", T.StringType())])


def run_collect(spark: SparkSession, args) -> None:
    fmt = args.format
    log = read_table(spark, args.log, schemas.PROGRESS_LOG, fmt)
    out = collect.compile_thread(
        read_table(spark, args.posts, schemas.POST, fmt),
        log,
        read_table(spark, args.pages, PAGES, fmt),
        read_table(spark, args.landed, LANDED, fmt),
        seed=args.seed,
        at_least=args.at_least,
        retry_failed=args.retry_failed,
    )
    append_rows(out.replies, f"{args.out}/replies", fmt)
    append_rows(out.authors, f"{args.out}/authors", fmt)
    news = progress.outcome_text(out.outcomes)
    replace_snapshot(progress.update_log(log, news), f"{args.out}/log", fmt)


def run_combine(spark: SparkSession, args) -> None:
    replies = schemas.REPLY_TEXT_ROW if args.format == "csv" else schemas.REPLY_ROW
    schema = {"replies": replies, "authors": schemas.AUTHOR_ROW}[args.kind]
    out = collect.combine_threads(spark, args.files, schema, args.format)
    out.per_file.show(truncate=False)
    out.duplicates.show()
    replace_snapshot(out.rows.select(schema.names), args.out, args.format)


def run_logs(spark: SparkSession, args) -> None:
    merged = collect.merge_scrape_logs(spark, args.files, args.format)
    replace_snapshot(merged, args.out, args.format)


def run_authors(spark: SparkSession, args) -> None:
    found, missed = collect.collect_authors(
        read_table(spark, args.usernames, USERNAMES, args.format),
        read_table(spark, args.profiles, schemas.AUTHOR_ROW, args.format),
    )
    append_rows(found, f"{args.out}/authors", args.format)
    append_rows(missed, f"{args.out}/missing", args.format)


def run_prepare(spark: SparkSession, args) -> None:
    replies = schemas.REPLY_TEXT_ROW if args.format == "csv" else schemas.REPLY_ROW
    frame = annotate.prepare_stances(
        read_table(spark, args.input, replies, args.format),
        read_table(spark, args.posts, schemas.POST, args.format),
    )
    replace_snapshot(frame, args.out, args.format)


def _model(name: str):
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory)


def run_annotation(spark: SparkSession, args) -> None:
    job, result, default = {
        "arguments": (annotate.argument_mine, "AM_output", "AM_Shots_CoT"),
        "stances": (annotate.stance_detect, "SD_output", "SD_Shots_CoT"),
    }[args.job]
    rows = read_table(spark, args.input, schemas.ANNOTATION_INPUT, args.format)
    options = {"only_missing": args.only_missing} if args.job == "stances" else {}
    done = job(
        rows,
        args.strategy or default,
        args.model if args.models else _model(args.model),
        mode=args.mode,
        null_text=args.null_text,
        run_id=args.run_id,
        responses_path=args.responses_path,
        parallelism=args.parallelism,
        models=_model(args.models) if args.models else None,
        calls=Calls(args.in_flight, args.attempts, args.wait),
        **options,
    )
    replace_snapshot(result_projection(done, result), args.out, args.format)


JOBS = {
    "collect": (run_collect, ["posts", "log", "pages", "landed", "out"]),
    "combine": (run_combine, ["files", "kind", "out"]),
    "logs": (run_logs, ["files", "out"]),
    "authors": (run_authors, ["usernames", "profiles", "out"]),
    "prepare": (run_prepare, ["input", "posts", "out"]),
    "arguments": (run_annotation, ["input", "out", "model"]),
    "stances": (run_annotation, ["input", "out", "model"]),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="threadloom", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (_, required) in JOBS.items():
        job = jobs.add_parser(name)
        for option in required:
            job.add_argument(f"--{option}", required=True)
        job.add_argument("--format", default="parquet", choices=["parquet", "orc", "json", "csv"])
        if name == "collect":
            job.add_argument("--seed", type=int)
            job.add_argument("--at-least", type=int, help="least replies of a post")
            job.add_argument("--retry-failed", action="store_true")
        if name in ("arguments", "stances"):
            job.add_argument("--strategy")
            job.add_argument("--mode", default="strict", choices=["strict", "compat"])
            job.add_argument("--null-text", help="what is sent for null text; without it, nothing")
            job.add_argument("--run-id", help="with --responses-path: repeat a run without asking twice")
            job.add_argument("--responses-path")
            job.add_argument("--parallelism", type=int, help="least tasks that call the model at once")
            job.add_argument("--models", help="module:mapping of names to factories; --model is then a name")
            job.add_argument("--in-flight", type=int, default=1, help="requests a task has under way at once")
            job.add_argument("--attempts", type=int, default=1, help="tries of a request that fails")
            job.add_argument("--wait", type=float, default=1.0, help="seconds before the second try, then doubled")
        if name == "stances":
            job.add_argument("--only-missing", action="store_true")
    args = parser.parse_args(argv)
    JOBS[args.job][0](build_session(f"threadloom {args.job}"), args)


if __name__ == "__main__":
    main()
