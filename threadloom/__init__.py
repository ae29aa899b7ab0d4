"""Conversation threads on Spark: collect, combine, batch, annotate."""

from threadloom.plans.annotate import argument_mine, stance_detect
from threadloom.plans.collect import (
    collect_authors,
    combine_threads,
    compile_thread,
    get_comments,
    merge_scrape_logs,
)
from threadloom.operators.threads import pull_comments
from threadloom.session import build_session

__all__ = [
    "argument_mine",
    "build_session",
    "collect_authors",
    "combine_threads",
    "compile_thread",
    "get_comments",
    "merge_scrape_logs",
    "pull_comments",
    "stance_detect",
]
