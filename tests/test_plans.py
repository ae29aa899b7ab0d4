"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from threadloom.bindings.queries import QUERIES as CORE
from threadloom.bindings import stub, tables
from threadloom.operators import batching, progress, threads
from threadloom.operators.annotation import model_responses
from threadloom.operators.numbering import number_rows
from threadloom.session import store

QUERIES = {name: entry_point.queries()[name] for name in CORE}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stance_batches(spark, small):
    numbered = number_rows(tables.stance_frame(spark, small), batching.stance_order())
    return batching.with_batch(numbered, batching.STANCE_BATCH)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_query_plans(spark, small, name):
    """The model runs before its answers are read; nothing else needs Python."""
    if name.startswith(("stream", "thread_depth", "prepare")):
        pytest.skip("runs whole jobs; covered by its own tests")
    plan = plan_of(QUERIES[name](spark, small))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "PythonUDTF"):
        assert node not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_small_log_is_broadcast_for_the_anti_join(spark, small):
    posts = tables.documents_as_posts(spark, small).select("row", "url")
    log = store(tables.merged_log(spark, small), "log")
    pending = progress.pending_posts(posts, log)
    pending.collect()
    assert "BroadcastHashJoin" in plan_of(pending) and "LeftAnti" in plan_of(pending)


def test_scans_read_only_what_is_asked(spark, small):
    plan = plan_of(threads.direct_replies(tables.replies(spark, small), F.col("root_id")).select("id"))
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint>" in plan
    plan = plan_of(tables.table(spark, small, "documents").where("lang = 'en'").select("doc_id"))
    assert "EqualTo(lang,en)" in plan


def test_numbering_reads_one_column_for_its_counts(spark, small):
    ids = batching.batch_ids(stance_batches(spark, small))
    assert "ReadSchema: struct<_place:bigint>" in plan_of(ids)


def test_model_stage_has_the_asked_number_of_tasks(spark, small):
    requests = batching.stance_requests(stance_batches(spark, small), tasks=7)
    responses = model_responses(requests, stub.stance_model)
    assert "Exchange hashpartitioning(batch_id" in plan_of(responses)
    assert responses.rdd.getNumPartitions() == 7
