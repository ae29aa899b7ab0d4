"""Batches, prompts, model calls and the two annotation jobs."""

import collections
import os
import re
import threading
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.functions.answers import MISSING_ID
from threadloom.operators import annotation, batching
from threadloom.operators.annotation import Calls, call_model, model_responses, route
from threadloom.operators.numbering import number_rows
from threadloom.plans.annotate import argument_mine, stance_detect, task_count

POSTS = "external_id BIGINT, content STRING, AM_output STRING"
REPLIES = "external_id BIGINT, content STRING, reply_depth INT, PARENT_URL STRING, PARENT_content STRING"


def echo():
    """Answers every id with the number of items in its prompt."""

    def answer(prompt, system):
        ids = re.findall(r"^\[id: (\d+), ", prompt, re.MULTILINE)
        return ",\n".join(f'[id: {i}, annotation: "of {len(ids)}"]' for i in ids)

    return answer


def posts(spark, n):
    return spark.range(n).select(
        F.col("id").alias("external_id"),
        F.concat(F.lit("text "), "id").alias("content"),
        F.lit(None).cast("string").alias("AM_output"),
    )


@pytest.mark.parametrize("size, n", [(20, n) for n in (0, 1, 19, 20, 21)] + [(25, n) for n in (24, 25, 26)])
def test_batch_edges(spark, size, n):
    batched = batching.with_batch(number_rows(posts(spark, n), ["external_id"]), size)
    ids = batching.batch_ids(batched).orderBy("batch_id").collect()
    assert [i for r in ids for i in r.ids] == list(range(n))
    assert [len(r.ids) for r in ids] == [min(size, n - s) for s in range(0, n, size)]


def test_argument_prompt(spark):
    df = spark.createDataFrame([(0, 0, 5, 'a "b"'), (1, 0, 6, None)], "rn BIGINT, batch_id BIGINT, external_id BIGINT, content STRING")
    got = batching.argument_requests(df, user_template="<{}>").collect()
    assert [(r.batch_id, r.ids, r.prompt) for r in got] == [
        (0, [5, 6], "<[id: 5, text: \"a 'b'\"],\n[id: 6, text: \"nan\"],\n>")
    ]


def test_stance_prompt_names_a_parent_once_per_run_and_batch(spark):
    rows = [
        (0, 0, 1, "r1", "P"),
        (1, 0, 2, "r2", "P"),
        (2, 0, 3, "r3", 'Q"'),
        (3, 0, 4, "r4", "Q'"),
        (4, 0, 5, "r5", None),
        (5, 0, 6, "r6", "P"),
        (6, 1, 7, "r7", "P"),
    ]
    df = spark.createDataFrame(
        rows, "rn BIGINT, batch_id BIGINT, external_id BIGINT, content STRING, PARENT_content STRING"
    )
    got = {r.batch_id: r.prompt for r in batching.stance_requests(df, "{}").collect()}
    assert got[0] == (
        '[[Tweet: "P", Replies: [\n[id: 1, text: "r1"],\n[id: 2, text: "r2"],\n'
        ']],\n[Tweet: "Q\'", Replies: [\n[id: 3, text: "r3"],\n[id: 4, text: "r4"],\n'
        ']],\n[Tweet: "nan", Replies: [\n[id: 5, text: "r5"],\n'
        ']],\n[Tweet: "P", Replies: [\n[id: 6, text: "r6"],\n]]]'
    )
    assert got[1] == '[[Tweet: "P", Replies: [\n[id: 7, text: "r7"],\n]]]'


def test_packing_shares_one_shuffle_with_the_model_call(spark):
    df = spark.range(100).select(
        F.col("id").alias("rn"), F.expr("id div 25").alias("batch_id"), F.col("id").alias("external_id"),
        F.lit("x").alias("content"), F.expr("cast(id div 7 as string)").alias("PARENT_content"),
    )
    requests = batching.stance_requests(df, tasks=6)
    responses = model_responses(requests, echo)
    plan = responses._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert requests.rdd.getNumPartitions() == 6


def test_argument_mine_fills_only_what_is_missing(spark):
    rows = [(1, "a", None), (2, "b", ""), (3, "c", "kept"), (4, None, None), (None, "d", None)]
    got = argument_mine(spark.createDataFrame(rows, POSTS), model=echo).collect()
    assert {r.external_id: r.AM_output for r in got} == {
        1: "of 2", 2: "of 2", 3: "kept", 4: None, None: None,
    }
    named = argument_mine(spark.createDataFrame(rows[:4], POSTS), model=echo, null_text="nan")
    assert {r.external_id: r.AM_output for r in named.collect()}[4] == "of 3"


def test_result_column_is_added(spark):
    df = posts(spark, 3).drop("AM_output")
    assert [r.AM_output for r in argument_mine(df, model=echo).collect()] == ["of 3"] * 3


def test_every_row_gets_one_result_also_with_repeated_ids(spark):
    df = posts(spark, 45).withColumn("k", F.col("external_id")).withColumn(
        "external_id", F.expr("external_id div 2")
    )
    got = argument_mine(df, model=echo, order_by=["k"]).orderBy("k").collect()
    assert [r.k for r in got] == list(range(45))
    assert [r.AM_output for r in got] == ["of 20"] * 40 + ["of 5"] * 5


def test_failed_batch_keeps_old_values_and_others_go_on(spark):
    def flaky():
        answer = echo()

        def call(prompt, system):
            if "[id: 20," in prompt:
                raise ConnectionError("gone")
            return answer(prompt, system)

        return call

    got = argument_mine(posts(spark, 45).fillna("", ["AM_output"]), model=flaky)
    by_id = {r.external_id: r.AM_output for r in got.collect()}
    assert all(by_id[i] == ("" if 20 <= i < 40 else "of 20" if i < 20 else "of 5") for i in by_id)


def test_errors_are_kept_with_the_answers(spark):
    def broken():
        def call(prompt, system):
            raise ValueError("bad prompt")

        return call

    requests = spark.createDataFrame([(0, [1], "p")], "batch_id BIGINT, ids ARRAY<BIGINT>, prompt STRING")
    assert call_model(requests, broken).first().error == "ValueError: bad prompt"
    unknown = call_model(requests, route({"echo": echo}, "no such model")).first()
    assert (unknown.output, unknown.error) == (None, "no text returned")
    assert route({"echo": echo}, "echo") is echo


def test_system_prompt_reaches_the_model(spark):
    def parrot():
        return lambda prompt, system: f'[id: 0, annotation: "{system}"]'

    got = argument_mine(
        posts(spark, 1), "s", parrot, system_template="<{}>", strategies={"s": "rules"}
    )
    assert got.first().AM_output == "<rules>"


def test_model_is_called_once_per_batch(spark, tmp_path):
    folder = str(tmp_path)

    def counting():
        answer = echo()

        def call(prompt, system):
            with open(os.path.join(folder, "calls"), "a") as log:
                log.write("x")
            return answer(prompt, system)

        return call

    done = argument_mine(posts(spark, 61), model=counting)
    assert done.count() == 61 and done.where("AM_output IS NULL").count() == 0
    assert (tmp_path / "calls").read_text() == "xxxx"


def test_answers_are_kept_by_run(spark, tmp_path):
    path = str(tmp_path / "answers")
    argument_mine(posts(spark, 25), model=echo, run_id="r1", responses_path=path)
    assert spark.read.parquet(path).where("run_id = 'r1'").count() == 2
    with pytest.raises(ValueError):
        argument_mine(posts(spark, 1), model=echo, responses_path=path)


def logged(folder, trouble):
    """``echo`` that notes each call and first does ``trouble(prompt)``."""
    folder = str(folder)

    def factory():
        answer = echo()

        def call(prompt, system):
            first = re.search(r"^\[id: (\d+), ", prompt, re.MULTILINE).group(1)
            with open(os.path.join(folder, "calls"), "a") as log:
                log.write(f"{first} ")
            trouble(int(first))
            return answer(prompt, system)

        return call

    return factory


def calls(folder):
    return sorted(map(int, (folder / "calls").read_text().split()))


def test_repeated_run_sends_only_what_failed(spark, tmp_path):
    def fail(first):
        if first == 20:
            raise ConnectionError("gone")

    keep = {"run_id": "r", "responses_path": str(tmp_path / "answers")}
    first = argument_mine(posts(spark, 61), model=logged(tmp_path, fail), **keep)
    assert first.where("AM_output IS NULL").count() == 20
    again = argument_mine(posts(spark, 61), model=logged(tmp_path, lambda first: None), **keep)
    assert calls(tmp_path) == [0, 20, 20, 40, 60]
    assert {r.external_id: r.AM_output for r in again.collect()} == {
        i: "of 20" if i < 60 else "of 1" for i in range(61)
    }


def test_answers_of_finished_tasks_survive_a_failed_job(spark, tmp_path):
    def crash(first):
        if first == 40:
            time.sleep(5)
            os._exit(1)

    keep = {"run_id": "r", "responses_path": str(tmp_path / "answers"), "requests_per_task": 1}
    df = posts(spark, 100).where("external_id != 99")
    with pytest.raises(Exception):
        argument_mine(df, model=logged(tmp_path, crash), parallelism=97, **keep)
    before = calls(tmp_path)
    done = argument_mine(df, model=logged(tmp_path, lambda first: None), parallelism=97, **keep)
    assert done.where("AM_output IS NULL").count() == 0
    after = calls(tmp_path)
    assert len(after) < len(before) + 5 and after.count(40) == 2


def test_stance_order_depth_then_parent_nulls_last(spark):
    rows = [
        (1, "x", 2, "b", "B"), (2, "x", 1, "b", "B"), (3, "x", None, "a", "A"), (4, "x", 1, None, None),
    ]

    def order():
        def call(prompt, system):
            ids = re.findall(r"\[id: (\d+), ", prompt)
            return ",".join(f'[id: {i}, annotation: "{k}"]' for k, i in enumerate(ids))

        return call

    def places(null_text):
        df = spark.createDataFrame(rows, REPLIES)
        got = stance_detect(df, model=order, null_text=null_text).collect()
        return {r.external_id: r.SD_output for r in got}

    assert places("nan") == {2: "0", 4: "1", 1: "2", 3: "3"}
    assert places(None) == {2: "0", 1: "1", 3: "2", 4: None}


def test_stance_redoes_all_unless_told_otherwise(spark):
    rows = [(1, "x", 1, "u", "P", "old"), (2, "y", 1, "u", "P", None)]
    df = spark.createDataFrame(rows, REPLIES + ", SD_output STRING")
    redone = {r.external_id: r.SD_output for r in stance_detect(df, model=echo).collect()}
    assert redone == {1: "of 2", 2: "of 2"}
    rest = stance_detect(df, model=echo, only_missing=True)
    assert {r.external_id: r.SD_output for r in rest.collect()} == {1: "old", 2: "of 1"}


def test_missing_ids_get_the_marker(spark):
    def silent():
        return lambda prompt, system: "I cannot help with that."

    got = stance_detect(
        spark.createDataFrame([(1, "x", 1, "u", "P")], REPLIES), model=silent, mode="compat"
    )
    assert got.first().SD_output == MISSING_ID


def test_split_ids(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "external_id STRING")
    good, bad = batching.split_ids(df)
    assert [r.external_id for r in good.collect()] == [12]
    assert sorted([r.external_id for r in bad.collect()], key=str) == [None, "x"]


def test_task_count():
    assert task_count(0, 20) == 1
    assert task_count(20_000, 20, 50) == 20
    assert task_count(10**12, 25) == 800_000_000


def test_resume_over_fewer_rows_loses_none(spark, tmp_path):
    keep = {"run_id": "r", "responses_path": str(tmp_path / "answers")}
    everything = argument_mine(posts(spark, 45), model=echo, **keep).collect()
    calls = str(tmp_path / "calls")

    def counting():
        import pathlib
        import uuid

        def call(prompt, system):
            pathlib.Path(calls).mkdir(exist_ok=True)
            (pathlib.Path(calls) / uuid.uuid4().hex).touch()
            return None

        return call

    fewer = argument_mine(posts(spark, 45).where("external_id >= 5"), model=counting, **keep).collect()
    want = {r.external_id: r.AM_output for r in everything}
    assert {r.external_id: r.AM_output for r in fewer} == {i: a for i, a in want.items() if i >= 5}
    assert all(r.AM_output for r in fewer)
    import pathlib

    assert not pathlib.Path(calls).exists()


def _slow_model():
    def answer(prompt, system):
        time.sleep(0.1)
        if prompt.endswith("7"):
            raise ValueError("seven")
        return f"{prompt} by {threading.get_ident()}"

    return answer


def _requests(spark, n):
    return spark.range(n).select(
        F.col("id").alias("batch_id"), F.array("id").alias("ids"), F.concat(F.lit("p"), "id").alias("prompt"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("model"),
    ).coalesce(1)


def test_requests_in_flight_overlap_and_keep_their_order(spark):
    took = {}
    for in_flight in (1, 10):
        begun = time.time()
        rows = annotation.model_responses(_requests(spark, 40), _slow_model, calls=Calls(in_flight=in_flight)).collect()
        took[in_flight] = time.time() - begun
        assert [r.batch_id for r in rows] == list(range(40))
        for r in rows:
            if r.batch_id % 10 == 7:
                assert (r.output, r.error) == (None, "ValueError: seven")
            else:
                assert r.output.startswith(f"p{r.batch_id} by ") and r.error is None
        threads = len({r.output.split(" by ")[1] for r in rows if r.output})
        assert threads == 1 if in_flight == 1 else 5 <= threads <= in_flight
    assert took[1] > 4 and took[10] < took[1] - 2.5


def test_a_task_reads_on_only_as_far_as_its_window(spark):
    """Batches are asked for once those under way no longer fill the window."""
    read = []

    def batches():
        for k in range(20):
            read.append(k)
            yield pa.RecordBatch.from_pydict({"batch_id": [k], "ids": [[k]], "prompt": [str(k)]})

    class Frame:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    run = annotation.model_responses(Frame(), lambda: lambda prompt, system: prompt, calls=Calls(in_flight=3))
    out = run(batches())
    next(out)
    assert len(read) <= 4
    assert [b.column("output")[0].as_py() for b in out] == [str(k) for k in range(1, 20)]


def _shaky_model():
    tries = collections.Counter()

    def answer(prompt, system):
        tries[prompt] += 1
        if tries[prompt] < 3:
            raise TimeoutError("busy")
        return f"after {tries[prompt]}"

    return answer


def test_a_failing_request_is_tried_again(spark):
    calls = Calls(attempts=3, wait=0.01)
    rows = annotation.model_responses(_requests(spark, 4), _shaky_model, calls=calls).collect()
    assert {r.output for r in rows} == {"after 3"}
    rows = annotation.model_responses(_requests(spark, 4), _shaky_model, calls=Calls(attempts=2, wait=0.01)).collect()
    assert {(r.output, r.error) for r in rows} == {(None, "TimeoutError: busy")}
    for wrong in ({"in_flight": 0}, {"attempts": 0}, {"wait": -1}):
        with pytest.raises(ValueError):
            Calls(**wrong)


def test_each_batch_goes_to_its_model(spark):
    models = {"a": lambda: lambda prompt, system: "A" + prompt, "b": lambda: lambda prompt, system: system + prompt}
    rows = annotation.model_responses(_requests(spark, 9), models, "S", Calls(in_flight=2)).collect()
    want = {0: lambda i: (f"Ap{i}", None), 1: lambda i: (f"Sp{i}", None), 2: lambda i: (None, "no model is called c")}
    assert [(r.output, r.error) for r in rows] == [want[i % 3](i) for i in range(9)]


def test_a_name_needs_the_mapping(spark):
    with pytest.raises(ValueError):
        argument_mine(posts(spark, 3), model="a")
