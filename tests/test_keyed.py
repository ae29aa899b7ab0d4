"""Streams with keyed state: items wait for answers, replies for their parents."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadloom.bindings import tables
from threadloom.operators import threads
from threadloom.session import runtime_conf
from threadloom.streaming import jobs, keyed

ROWS = "external_id long, content string, at timestamp, n long"
NOW = timedelta(0)
BIG = 123456789012345678


class Asked:
    """Answers ids in ``known``; keeps what it was asked."""

    def __init__(self):
        self.known, self.calls = set(), []

    def __call__(self, df):
        rows = df.collect()
        self.calls += [tuple(r) for r in rows]
        answer = F.when(F.col("external_id").isin(*self.known, -1), F.concat(F.lit("re "), "content"))
        return df.withColumn("AM_output", answer)

    def take(self):
        calls, self.calls = sorted(self.calls, key=str), []
        return calls


@pytest.fixture
def items(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    asked = Asked()

    def land(*rows):
        spark.createDataFrame([(*r, None, None)[:4] for r in rows], ROWS).coalesce(1).write.mode("append").parquet(landed)

    def run(**options):
        stream = jobs.landed_stream(spark, landed, spark.createDataFrame([], ROWS).schema)
        with runtime_conf(spark, spark__sql__shuffle__partitions="1"):
            keyed.annotate_items(
                stream, asked, out, state, "AM_output", skew=NOW, **{"texts": ["content"], **options}
            ).awaitTermination()
        return [(r[0], r[1]) for r in asked.take()]

    def results():
        rows = jobs.latest_results(spark, out, "AM_output").collect()
        return {r.external_id: r.AM_output for r in rows}

    def given_up():
        return sorted((r[0], r[1]) for r in spark.read.parquet(f"{out}/unsendable").collect())

    land()
    return type("Items", (), dict(asked=asked, land=land, run=run, results=results, given_up=given_up, spark=spark))


def test_items_are_sent_once_and_again_when_due(items):
    at = datetime(2024, 1, 2, 3, 4, 5, 678901)
    items.asked.known = {1, BIG}
    items.land((1, "a"), (2, "b"), (BIG, "c", at, BIG + 1), (None, "nobody"))
    first = items.run(tries=1000)
    assert first == [(1, "a"), (BIG, "c"), (2, "b")]
    # Landed again, answered or under way: nothing is due within the hour.
    items.land((1, "a"), (2, "newer"), (2, "newer"))
    assert items.run(tries=1000) == []
    assert items.results() == {1: "re a", 2: None, BIG: "re c"}
    assert items.given_up() == []


def test_timers_fire_without_new_files(items):
    items.asked.known = {1}
    items.land((1, "a"), (2, "b"))
    assert items.run(retry_after=NOW, tries=1000)[:2] == [(1, "a"), (2, "b")]
    # The waiting item takes the text that landed last; the answered one is left alone.
    items.land((2, "newer"))
    items.asked.known = {1, 2}
    assert set(items.run(retry_after=NOW, tries=1000)) <= {(2, "b"), (2, "newer")}
    assert items.run(retry_after=NOW, tries=1000) == []
    assert items.results()[1] == "re a" and items.results()[2] is not None


def test_items_are_given_up_and_start_anew(items):
    items.land((1, None), (2, "b"), (3, None), (3, "c"))
    asked = []
    for _ in range(4):
        asked += items.run(retry_after=NOW, tries=2)
    # Each was tried twice; a row with a null text never.
    assert sorted(asked) == [(2, "b"), (2, "b"), (3, "c"), (3, "c")]
    assert items.given_up() == [(1, None), (2, "b"), (3, "c")]
    items.asked.known = {1, 2}
    items.land((1, "now"), (1, None), (2, "again"))
    assert items.run(retry_after=NOW, tries=2) == [(1, "now"), (2, "again")]
    assert items.results() == {1: "re now", 2: "re again", 3: None}


def test_answered_ids_can_be_forgotten(items):
    items.asked.known = {1}
    items.land((1, "a"))
    assert items.run(forget=NOW) == [(1, "a")]
    # The answer reaches the state and is forgotten by the end of this run.
    assert items.run(forget=NOW) == []
    items.land((1, "later"))
    assert items.run(forget=NOW) == [(1, "later")]


def test_every_column_survives_the_wait(items):
    row = (BIG, 'quote " and \n ü', datetime(2024, 1, 2, 3, 4, 5, 678901), -BIG)
    items.land(row)
    seen = []
    answer = items.asked.__class__.__call__
    items.asked.__class__.__call__ = lambda self, df: (seen.extend(tuple(r) for r in df.collect()), answer(self, df))[1]
    try:
        items.run()
    finally:
        items.asked.__class__.__call__ = answer
    assert seen == [row]


class Held:
    """A bucket's state between calls, as ``item_state`` uses it."""

    def __init__(self):
        self.exists, self.get, self.timer, self.hasTimedOut, self.now = False, None, None, False, 0

    def getCurrentWatermarkMs(self):
        return self.now

    def update(self, value):
        self.exists, self.get = True, value

    def remove(self):
        self.exists, self.get = False, None

    def setTimeoutTimestamp(self, at):
        assert at > self.now
        self.timer = at


def test_one_call_serves_many_items_each_with_its_timer():
    step, state = keyed.item_state(retry_ms=10, tries=2, forget_ms=30), Held()

    def call(now, *rows):
        state.now, state.hasTimedOut, state.timer = now, not rows, None
        part = pd.DataFrame(rows, columns=["item", "payload", "lost", "answer", "landed"])
        sent = [tuple(r) for out in step((7,), iter([part]), state) for r in out.itertuples(index=False)]
        return sorted(sent), state.timer

    many = [(f"item:{i}", "t", False, False, 100) for i in range(500)]
    sent, timer = call(90, *many, ("item:x", "lost", True, False, 100), ("began", None, False, False, 100))
    assert len(sent) == 501 and ("item:x", "lost", 0, True) in sent and timer == 110
    # All but two are answered; those two are due at their own times.
    answers = [(f"item:{i}", None, False, True, 105) for i in range(2, 500)]
    assert call(100, *answers, ("item:new", "n", False, False, 105)) == ([("item:new", "n", 1, False)], 110)
    assert call(112) == ([("item:0", "t", 2, False), ("item:1", "t", 2, False)], 115)
    assert call(116) == ([("item:new", "n", 2, False)], 122)
    # Rows of one item leave the others' expired timers to fire in the same call.
    assert call(123, ("item:0", None, False, True, 125)) == ([("item:1", "t", 2, True)], 126)
    assert call(200) == ([("item:new", "n", 2, True)], None)
    # Answered items are forgotten, the others stay.
    assert sorted(state.get[0]) == ["item:1", "item:new", "item:x"]


def test_items_of_one_bucket_are_sent_apart(items):
    items.asked.known = {1}
    items.land((1, "a"), (2, "b"))
    assert items.run(tries=1000, buckets=1) == [(1, "a"), (2, "b")]
    items.land((1, "a"), (2, "newer"), (3, "c"))
    assert items.run(tries=1000, buckets=1) == [(3, "c")]
    assert items.results() == {1: "re a", 2: None, 3: None}


def linked(frame):
    return sorted((r.id, r.in_reply_to_id, r.PARENT_URL, r.PARENT_content) for r in frame.collect())


def test_late_parents_equal_the_batch_link(spark, tmp_path, small):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = tables.replies(spark, small)

    def run(part):
        part.coalesce(1).write.mode("append").parquet(landed)
        stream = jobs.landed_stream(spark, landed, rows.schema, max_files_per_trigger=1)
        found = keyed.late_parents(stream)
        keyed.start(
            found.writeStream.format("parquet").option("checkpointLocation", state).option("path", out), spark
        ).awaitTermination()
        return spark.read.schema(found.schema).parquet(out)

    # Replies land first; the posts they answer in a later run, some rows twice.
    odd = rows.where("reply_depth % 2 = 1")
    assert run(odd).count() == 0
    whole = run(rows)
    assert linked(whole) == linked(threads.link_parents(rows))


def test_a_reply_without_parent_comes_out_after_the_wait(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id long, in_reply_to_id long, url string, content string"

    def run(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        found = keyed.late_parents(
            jobs.landed_stream(spark, landed, spark.createDataFrame([], schema).schema), wait="1 second"
        )
        keyed.start(
            found.writeStream.format("parquet").option("checkpointLocation", state).option("path", out), spark
        ).awaitTermination()
        return linked(spark.read.schema(found.schema).parquet(out))

    # A post comes out at once, a null id never.
    assert run((1, None, "u1", "post"), (3, 2, "u3", "orphan"), (None, 1, "u", "x")) == [(1, None, None, None)]
    import time

    time.sleep(2)
    assert run((4, 1, "u4", "reply")) == [
        (1, None, None, None), (3, 2, None, None), (4, 1, "u1", "post")
    ]
