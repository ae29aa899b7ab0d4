"""Streams that remember by key: items that wait for an answer, replies that wait for a parent.

What a micro-batch costs follows from what landed and what is due: the state is in
RocksDB, so only the keys a micro-batch touches are read. A key is a reply or post,
or a bucket of items, whose ids are read with it.
All times are landing times, which never run backwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from threadloom.session import runtime_conf

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Keys are text and never null: with a null among them, pandas would turn ids into floats.
_ITEM, _BEGAN = "item:", "began"
# Buckets of item state: few enough that calls of Python do not count, many enough to keep each small.
BUCKETS = 1 << 14
# Timestamps keep their microseconds on the way through JSON.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def start(writer, spark: SparkSession) -> StreamingQuery:
    """Start a query over what has landed, its state in RocksDB."""
    with runtime_conf(spark, spark__sql__streaming__stateStore__providerClass=_ROCKS):
        return writer.trigger(availableNow=True).start()


# A row of state is a bucket of items, one entry of every list for each.
STATE = (
    "items array<string>, payloads array<string>, sent array<int>, due array<bigint>, answered array<boolean>"
)
OUT = "item string, payload string, sent int, given_up boolean"
# A new item: no text, never sent, no timer, no answer.
_NEW = ("", 0, 0, False)


def item_turn(entry, landed, now: int, retry_ms: int, tries: int, forget_ms: int | None):
    """(entry or None, send, give up) of one item after one micro-batch.

    The entry is the item's row while it has no answer, how often it was sent, when
    its timer is due (0: none) and whether it has an answer. A new item is sent and
    gets a timer. When that expires without an answer, the item is sent again,
    ``tries`` times in all, and then given up. An answer ends the timer; ``forget_ms``
    later, if set, the item is as if it had never landed. ``landed`` is what came of
    it: time, whether an answer, largest sendable and unsendable text; None when its
    timer expired.
    """
    payload, sent, due, answered = entry
    send = give_up = False
    if landed is None:
        if answered:
            return None, False, False
        if sent >= tries:
            # As if it could not be sent: a text that lands later starts anew.
            give_up, due = True, 0
        else:
            send, due = True, now + retry_ms
    else:
        time, answer, good, bad = landed
        if answered and 0 < due <= time:
            # Due to be forgotten, though the timer has not fired yet.
            payload, sent, due, answered = _NEW
        waits = due > 0
        if answered:
            pass
        elif answer:
            payload, answered = "", True
            due = 0 if forget_ms is None else time + forget_ms
        elif good:
            # An item under way takes the text that landed last with its next try.
            payload = good
            if not waits:
                send, sent, due = True, 0, time + retry_ms
        elif bad and not payload:
            payload, give_up = bad, True
    return (payload, sent + send, due, answered), send, give_up


def item_state(retry_ms: int, tries: int, forget_ms: int | None):
    """The step of a bucket of items in one micro-batch, for ``applyInPandasWithState``.

    Every item takes its own ``item_turn``: those of which rows landed, and of the
    others those whose timer has expired. The bucket's timer is the first of its
    items'. One call for many items: a call costs milliseconds, an item microseconds.
    """

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = {}
        if state.exists:
            items, *columns = state.get
            held = dict(zip(items, zip(*columns, strict=True), strict=True))
        landed = {}
        if not state.hasTimedOut:
            for part in parts:
                names = ("item", "payload", "lost", "answer", "landed")
                for item, payload, lost, answer, time in zip(*(part[n].tolist() for n in names), strict=True):
                    if item == _BEGAN:
                        continue
                    latest, answers, good, bad = landed.get(item, (0, False, "", ""))
                    if payload is not None:
                        good, bad = (good, max(bad, payload)) if lost else (max(good, payload), bad)
                    landed[item] = (max(latest, time), answers or bool(answer), good, bad)
        expired = [item for item, entry in held.items() if 0 < entry[2] < now and item not in landed]
        out = []
        for item, what in [*landed.items(), *((item, None) for item in expired)]:
            entry, send, give_up = item_turn(held.get(item, _NEW), what, now, retry_ms, tries, forget_ms)
            if entry is None:
                del held[item]
            else:
                held[item] = entry
            if send or give_up:
                out.append((item, entry[0], entry[1], give_up))
        if held:
            state.update((list(held), *(list(column) for column in zip(*held.values(), strict=True))))
            if timers := [entry[2] for entry in held.values() if entry[2]]:
                # Every call ends the timer, which must lie after the time already reached.
                state.setTimeoutTimestamp(max(min(timers), now + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["item", "payload", "sent", "given_up"])

    return step


def _millis(time: timedelta) -> int:
    return time // timedelta(milliseconds=1)


def annotate_items(
    rows: DataFrame,
    annotate: Callable[[DataFrame], DataFrame],
    results_path: str,
    checkpoint: str,
    result: str,
    item_id: str = "external_id",
    texts: Sequence[str] = (),
    retry_after: timedelta = timedelta(hours=1),
    tries: int = 5,
    forget: timedelta | None = None,
    skew: timedelta = timedelta(minutes=1),
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Annotate items as they land, each once, and again while they have no answer.

    Like ``annotate_stream``, but seen ids and open rows are keyed state with timers:
    no micro-batch reads earlier results or open rows. Under ``results_path``, every
    micro-batch owns one folder of each of ``results`` (item, result), read by
    ``latest_results``; ``unsendable`` (rows given up); ``answers``, the ids that
    have an answer, which the stream itself reads in its next run.

    An item without an answer is sent again by the first run that begins
    ``retry_after`` and ``skew`` (by which drivers' clocks may differ) after it was sent, whether new files came or not, at most
    ``tries`` times in all. A row whose ``texts`` hold a null can never be sent and is
    given up at once. An item that was given up is sent again if it lands again with
    texts. Of several texts that land while an item waits, the last is sent, and of
    several in one micro-batch the largest. Rows without an id cannot be answered and
    are left out; ``split_rejects`` lists them. Answered ids stay in state for ever,
    or for ``forget``, after which an item that lands again is sent again.

    State is kept by bucket, a hash of the id: a micro-batch reads and writes the
    buckets of the items that landed or are due, ids and open texts. ``buckets`` is
    fixed with the checkpoint; the open texts of one must fit a task.
    """
    spark = rows.sparkSession
    schema, id_type = rows.schema, rows.schema[item_id].dataType
    answers = f"{results_path}/answers"
    answer_schema = T.StructType([T.StructField(item_id, id_type), T.StructField("epoch", T.LongType())])
    # The sign that a run began: it moves the time on although no file may have landed.
    spark.createDataFrame([(None, -1)], answer_schema).write.mode("append").partitionBy("epoch").parquet(answers)
    acknowledged = spark.readStream.schema(answer_schema).option("ignoreMissingFiles", "true").parquet(answers)
    lost: Column = F.lit(False)
    for text in texts:
        lost = lost | F.col(text).isNull()
    landed = (
        rows.where(F.col(item_id).isNotNull())
        .select(
            F.concat(F.lit(_ITEM), F.col(item_id).cast("string")).alias("item"),
            F.to_json(F.struct(*schema.names), _JSON).alias("payload"),
            lost.alias("lost"), F.lit(False).alias("answer"),
        )
        .unionByName(
            acknowledged.select(
                F.coalesce(F.concat(F.lit(_ITEM), F.col(item_id).cast("string")), F.lit(_BEGAN)).alias("item"),
                F.lit(None).cast("string").alias("payload"),
                F.lit(False).alias("lost"), F.col(item_id).isNotNull().alias("answer"),
            )
        )
        .withColumn("time", F.current_timestamp())
        .withWatermark("time", f"{_millis(skew)} milliseconds")
        .withColumn("landed", F.unix_millis("time"))
    )
    step = item_state(_millis(retry_after), tries, None if forget is None else _millis(forget))
    bucketed = landed.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)))
    due = bucketed.groupBy("bucket").applyInPandasWithState(
        step, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    result_schema = T.StructType([T.StructField(item_id, id_type), T.StructField(result, T.StringType())])
    by_epoch = T.StructType([*result_schema.fields, T.StructField("epoch", T.LongType())])
    # Epochs of this run: their answers are not in the state yet.
    own: list[int] = []

    def run(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        taken = f"{results_path}/taken/epoch={epoch}"
        batch.write.mode("overwrite").parquet(taken)
        stored = session.read.schema(OUT).parquet(taken)
        parsed = F.from_json("payload", schema, _JSON).alias("row")
        stored.where("given_up").select(parsed).select("row.*").write.mode("overwrite").parquet(
            f"{results_path}/unsendable/epoch={epoch}"
        )
        ready = stored.where("NOT given_up")
        if own:
            just = session.read.schema(by_epoch).parquet(f"{results_path}/results").where(
                F.col("epoch").between(own[0], own[-1]) & (F.col(result) != "")
            )
            named = just.select(F.concat(F.lit(_ITEM), F.col(item_id).cast("string")).alias("item"))
            ready = ready.join(named, "item", "left_anti")
        annotate(ready.select(parsed).select("row.*")).select(item_id, result).write.mode(
            "overwrite"
        ).parquet(f"{results_path}/results/epoch={epoch}")
        got = session.read.schema(result_schema).parquet(f"{results_path}/results/epoch={epoch}")
        got.where(F.col(result) != "").select(item_id).write.mode("overwrite").parquet(
            f"{answers}/epoch={epoch}"
        )
        own.append(epoch)

    return start(
        due.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), spark
    )


def late_parents(
    replies: DataFrame, wait: str = "1 day", keep: str | None = None, spread: int = 8
) -> DataFrame:
    """Add PARENT_URL and PARENT_content, whichever of reply and parent lands first.

    A reply whose parent has not landed waits in state and comes out when the parent
    does; after ``wait`` it comes out without one. A post, which answers nothing,
    comes out at once. A parent is found for ``keep`` after it landed, by default
    for ever: the state then grows with the posts, on disk. Ids that land again within
    ``wait`` count once; of different rows with one id the first to land stays. Rows
    without an id are left out.

    The replies to one parent are dealt to ``spread`` tasks; a parent is kept in each.
    """
    rows = (
        replies.where(F.col("id").isNotNull())
        .withColumn("_landed", F.current_timestamp())
        .withWatermark("_landed", wait)
        .dropDuplicatesWithinWatermark(["id"])
    )
    parents = rows.select(
        F.col("id").alias("_parent"), F.col("url").alias("PARENT_URL"),
        F.col("content").alias("PARENT_content"), F.col("_landed").alias("_parent_landed"),
        F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_parent_salt"),
    )
    children = rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int"))
    match = (
        F.col("in_reply_to_id").isNotNull()
        & (F.col("in_reply_to_id") == F.col("_parent"))
        & (F.col("_salt") == F.col("_parent_salt"))
        & (F.col("_parent_landed") <= F.col("_landed") + F.expr(f"INTERVAL {wait}"))
    )
    if keep is not None:
        match = match & (F.col("_parent_landed") >= F.col("_landed") - F.expr(f"INTERVAL {keep}"))
    return children.join(parents, match, "left").select(
        *replies.columns, "PARENT_URL", "PARENT_content"
    )
