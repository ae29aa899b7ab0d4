"""Calling a user-supplied model over request batches."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from threadloom.session import runtime_conf, scratch_path, store

# A model takes (prompt, system prompt) and returns text; a factory makes one
# per task, so clients and connections are never shipped from the driver.
Model = Callable[[str, str], str | None]
ModelFactory = Callable[[], Model]

RESPONSE = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("output", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# Prompts per Arrow batch: a prompt may hold 25 long texts.
PROMPTS_PER_ARROW_BATCH = 64


def route(models: Mapping[str, ModelFactory], name: str) -> ModelFactory:
    """Factory registered under ``name``; an unknown name answers nothing."""
    return models.get(name, lambda: lambda prompt, system: None)


@dataclass(frozen=True)
class Calls:
    """How a task calls the model.

    in_flight: requests a task has under way at once; each of as many threads has
    a model of its own. attempts: tries of a request that fails; wait: seconds
    before the second try, doubled before every further one.
    """

    in_flight: int = 1
    attempts: int = 1
    wait: float = 1.0

    def __post_init__(self):
        if self.in_flight < 1 or self.attempts < 1 or self.wait < 0:
            raise ValueError("in_flight and attempts are at least 1, wait at least 0")


class _Unknown(Exception):
    """A request names a model that nobody registered."""


class _Caller:
    """Models made as they are needed, one per thread and name."""

    def __init__(self, factory: ModelFactory | Mapping[str, ModelFactory], system_prompt: str, calls: Calls):
        self.factory, self.system_prompt, self.calls = factory, system_prompt, calls
        self.held = threading.local()

    def _model(self, name: str | None) -> Model:
        models = self.held.__dict__.setdefault("models", {})
        if name not in models:
            if isinstance(self.factory, Mapping):
                if name not in self.factory:
                    raise _Unknown(f"no model is called {name}")
                models[name] = route(self.factory, name)()
            else:
                models[name] = self.factory()
        return models[name]

    def answer(self, prompt: str, name: str | None) -> tuple[str | None, str | None]:
        """(output, error) of one request."""
        wait, error = self.calls.wait, None
        for attempt in range(self.calls.attempts):
            if attempt:
                time.sleep(wait)
                wait *= 2
            try:
                output = self._model(name)(prompt, self.system_prompt)
            except _Unknown as unknown:
                return None, str(unknown)
            except Exception as failure:
                error = f"{type(failure).__name__}: {failure}"
            else:
                if output is not None:
                    return output, None
                error = "no text returned"
        return None, error


def model_responses(
    requests: DataFrame,
    factory: ModelFactory | Mapping[str, ModelFactory],
    system_prompt: str = "",
    calls: Calls = Calls(),
) -> DataFrame:
    """(batch_id, ids, output, error), not evaluated yet.

    ``factory`` makes the model, or is a mapping of names to factories; then the
    requests have a column ``model`` with a name, and one that is not in the
    mapping leaves its batch without an answer. A task keeps ``calls.in_flight``
    requests under way while it reads on, holds at most that many and one Arrow
    batch more, and returns answers in the order of the requests.

    A call that raises or returns no text leaves its batch with a null output
    and the error text; the other batches go on.
    """
    routed = isinstance(factory, Mapping)

    def collected(batch: pa.RecordBatch, answers: list[Future]) -> pa.RecordBatch:
        found = [answer.result() for answer in answers]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("batch_id"),
                batch.column("ids"),
                pa.array([output for output, _ in found], pa.string()),
                pa.array([error for _, error in found], pa.string()),
            ],
            names=RESPONSE.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caller = _Caller(factory, system_prompt, calls)
        waiting: deque[tuple[pa.RecordBatch, list[Future]]] = deque()
        ahead = 0
        with ThreadPoolExecutor(calls.in_flight) as pool:
            for batch in batches:
                prompts = batch.column("prompt").to_pylist()
                names = batch.column("model").to_pylist() if routed else [None] * len(prompts)
                answers = [pool.submit(caller.answer, *pair) for pair in zip(prompts, names, strict=True)]
                waiting.append((batch, answers))
                ahead += len(answers)
                # The oldest batch is waited for once those behind it keep all threads busy.
                while waiting and ahead - len(waiting[0][1]) >= calls.in_flight:
                    ahead -= len(waiting[0][1])
                    yield collected(*waiting.popleft())
            while waiting:
                yield collected(*waiting.popleft())

    columns = ["batch_id", "ids", "prompt"] + (["model"] if routed else [])
    return requests.select(*columns).mapInArrow(run, RESPONSE)


def _responses_at(spark: SparkSession, path: str, run_id: str | None) -> str:
    """The folder of one run's answers, made if it is not there."""
    if run_id is None:
        raise ValueError("answers kept at a path need a run_id")
    target = f"{path.rstrip('/')}/run_id={run_id}"
    spark.createDataFrame([], RESPONSE).write.mode("append").parquet(target)
    return target


def stored_answers(spark: SparkSession, path: str, run_id: str | None) -> DataFrame:
    """One answer with text per request (batch_id, ids) of a run; of several the same one always."""
    return (
        spark.read.schema(RESPONSE)
        .parquet(_responses_at(spark, path, run_id))
        .where("output IS NOT NULL")
        .groupBy("batch_id", "ids")
        .agg(F.min("output").alias("output"))
        .withColumn("error", F.lit(None).cast("string"))
    )


def call_model(
    requests: DataFrame,
    factory: ModelFactory | Mapping[str, ModelFactory],
    system_prompt: str = "",
    run_id: str | None = None,
    path: str | None = None,
    calls: Calls = Calls(),
) -> DataFrame:
    """Call the model once per request and return a scan of the stored answers.

    Answers are written before anything reads them, so no later join, action or
    lost executor repeats paid calls. With ``path`` they are kept there under
    ``run_id``; repeating a run after a crash or failed calls sends only the
    requests, known by their batch and ids, that have no answer yet. Only the
    answers to ``requests`` come back.
    """
    spark = requests.sparkSession
    with runtime_conf(
        spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(PROMPTS_PER_ARROW_BATCH)
    ):
        if path is None:
            target = scratch_path(spark, "responses")
            model_responses(requests, factory, system_prompt, calls).write.parquet(target)
            return spark.read.schema(RESPONSE).parquet(target)
        target = _responses_at(spark, path, run_id)
        wanted = store(requests.select("batch_id", "ids"), "requests")
        answered = stored_answers(spark, path, run_id).select("batch_id", "ids")
        open_requests = requests.join(answered, ["batch_id", "ids"], "left_anti")
        # A finished task's answers stay even if the job as a whole fails.
        model_responses(open_requests, factory, system_prompt, calls).write.mode("append").option(
            "mapreduce.fileoutputcommitter.algorithm.version", "2"
        ).parquet(target)
    every = spark.read.schema(RESPONSE).parquet(target)
    rank = F.struct(F.col("output").isNull(), "output", "error")
    return (
        every.join(wanted, ["batch_id", "ids"], "left_semi")
        .groupBy("batch_id", "ids")
        .agg(F.min_by(F.struct("output", "error"), rank).alias("_kept"))
        .select("batch_id", "ids", "_kept.*")
    )
