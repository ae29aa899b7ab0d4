"""From stored answers back to one result per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.answers import MISSING_ID, found_items, id_marks, once, slices


def _found_strict(ids: Column, output: Column) -> Column:
    return found_items(output)


def _found_compat(ids: Column, output: Column) -> Column:
    return once(
        id_marks(ids, output),
        lambda marks: F.zip_with(
            marks,
            slices(marks, output),
            lambda mark, value: F.struct(mark["id"].alias("id"), value.alias("value")),
        ),
    )


# (id, value) of the items of an answer, in its order.
MODES = {"strict": _found_strict, "compat": _found_compat}


def extract(responses: DataFrame, mode: str = "strict") -> DataFrame:
    """(batch_id, pos, id, result, error), one row per requested position.

    A result is the answer's value (of repeated ids the first), or the
    missing-id marker where the answer lacks the id, or null where the whole
    batch failed. Answers are searched once each and only (id, result) is exploded.
    """
    def lookup(found: Column, item_id: Column) -> Column:
        at = F.array_position(found["id"], item_id).cast("int")
        return F.when(at > 0, F.try_element_at(found["value"], at))

    results = once(
        MODES[mode](F.col("ids"), F.col("output")),
        lambda found: F.transform(
            "ids",
            lambda i, pos: F.struct(
                pos.cast("bigint").alias("pos"),
                i.alias("id"),
                F.when(F.col("output").isNotNull(), F.coalesce(lookup(found, i), F.lit(MISSING_ID))).alias("result"),
            ),
        ),
    )
    return (
        responses.select("batch_id", results.alias("_results"), "error")
        .select("batch_id", F.explode("_results").alias("_r"), "error")
        .select("batch_id", "_r.pos", "_r.id", "_r.result", "error")
    )


def attach(
    numbered: DataFrame,
    results: DataFrame,
    size: int,
    result: str,
    item_id: str = "external_id",
) -> DataFrame:
    """Put results beside the rows they were asked for, matched on ``rn`` and id.

    Position in the batch identifies the row, so repeated ids stay apart. Rows
    of a failed batch keep the value they had.
    """
    placed = results.select(
        (F.col("batch_id") * size + F.col("pos")).alias("rn"),
        F.col("id").alias(item_id),
        F.col("result").alias("_result"),
    )
    return (
        numbered.join(placed, ["rn", item_id], "left")
        .withColumn(result, F.coalesce("_result", result))
        .drop("_result")
    )
