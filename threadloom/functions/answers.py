"""Finding a model's answer items in its free text.

A request asks for a few dozen ids at most, so arrays inside the answer's own
row do it; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from threadloom.functions.text import strip

# Fixed value: what a row gets whose id the answer does not contain.
MISSING_ID = "ERROR: HALLUCINATION"

# An answer item up to its value; keys, id and value may be quoted.
_ITEM = r"""\[\s*"?id"?\s*:\s*"?\d+"?\s*,\s*"?annotation"?\s*:\s*"?"""
# What stands behind the bracket that ends an item: a next item, the list's end, a new line.
_AFTER = rf"""(?=\s*(?:[,;.]\s*)?(?:{_ITEM}|\]|```|$)|[ \t]*\r?\n)"""
# Put behind every such bracket, so that a token tells it from others.
_MARK = "\u0001"
_TOKEN = rf'{_ITEM}|"\s*\]{_MARK}?|\]{_MARK}?|[\["]|[^\[\]"]+'
# Kinds of tokens.
_TEXT, _SEPARATOR, _START, _CLOSE, _BRACKET, _INNER = range(6)
_STATE = (
    "at", "open", "quoted", "id", "start", "depth", "near", "outer", "ending", "inner", "bare", "items",
)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once however often it is used.

    Spark may put an expression in place of each use of a column; it never does
    so with the argument of a function.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _token(text: Column) -> Column:
    """What the scanner needs to know of a token, found out once."""
    first, n = F.substring(text, 1, 1), F.char_length(text)
    long = n > 1
    kind = (
        F.when(first == "[", F.when(long, _START).otherwise(_INNER))
        .when(first == '"', F.when(long, _CLOSE).otherwise(_TEXT))
        .when(first == "]", _BRACKET)
        .when(text.rlike(r"^[\s,;.]+$"), _SEPARATOR)
        .otherwise(_TEXT)
    )
    return F.struct(
        kind.alias("kind"),
        n.alias("n"),
        F.endswith(text, F.lit(_MARK)).alias("marked"),
        F.endswith(text, F.lit('"')).alias("quote"),
        F.when((first == "[") & long, F.regexp_extract(text, r"(\d+)", 1)).otherwise("").alias("id"),
    )


def _scan(state: Column, token: Column) -> Column:
    """One step over an answer: the state after ``token``.

    depth: brackets open inside the value. Ends the value may have: near, with
    nothing but separators behind it; outer, the last bracket outside of inner
    ones; ending, inner ones that look like the end of an item; inner, any inner
    one; bare, a bracket without the closing quote of a quoted value. 0 is none.
    """
    kind, marked = token["kind"], token["marked"]
    opened, nested, at = state["open"], state["depth"] > 0, state["at"]
    is_close = (kind == _CLOSE) | ((kind == _BRACKET) & ~state["quoted"])
    is_bracket = (kind == _BRACKET) & state["quoted"]
    none = F.lit(0)
    starts = (kind == _START) & (~opened | (state["near"] > 0) | (state["outer"] > 0))
    ends = is_close & opened & ~nested & marked
    after = at + token["n"]
    done = F.when(starts & opened, F.when(state["near"] > 0, state["near"]).otherwise(state["outer"])).when(ends, at)
    item = F.struct(state["id"].alias("id"), state["start"].alias("start"), done.alias("end"))
    step = {
        "at": after,
        "open": starts | (opened & ~ends),
        "quoted": F.when(starts, token["quote"]).otherwise(state["quoted"]),
        "id": F.when(starts, token["id"]).otherwise(state["id"]),
        "start": F.when(starts, after).otherwise(state["start"]),
        "depth": F.when(starts, none)
        .when((kind == _START) | (kind == _INNER), state["depth"] + 1)
        .when((is_close | is_bracket) & nested, state["depth"] - 1)
        .otherwise(state["depth"]),
        "near": F.when(starts, none)
        .when(is_close | (is_bracket & ~nested), at)
        .when(kind == _SEPARATOR, state["near"])
        .otherwise(none),
        "outer": F.when(starts, none).when(is_close & ~nested, at).otherwise(state["outer"]),
        "ending": F.when(starts, none)
        .when(is_close & nested & marked & (state["ending"] == 0), at)
        .otherwise(state["ending"]),
        "inner": F.when(starts, none).when(is_close & nested, at).otherwise(state["inner"]),
        "bare": F.when(starts, none).when(is_bracket, at).otherwise(state["bare"]),
        "items": F.when(done.isNotNull(), F.array_append(state["items"], item)).otherwise(state["items"]),
    }
    return F.struct(*[value.alias(name) for name, value in step.items()])


def _last(state: Column) -> Column:
    """All items, also one that the text ends in."""
    ends = [state[name] for name in ("outer", "ending", "inner", "bare")]
    end = F.coalesce(*[F.when(e > 0, e) for e in ends])
    item = F.struct(state["id"].alias("id"), state["start"].alias("start"), end.alias("end"))
    return F.when(state["open"] & end.isNotNull(), F.array_append(state["items"], item)).otherwise(state["items"])


def found_items(output: Column) -> Column:
    """Strict mode: (id, value) of the well-formed items, in answer order.

    A scanner goes over the answer once, with the brackets open inside a value as
    its state. A value ends at ``"]`` (unquoted ones: at ``]``) outside of inner
    brackets, where a next item, the end of the list or a new line follows; if none
    does, at the last one before the next item. An item start inside a value that
    has not ended yet is part of it: a justification may quote an item. Commas,
    semicolons, numbering, a code fence or prose may stand between and after items.
    Brackets that are opened and never closed, or the reverse, cost no item.
    """
    marked = F.regexp_replace(F.replace(output, F.lit(_MARK), F.lit("")), rf"\]{_AFTER}", f"]{_MARK}")
    fresh = {
        "at": F.lit(1), "open": F.lit(False), "quoted": F.lit(False), "id": F.lit(""),
        "items": F.array().cast("array<struct<id:string,start:int,end:int>>"),
    }
    start = F.struct(*[fresh.get(name, F.lit(0)).alias(name) for name in _STATE])

    def item(text: Column, place: Column) -> Column:
        value = F.replace(F.substring(text, place["start"], place["end"] - place["start"]), F.lit(_MARK), F.lit(""))
        quoted = F.substring(text, place["start"] - 1, F.lit(1)) == '"'
        bare = F.regexp_replace(strip(value), r'"?\s*$', "")
        return F.struct(place["id"].try_cast("bigint").alias("id"), F.when(quoted, value).otherwise(bare).alias("value"))

    def items(text: Column) -> Column:
        tokens = F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), _token)
        return F.transform(F.aggregate(tokens, start, _scan, _last), lambda place: item(text, place))

    return F.filter(once(marked, items), lambda found: found["id"].isNotNull())


def id_marks(ids: Column, output: Column) -> Column:
    """Compatible mode: (at, id) of each id's first occurrence, in text order.

    An id is searched as plain text, so one inside another number or inside a
    justification counts; of two ids at one place the smaller comes first.
    """
    places = F.transform(
        F.array_distinct(ids),
        lambda i: F.struct(F.instr(output, i.cast("string")).alias("at"), i.alias("id")),
    )
    return F.array_sort(F.filter(places, lambda mark: mark["at"] > 0))


def slices(marks: Column, output: Column) -> Column:
    """Compatible mode: text from each mark to the next, stripped."""
    ends = F.concat(
        F.slice(marks["at"], F.lit(2), F.greatest(F.size(marks), F.lit(1))),
        F.array(F.char_length(output) + 1),
    )
    return F.zip_with(
        marks, ends, lambda mark, end: strip(F.substring(output, mark["at"], end - mark["at"]))
    )
