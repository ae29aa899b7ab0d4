"""Chat formatting: turns laid out byte by byte in one Arrow buffer, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import flat

START, END = b"<|im_start|>", b"<|im_end|>\n"
LEARNED = "assistant"  # the role whose texts are under the loss mask
PART = 4 << 20  # bytes of text after which a conversation goes on in a new row
BLOCK = 2 << 20  # bytes of text laid out at once

# Texts: one more backslash inside "<|", "<\|", "<\\|" ..., so none holds "<|".
_CONTROL = re.compile(rb"<\\*\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_ROLE_CODES = {"\\": "\\\\", "\n": "\\n", "<": "\\l"}
_ROLE_NAMES = {code: text for text, code in _ROLE_CODES.items()}

FORMATTED = (
    "conv_id bigint, first_turn bigint, part bigint, n_turns bigint, body string, "
    "loss array<struct<start:bigint,end:bigint>>"
)


def escape_role(role: str) -> str:
    return re.sub(r"[\\\n<]", lambda m: _ROLE_CODES[m[0]], role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\.", lambda m: _ROLE_NAMES[m[0]], role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def lay_out(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, turn offsets, content ranges) of a block of turns.

    Lengths of header, escaped text and footer give every segment's place; the
    target index of each text byte is its own index plus its row's shift plus
    the backslashes put in before it.
    """
    data, offsets = flat(texts)
    lengths = np.diff(offsets)
    added = np.zeros(0, np.int64)
    if len(data) and (data == 0x3C).any():
        raw = data.tobytes()
        found = np.array(
            [(m.start(), m.end()) for m in _CONTROL.finditer(raw)], np.int64
        ).reshape(-1, 2)
        row = np.searchsorted(offsets, found[:, 0], "right") - 1
        # A match that ends in the next text is none.
        added = found[found[:, 1] <= offsets[row + 1], 0] + 1
    extra = np.bincount(np.searchsorted(offsets, added - 1, "right") - 1, minlength=len(lengths))

    coded = roles.fill_null("").dictionary_encode()
    heads = [
        np.frombuffer(START + escape_role(r).encode() + b"\n", np.uint8)
        for r in coded.dictionary.to_pylist()
    ]
    kind = coded.indices.to_numpy()
    head = np.array([len(h) for h in heads], np.int64)[kind] if heads else np.zeros(0, np.int64)
    foot = np.frombuffer(END, np.uint8)

    places = np.concatenate([[0], np.cumsum(head + lengths + extra + len(foot))])
    begins = places[:-1] + head
    out = np.empty(int(places[-1]), np.uint8)
    for k, h in enumerate(heads):
        out[places[:-1][kind == k][:, None] + np.arange(len(h))] = h
    out[(places[1:] - len(foot))[:, None] + np.arange(len(foot))] = foot
    shift = begins - offsets[:-1] - (np.cumsum(extra) - extra)
    target = np.arange(len(data)) + np.repeat(shift, lengths)
    if len(added):
        before = np.zeros(len(data) + 1, np.int64)
        before[added] = 1
        target += np.cumsum(before)[:-1]
        out[target[added] - 1] = 0x5C
    out[target] = data
    return out, places, np.stack([begins, begins + lengths + extra], axis=1)


def _parts(table: pa.Table) -> np.ndarray:
    """First rows of the parts of a table sorted by conversation."""
    conv = table.column("conv_id").combine_chunks()
    same = conv.fill_null(0).to_numpy()
    null = conv.is_null().to_numpy(zero_copy_only=False)
    size = _sizes(table.column("text"))
    before = np.cumsum(size) - size
    new = np.ones(len(same), bool)
    new[1:] = (same[1:] != same[:-1]) | (null[1:] != null[:-1])
    starts = np.flatnonzero(new)
    since = before - np.repeat(before[starts], np.diff(np.append(starts, len(same))))
    step = since // PART
    new[1:] |= step[1:] != step[:-1]
    return np.flatnonzero(new)


def _sizes(column) -> np.ndarray:
    return np.diff(flat(column)[1])


def _formatted(table: pa.Table, starts: np.ndarray, serial: int) -> Iterator[pa.RecordBatch]:
    """One row per part, in blocks of whole parts."""
    size = np.append(np.cumsum(_sizes(table.column("text"))), 0)
    stops = np.append(starts[1:], table.num_rows)
    first = 0
    while first < len(starts):
        base = size[starts[first] - 1] if starts[first] else 0
        last = first + 1
        while last < len(starts) and size[stops[last] - 1] - base <= BLOCK:
            last += 1
        lo, hi = int(starts[first]), int(stops[last - 1])
        rows = table.slice(lo, hi - lo).combine_chunks()
        roles, texts = (rows.column(c).combine_chunks() for c in ("role", "text"))
        out, places, contents = lay_out(roles, texts)
        heads = starts[first:last] - lo
        edges = np.append(heads, hi - lo)
        learned = np.flatnonzero(
            roles.fill_null("").to_numpy(zero_copy_only=False) == LEARNED
        )
        part = np.searchsorted(heads, learned, "right") - 1
        spans = contents[learned] - places[heads[part]][:, None]
        structs = pa.StructArray.from_arrays(
            [pa.array(spans[:, 0]), pa.array(spans[:, 1])], ["start", "end"]
        )
        loss = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(learned, edges).astype(np.int32)), structs
        )
        body = pa.StringArray.from_buffers(
            len(heads), pa.py_buffer(places[edges].astype(np.int32)), pa.py_buffer(out)
        )
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("conv_id").combine_chunks().take(pa.array(heads)),
                rows.column("turn").combine_chunks().take(pa.array(heads)),
                pa.array(np.arange(len(heads)) + serial + first),
                pa.array(np.diff(edges)),
                body,
                loss,
            ],
            ["conv_id", "first_turn", "part", "n_turns", "body", "loss"],
        )
        first = last


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> parts. The last part of a batch waits for the next batch."""
    held, serial = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        starts = _parts(table)
        held = table.slice(int(starts[-1]))
        if len(starts) > 1:
            yield from _formatted(table.slice(0, int(starts[-1])), starts[:-1], serial)
            serial += len(starts) - 1
    if held is not None:
        yield from _formatted(held, np.array([0]), serial)


def format_chats(conversations: DataFrame) -> DataFrame:
    """Conversations as training texts: one row per conversation or part of one.

    Every turn becomes ``<|im_start|>role\\n`` text ``<|im_end|>\\n``. Control
    strings inside texts are escaped by one backslash, reversibly. ``loss`` lists
    the byte ranges of the assistant's texts in ``body``. Turns are range
    partitioned by conversation and turn, so that one conversation may fill many
    tasks; parts of a conversation are ordered by (first_turn, part) and their
    bodies joined up are the whole. Most conversations have one part; one goes on
    in another after 4 MB of text, or where a range of turns ends.

    Null text or role counts as empty; null turns come first, equal turns by
    role and text; a null conversation id is a conversation of its own. Repeated
    rows are repeated turns. Other columns are ignored; an empty table gives no
    rows.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return (
        turns.repartitionByRange("conv_id", "turn")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_format, FORMATTED)
    )


def parse_body(body: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a body."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(body)]


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation; holds one body and two running digests."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )
    state = None
    for batch in batches:
        done = []
        for conv, body, loss in zip(
            batch.column("conv_id").to_pylist(), batch.column("body"), batch.column("loss"), strict=True
        ):
            if state is None or state[0] != conv:
                if state is not None:
                    done.append(state)
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            raw = body.as_buffer().to_pybytes()
            text = raw.decode()
            for role, said in parse_body(text):
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode())
            for span in loss.as_py():
                learned = unescape(raw[span["start"] : span["end"]].decode())
                state[3] += len(learned)
                state[4].update(learned.encode())
            state[5] += len(text)
        yield _rows(done, schema)
    if state is not None:
        yield _rows([state], schema)


def _rows(states: list, schema: pa.Schema) -> pa.RecordBatch:
    rows = [(c, n, a.hexdigest(), m, b.hexdigest(), f) for c, n, a, m, b, f in states]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted parts hold, read back from them.

    A digest over a whole conversation runs in order, so the parts of one
    conversation pass through one task, one at a time; nothing is gathered.
    """
    return (
        formatted.select("conv_id", "first_turn", "part", "body", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "first_turn", "part")
        .mapInArrow(_digest, DIGESTS)
    )
