"""Fill-in-middle: a set of line ends, kept in containers, gives both cuts of a text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from threadloom.llm.common import flat, free_name

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE = 100  # per cent of the documents that are cut
SUFFIX_FIRST = 50  # per cent of the cut documents whose suffix comes first
CHUNK = 1 << 16  # positions a container covers
BITMAP_BYTES = CHUNK // 8


@dataclass(frozen=True)
class Container:
    """Sorted 16-bit positions as a list, as a bitmap or as runs, whichever is smallest."""

    kind: str
    values: np.ndarray  # array: positions; bitmap: 64-bit words; run: first positions
    before: np.ndarray  # bitmap, run: positions held before each word or run

    @classmethod
    def of(cls, low: np.ndarray) -> Container:
        firsts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        sizes = {"array": 2 * len(low), "bitmap": BITMAP_BYTES, "run": 4 * len(firsts)}
        kind = min(sizes, key=sizes.__getitem__)
        if kind == "array":
            return cls(kind, low.astype(np.uint16), np.zeros(0, np.int64))
        if kind == "run":
            return cls(kind, low[firsts].astype(np.uint16), firsts)
        bits = np.zeros(CHUNK, np.uint8)
        bits[low] = 1
        counts = bits.reshape(-1, 64).sum(axis=1, dtype=np.int64)
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        return cls(kind, words, np.cumsum(counts) - counts)

    def select(self, k: int) -> int:
        """The position with ``k`` smaller ones in this container."""
        if self.kind == "array":
            return int(self.values[k])
        at = int(np.searchsorted(self.before, k, "right")) - 1
        left = k - int(self.before[at])
        if self.kind == "run":
            return int(self.values[at]) + left
        word = np.unpackbits(self.values[at : at + 1].view(np.uint8), bitorder="little")
        return 64 * at + int(np.flatnonzero(word)[left])


class Boundaries:
    """The last byte of every line of a text, a container for each 64 KiB that holds any."""

    def __init__(self, data: np.ndarray):
        self.keys: list[int] = []
        self.containers: list[Container] = []
        totals = [0]
        for first in range(0, len(data), CHUNK):
            part = data[first : first + CHUNK]
            low = np.flatnonzero(part == 0x0A)
            if first + len(part) == len(data) and part[-1] != 0x0A:
                low = np.append(low, len(part) - 1)
            if len(low):
                self.keys.append(first)
                self.containers.append(Container.of(low))
                totals.append(totals[-1] + len(low))
        self.totals = np.array(totals)

    def __len__(self) -> int:
        return int(self.totals[-1])

    def cut(self, units: int) -> int:
        """The byte offset after that many lines."""
        if units == 0:
            return 0
        at = int(np.searchsorted(self.totals, units - 1, "right")) - 1
        return self.keys[at] + self.containers[at].select(units - 1 - int(self.totals[at])) + 1


def _code_points(data: np.ndarray) -> int:
    return int(((data & 0xC0) != 0x80).sum())


_CUT = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"


def _cutter(rate: int, suffix_first: int):
    marks = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
    opens, closes, fills = marks

    def apply(texts: pa.Array, draws: pa.Array) -> pa.Array:
        data, offsets = flat(texts)
        drawn = flat(draws)[0].view(">u4").reshape(-1, 4).tolist()
        n, forms, prefixes, middles, outputs = [], [], [], [], []
        for row, (h1, h2, h3, h4) in enumerate(drawn):
            part = data[offsets[row] : offsets[row + 1]]
            raw = part.tobytes()
            lines = Boundaries(part)
            n.append(len(lines))
            if not raw or h3 % 100 >= rate or any(mark in raw for mark in marks):
                forms.append("plain")
                prefixes.append(None)
                middles.append(None)
                outputs.append(raw)
                continue
            low, high = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
            a, b = lines.cut(low), lines.cut(high)
            prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
            if h4 % 100 < suffix_first:
                forms.append("spm")
                pieces = (closes, suffix, opens, prefix, fills, middle)
            else:
                forms.append("psm")
                pieces = (opens, prefix, closes, suffix, fills, middle)
            prefixes.append(_code_points(part[:a]))
            middles.append(_code_points(part[a:b]))
            outputs.append(b"".join(pieces))
        return pa.StructArray.from_arrays(
            [
                pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
                pa.array(middles, pa.int64()), pa.array(outputs, pa.string()),
            ],
            ["n", "form", "prefix_chars", "middle_chars", "output"],
        )

    return apply


def fill_in_middle(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    name: str = "fim",
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    seed: int = SEED,
) -> DataFrame:
    """``documents`` with a struct ``name``: n, form, prefix_chars, middle_chars, output.

    A text is cut after two numbers of lines, drawn from a hash of ``seed`` and
    the id, so reruns agree. The ends of its lines are a set of containers (list,
    bitmap or runs per 64 KiB) with cumulative counts: a search for the container
    and a selection inside it give a cut. Lines end in an ASCII byte, so cuts on
    bytes are cuts between code points. ``restore`` gives the text back.

    Null and empty texts, texts that hold one of the three marks, and those above
    ``rate`` stay as they are (form ``plain``, no counts of characters); n counts
    their lines all the same. A null id draws as an empty one, equal ids draw
    alike. A text without line breaks is one line. Rows that repeat stay; a column
    called ``name`` is replaced; an empty table gives no rows.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    draws = F.unhex(F.substring(F.sha2(key, 256), 1, 32))
    cut = arrow_udf(_cutter(rate, suffix_first), _CUT)
    return documents.withColumn(name, cut(F.col(text).cast("string"), draws))


def restore(output: Column, form: Column) -> Column:
    """The text an output was made of.

    No part holds a mark, and no mark begins with the end of another, so the
    first mark of a kind is always the one that was put in.
    """
    body = F.substr(output, F.lit(1 + len(PREFIX)))
    middle = F.substring_index(output, MIDDLE, -1)
    by_prefix = F.concat(
        F.substring_index(body, SUFFIX, 1),
        middle,
        F.substring_index(F.substring_index(output, SUFFIX, -1), MIDDLE, 1),
    )
    by_suffix = F.concat(
        F.substring_index(F.substring_index(output, PREFIX, -1), MIDDLE, 1),
        middle,
        F.substring_index(body, PREFIX, 1),
    )
    return F.when(form == "psm", by_prefix).when(form == "spm", by_suffix).otherwise(output)


def fill_in_middle_digests(documents: DataFrame) -> DataFrame:
    """One row per document with counts and the digests of output and restored text."""
    name = free_name(documents, "fim")
    cut = fill_in_middle(documents, name=name)
    output, form = F.col(f"{name}.output"), F.col(f"{name}.form")
    return cut.select(
        "doc_id",
        f"{name}.n", f"{name}.form", f"{name}.prefix_chars", f"{name}.middle_chars",
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(restore(output, form), 256).alias("restored_sha256"),
    )
