"""Embedding near-duplicates: spherical k-means cells, pruned cosine products, components."""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType

from threadloom.llm.common import mix
from threadloom.llm.components import components
from threadloom.session import runtime_conf, scratch_path, store

COSINE = 0.95
SAMPLE = 20_000  # vectors the cells are fitted on
PER_CELL = 2048  # vectors wanted per cell
MOST_CELLS = 2048  # bounds the centres that travel to every task
ROUNDS = 8
BLOCK = 8192  # rows of a cell that are read at once
SHARE = 32_768  # rows of a cell that one task writes, by the sample's estimate
GROUP = 65_536  # rows that a task holds against the others, and
_COMPONENTS = 1 << 23  # the components they have at most
_STRIP = 64  # rows that are held against others at once
_CHUNK = 128  # centres that a group's rows are multiplied with at once
_EMIT = 100_000
_INDEX = "file string, offset bigint, size int, cell int, rows int, reach binary"


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; first scaled by powers of two, so that no square over- or underflows."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    x = np.ldexp(x, -exponent)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cells(sample: np.ndarray, cells: int, seed: int = 5) -> np.ndarray:
    """Centres of spherical k-means over unit vectors."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        nearest = np.concatenate(
            [(sample[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)]
        )
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return centres


def gaps(centres: np.ndarray) -> np.ndarray:
    """Distances between all centres."""
    return np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 1e-12))


def cells_of(
    x: np.ndarray, centres: np.ndarray, cosine: float, home: np.ndarray | None = None, gap: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(home cell, mask of further cells) of unit vectors; a known ``home`` or ``gap`` is taken as it is.

    Two vectors of cosine >= ``cosine`` in cells c and d lie on two sides of the
    plane between the centres, no further apart than the chord of that angle, so
    one of them is within half a chord of the plane. A vector reaches every cell
    to whose plane it is that near; of two cells of which neither has a row that
    reaches the other, no pair is linked.
    """
    near = x @ centres.T
    if home is None:
        home = near.argmax(axis=1)
    rows = np.arange(len(x))
    gap = gaps(centres) if gap is None else gap
    reach = math.sqrt(2 - 2 * cosine) / 2 + 1e-9
    mask = near[rows, home][:, None] - near <= reach * gap[home]
    mask[rows, home] = False
    return home, mask


def kept_axes(size: int) -> int:
    """Components that folded vectors keep: all few, else three eighths."""
    return size if size <= 16 else max(15, size * 3 // 8 - 1)


def fit_axes(sample: np.ndarray) -> np.ndarray:
    """Orthonormal columns along which the sample spreads most."""
    spread = sample - sample.mean(axis=0)
    return np.linalg.eigh(spread.T @ spread)[1][:, -kept_axes(sample.shape[1]) :]


def slack(size: int) -> float:
    """More than rounding to single precision changes any product here."""
    return math.sqrt(kept_axes(size) + 1) * (size + 16) * 2.0**-22


def folded(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors' components along the axes, and the length of what is left.

    By Cauchy and Schwarz a product of folded vectors is no smaller than that of
    the vectors, but for ``slack``.
    """
    out = np.empty((len(x), axes.shape[1] + 1), np.float32)
    out[:, :-1] = x @ axes
    left = 1 - np.einsum("ij,ij->i", out[:, :-1], out[:, :-1])
    out[:, -1] = np.sqrt(np.maximum(left, 0) + np.float32(slack(x.shape[1])))
    return out


def _matrix(column, kind: str = "<f8") -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


class _Fitted(NamedTuple):
    """What is known about the vectors of one length."""

    first: int  # number of its first cell
    centres: np.ndarray
    axes: np.ndarray
    parts: np.ndarray  # tasks that write a cell


def _of_length(fitted: dict[int, _Fitted], size: int) -> _Fitted:
    """A length the sample doesn't hold has one cell, numbered below zero."""
    if size in fitted:
        return fitted[size]
    return _Fitted(-1 - size, np.zeros((1, size)), np.eye(size, kept_axes(size)), np.ones(1, int))


def _record(size: int, kind: str) -> np.dtype:
    return np.dtype([("node", "<i8"), ("copies", "<i8"), ("norm", "<f8"), ("vector", kind, (size,))])


def _assign(fitted: dict[int, _Fitted]):
    """Each class of a block of rows with its cell; cells are numbered over all lengths."""

    def apply(batches):
        for batch in batches:
            lengths = np.diff(batch.column("vector").offsets.to_numpy())
            for size in np.unique(lengths).tolist():
                known = _of_length(fitted, size)
                rows = np.flatnonzero(lengths == size)
                for lo in range(0, len(rows), 2048):
                    part = batch.take(pa.array(rows[lo : lo + 2048]))
                    node, at, copies = np.unique(
                        part.column("node").to_numpy(), return_index=True, return_counts=True
                    )
                    vector = part.column("vector").take(pa.array(at))
                    home = (_unit(_matrix(vector)) @ known.centres.T).argmax(axis=1)
                    dealt = mix(node.view(np.uint64)) % known.parts[home].astype(np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(node), pa.array(copies.astype(np.int64)), vector,
                            pa.array((home + known.first).astype(np.int32)), pa.array(dealt.astype(np.int32)),
                        ],
                        ["node", "copies", "vector", "cell", "part"],
                    )

    return apply


def _classes(batches: Iterator[pa.RecordBatch], kind: str, block: int) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, records) of rows sorted by cell and node; rows of one class become one, ``block`` at most at a time."""
    cell, held = None, []
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        cuts = np.flatnonzero(np.diff(cells)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(cells)], strict=True):
            if lo == hi:
                continue
            part = batch.slice(lo, hi - lo)
            node = part.column("node").to_numpy()
            starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            x = _matrix(part.column("vector").take(pa.array(starts)), kind)
            found = np.empty(len(starts), _record(x.shape[1], kind))
            found["node"] = node[starts]
            found["copies"] = np.add.reduceat(part.column("copies").to_numpy(), starts)
            # Scaled by powers of two as in _unit, so the norm is a plain number.
            x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
            found["vector"], found["norm"] = x, np.linalg.norm(x.astype(np.float64), axis=1)
            if cells[lo] != cell:
                if held:
                    yield cell, np.concatenate(held)
                cell, held = int(cells[lo]), []
            elif held[-1]["node"][-1] == found["node"][0]:
                held[-1]["copies"][-1] += found["copies"][0]
                found = found[1:]
            if len(found):
                held.append(found)
            limit = max(1, min(block, _COMPONENTS // x.shape[1]))
            if sum(map(len, held)) > limit:  # the last row may go on
                rows = np.concatenate(held)
                while len(rows) > limit:
                    yield cell, rows[:limit]
                    rows = rows[limit:]
                held = [rows]
    if held:
        yield cell, np.concatenate(held)


def _write(fitted: dict[int, _Fitted], kind: str, block: int, cosine: float, folder: str):
    """Rows sorted by cell to a file of this attempt; one row per block, with a bit for every cell it reaches."""

    def apply(batches):
        system, base = FileSystem.from_uri(folder)
        out, name, offset, done, gap = None, "", 0, [], {}
        for cell, rows in _classes(batches, kind, block):
            if out is None:
                system.create_dir(base, recursive=True)
                name = f"{folder}/{uuid.uuid4().hex}.vectors"
                out = system.open_output_stream(FileSystem.from_uri(name)[1], compression=None)
            size = rows["vector"].shape[1]
            known = _of_length(fitted, size)
            if size not in gap:
                gap[size] = gaps(known.centres)
            reach = np.zeros(len(known.centres), bool)
            for lo in range(0, len(rows), 2048):
                few = rows[lo : lo + 2048]
                x = few["vector"].astype(np.float64) / few["norm"][:, None]
                home = np.full(len(x), cell - known.first)
                reach |= cells_of(x, known.centres, cosine, home, gap[size])[1].any(axis=0)
            out.write(rows.tobytes())
            done.append((name, offset, size, cell - known.first, len(rows), np.packbits(reach).tobytes()))
            offset += rows.nbytes
        if out is not None:
            out.close()
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in done], kind) for k, kind in enumerate(kinds)],
            [part.split()[0] for part in _INDEX.split(", ")],
        )

    return apply


class _Roots:
    """Union-find over the rows of a group."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, rows: np.ndarray) -> None:
        tops = rows
        while True:
            above = self.up[tops]
            if (above == tops).all():
                break
            tops = above
        self.up[rows] = self.up[np.unique(tops)] = tops.min()

    def all(self) -> np.ndarray:
        while True:
            above = self.up[self.up]
            if (above == self.up).all():
                return above
            self.up = above


class _Block(NamedTuple):
    file: str
    offset: int
    cell: int
    rows: int
    reach: bytes

    def reaches(self, cell: int) -> bool:
        return bool(self.reach[cell >> 3] >> (7 - (cell & 7)) & 1)


def _groups(blocks: list[_Block], rows: int) -> list[tuple[int, int]]:
    """Ranges of blocks of about ``rows`` rows."""
    found, first, held = [], 0, 0
    for i, block in enumerate(blocks):
        if held and held + block.rows > rows:
            found.append((first, i))
            first, held = i, 0
        held += block.rows
    return [*found, (first, len(blocks))] if blocks else []


class _Held:
    """A task's rows, behind them room for a block that is held against them."""

    def __init__(self, size: int, kind: str, known: _Fitted, cosine: float, rows: int, guests: int):
        self.axes, self.cosine = known.axes.astype(np.float32), cosine
        self.slack = slack(size)
        self.kind, self.own = _record(size, kind), rows
        self.records = np.empty(rows + guests, self.kind)
        self.unit = np.empty((rows + guests, size), np.float32)
        self.fold = np.empty((rows + guests, self.axes.shape[1] + 1), np.float32)
        self.copies = np.zeros(rows + guests)
        self.links = np.zeros(rows + guests, np.int64)
        self.roots = _Roots(rows + guests)

    def fill(self, at: int, stream, block: _Block) -> None:
        found = np.frombuffer(stream.read_at(block.rows * self.kind.itemsize, block.offset), self.kind)
        rows = slice(at, at + block.rows)
        self.records[rows] = found
        self.unit[rows] = found["vector"] / found["norm"][:, None].astype(found["vector"].dtype)
        self.fold[rows] = folded(self.unit[rows], self.axes)
        self.copies[rows] = found["copies"]

    def _linked(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether rows p and q are linked, in double precision."""
        out = np.empty(len(p), bool)
        step = max(1, (1 << 20) // self.unit.shape[1])
        for lo in range(0, len(p), step):
            x, y = (
                found["vector"].astype(np.float64) / found["norm"][:, None]
                for found in (self.records[p[lo : lo + step]], self.records[q[lo : lo + step]])
            )
            out[lo : lo + step] = np.einsum("ij,ij->i", x, y) >= self.cosine
        return out

    def _join(self, top: np.ndarray, other: np.ndarray) -> None:
        """Join each ``other`` to its ``top``, both roots."""
        apart, n = top != other, len(self.links)
        top, other = np.divmod(np.unique(top[apart] * n + other[apart]), n)
        for found in np.split(np.arange(len(top)), np.flatnonzero(np.diff(top)) + 1):
            if len(found):
                self.roots.join(np.append(other[found], top[found[0]]))

    def _few(self, p: np.ndarray, q: np.ndarray) -> None:
        linked = self._linked(p, q)
        p, q = p[linked], q[linked]
        if len(p):
            np.add.at(self.links, p, self.copies[q].astype(np.int64))
            np.add.at(self.links, q, self.copies[p].astype(np.int64))
            tops = self.roots.all()
            self._join(tops[p], tops[q])

    def _many(self, xs: np.ndarray, ys: np.ndarray, close: np.ndarray) -> None:
        product = self.unit[xs] @ self.unit[ys].T
        close &= product >= self.cosine - self.slack
        r, c = np.nonzero(close & (product < self.cosine + self.slack))
        close[r, c] = self._linked(xs[r], ys[c])
        hit = close.astype(np.float64)  # sums of copies below 2**53 are exact
        self.links[xs] += (hit @ self.copies[ys]).astype(np.int64)
        self.links[ys] += (self.copies[xs] @ hit).astype(np.int64)
        tops = self.roots.all()
        for top in np.unique(tops[xs[close.any(axis=1)]]).tolist():
            other = tops[ys[close[tops[xs] == top].any(axis=0)]]
            self._join(np.full(len(other), top), other)

    def hold(self, xs: np.ndarray, ys: np.ndarray, ends: np.ndarray | None = None, same: bool = False) -> None:
        """Link rows xs to rows ys; strip k of xs only to the first ``ends[k]`` of ys."""
        fold = self.fold[ys]
        found, count = [], 0
        for k, lo in enumerate(range(0, len(xs), _STRIP)):
            few = xs[lo : lo + _STRIP]
            part = slice(lo, None) if same else slice(None if ends is None else ends[k])
            close = self.fold[few] @ fold[part].T >= self.cosine - self.slack
            if same:
                close[:, : len(few)] &= np.tri(len(few), k=-1, dtype=bool).T
            pairs = np.count_nonzero(close)
            if pairs * 16 >= close.size:
                self._many(few, ys[part], close)
            elif pairs:
                r, c = np.divmod(np.flatnonzero(close), close.shape[1])
                found.append((few[r], ys[part][c]))
                count += pairs
            if count > _EMIT or found and lo + _STRIP >= len(xs):
                self._few(*map(np.concatenate, zip(*found, strict=True)))
                found, count = [], 0

    def across(self, lo: int, mine: np.ndarray, at: int, theirs: np.ndarray, limit: float) -> None:
        """Rows from ``lo`` and from ``at`` on, of two cells.

        ``mine`` and ``theirs`` are their distances from the plane between the
        cells, times the gap of the centres. The sum is at most ``limit``, the
        chord times the gap, for a linked pair.
        """
        least, other = mine.min(), theirs.min()
        if least + other > limit:
            return
        xs, ys = np.flatnonzero(mine <= limit - other), np.flatnonzero(theirs <= limit - least)
        xs, ys = xs[np.argsort(mine[xs])], ys[np.argsort(theirs[ys])]
        ends = np.searchsorted(theirs[ys], limit - mine[xs[::_STRIP]], "right")
        self.hold(lo + xs, at + ys, ends)

    def told(self, lo: int, hi: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(node, links, node of a linked component) of the rows that have links."""
        hit = lo + np.flatnonzero(self.links[lo:hi])
        if not len(hit):
            return []
        node = self.records["node"]
        return [(node[hit], self.links[hit], node[self.roots.all()[hit]])]


def _against(
    size: int, kind: str, known: _Fitted, cosine: float, blocks: list[_Block], groups: list[tuple[int, int]], g: int
):
    """Group ``g`` held against itself and half of the others, in a circle, so each two groups meet once."""
    opened: dict = {}

    def stream(block: _Block):
        if block.file not in opened:
            system, path = FileSystem.from_uri(block.file)
            if len(opened) >= 32:
                opened.pop(next(iter(opened))).close()
            opened[block.file] = system.open_input_file(path)
        return opened[block.file]

    own = blocks[slice(*groups[g])]
    edges = np.append(0, np.cumsum([block.rows for block in own])).tolist()
    n = edges[-1]
    held = _Held(size, kind, known, cosine, n, max(block.rows for block in blocks))
    for block, at in zip(own, edges, strict=False):
        held.fill(at, stream(block), block)
    centres = known.centres.astype(np.float32)
    cells = np.array([block.cell for block in own])
    home = np.einsum("ij,ij->i", held.unit[:n], centres[np.repeat(cells, np.diff(edges))])
    chord = math.sqrt(2 - 2 * cosine)
    limits = {
        c: chord * np.linalg.norm(known.centres - known.centres[c], axis=1) + held.slack for c in set(cells.tolist())
    }
    chunk, near = -1, np.empty(0, np.float32)

    def meet(block: _Block, at: int, mine: list[int]) -> None:
        """The block, whose rows lie from ``at`` on, and those of this group's blocks that it may be linked to."""
        nonlocal chunk, near
        mine = [
            i for i in mine
            if own[i].cell == block.cell or own[i].reaches(block.cell) or block.reaches(own[i].cell)
        ]
        if not mine:
            return
        if at == n:
            held.fill(at, stream(block), block)
        rows = np.arange(at, at + block.rows)
        apart = [i for i in mine if own[i].cell != block.cell]
        if apart and block.cell // _CHUNK != chunk:
            chunk = block.cell // _CHUNK
            near = held.unit[:n] @ centres[chunk * _CHUNK : (chunk + 1) * _CHUNK].T
        x = held.unit[rows[0] : rows[-1] + 1]
        theirs = (x @ centres[block.cell])[:, None] - x @ centres[cells[apart]].T
        for i in mine:
            lo, hi = edges[i], edges[i + 1]
            if own[i].cell == block.cell:
                held.hold(np.arange(lo, hi), rows, same=lo == at)
            else:
                column = near[lo:hi, block.cell % _CHUNK]
                held.across(
                    lo, home[lo:hi] - column, at, theirs[:, apart.index(i)], limits[own[i].cell][block.cell]
                )

    for j, block in enumerate(own):
        meet(block, edges[j], list(range(j + 1)))
    told, count = [], 0
    for step in range(1, len(groups) // 2 + 1):
        q = (g + step) % len(groups)
        if 2 * step == len(groups) and q < g:
            continue
        for block in blocks[slice(*groups[q])]:
            meet(block, n, list(range(len(own))))
            found = held.told(n, n + block.rows)
            told.extend(found)
            count += sum(len(part[0]) for part in found)
            held.links[n:] = 0
            held.roots.up[n:] = np.arange(n, len(held.links))
            if count > _EMIT:
                yield told
                told, count = [], 0
    yield [*told, *held.told(0, n)]
    for file in opened.values():
        file.close()


def _compare(fitted: dict[int, _Fitted], kind: str, cosine: float, blocks: dict, groups: dict):
    tasks = [(size, g) for size in sorted(groups) for g in range(len(groups[size]))]

    def apply(batches):
        for batch in batches:
            for size, g in (tasks[i] for i in batch.column("id").to_pylist()):
                known = _of_length(fitted, size)
                for told in _against(size, kind, known, cosine, blocks[size], groups[size], g):
                    columns = [np.concatenate(c) for c in zip(*told, strict=True)] or [np.empty(0, np.int64)] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "links", "root"])

    return apply


def embedding_duplicates(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Equal vectors are one class from the start. Spherical k-means, fitted on the
    ``SAMPLE`` classes of smallest hash, gives each class its cell; classes are
    written once, to files sorted by cell, and no vector is copied for another cell.
    A task holds a group of blocks against half of the others, which it reads from
    those files. Of two cells only rows near enough to the plane between their
    centres are compared, by products of folded vectors (see ``folded``) that rule
    a pair out; what is left is settled in double precision, so no link is
    missed and none is added. A task returns per class its number of links and a
    class of its component, never the pairs.

    Null, zero, empty and non-finite vectors link with nothing and are their own
    component; vectors of different lengths never link. A null id keeps its row
    with no links, a null component and ``kept`` false. Repeated rows are vectors
    of their own. Other columns are ignored; an empty table gives no rows.
    """
    v = F.col("vector")
    usable = (
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
        & F.exists(v, lambda c: c != 0)
    )
    rows = embeddings.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector")
    ).select(
        "vec_id", "vector",
        F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("vector")).alias("node"),
    )
    rows = store(rows, "vectors")
    usable = rows.where("node is not null")
    classes = store(usable.groupBy("node").agg(F.count(F.lit(1)).alias("copies")), "classes")
    n = classes.count()
    # Twice the sample's share of hashes holds the smallest SAMPLE; only those are sorted.
    least = -(2**63) + 2**64 * min(1.0, 2 * SAMPLE / max(n, 1))
    sample = (
        usable.where(F.xxhash64("node") <= F.lit(least))
        .groupBy("node").agg(F.first("vector").alias("vector"))
        .orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector").toArrow()
        .column("vector")
    )
    by_length: dict[int, list] = defaultdict(list)
    for found in sample:
        by_length[len(found)].append(found.values.to_numpy(zero_copy_only=False))
    fitted, first = {}, 0
    for size, found in sorted(by_length.items()):
        x = _unit(np.array(found, np.float64))
        share = n / len(sample)
        cells = min(MOST_CELLS, max(1, round(len(x) * share / PER_CELL)))
        centres = fit_cells(x, cells)
        held = np.bincount(
            np.concatenate([(x[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(x), 4096)]),
            minlength=len(centres),
        )
        parts = np.maximum(1, np.ceil(held * share / SHARE)).astype(int)
        fitted[size] = _Fitted(first, centres, fit_axes(x), parts)
        first += len(centres)
    spark = rows.sparkSession
    vector_type = rows.schema["vector"].dataType
    kind = "<f4" if isinstance(vector_type.elementType, FloatType) else "<f8"
    with runtime_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch="2048"):
        placed = usable.select("node", "vector").mapInArrow(
            _assign(fitted),
            f"node bigint, copies bigint, vector {vector_type.simpleString()}, cell int, part int",
        )
        index = store(
            placed.repartition("cell", "part").sortWithinPartitions("cell", "node")
            .mapInArrow(_write(fitted, kind, BLOCK, cosine, scratch_path(spark, "cells")), _INDEX),
            "cell-blocks",
        )
    blocks: dict[int, list[_Block]] = defaultdict(list)
    for row in index.orderBy("size", "cell", "file", "offset").collect():  # one row per block
        blocks[row.size].append(_Block(row.file, row.offset, row.cell, row.rows, bytes(row.reach)))
    # A group for every task slot four times over, if groups don't become larger than a task can hold.
    wanted = 4 * max(8, spark.sparkContext.defaultParallelism)
    groups = {
        size: _groups(found, min(GROUP, max(1, _COMPONENTS // size), -(-sum(b.rows for b in found) // wanted)))
        for size, found in blocks.items()
    }
    tasks = sum(map(len, groups.values()))
    found = store(
        spark.range(0, tasks, 1, max(1, tasks))
        .mapInArrow(
            _compare(fitted, kind, cosine, dict(blocks), groups), "node bigint, links bigint, root bigint"
        ),
        "found",
    )
    roots = components(found, "root", "node").withColumnRenamed("root", "top")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        rows.select("vec_id", "node")
        .join(classes, "node", "left")
        .join(links, "node", "left")
        .join(roots, "node", "left")
        .withColumn("top", F.coalesce("top", "node"))
    )
    smallest = named.where("top is not null").groupBy("top").agg(F.min("vec_id").alias("smallest"))
    component = F.coalesce("smallest", "vec_id")
    return named.join(smallest, "top", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
