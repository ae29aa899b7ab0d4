"""Hard negatives: an inverted multi-index, searched cell by cell until every window is certain."""

from __future__ import annotations

import heapq
import math
import uuid
from collections import OrderedDict, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, functions as F

from threadloom.session import runtime_conf, scratch_path, store

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score in per cent of the positive's
SAMPLE = 20_000  # rows the codebooks are fitted on
PER_CELL = 512  # rows wanted per cell
MOST_WORDS = 512  # of a half: bounds the list of cells that travels to every task
ROUNDS = 8
GROUP = 256  # anchors a task searches together
BLOCK = 4096  # rows read at once
FIRST_ROWS = 2048  # rows of the first wave; every wave doubles
CACHE_BYTES = 64 << 20

_RUN = (
    "size int, left int, right int, file string, offset bigint, rows bigint, "
    "left_radius double, right_radius double, norm double"
)
_FOUND = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
    "positive_score bigint, negative_score bigint"
)


def fit_words(half: np.ndarray, words: int, seed: int = 11) -> np.ndarray:
    """Centres of k-means over one half of the sample."""
    rng = np.random.default_rng(seed)
    centres = half[rng.choice(len(half), min(words, len(half)), replace=False)]
    for _ in range(ROUNDS):
        nearest = nearest_word(half, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, half)
        count = np.bincount(nearest, minlength=len(centres))[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return centres


def nearest_word(half: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(half), np.int64)
    lengths = (centres**2).sum(axis=1) / 2
    for lo in range(0, len(half), 4096):
        out[lo : lo + 4096] = (half[lo : lo + 4096] @ centres.T - lengths).argmax(axis=1)
    return out


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.diff(batch.column("vector").offsets.to_numpy())
    for size in np.unique(sizes).tolist():
        yield size, batch.take(pa.array(np.flatnonzero(sizes == size)))


def _codebook(codebooks: dict, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves' words; a length the sample doesn't hold has one cell."""
    half = size // 2
    return codebooks.get(size) or (np.zeros((1, half)), np.zeros((1, size - half)))


def _assign(codebooks: dict):
    def apply(batches):
        for batch in batches:
            for size, part in _by_size(batch):
                x = _matrix(part.column("vector"), size).astype(np.float64)
                left, right = _codebook(codebooks, size)
                half = size // 2
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(np.full(len(x), size), pa.int32()),
                        pa.array(nearest_word(x[:, :half], left), pa.int32()),
                        pa.array(nearest_word(x[:, half:], right), pa.int32()),
                    ],
                    [*part.schema.names, "size", "left", "right"],
                )

    return apply


def _record(size: int) -> np.dtype:
    return np.dtype([("id", "<i8"), ("label", "<i8"), ("vector", "<i4", (size,))])


def _write(codebooks: dict, folder: str):
    """Rows sorted by cell to files of this attempt; one row per run of a cell in a file."""

    def apply(batches):
        system, base = FileSystem.from_uri(folder)
        out, name, offset, run, done = None, "", 0, None, []
        for batch in batches:
            cells = np.stack([batch.column(c).to_numpy() for c in ("size", "left", "right")], axis=1)
            cuts = np.flatnonzero((np.diff(cells, axis=0) != 0).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(cells)], strict=True):
                if lo == hi:
                    continue
                cell = tuple(cells[lo].tolist())
                size, i, j = cell
                part = batch.slice(lo, hi - lo)
                rows = np.empty(hi - lo, _record(size))
                rows["id"], rows["label"] = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                rows["vector"] = _matrix(part.column("vector"), size)
                if out is None:
                    system.create_dir(base, recursive=True)
                    name = f"{folder}/{uuid.uuid4().hex}.cells"
                    out = system.open_output_stream(FileSystem.from_uri(name)[1], compression=None)
                if run is None or run[0] != cell:
                    if run is not None:
                        done.append(run)
                    run = [cell, name, offset, 0, 0.0, 0.0, 0.0]
                x = rows["vector"].astype(np.float64)
                left, right = _codebook(codebooks, size)
                half = size // 2
                run[3] += len(rows)
                run[4] = max(run[4], np.linalg.norm(x[:, :half] - left[i], axis=1).max())
                run[5] = max(run[5], np.linalg.norm(x[:, half:] - right[j], axis=1).max())
                run[6] = max(run[6], np.linalg.norm(x, axis=1).max())
                out.write(rows.tobytes())
                offset += rows.nbytes
        if out is not None:
            out.close()
            done.append(run)
        columns = [[r[0][k] for r in done] for k in range(3)] + [[r[k] for r in done] for k in range(1, 7)]
        kinds = [pa.int32()] * 3 + [pa.string(), pa.int64(), pa.int64()] + [pa.float64()] * 3
        names = [part.split()[0] for part in _RUN.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return apply


class _Shelf:
    """Blocks of rows read from the index files, the latest kept up to ``CACHE_BYTES``."""

    def __init__(self):
        self.opened: OrderedDict = OrderedDict()
        self.held: OrderedDict = OrderedDict()
        self.bytes = 0

    def _read(self, file: str, size: int, place: int, rows: int) -> np.ndarray:
        if file not in self.opened:
            system, path = FileSystem.from_uri(file)
            if len(self.opened) >= 32:
                self.opened.popitem(last=False)[1].close()
            self.opened[file] = system.open_input_file(path)
        kind = _record(size)
        return np.frombuffer(self.opened[file].read_at(rows * kind.itemsize, place), kind)

    def blocks(self, size: int, file: str, offset: int, rows: int) -> Iterator[np.ndarray]:
        step = _record(size).itemsize
        for first in range(0, rows, BLOCK):
            key = (file, offset + first * step)
            found = self.held.get(key)
            if found is None:
                found = self._read(file, size, key[1], min(BLOCK, rows - first))
                self.held[key] = found
                self.bytes += found.nbytes
                while self.bytes > CACHE_BYTES and len(self.held) > 1:
                    self.bytes -= self.held.popitem(last=False)[1].nbytes
            else:
                self.held.move_to_end(key)
            yield found

    def close(self) -> None:
        for stream in self.opened.values():
            stream.close()


class _Cells:
    """The runs of all cells of one vector length, with what bounds the scores in them."""

    def __init__(self, size: int, words: tuple[np.ndarray, np.ndarray], runs: list[tuple]):
        self.size, self.half = size, size // 2
        self.left, self.right = words
        self.left_radius, self.right_radius = np.zeros(len(self.left)), np.zeros(len(self.right))
        self.runs: dict[tuple[int, int], list[tuple]] = defaultdict(list)
        self.norm = 0.0
        for i, j, *run in runs:
            self.runs[i, j].append(tuple(run))
            self.left_radius[i] = max(self.left_radius[i], run[3])
            self.right_radius[j] = max(self.right_radius[j], run[4])
            self.norm = max(self.norm, run[5])

    def visits(self, q: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, i, j) of every cell with rows, by falling bound on the scores in it.

        The multi-sequence walk: words of each half are sorted by their part of the
        bound; the heap holds pairs whose predecessors in both orders were visited.
        """
        a = self.left @ q[: self.half] + np.linalg.norm(q[: self.half]) * self.left_radius
        b = self.right @ q[self.half :] + np.linalg.norm(q[self.half :]) * self.right_radius
        first, second = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b = a[first].tolist(), b[second].tolist()
        first, second = first.tolist(), second.tolist()
        slack = 1e-9 * (1 + float(np.linalg.norm(q)) * self.norm)
        heap, left = [(-(a[0] + b[0]), 0, 0)], len(self.runs)
        while heap and left:
            bound, x, y = heapq.heappop(heap)
            if (first[x], second[y]) in self.runs:
                left -= 1
                yield slack - bound, first[x], second[y]
            if y + 1 < len(b):
                heapq.heappush(heap, (-(a[x] + b[y + 1]), x, y + 1))
            if y == 0 and x + 1 < len(a):
                heapq.heappush(heap, (-(a[x + 1] + b[0]), x + 1, 0))

    def range_of(self, q: np.ndarray, i: int, j: int, run: tuple) -> tuple[float, float]:
        """Least and greatest score a row of the run can have."""
        middle = float(self.left[i] @ q[: self.half] + self.right[j] @ q[self.half :])
        reach = float(np.linalg.norm(q[: self.half])) * run[3] + float(np.linalg.norm(q[self.half :])) * run[4]
        reach += 1e-9 * (1 + float(np.linalg.norm(q)) * self.norm)
        return middle - reach, middle + reach


class _Best:
    """The first ``n`` (score, id) of those offered within [low, high]: high scores, then small ids."""

    def __init__(self, n: int, low: float = -math.inf, high: float = math.inf):
        self.n, self.low, self.high = n, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> float:
        """No score below it can enter."""
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.n else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.floor) & (scores <= self.high)
        scores = np.concatenate([self.scores, scores[fits]])
        ids = np.concatenate([self.ids, ids[fits]])
        order = np.lexsort((ids, -scores))[: self.n]
        self.scores, self.ids = scores[order], ids[order]

    def certain(self, bound: float) -> bool:
        """Whether rows of scores up to ``bound`` cannot change the list."""
        return bound < self.floor or self.low > self.high


def _search(cells: _Cells, shelf: _Shelf, anchors: list[tuple], same: bool, wanted: list[list[_Best]]) -> None:
    """Fill the lists of every anchor (id, label, vector) with rows of its own or other labels.

    In waves: each open anchor takes its next cells, every run they need is read
    once and scored against all anchors that ask for it, and an anchor closes when
    its next cell's bound leaves all its lists certain.
    """
    walks = [cells.visits(vector.astype(np.float64)) for _, _, vector in anchors]
    following = [next(walk, None) for walk in walks]
    quota = FIRST_ROWS
    while True:
        asked: dict[tuple, list[int]] = defaultdict(list)
        for k, walk in enumerate(walks):
            rows = 0
            q = anchors[k][2].astype(np.float64)
            open_lists = [best for best in wanted[k] if following[k] and not best.certain(following[k][0])]
            if not open_lists:
                following[k] = None
            while following[k] and rows < quota and not all(best.certain(following[k][0]) for best in open_lists):
                _, i, j = following[k]
                for run in cells.runs[i, j]:
                    low, high = cells.range_of(q, i, j, run)
                    if any(high >= best.floor and low <= best.high for best in open_lists):
                        asked[run].append(k)
                        rows += run[2]
                following[k] = next(walk, None)
        if not asked and not any(following):
            return
        for run in sorted(asked):
            group = asked[run]
            file, offset, rows, _, _, norm = run
            queries = np.stack([anchors[k][2] for k in group])
            # Sums below 2**53 are exact in doubles; larger ones are added as integers.
            exact = norm * float(np.linalg.norm(queries.astype(np.float64), axis=1).max()) < 2**52
            kind = np.float64 if exact else np.int64
            for block in shelf.blocks(cells.size, file, offset, rows):
                scores = (queries.astype(kind) @ block["vector"].astype(kind).T).astype(np.int64)
                for k, found in zip(group, scores, strict=True):
                    name, label, _ = anchors[k]
                    least = min(best.floor for best in wanted[k])
                    most = max(best.high for best in wanted[k])
                    fits = np.flatnonzero(
                        (found >= least) & (found <= most)
                        & ((block["label"] == label) == same) & (block["id"] != name)
                    )
                    if len(fits):
                        scored, ids = found[fits], block["id"][fits]
                        for best in wanted[k]:
                            best.offer(scored, ids)
        quota *= 2


def _mine(codebooks: dict, runs: dict, positives: int, negatives: int, low: int, high: int, group: int):
    def apply(batches):
        shelf = _Shelf()
        known: dict[int, _Cells] = {}
        for batch in batches:
            for size, part in _by_size(batch):
                if size not in known:
                    known[size] = _Cells(size, _codebook(codebooks, size), runs[size])
                x = _matrix(part.column("vector"), size).astype(np.int64)
                names, labels = part.column("vec_id").to_pylist(), part.column("label").to_pylist()
                for first in range(0, len(x), group):
                    few = slice(first, first + group)
                    anchors = list(zip(names[few], labels[few], x[few], strict=True))
                    near = [[_Best(positives)] for _ in anchors]
                    _search(known[size], shelf, anchors, True, near)
                    windows = []
                    for (best,) in near:
                        # low * p <= 100 * score <= high * p, in whole numbers; equal scores share a window
                        spans = {p: (-(-low * p // 100), high * p // 100) for p in best.scores.tolist()}
                        windows.append({p: _Best(negatives, a, b) for p, (a, b) in spans.items()})
                    _search(known[size], shelf, anchors, False, [list(w.values()) for w in windows])
                    rows = [
                        (anchor[0], positive, rank, negative, p, score)
                        for anchor, (best,), window in zip(anchors, near, windows, strict=True)
                        for positive, p in zip(best.ids.tolist(), best.scores.tolist(), strict=True)
                        for rank, (negative, score) in enumerate(
                            zip(window[p].ids.tolist(), window[p].scores.tolist(), strict=True), 1
                        )
                    ]
                    columns = zip(*rows, strict=True) if rows else [[]] * 6
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        [part.split()[0] for part in _FOUND.split(", ")],
                    )
        shelf.close()

    return apply


def hard_negatives(
    embeddings: DataFrame,
    anchor,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    per_cell: int = PER_CELL,
    group: int = GROUP,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition on ``embeddings``. Components become
    floor(scale * x); a score is the whole-number inner product, higher first,
    ties by smaller id. For each of an anchor's first ``positives`` rows of its
    label come the first ``negatives`` rows of other labels whose score is
    ``low`` to ``high`` per cent of the positive's.

    The index: k-means on each half of a vector (fitted on the ``SAMPLE`` rows of
    smallest hash; every row is indexed) makes cells of two words; rows lie in
    files sorted by cell, with the radius of each half about its word. A task takes
    groups of anchors of near cells and visits cells by falling bound, word
    products plus norm times radius; a list is done when no later cell can change
    it. So results are exact; where cells bound little (vectors without clusters),
    an anchor is held against all rows, a block at a time. Of the index the
    driver and the tasks hold the words and one row per cell and file border.

    Rows with a null id or label, a null vector, a null or non-finite component,
    or a product with themselves of 2**62 or more (scores would not fit a long) take
    no part. Rows equal in id, label and whole-number vector count once; a row is
    no partner of rows of its own id. Vectors of different lengths never meet. A
    positive of negative score has no negatives. Other columns are ignored; an
    empty table gives no rows.
    """
    spark = embeddings.sparkSession
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    finite = F.forall(
        F.col(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double")) * scale < F.lit(float(2**31)))
    )
    squares = F.aggregate(
        "vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    rows = store(
        embeddings.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & finite)
        .select(
            F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"), whole.alias("vector"),
        )
        .where(squares < float(2**62))
        .groupBy("vec_id", "label", "vector").agg(F.max("anchor").alias("anchor")),
        "vectors",
    )
    n = rows.count()
    if n == 0:
        return spark.createDataFrame([], _FOUND)
    # A share of the rows by hash, so no task sends more than its part of the sample.
    draw = F.xxhash64("vec_id", "vector")
    share = min(1.0, 1.2 * SAMPLE / n + 1e-6)
    few = rows.where(F.pmod(draw, F.lit(1 << 40)) < int(share * (1 << 40))) if share < 1 else rows
    sample = few.orderBy(draw, "vec_id").limit(SAMPLE).select("vector").toArrow().column("vector")
    by_size: dict[int, list] = defaultdict(list)
    for found in sample:
        by_size[len(found)].append(found.values.to_numpy(zero_copy_only=False))
    codebooks = {}
    for size, found in by_size.items():
        x = np.array(found, np.float64).reshape(len(found), size)
        words = min(MOST_WORDS, max(1, round(math.sqrt(n * len(found) / len(sample) / per_cell))))
        codebooks[size] = fit_words(x[:, : size // 2], words), fit_words(x[:, size // 2 :], words)

    cell = ["size", "left", "right"]
    with runtime_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BLOCK)):
        placed = store(
            rows.mapInArrow(
                _assign(codebooks),
                "vec_id bigint, label bigint, vector array<bigint>, anchor boolean, "
                "size int, left int, right int",
            ),
            "placed",
        )
        index = store(
            placed.repartitionByRange(*cell, "vec_id").sortWithinPartitions(*cell)
            .select(*cell, "vec_id", "label", "vector")
            .mapInArrow(_write(codebooks, scratch_path(spark, "cells")), _RUN),
            "cell-runs",
        )
    runs: dict[int, list] = defaultdict(list)
    for row in index.collect():  # one row per cell and file border
        runs[row.size].append(tuple(row)[1:])
    anchors = placed.where("anchor").select(*cell, "vec_id", "label", "vector")
    tasks = max(spark.sparkContext.defaultParallelism, -(-anchors.count() // group))
    return (
        anchors.repartitionByRange(tasks, *cell, "vec_id")
        .sortWithinPartitions(*cell, "vec_id")
        .mapInArrow(_mine(codebooks, dict(runs), positives, negatives, low, high, group), _FOUND)
    )
