"""Token ids in files of patched frame-of-reference blocks, written and read in parallel."""

from __future__ import annotations

import functools
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.common import blocks, flat
from threadloom.session import scratch_path, store

END = 0  # id that closes a document
BLOCK = 4096  # ids of a block
PERCENTILE = 90  # share of a block's ids that fit the packed width; the others are exceptions
FILE_IDS = 1 << 26  # a file ends with the document that reaches this many ids
FILE_DOCUMENTS = 1 << 20
READ_IDS = 1 << 20  # ids decoded at once, unless one document is longer
SLOTS = 1 << 21  # units a worker remembers
UNIT_WORDS = 3  # of 8 bytes: longer units are not remembered
POOL = 1 << 23  # ids of the remembered units
PIECE = 1 << 20  # bytes of text encoded at once

MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<IHHBxxx")  # minimum, ids, exceptions, width
_TAIL = struct.Struct("<QQQQQ8s")  # ids, blocks, documents, place of the block index, of the documents

# Classes of bytes. Class 0 (control, apostrophe excepted, and most of non-ASCII) says nothing.
_SPACE, _BREAK, _LETTER, _DIGIT, _MARK, _QUOTE = 1, 2, 3, 4, 5, 6


def _kind(byte: int) -> int:
    if byte == 0x20:
        return _SPACE
    if 0x09 <= byte <= 0x0D:
        return _BREAK
    if chr(byte) == "'":
        return _QUOTE
    if not 0x20 < byte < 0x7F:
        return 0
    return _LETTER if chr(byte).isalpha() else _DIGIT if chr(byte).isdigit() else _MARK


def _cuts(left: int, right: int) -> bool:
    """Whether a split falls between bytes of these classes wherever they stand."""
    if left in (0, _SPACE, _BREAK) or right == 0:
        return False
    if right in (_SPACE, _BREAK):
        return True
    if left == _QUOTE or (left, right) == (_MARK, _QUOTE):
        return False
    return left != right


_KINDS = bytes(_kind(byte) for byte in range(256))
_CUTS = bytes(_cuts(pair >> 3, pair & 7) for pair in range(64)) + bytes(192)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@functools.lru_cache(256)
def _word_places(count: int, width: int) -> tuple[np.ndarray, ...]:
    """Shifts, first value of each word, values that reach into a next word, that word, their rest."""
    at = np.arange(count) * width
    word, shift = at >> 6, at & 63
    over = np.flatnonzero(shift + width > 64)
    firsts = np.searchsorted(word, np.arange(word[-1] + 1))
    return shift.astype(np.uint64), firsts, over, word[over] + 1, (64 - shift[over]).astype(np.uint64)


def pack_block(ids: np.ndarray) -> bytes:
    """Head, bits of ids minus their minimum, then places and high bits of the exceptions."""
    low = int(ids.min())
    delta = ids.astype(np.uint32) - np.uint32(low)
    widths = np.frexp(delta.astype(np.float64))[1]
    fitting = np.cumsum(np.bincount(widths))
    width = int(np.argmax(100 * fitting >= PERCENTILE * len(ids)))
    places = np.flatnonzero(widths > width)
    highs = (delta[places].astype(np.uint64) >> np.uint64(width)).astype("<u4")
    packed = b""
    if width:
        # Values are shifted to their place in 64-bit words; one may reach into the next word.
        value = delta.astype(np.uint64) & np.uint64((1 << width) - 1)
        shift, firsts, over, word, rest = _word_places(len(ids), width)
        words = np.zeros(len(firsts) + 1, np.uint64)
        words[:-1] = np.bitwise_or.reduceat(value << shift, firsts)
        words[word] |= value[over] >> rest
        packed = words.astype("<u8").tobytes()[: -(-len(ids) * width // 8)]
    return b"".join(
        (_HEAD.pack(low, len(ids), len(places), width), packed, places.astype("<u2").tobytes(), highs.tobytes())
    )


@functools.lru_cache(256)
def _bit_places(count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(count, dtype=np.int64) * width
    return at >> 3, (at & 7).astype(np.uint64)


def unpack_block(raw: memoryview) -> np.ndarray:
    """The ids of one block."""
    low, count, exceptions, width = _HEAD.unpack_from(raw)
    size = -(-count * width // 8)
    body = np.zeros(size + 8, np.uint8)
    body[:size] = np.frombuffer(raw, np.uint8, size, _HEAD.size)
    words = np.lib.stride_tricks.as_strided(body[:8].view("<u8"), (size + 1,), (1,))
    place, shift = _bit_places(count, width)
    out = (words[place] >> shift) & np.uint64((1 << width) - 1)
    at = _HEAD.size + size
    places = np.frombuffer(raw, "<u2", exceptions, at)
    highs = np.frombuffer(raw, "<u4", exceptions, at + 2 * exceptions)
    out[places] |= highs.astype(np.uint64) << np.uint64(width)
    return (out + np.uint64(low)).astype("<u4")


class Encoder:
    """Ids of texts by the tokenizers library, unit by unit.

    A byte-level tokenizer splits a text by a pattern before it merges bytes, and
    between some classes of characters a split falls whatever stands around them
    (see ``units``). A text is cut there and each different unit is encoded once;
    the ids are those of the whole text. Short units are remembered in a table of
    ``SLOTS`` rows that a newer unit of the same slot takes over, compared byte by
    byte, so memory is bounded. Control strings in a text are ordinary text.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        # Every byte of a piece is one character of its entry.
        pieces = self.tokenizer.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
        for piece, number in pieces.items():
            self.lengths[number] = len(piece)
        self.keys = np.zeros((UNIT_WORDS, SLOTS), np.uint64)
        self.sizes, self.counts = np.zeros(SLOTS, np.uint8), np.zeros(SLOTS, np.uint8)
        self.offsets, self.pool, self.used = np.zeros(SLOTS, np.int32), np.zeros(POOL, "<u4"), 0

    def units(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where the units of a block of texts begin, and its end.

        Cuts: white space after anything else; letters, digits and other marks
        next to each other, but not a letter after an apostrophe; anything after
        a single line break or tab. Bytes of unknown class make no cut.
        """
        kind = np.frombuffer(bytearray(data.tobytes().translate(_KINDS)), np.uint8)
        accents = np.flatnonzero(data[:-1] == 0xC3)
        accents = accents[(data[accents + 1] != 0x97) & (data[accents + 1] != 0xB7)]
        kind[accents] = kind[accents + 1] = _LETTER
        pairs = np.frombuffer((kind[:-1] * 8 + kind[1:]).tobytes().translate(_CUTS), np.uint8)
        breaks = np.flatnonzero(kind[1:-1] == _BREAK) + 1
        lone = breaks[(kind[breaks - 1] >= _LETTER) & (kind[breaks + 1] >= _LETTER)] + 1
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = pairs
        cut[lone] = cut[edges] = True
        return np.flatnonzero(cut)

    def learn(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of units one after another, number of ids of each)."""
        words = [[unit.decode() for unit in found]]
        ids = self.tokenizer.encode_batch_fast(words, is_pretokenized=True, add_special_tokens=False)[0].ids
        ids = np.array(ids, "<u4")
        ends = np.cumsum(self.lengths[ids])
        wanted = np.cumsum([len(unit) for unit in found])
        last = np.searchsorted(ends, wanted)
        if last[-1] != len(ends) - 1 or (ends[last] != wanted).any():
            raise ValueError("the vocabulary is not one of a byte-level tokenizer")
        return ids, np.diff(last, prepend=-1)

    def encode(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of a block of texts, number of ids of each), the end id with each."""
        starts = self.units(data, edges)
        if len(data) + self.used > POOL:
            self.sizes[:] = self.used = 0
        first, size = starts[:-1], np.diff(starts)
        padded = np.concatenate([data, np.zeros(8 * UNIT_WORDS + 8, np.uint8)])
        words = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(padded) - 7,), (1,))
        keys = [words[first + 8 * k] & _MASKS[np.clip(size - 8 * k, 0, 8)] for k in range(UNIT_WORDS)]
        slot = size.astype(np.uint64)
        for key in keys:
            slot = (slot ^ key) * np.uint64(0x9E3779B97F4A7C15)
            slot ^= slot >> np.uint64(29)
        slot = (slot % np.uint64(SLOTS)).astype(np.int64)
        short = size <= 8 * UNIT_WORDS
        hit = short & (self.sizes[slot] == size)
        for held, key in zip(self.keys, keys, strict=True):
            hit &= held[slot] == key
        count, offset = self.counts[slot].astype(np.int64), self.offsets[slot].astype(np.int64)
        pool = self.pool
        new = np.flatnonzero(~hit)
        if len(new):
            raw = data.tobytes()
            units = [raw[a : a + n] for a, n in zip(first[new].tolist(), size[new].tolist(), strict=True)]
            number: dict[bytes, int] = {}
            which = np.array([number.setdefault(unit, len(number)) for unit in units])
            ids, counts = self.learn(list(number))
            if len(data) > POOL:  # a stretch without any cut
                pool, self.used = np.concatenate([self.pool[: self.used], ids]), 0
                places = len(pool) - len(ids) + np.cumsum(counts) - counts
            else:
                places = self.used + np.cumsum(counts) - counts
                pool[self.used : self.used + len(ids)] = ids
                self.used += len(ids)
                keep = new[short[new]]
                self.sizes[slot[keep]] = size[keep]
                self.counts[slot[keep]] = counts[which[short[new]]]
                self.offsets[slot[keep]] = places[which[short[new]]]
                for held, key in zip(self.keys, keys, strict=True):
                    held[slot[keep]] = key[keep]
            count[new], offset[new] = counts[which], places[which]
        totals = np.append(0, np.cumsum(count))
        ids = pool[np.repeat(offset - totals[:-1], count) + np.arange(totals[-1])]
        ends = totals[np.searchsorted(starts, edges)]
        return np.insert(ids, ends[1:], END), np.diff(ends) + 1

    def encode_long(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of one long text, a stretch of units at a time, the end id last."""
        first, size = 0, PIECE
        while first < len(data):
            part = data[first : first + size]
            if first + len(part) < len(data):
                inner = self.units(part, np.array([0, len(part)]))[1:-1]
                if not len(inner):
                    size *= 2
                    continue
                part = part[: inner[-1]]
            yield self.encode(part, np.array([0, len(part)]))[0][:-1]
            first, size = first + len(part), PIECE
        yield np.array([END], "<u4")


@functools.cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


class _File:
    """One file being written: blocks as they fill, then their index and the documents."""

    def __init__(self, system: FileSystem, path: str):
        self.out = system.open_output_stream(path, compression=None)
        self.out.write(MAGIC)
        self.offset, self.starts = len(MAGIC), []
        self.held: list[np.ndarray] = []
        self.waiting = self.ids = self.documents = 0
        self.names: list[np.ndarray] = []
        self.known: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add_documents(self, names: np.ndarray, known: np.ndarray, counts: np.ndarray) -> None:
        self.names.append(names)
        self.known.append(known)
        self.counts.append(counts)
        self.documents += len(names)

    def add_ids(self, ids: np.ndarray) -> None:
        self.ids += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 64 * BLOCK:
            self._flush(whole=False)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        end = len(ids) if whole else len(ids) - len(ids) % BLOCK
        for first in range(0, end, BLOCK):
            packed = pack_block(ids[first : min(first + BLOCK, end)])
            self.starts.append(self.offset)
            self.offset += len(packed)
            self.out.write(packed)
        self.held, self.waiting = [ids[end:].copy()], len(ids) - end

    def close(self) -> None:
        self._flush(whole=True)
        index = self.offset
        self.out.write(np.array([*self.starts, index], "<u8").tobytes())
        documents = index + 8 * (len(self.starts) + 1)
        self.out.write(np.concatenate(self.names).astype("<i8").tobytes())
        self.out.write(np.concatenate(self.counts).astype("<i8").tobytes())
        self.out.write(np.concatenate(self.known).astype(np.uint8).tobytes())
        self.out.write(_TAIL.pack(self.ids, len(self.starts), self.documents, index, documents, MAGIC))
        self.out.close()


FILES = "shard int, place int, file string, n_documents bigint, n_ids bigint"


def _writer(folder: str, vocabulary: str, file_ids: int):
    """Sorted documents to files of this attempt; the rows say which files count.

    A file is named anew for each attempt, so a lost or repeated task leaves at
    most a file that no row names.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        system, base = FileSystem.from_uri(folder)
        out, name, rows = None, "", []

        def close() -> None:
            out.close()
            rows.append((shard, len(rows), name, out.documents, out.ids))

        for batch in batches:
            names = batch.column("doc_id")
            known = np.asarray(names.is_valid())
            names = names.fill_null(0).to_numpy(zero_copy_only=False)
            data, offsets = flat(batch.column("text"))
            for first, last in blocks(offsets, PIECE):
                if out is None:
                    system.create_dir(base, recursive=True)
                    name = f"{folder}/{uuid.uuid4().hex}.ids"
                    out = _File(system, FileSystem.from_uri(name)[1])
                part = data[offsets[first] : offsets[last]]
                if len(part) > 2 * PIECE:  # one long text
                    before = out.ids
                    for ids in encoder(vocabulary).encode_long(part):
                        out.add_ids(ids)
                    counts = np.array([out.ids - before])
                else:
                    ids, counts = encoder(vocabulary).encode(part, offsets[first : last + 1] - offsets[first])
                    out.add_ids(ids)
                out.add_documents(names[first:last], known[first:last], counts)
                if out.ids >= file_ids or out.documents >= FILE_DOCUMENTS:
                    close()
                    out = None
        if out is not None:
            close()
        shards, places, files, documents, ids = zip(*rows, strict=True) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(shards, pa.int32()), pa.array(places, pa.int32()), pa.array(files, pa.string()),
                pa.array(documents, pa.int64()), pa.array(ids, pa.int64()),
            ],
            ["shard", "place", "file", "n_documents", "n_ids"],
        )

    return apply


def write_tokens(
    documents: DataFrame,
    vocabulary: str,
    folder: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode every text, write the ids in ascending order of ids; returns the files.

    Documents are range partitioned by id, so a file holds a stretch of the order
    and ``first`` is the number of ids before it. A file has blocks of ``BLOCK``
    ids: minimum, width that ``PERCENTILE`` per cent of the differences fit, packed
    differences, and lists of the places and high bits of the others; then the
    start of every block and the ids and lengths of its documents.

    Null and empty texts are the end id alone. Null ids come first. Documents of
    one id are ordered by a hash of their texts, equal rows by the input partition
    they are in, so they too fill many tasks. Other columns are ignored; an empty
    table gives no files.
    """
    spark = documents.sparkSession
    folder = folder or scratch_path(spark, "token-ids")
    order = ["doc_id", "_hash", "_from"]
    rows = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    ).select("doc_id", "text", F.xxhash64("text").alias("_hash"), F.spark_partition_id().alias("_from"))
    files = store(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(_writer(folder, vocabulary, file_ids), FILES),
        "token-files",
    )
    # One row per writing task.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("_ids")).select(
        "shard", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_first")
    )
    inside = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return files.join(shards, "shard").select(
        "file", "n_documents", "n_ids",
        (F.col("_first") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("first"),
    )


class TokenFile:
    """Random access to one file."""

    def __init__(self, file: str):
        system, path = FileSystem.from_uri(file)
        self.stream = system.open_input_file(path)
        size = self.stream.size()
        tail = _TAIL.unpack(self._read(size - _TAIL.size, size))
        self.ids, n_blocks, n, index, documents, magic = tail
        if magic != MAGIC:
            raise ValueError(f"{file} holds no token blocks")
        self.starts = np.frombuffer(self._read(index, documents), "<u8").astype(np.int64)
        table = self._read(documents, documents + 17 * n)
        self.names = np.frombuffer(table, "<i8", n)
        self.counts = np.frombuffer(table, "<i8", n, 8 * n)
        self.known = np.frombuffer(table, np.uint8, n, 16 * n).astype(bool)

    def _read(self, begin: int, end: int) -> bytes:
        return self.stream.read_at(end - begin, begin)

    def read(self, begin: int, end: int) -> np.ndarray:
        """The ids from ``begin`` to ``end``; only their blocks are read."""
        if begin >= end:
            return np.zeros(0, "<u4")
        first, last = begin // BLOCK, -(-end // BLOCK)
        origin = int(self.starts[first])
        raw = memoryview(self._read(origin, int(self.starts[last])))
        at = (self.starts[first : last + 1] - origin).tolist()
        ids = np.concatenate([unpack_block(raw[a:b]) for a, b in zip(at, at[1:], strict=False)])
        return ids[begin - first * BLOCK : end - first * BLOCK]

    def close(self) -> None:
        self.stream.close()


def _reader(with_ids: bool):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, before in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                held = TokenFile(file)
                ends = np.append(0, np.cumsum(held.counts))
                for lo, hi in blocks(ends, READ_IDS):
                    ids = held.read(int(ends[lo]), int(ends[hi]))
                    edges = (ends[lo : hi + 1] - ends[lo]).tolist()
                    sums = [zlib.crc32(ids[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
                    columns = [
                        pa.array(held.names[lo:hi], pa.int64(), mask=~held.known[lo:hi]),
                        pa.array(before + ends[lo:hi]),
                        pa.array(held.counts[lo:hi], pa.int64()),
                        pa.array(sums, pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(
                            pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32)))
                        )
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
                held.close()

    return apply


def read_tokens(files: DataFrame, ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ``ids``) of every document in ``files``.

    Each file is read by one task, a few blocks at a time.
    """
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if ids:
        schema += ", ids array<int>"
    count = files.count()
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, count)
    return (
        files.select("file", "first").repartition(tasks, "file").mapInArrow(_reader(ids), schema)
    )
