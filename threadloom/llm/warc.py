"""WARC archives: written record by record with an index, read back by byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, functions as F

from threadloom.session import scratch_path, store

LEAST_BYTES = 0  # payloads shorter than this are never written as revisits
FILE_BYTES = 1 << 30
GAP = 64 << 10  # unwanted bytes read rather than starting another read
READ = 8 << 20  # bytes fetched by one read, unless one record is longer
TASK_BYTES = 64 << 20  # archive bytes a reading task is given
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "page_id bigint, url string, payload_digest string, record_type string, refers_to bigint, "
    "payload_bytes bigint, file string, offset bigint, length bigint"
)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def make_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool
) -> tuple[bytes, str]:
    """(one gzip member with one record, payload digest)."""
    digest = base32_digest(payload)
    body = b"" if revisit else payload
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(http) + len(body)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [
            f"WARC-Profile: {REVISIT}",
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush(), digest


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, payload) of one gzip member; the payload's digest is checked."""
    raw = zlib.decompress(member, 31)
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = raw[end + 4 : end + 4 + int(fields["Content-Length"])]
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    wanted = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and base32_digest(payload) != wanted:
        raise ValueError(f"digest of {fields['WARC-Record-ID']} does not match")
    return fields, payload


def _writer(folder: str):
    """Records to archive files of this attempt; the index says where they are.

    A file is named anew for each attempt, so a lost or repeated task leaves at
    most a file that no index row names.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = FileSystem.from_uri(folder)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "revisit")]
                for cells in zip(*columns, strict=True):
                    page_id, url, payload, refers_to, revisit = (c.as_py() for c in cells)
                    payload = (payload or "").encode()
                    if out is None or offset >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        system.create_dir(base, recursive=True)
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    member, digest = make_record(page_id, url, payload, refers_to, revisit)
                    out.write(member)
                    rows.append(
                        (page_id, url, digest, "revisit" if revisit else "response",
                         refers_to if revisit else None, len(payload), f"{folder}/{name}", offset, len(member))
                    )
                    offset += len(member)
                if rows:
                    yield _batch(rows, _INDEX_TYPES)
        finally:
            if out is not None:
                out.close()

    return apply


_INDEX_TYPES = [
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
]


def _batch(rows: list[tuple], types: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)], [n for n, _ in types]
    )


def write_warc(
    pages: DataFrame, folder: str | None = None, payload: str = "html", least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """Write a record per row of (page_id, url, ``payload``); returns the index.

    Of rows with equal payloads of at least ``least_bytes`` bytes, that with the
    smallest page_id is a response and the others revisit it. Only payloads that
    occur more than once are joined back, so where there are few the payloads do
    not move. Each record is a gzip member of its own; archives go to ``folder``
    (default: the shared folder), and every index row says file, offset, length,
    URL and digest.

    A null payload is an empty one. A null page_id never stands for others; rows
    that repeat a response's page_id and payload are responses too. A null url is
    empty. Other columns are ignored; an empty table writes nothing.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"),
    )
    sha = F.sha1(F.encode("payload", "UTF-8"))
    size = F.octet_length("payload")
    repeated = store(
        rows.select("page_id", sha.alias("sha"), size.alias("size"))
        .where(F.col("size") >= least_bytes)
        .groupBy("sha", "size")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
        .drop("n"),
        "repeated",
    )
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    marked = (
        rows.withColumn("sha", sha).withColumn("size", size)
        .join(repeated, ["sha", "size"], "left")
        .select("page_id", "url", "payload", "refers_to", revisit.alias("revisit"))
    )
    return store(marked.mapInArrow(_writer(folder), INDEX), "warc-index")


def _ranges(places: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of sorted (file, offset, length) that one read fetches."""
    first = 0
    for k in range(1, len(places) + 1):
        if k < len(places):
            file, offset, length = places[k]
            before = places[k - 1]
            near = file == before[0] and offset - (before[1] + before[2]) <= GAP
            if near and offset + length - places[first][1] <= READ:
                continue
        yield first, k
        first = k


RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, payload binary"
)
_RECORD_TYPES = [
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload", pa.binary()),
]


def _reader(payloads: bool):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, stream = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            for first, last in _ranges(places) if places else ():
                file, begin, _ = places[first]
                if file != opened:
                    if stream is not None:
                        stream.close()
                    system, path = FileSystem.from_uri(file)
                    opened, stream = file, system.open_input_file(path)
                end = places[last - 1][1] + places[last - 1][2]
                fetched = stream.read_at(end - begin, begin)
                rows = []
                for _, offset, length in places[first:last]:
                    at = offset - begin
                    fields, payload = parse_record(fetched[at : at + length])
                    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")
                    rows.append(
                        (
                            None if page is None else int(page),
                            fields["WARC-Target-URI"],
                            len(payload) if fields["WARC-Type"] == "response" else int(fields["X-Payload-Length"]),
                            fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                            fields["WARC-Type"],
                            None if refers is None else int(refers),
                            payload if payloads else None,
                        )
                    )
                yield _batch(rows, _RECORD_TYPES)
        if stream is not None:
            stream.close()

    return apply


def read_warc(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the given index rows, parsed from the archives.

    Rows are range partitioned and sorted by file and offset; neighbouring ranges
    are fetched in one read. ``payloads`` set to false leaves the payload out
    after its digest was checked; a revisit has none of its own.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return (
        index.select("file", "offset", "length")
        .repartitionByRange(int(tasks), "file", "offset")
        .sortWithinPartitions("file", "offset")
        .mapInArrow(_reader(payloads), RECORDS)
    )
