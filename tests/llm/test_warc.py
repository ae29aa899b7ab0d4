"""Archives read back to the pages, and to the bytes other readers expect."""

import gzip
import hashlib
import pathlib

from threadloom.llm import warc
from threadloom.llm.warc import make_record, parse_record, read_warc, write_warc

ROWS = [
    (3, "http://a/?x=1 2\r\nEvil: 1", "<p>é</p>", 1), (1, None, "<p>é</p>", 2), (2, "u", None, 3), (7, "u", "", 4),
    (None, "n", "<p>é</p>", 5), (None, "n", "alone", 6), (5, "w", "x" * 3_000_000, 7), (8, "r", "twice", 8), (8, "r", "twice", 8),
    (9, "q", "WARC/1.1\r\n\r\nWARC-Type: revisit\r\n\r\n", 9),
]
SCHEMA = "page_id long, url string, html string, payload int"


def want(rows, least=0):
    payloads = [(r[0], (r[2] or "").encode()) for r in rows]
    first = {}
    for page, p in payloads:
        if page is not None:
            first[p] = min(first.get(p, page), page)
    out = []
    for page, p in payloads:
        again = len(p) >= least and p in first and page != first[p]
        out.append((page, len(p), warc.base32_digest(p), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=str)


def got(records):
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records.collect()), key=str
    )


def test_defined_cases(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert got(read_warc(write_warc(df))) == want(ROWS)
    assert got(read_warc(write_warc(df, least_bytes=6))) == want(ROWS, 6)
    assert got(read_warc(write_warc(df.limit(0)))) == []


def test_payloads_and_selected_records(spark):
    index = write_warc(spark.createDataFrame(ROWS, SCHEMA))
    rows = read_warc(index.where("page_id in (1, 5, 9)")).collect()
    assert {r.page_id: r.payload.decode() for r in rows} == {r[0]: r[2] for r in ROWS if r[0] in (1, 5, 9)}


def test_archive_is_a_chain_of_gzip_members(spark, tmp_path):
    index = write_warc(spark.createDataFrame(ROWS, SCHEMA).repartition(3), folder=f"file://{tmp_path}/out")
    by_file = {}
    for r in index.collect():
        by_file.setdefault(r.file, []).append((r.offset, r.length))
    assert sum(map(len, by_file.values())) == len(ROWS)
    for file, places in by_file.items():
        path = pathlib.Path(file.removeprefix("file://"))
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert path.stat().st_size == end
        raw = gzip.decompress(path.read_bytes())
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        assert b"\r\nEvil" not in raw


def test_damaged_payload_is_refused():
    member, digest = make_record(1, "u", b"abc", None, False)
    fields, payload = parse_record(member)
    assert payload == b"abc" and fields["WARC-Payload-Digest"] == f"sha1:{digest}"
    assert fields["Content-Length"] == str(len(gzip.decompress(member).split(b"\r\n\r\n", 1)[1]) - 4)
    bad = gzip.compress(gzip.decompress(member).replace(b"abc", b"abd"))
    try:
        parse_record(bad)
    except ValueError:
        return
    raise AssertionError("a wrong digest was accepted")


def test_ranges_are_coalesced():
    near = [("a", 0, 10), ("a", 20, 10), ("a", 40 + warc.GAP, 5), ("b", 0, 5), ("b", 5, warc.READ), ("b", 6 + warc.READ, 1)]
    assert list(warc._ranges(near)) == [(0, 2), (2, 3), (3, 4), (4, 5), (5, 6)]


def test_digest_is_base32_sha1():
    import base64

    assert warc.base32_digest(b"x") == base64.b32encode(hashlib.sha1(b"x").digest()).decode()
