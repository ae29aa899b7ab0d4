"""Token blocks: exact round trips, and ids equal to the tokenizer's on whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from threadloom.llm import token_blocks
from threadloom.llm.token_blocks import BLOCK, Encoder, TokenFile, pack_block, read_tokens, unpack_block, write_tokens

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 1000, BLOCK])
@pytest.mark.parametrize("most", [0, 1, 2, 255, 50_000, 2**31, 2**32 - 1])
def test_blocks_come_back(size, most):
    rng = np.random.default_rng(size + most)
    for ids in (
        rng.integers(0, most, size, endpoint=True),
        np.where(rng.random(size) < 0.03, most, rng.integers(0, min(most, 9), size, endpoint=True)),
        np.full(size, most),
    ):
        ids = ids.astype("<u4")
        raw = pack_block(ids)
        assert (unpack_block(memoryview(raw)) == ids).all()
        assert unpack_block(memoryview(raw)).dtype == np.dtype("<u4")


def test_outliers_do_not_widen_a_block():
    ids = np.arange(BLOCK, dtype="<u4") % 16
    ids[::50] = 50_000
    assert len(pack_block(ids)) < BLOCK // 2 + BLOCK // 50 * 6 + 30


PARTS = [
    "a", "the", "é", "È", "×", "÷", "ß", "日本", "😀", "1", "23", "²", "'", "'s", "'LL", "'d", "’", "-", "...", "#!", "<|endoftext|>",
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x00", "\x1c", "\x85", "\xa0", " ", " ", "　", "﻿", "​",
]


def test_units_leave_the_ids_as_they_are(whole, monkeypatch):
    """Every mixture of classes, in a table so small that units push each other out."""
    monkeypatch.setattr(token_blocks, "SLOTS", 64)
    monkeypatch.setattr(token_blocks, "POOL", 4096)
    rng = random.Random(4)
    encoder = Encoder(VOCABULARY)
    for _ in range(60):
        texts = ["".join(rng.choices(PARTS, k=rng.randrange(0, 40))) for _ in range(rng.randrange(1, 30))]
        raw = [text.encode() for text in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        edges = np.append(0, np.cumsum([len(r) for r in raw]))
        ids, counts = encoder.encode(data, edges)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [[*whole(text), 0] for text in texts]


def test_long_texts_go_in_pieces(whole, monkeypatch):
    monkeypatch.setattr(token_blocks, "PIECE", 100)
    encoder = Encoder(VOCABULARY)
    for text in ("word, and 'more' é words. " * 200, "x" * 3000, "a b" + "é" * 500 + " c" * 400, "\n \n" * 300, ""):
        pieces = list(encoder.encode_long(np.frombuffer(text.encode(), np.uint8)))
        assert np.concatenate(pieces).tolist() == [*whole(text), 0]


def expect(rows, whole):
    """(doc_id, start, n_tokens, crc) in ascending order of ids; rows of one id are compared as a set."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = {}, 0
    for doc_id, text, *_ in ordered:
        ids = np.array([*whole(text), 0], "<u4")
        out.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids), ids.tolist()))
        start += len(ids)
    return out, start


@pytest.mark.parametrize("file_ids", [1 << 26, 50])
def test_files_hold_every_text(spark, whole, file_ids):
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choices(PARTS, k=rng.randrange(0, 60))), "s", 1.0) for k in range(200)]
    rows += [(7, "same id, other text", "s", 2.0), (7, None, "s", 2.0), (None, "no id", "s", 3.0), (-3, "", None, None)]
    rows += [(11, "equal rows", "s", 0.0)] * 30 + [(500, "long, long words\n" * 20_000, "s", 0.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, n_tokens double").repartition(6)
    files = write_tokens(df, VOCABULARY, file_ids=file_ids)
    got = read_tokens(files, ids=True).collect()
    want, total = expect(rows, whole)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32, r.ids))
    assert {k: sorted(v) for k, v in by_id.items()} == {k: sorted(v) for k, v in want.items()}
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    assert place == total
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids)
    assert sorted(map(tuple, read_tokens(files).collect()), key=str) == sorted(
        ((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=str
    )


def test_any_span_of_a_file(spark, whole):
    text = "some words of a text, and 12 more\n" * 3000
    files = write_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), VOCABULARY).collect()
    want = np.array([*whole(text), 0])
    held = TokenFile(files[0].file)
    assert len(held.starts) == -(-len(want) // BLOCK) + 1 > 3
    for begin, end in ((0, 0), (0, 1), (4095, 4097), (4096, 8192), (5000, len(want)), (0, len(want))):
        assert held.read(begin, end).tolist() == want[begin:end].tolist()
    held.close()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert read_tokens(write_tokens(df, VOCABULARY)).collect() == []
