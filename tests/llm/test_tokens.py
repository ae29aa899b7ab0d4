"""Counts against the pieces that a tokenizer library returns."""

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from threadloom.llm.queries import PIECES
from threadloom.llm.tokens import PieceCounts, load_vocabulary, token_counts

CASES = [
    None, "", " ", "  a  b ", "▁x▁ y", "<0x0A> <s></s><unk>", "日本語 テキスト🙂🙂 \n\t zz", "a" * 3000,
    "\U0001f9ff" * 5, "x\x00y", " lead", "trail ", "ﷺ ǈ", "same same",
]


def library(vocabulary):
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(tokenizer.encode(text or "").ids)


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(PIECES)


def test_table_and_cases_equal_the_library(spark, small, vocabulary):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    cases = spark.createDataFrame([(-i, t) for i, t in enumerate(CASES, 1)], "doc_id long, text string")
    count = library(vocabulary)
    rows = token_counts(docs.unionByName(cases), vocabulary).collect()
    assert len(rows) == docs.count() + len(CASES)
    assert [(r.doc_id, r.n_tokens) for r in rows] == [(r.doc_id, count(r.text)) for r in rows]


def test_ties_go_to_the_longer_last_piece():
    vocabulary = [("<unk>", -90.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("é", -5.0)]
    counts, count = PieceCounts(vocabulary), library(vocabulary)
    for text in ("ab", "aab", "abab", "ba", "é a", "a b ab"):
        assert counts.text(text) == count(text)


def test_long_text_is_cut_at_blanks_only(vocabulary):
    counts = PieceCounts(vocabulary)
    words = "abc de " * 300_000
    assert counts.text(words) == 300_000 * (counts["abc"] + counts["de"]) + counts[""]


def test_other_columns_and_empty_table(spark, vocabulary):
    df = spark.createDataFrame([("x y", "n", 1)], "text string, n_tokens string, z int")
    out = token_counts(df, vocabulary)
    assert set(out.columns) == {"text", "n_tokens", "z"} and out.first().n_tokens > 0
    assert token_counts(df.limit(0), vocabulary).collect() == []
