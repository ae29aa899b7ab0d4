"""Registered queries against their SQL twins, and what every query promises."""

import oracle
import pytest

import __spark_entry__ as entry_point
from threadloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, con, name):
    assert oracle.differences(QUERIES[name](spark, small), con, ORACLES[name]) is None


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_point.queries())


@pytest.mark.parametrize("name", ["op3_token_counts", "op6_benchmark_decontamination", "op9_toxicity_severity", "op10_pii_pseudonyms", "op11_token_blocks"])
def test_one_row_per_document(spark, small, name):
    ids = [r.doc_id for r in QUERIES[name](spark, small).select("doc_id").collect()]
    want = [r.doc_id for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect()]
    assert sorted(ids) == sorted(want)
