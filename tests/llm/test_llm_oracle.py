"""Queries of the subpackage against their DuckDB twins."""

import pytest

from conftest import SF001
from ledgerlake.llm.registry import LLM_ORACLE, LLM_QUERIES
from oracle_harness import compare, duck, type_mismatches


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(LLM_QUERIES[name](spark, SF001), duck(SF001), LLM_ORACLE[name])
    assert r["columns_match"] and r["values_match"], r["diffs"]
    assert r["spark_rows"] == r["oracle_rows"] > 0 and type_mismatches(r) == {}


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 1 + len(LLM_QUERIES)))
