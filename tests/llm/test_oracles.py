"""The operators' queries that SQL can express equal it on sf0.01; the others are tested by brute force."""

from __future__ import annotations

import pytest

import __spark_entry__ as se
from martsmith.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck_connection

SF001 = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    result = compare(spark, name, SF001, duck_connection(SF001))
    assert result["status"] == "ok", result


def test_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(se.queries())
