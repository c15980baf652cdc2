"""Every mart query equals its DuckDB oracle on sf0.01 (the driver's correctness gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as se
from martsmith.plans.entries import QUERIES
from martsmith.plans.oracles import ORACLES
from tests.conftest import SF0001, SF001
from tests.oracle_check import compare, duck_connection


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    result = compare(spark, name, SF001, duck)
    assert result["status"] == "ok", result


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert len(df.columns) == 45
    assert df.count() > 0


def test_smoke_scale_oracles(spark):
    con = duck_connection(SF0001)
    for name in ("users_mart", "withdraw_mart", "add_funds_mart", "issuer_mart"):
        assert compare(spark, name, SF0001, con)["status"] == "ok", name


def test_oracles_hold_with_ansi_off(spark):
    """The driver's session may run without ANSI mode: coercion uses try_* either way."""
    con = duck_connection(SF0001)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for name in ("conform_types", "users_mart", "withdraw_mart", "typed_key_join"):
            assert compare(spark, name, SF0001, con)["status"] == "ok", name
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
