from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martsmith.session import build_session

    s = build_session("local[4]", app_name="martsmith-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def registry(spark):
    """A source registry made of literal DataFrames: ``registry({"name": df, ...})``."""
    from martsmith.sources.registry import SourceRegistry

    def make(tables):
        return SourceRegistry(spark, tables)

    return make


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when none given)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
