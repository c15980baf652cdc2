"""Load-mode properties against a plain-Python model on random small batches."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martsmith.operators.dedup import first_wins
from martsmith.operators.loadplan import insert_ignore_report, plan_insert_ignore

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3), st.sampled_from(["a", "b", None]))
BATCH = st.lists(ROW, max_size=12)
SCHEMA = "k int, o int, v string"


def _key(t):
    return tuple((x is None, x if x is not None else 0) if not isinstance(x, str) else (False, x) for x in t)


def model_first_wins(batch):
    """First row per non-NULL key in (o, k, v) order, NULLs first; NULL keys all kept."""
    order = sorted(batch, key=lambda r: (_key((r[1],)), _key((r[0],)), (r[2] is not None, r[2] or "")))
    seen, out = set(), []
    for r in order:
        if r[0] is None:
            out.append(r)
        elif r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


def model_insert_ignore(existing, batch):
    present = {r[0] for r in existing if r[0] is not None}
    return [r for r in model_first_wins(batch) if r[0] is None or r[0] not in present]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: repr(t))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(existing=BATCH, batch=BATCH)
def test_insert_ignore_matches_model(spark, existing, batch):
    ex = spark.createDataFrame(existing, SCHEMA)
    inc = spark.createDataFrame(batch, SCHEMA)
    got = _rows(plan_insert_ignore(ex, inc, ["k"], ["o"]))
    want = sorted(model_insert_ignore(existing, batch), key=lambda t: repr(t))
    assert got == want
    # never changes an existing row; twice = once for complete keys
    after = existing + want
    again = model_insert_ignore(after, batch)
    assert all(r[0] is None for r in again)
    rep = insert_ignore_report(ex, inc, ["k"]).first()
    assert rep.read == len(batch) == rep.written + rep.deduped_in_batch + rep.already_present
    assert rep.written == len(want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=BATCH)
def test_first_wins_keys_unique(spark, batch):
    out = first_wins(spark.createDataFrame(batch, SCHEMA), ["k"], ["o"])
    keys = [r.k for r in out.collect() if r.k is not None]
    assert len(keys) == len(set(keys))
    assert _rows(out) == sorted(model_first_wins(batch), key=lambda t: repr(t))
