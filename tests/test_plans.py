"""Plan shape: pushdown and pruning reach the scan, dedup pre-aggregates before the shuffle,
dead joins vanish, small dimensions are broadcast, surrogate ids need no single partition."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martsmith.operators.dedup import first_wins
from martsmith.operators.surrogate import assign_surrogate_ids
from martsmith.plans.entries import QUERIES
from martsmith.plans.jobs import bank_query, campaign_query, campaign_transactions_query, users_query
from martsmith.sources.standins import standin_registry
from tests.conftest import SF0001


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_users_dead_joins_are_removed(spark):
    src = standin_registry(spark, SF0001)
    with_dead = optimized(users_query(src, dead_joins=True))
    without = optimized(users_query(src, dead_joins=False))
    # the 3 joins whose columns are unused under DISTINCT are removed: the plans with and
    # without them have exactly the same joins
    for kind in ("Join LeftOuter", "Join Inner", "Join LeftAnti"):
        assert with_dead.count(kind) == without.count(kind), kind
    assert with_dead.count("Join ") == without.count("Join ")


def test_not_null_filter_and_pruning_reach_the_scan(spark):
    src = standin_registry(spark, SF0001)
    plan = physical(campaign_transactions_query(src))
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_linenumber)]" in plan
    bank = physical(bank_query(src))
    # users stand-in has 22 columns; the bank mart reads two customer columns
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in bank


def test_first_wins_partial_limit_before_shuffle(spark):
    li = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    df = first_wins(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    # the physical plan before AQE wraps it: partial limit, then the hash exchange
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_small_dimensions_are_broadcast(spark):
    src = standin_registry(spark, SF0001)
    plan = campaign_query(src)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_surrogate_ids_have_no_single_partition_exchange(spark):
    li = spark.read.parquet(f"{SF0001}/orders.parquet")
    out = assign_surrogate_ids(li, ["o_orderdate"], "row_id", 0, "bigint")
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SinglePartition" not in plan
    ids = [r.row_id for r in out.select("row_id").collect()]
    assert sorted(ids) == list(range(1, li.count() + 1))
    first = out.orderBy("row_id").first()
    assert first.o_orderdate == li.agg(F.min("o_orderdate")).first()[0]


@pytest.mark.parametrize("mart", ["bank", "users", "campaign", "issuer_onboardings", "wallet_add_funds", "wallet_withdraw_funds"])
def test_split_marts_plan_sort_merge_joins(spark, mart):
    """The `_split` queries check the joins of large tables: no fan-out join of theirs is a broadcast at test size."""
    from martsmith.plans.runner import mart_rows

    src = standin_registry(spark, SF0001)
    plan = mart_rows(src, mart, strategy="split")._jdf.queryExecution().sparkPlan().toString()
    auto = mart_rows(src, mart)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") >= 2 and plan.count("BroadcastHashJoin") < max(1, auto.count("BroadcastHashJoin"))


def test_tasks_are_sized_by_what_they_read(spark, tmp_path, monkeypatch):
    """A larger input makes more tasks, not larger ones: scans, shuffles and the caller's settings."""
    from martsmith import session

    line = spark.range(2000).selectExpr("id AS l_orderkey", "1 AS l_linenumber", "CAST(id % 3 AS DOUBLE) AS l_discount", "CAST(0 AS DOUBLE) AS l_tax")
    line.repartition(20).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = dict(spark.conf.getAll)
    monkeypatch.setattr(session, "TASK_BYTES", 4096)
    got = QUERIES["nan_to_null"](spark, str(tmp_path))
    assert got.rdd.getNumPartitions() == 20  # under the session's own settings they are packed by 4 MB per file
    assert got.count() == 2000
    assert dict(spark.conf.getAll) == before
    own = session.task_session(spark, str(tmp_path))
    read = sum(f.stat().st_size for f in tmp_path.rglob("*") if f.is_file())
    first = int(own.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    assert 8 <= first and abs(first - read * session.ROW_GROWTH / (4 * 4096)) <= 2
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "4096"
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert session.task_session(own, str(tmp_path)).conf.get("spark.sql.files.maxPartitionBytes") == "4096"


def _users_tables(spark, path, copies: int = 1):
    """Test tables of three users, two with KYC documents and equal types; ``copies`` of each document and platform row."""
    from datetime import datetime

    day = datetime(2024, 5, 1)
    made = {
        "customer": [(k, f"N{k}", k, 10.0 * k, "BUILDING") for k in (1, 2, 3)],
        "events": [(k, day, 1 + k % 2, "signup", 9.0, None) for k in range(1, 9)] * copies,
        "orders": [(k, 1, "F", 5.0, day, "1-URGENT") for k in range(2, 12)] * copies,
        "part": [(2, "p", "b", "t", 1, 1.0), (3, "p", "b", "t", 8, 1.0), (4, "p", "b", "t", 5, 1.0), (5, "p", "b", "t", 6, 1.0)],
        "supplier": [(1, "S1", 1, 1.0), (2, "S2", 2, 1.0)],
        "nation": [(1, "A", 1), (2, "B", 1), (3, "C", 0)],
        "region": [(k, f"R{k}") for k in range(3)],
    }
    for table, rows in made.items():
        schema = spark.read.parquet(f"{SF0001}/{table}.parquet").schema
        width = len(schema.fields)
        spark.createDataFrame([(*r, *[None] * width)[:width] for r in rows], schema).write.parquet(f"{path}/{table}.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["append_snapshots", "load_append"])
def test_ordered_users_pass_one_exchange(spark, tmp_path, monkeypatch, name):
    """The users mart's wide rows are shuffled for the order of their ids alone, and not for DISTINCT as well."""
    import re

    from martsmith.operators import surrogate
    from martsmith.plans import runner

    path, plans, write = _users_tables(spark, tmp_path), [], surrogate.write_stage

    def spy(df, what):
        plans.append(physical(df))
        return write(df, what)

    monkeypatch.setattr(surrogate, "write_stage", spy)
    monkeypatch.setattr(runner, "write_stage", spy)
    n = QUERIES["users_mart"](spark, path).count()
    assert n > 8 and QUERIES[name](spark, path).count() == 2 * n
    assert len(plans) >= 2 and not re.findall(r"hashpartitioning\([^()]*email#", "\n".join(plans))


@pytest.mark.parametrize("copies", [1, 3])
def test_append_snapshots_of_repeated_rows(spark, tmp_path, copies):
    path = _users_tables(spark, tmp_path, copies)
    mart = sorted(map(str, QUERIES["users_mart"](spark, path).collect()))
    got = QUERIES["append_snapshots"](spark, path).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 2 * len(mart) + 1))
    for load in (1, 2):
        part = [r for r in got if r.load_no == load]
        assert [r.user_id for r in part] == sorted(r.user_id for r in part)
        assert sorted(str(r).replace(f"id={r.id}, ", "", 1).replace(f", load_no={load})", ")") for r in part) == mart


def test_load_append_stages_wide_rows_once(spark, tmp_path, monkeypatch):
    """A load of the users mart stores its joined rows and writes them to the target: no staged table between the two."""
    from martsmith.operators import surrogate
    from martsmith.plans import entries, runner

    path, staged, write = _users_tables(spark, tmp_path), [], surrogate.write_stage

    def spy(df, what):
        staged.append(what)
        return write(df, what)

    for module in (surrogate, runner):
        monkeypatch.setattr(module, "write_stage", spy)
    n = QUERIES["users_mart"](spark, path).count()
    assert entries.load_append(spark, path).count() == 2 * n and staged == ["joined", "joined"]


@pytest.mark.parametrize("copies", [1, 3])
def test_load_append_numbers_and_reports_as_a_plain_load(spark, tmp_path, copies):
    from martsmith.plans import MARTS, entries, load_mart
    from martsmith.sinks import ParquetTarget
    from martsmith.sources.standins import standin_registry

    src, spec = standin_registry(spark, _users_tables(spark, tmp_path / "in", copies)), MARTS["users"].target
    plain, marked = (ParquetTarget(spec, str(tmp_path / n)) for n in ("plain", "marked"))
    for _ in range(2):
        want, got = load_mart(spark, src, "users", plain), load_mart(spark, src, "users", marked, distinct=entries._distinct_marked)
        assert got == want and got.written > 8
    rows = marked.read(spark).orderBy("id").collect()
    n = len(rows) // 2
    assert [r.id for r in rows] == list(range(1, 2 * n + 1))
    for part in (rows[:n], rows[n:]):
        assert [r.user_id for r in part] == sorted(r.user_id for r in part)
    without_ids = [sorted(map(str, t.read(spark).drop("id").collect())) for t in (marked, plain)]
    assert without_ids[0] == without_ids[1]


def test_loads_run_in_code_that_the_jvm_compiles(spark, tmp_path):
    """The conversion of 45 columns, counted, is a loop of more than 8000 bytes when its operators are fused."""
    from martsmith.session import task_session

    own = task_session(spark, str(tmp_path))
    assert own.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    own.conf.set("spark.sql.codegen.hugeMethodLimit", "4000")
    assert task_session(own, str(tmp_path)).conf.get("spark.sql.codegen.hugeMethodLimit") == "4000"
