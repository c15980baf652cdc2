"""Versioned targets: whole versions for readers, runs that count once, key index; and JDBC loads through a staging table."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

import pytest

from martsmith.operators.loadplan import anti_existing
from martsmith.plans.runner import load_frame
from martsmith.schemas import TargetSpec
from martsmith.sinks import ConcurrentLoad, JdbcTarget, VersionedTarget
from martsmith.sinks.targets import ATTEMPT, LEDGER, PLACE, StagedLoad, ledger_ddl, merge_sql, unique_key_ddl
from martsmith.streaming import incremental_load
from tests.conftest import rows

KEYED = TargetSpec("t", (("k", "bigint"), ("v", "varchar(5)")), not_null=("k",), key=("k",))
LOG = TargetSpec("log", (("id", "bigint"), ("k", "bigint"), ("v", "varchar(5)")), surrogate="id", mode="append")
LOOSE = TargetSpec("loose", (("k", "bigint"), ("v", "varchar(5)")), key=("k",))
DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def batch(spark, *values):
    return spark.createDataFrame(list(values), "k long, v string")


def test_a_run_counts_once(spark, tmp_path):
    target = VersionedTarget(LOG, str(tmp_path / "log"))
    first = load_frame(spark, batch(spark, (1, "a"), (1, "a"), (None, "b")), LOG, target, run_id="r1")
    again = load_frame(spark, batch(spark, (9, "other")), LOG, target, run_id="r1")
    assert again == replace(first, replayed=True) and first.written == 3
    load_frame(spark, batch(spark, (1, "a")), LOG, target, run_id="r2")
    assert rows(target.read(spark).drop("id")) == [(1, "a"), (1, "a"), (1, "a"), (None, "b")]
    assert sorted(r.id for r in target.read(spark).collect()) == [1, 2, 3, 4] and target.max_id(spark) == 4


def test_null_keys_count_once_per_run(spark, tmp_path):
    target = VersionedTarget(LOOSE, str(tmp_path / "loose"))
    for run in ("r1", "r1", "r2"):
        load_frame(spark, batch(spark, (1, "a"), (None, "b"), (None, "b")), LOOSE, target, run_id=run)
    assert rows(target.read(spark)) == [(1, "a")] + [(None, "b")] * 4


def test_readers_see_whole_versions(spark, tmp_path):
    spec = replace(KEYED, mode="full_refresh")
    target = VersionedTarget(spec, str(tmp_path / "t"))
    load_frame(spark, batch(spark, (1, "old")), spec, target)
    reader = target.read(spark)
    ticket = target.overwrite(batch(spark, (2, "new")))
    assert rows(target.read(spark)) == [(1, "old")]  # written, not published
    target.publish(spark, ticket, None, {})
    assert rows(target.read(spark)) == [(2, "new")] and rows(reader) == [(1, "old")]
    assert rows(target.read(spark, 2)) == [(1, "old")]
    assert load_frame(spark, batch(spark), spec, target).skipped_empty
    assert rows(target.read(spark)) == [(2, "new")]


def test_a_failed_load_leaves_nothing(spark, tmp_path):
    target = VersionedTarget(KEYED, str(tmp_path / "t"))
    load_frame(spark, batch(spark, (1, "a")), KEYED, target)
    target.append(batch(spark, (2, "lost")))  # never published
    (tmp_path / "t/versions/000000000003.json").write_text('{"version": 3, "fol')  # a publisher that died in the middle
    assert rows(target.read(spark)) == [(1, "a")]
    with pytest.raises(ConcurrentLoad):
        target.publish(spark, target.append(batch(spark, (3, "c"))), None, {})
    (tmp_path / "t/versions/000000000003.json").unlink()
    assert len(target.drop_unreferenced(spark)) == 2 and rows(target.read(spark)) == [(1, "a")]


def test_the_second_of_two_loads_fails(spark, tmp_path):
    target = VersionedTarget(KEYED, str(tmp_path / "t"))
    target.create_if_missing(spark)
    one, two = target.append(batch(spark, (1, "a"))), target.append(batch(spark, (1, "b")))
    target.publish(spark, one, None, {})
    with pytest.raises(ConcurrentLoad):
        target.publish(spark, two, None, {})
    assert rows(target.read(spark)) == [(1, "a")]


def test_key_index(spark, tmp_path):
    plain, target = VersionedTarget(KEYED, str(tmp_path / "p")), VersionedTarget(KEYED, str(tmp_path / "t"), buckets=4)
    for k in range(4):
        values = batch(spark, *[(i, f"b{k}") for i in range(0, 40 * (k + 1), k + 1)])
        assert load_frame(spark, values, KEYED, target).written == load_frame(spark, values, KEYED, plain).written
    assert rows(target.read(spark)) == rows(plain.read(spark))
    assert rows(target.keys(spark)) == rows(target.read(spark).select("k"))
    within = target.keys(spark, batch(spark, (10, "x"), (12, "x")))
    assert rows(within) == [(10,), (11,), (12,)]
    assert "GreaterThanOrEqual(k,10)" in within._jdf.queryExecution().executedPlan().toString()


def test_key_index_is_not_shuffled(spark, tmp_path):
    target = VersionedTarget(KEYED, str(tmp_path / "t"), buckets=4)
    load_frame(spark, batch(spark, *[(i, "a") for i in range(50)]), KEYED, target)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = anti_existing(batch(spark, *[(i, "b") for i in range(40, 60)]), target.keys(spark), ("k",))
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert rows(new) == [(i, "b") for i in range(50, 60)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_index_left_behind_is_caught_up(spark, tmp_path):
    target = VersionedTarget(KEYED, str(tmp_path / "t"), buckets=4)
    load_frame(spark, batch(spark, (1, "a")), KEYED, target)
    VersionedTarget(KEYED, target.path).publish(spark, target.append(batch(spark, (2, "b"))), None, {})  # died before its index
    assert load_frame(spark, batch(spark, (1, "x"), (2, "x"), (3, "x")), KEYED, target).written == 1
    target.publish(spark, target.overwrite(batch(spark, (7, "z"))), None, {})
    assert rows(target.keys(spark)) == [(7,)]


def test_index_needs_plain_keys():
    with pytest.raises(ValueError):
        VersionedTarget(LOG, "x", buckets=2)
    with pytest.raises(ValueError):
        VersionedTarget(replace(KEYED, key_collation="UTF8_LCASE"), "x", buckets=2)


def test_run_ids_need_a_ledger(spark, tmp_path):
    from martsmith.sinks import ParquetTarget

    with pytest.raises(ValueError):
        load_frame(spark, batch(spark, (1, "a")), KEYED, ParquetTarget(KEYED, str(tmp_path / "p")), run_id="r")


def test_stream_into_a_log(spark, tmp_path):
    """A micro-batch that the stream replays adds nothing; new files do."""
    source, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")
    target = VersionedTarget(LOG, str(tmp_path / "log"))
    batch(spark, (1, "a"), (1, "a")).coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema
    incremental_load(spark, source, schema, LOG, target, checkpoint_location=ckpt)
    for name in (tmp_path / "ckpt/commits").iterdir():  # as if the driver had died before the commit
        if name.name.strip(".").startswith("0"):
            name.unlink()
    reports = incremental_load(spark, source, schema, LOG, target, checkpoint_location=ckpt)
    assert [r.replayed for r in reports] == [True]
    batch(spark, (2, "b")).coalesce(1).write.mode("append").parquet(source)
    incremental_load(spark, source, schema, LOG, target, checkpoint_location=ckpt)
    assert rows(target.read(spark).drop("id")) == [(1, "a"), (1, "a"), (2, "b")]


def test_merge_statements():
    own = 'INSERT INTO T ("k", "v") SELECT s."k", s."v" FROM S s WHERE NOT EXISTS (SELECT 1 FROM S d WHERE d."load_place" = s."load_place" AND d."load_attempt" < s."load_attempt")'
    keyed = ' AND NOT EXISTS (SELECT 1 FROM T t WHERE t."k" = s."k")'
    assert merge_sql(replace(LOG, mode="append"), "T", "S", ("k", "v"), '"') == own
    assert merge_sql(KEYED, "T", "S", ("k", "v"), '"', "derby") == own + keyed
    assert merge_sql(KEYED, "T", "S", ("k", "v"), '"', "postgresql") == own + keyed + " ON CONFLICT DO NOTHING"
    assert merge_sql(KEYED, "T", "S", ("k", "v"), "`", "mysql") == "INSERT IGNORE" + (own + keyed)[6:].replace('"', "`")
    assert ledger_ddl("d.runs").startswith("CREATE TABLE d.runs (TARGET_NAME")
    assert unique_key_ddl(KEYED, "T") == "ALTER TABLE T ADD CONSTRAINT uk_t_k UNIQUE (`k`)"


def jdbc(spec, partitions=None):
    return JdbcTarget(spec, f"jdbc:derby:memory:v{uuid.uuid4().hex[:8]};create=true", "T", DERBY, num_partitions=partitions)


def test_a_partition_written_twice_counts_once(spark):
    """A staging table in which one task's rows stand twice, as after a retry of a committed task."""
    for spec in (KEYED, LOOSE, replace(LOG, surrogate=None, columns=LOG.columns[1:])):
        target = jdbc(spec)
        target.create_if_missing(spark)
        staged = target.append(batch(spark, (1, "a"), (2, "b"), (None if spec is not KEYED else 3, "c")).repartition(2))
        copy = spark.read.format("jdbc").options(url=target.url, dbtable=staged.table, **DERBY).load()
        again = [tuple(r) for r in copy.selectExpr("k", "v", PLACE, f"concat('~', substr({ATTEMPT}, 2)) AS {ATTEMPT}").collect()]
        spark.createDataFrame(again, copy.schema).write.format("jdbc").options(url=target.url, dbtable=staged.table, **DERBY).mode("append").save()
        target.publish(spark, staged, "r1", {"mart": "t", "mode": spec.mode})
        assert rows(target.read(spark)) == rows(batch(spark, (1, "a"), (2, "b"), (None if spec is not KEYED else 3, "c")))


def test_jdbc_runs_count_once(spark):
    target = jdbc(LOG, 2)
    first = load_frame(spark, batch(spark, (1, "a"), (1, "a")), LOG, target, run_id="r1")
    assert load_frame(spark, batch(spark, (2, "b")), LOG, target, run_id="r1") == replace(first, replayed=True)
    load_frame(spark, batch(spark, (2, "b")), LOG, target, run_id="r2")
    assert rows(target.read(spark)) == [(1, 1, "a"), (2, 1, "a"), (3, 2, "b")]
    with target._connected(spark) as connection:
        left = connection.getMetaData().getTables(None, None, "T%LOAD%", None)
        assert not left.next() and target._found(connection, LEDGER)
    # a second publisher of the run fails as a whole: no row of it comes in
    staged = target.append(spark.createDataFrame([(9, 9, "z")], "id long, k long, v string"))
    with pytest.raises(Exception):  # noqa: B017
        target.publish(spark, staged, "r2", {})
    assert target.read(spark).count() == 3
    assert json.loads(json.dumps(target.find_run(spark, "r2")))["written"] == 1


def test_jdbc_refresh_is_one_transaction(spark):
    spec = replace(KEYED, mode="full_refresh")
    target = jdbc(spec)
    load_frame(spark, batch(spark, (1, "old")), spec, target)
    staged = target.overwrite(batch(spark, (2, "new")))
    assert rows(target.read(spark)) == [(1, "old")]
    broken = StagedLoad(staged.table, ("k", "nowhere"), True)
    with pytest.raises(Exception):  # noqa: B017
        target.publish(spark, broken, None, {})
    assert rows(target.read(spark)) == [(1, "old")]  # the deletion was rolled back
    staged = target.overwrite(batch(spark, (2, "new")))
    target.publish(spark, staged, None, {})
    assert rows(target.read(spark)) == [(2, "new")]


def test_jdbc_slices_and_late_key(spark):
    spec = replace(KEYED, columns=(("K", "bigint"), ("V", "varchar(5)")), key=("K",), not_null=("K",))
    target = jdbc(spec, 3)
    # a table whose creator died before its key
    replace_key = JdbcTarget(replace(spec, key=()), target.url, "T", DERBY)
    replace_key.create_if_missing(spark)
    with target._connected(spark) as connection:
        assert not target._has_key(connection)
    load_frame(spark, spark.createDataFrame([(i, "a") for i in range(30)], "K long, V string"), spec, target)
    with target._connected(spark) as connection:
        assert target._has_key(connection)
    assert target.slice_column() == "K" and target.read(spark).rdd.getNumPartitions() == 3
    assert JdbcTarget(replace(spec, columns=(("K", "text"),)), "u", "T").slice_column() is None
