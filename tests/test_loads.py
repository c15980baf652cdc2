"""Load-mode properties on the stand-in tables, and the incremental (streaming) load."""

from __future__ import annotations

from pyspark.sql import functions as F

from martsmith import TARGETS
from martsmith.plans import MARTS, load_mart, mart_rows
from martsmith.schemas import TargetSpec
from martsmith.sinks import ParquetTarget
from martsmith.sources.standins import standin_registry
from martsmith.streaming import incremental_load
from tests.conftest import SF0001, rows


def test_insert_ignore_twice_equals_once(spark, tmp_path):
    src = standin_registry(spark, SF0001)
    target = ParquetTarget(TARGETS["campaign"], str(tmp_path / "campaign"))
    r1 = load_mart(spark, src, "campaign", target)
    snapshot = rows(target.read(spark))
    r2 = load_mart(spark, standin_registry(spark, SF0001), "campaign", target)
    assert r2.written == 0 and rows(target.read(spark)) == snapshot
    for r in (r1, r2):
        assert r.read == r.written + r.deduped_in_batch + r.already_present
    ids = [x.id for x in target.read(spark).select("id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    keys = target.read(spark).groupBy("campaign_id").count().where("count > 1").count()
    assert keys == 0


def test_existing_rows_never_change(spark, tmp_path):
    spec = TargetSpec("r", (("id", "bigint"), ("v", "varchar(5)")), key=("id",))
    target = ParquetTarget(spec, str(tmp_path / "r"))
    from martsmith.plans.runner import load_frame

    load_frame(spark, spark.createDataFrame([(1, "old")], "id long, v string"), spec, target)
    load_frame(spark, spark.createDataFrame([(1, "new"), (2, "new")], "id long, v string"), spec, target)
    assert rows(target.read(spark)) == [(1, "old"), (2, "new")]


def test_full_refresh_ignores_prior_content(spark, tmp_path):
    src = standin_registry(spark, SF0001)
    target = ParquetTarget(TARGETS["issuer_onboardings"], str(tmp_path / "issuer"))
    spark.createDataFrame([], TARGETS["issuer_onboardings"].schema).write.parquet(target.path)
    load_mart(spark, src, "issuer_onboardings", target)
    first = rows(target.read(spark).drop("id"))
    load_mart(spark, standin_registry(spark, SF0001), "issuer_onboardings", target)
    assert rows(target.read(spark).drop("id")) == first
    assert rows(mart_rows(standin_registry(spark, SF0001), "issuer_onboardings")) == first


def test_append_doubles_with_unique_ids(spark, tmp_path):
    src = standin_registry(spark, SF0001)
    target = ParquetTarget(TARGETS["users"], str(tmp_path / "users"))
    n = load_mart(spark, src, "users", target).written
    load_mart(spark, standin_registry(spark, SF0001), "users", target)
    t = target.read(spark)
    assert t.count() == 2 * n
    assert t.select("id").distinct().count() == 2 * n
    assert t.agg(F.max("id")).first()[0] == 2 * n


def test_incremental_insert_ignore(spark, tmp_path):
    """Two runs over a growing folder: the second run only reads the new file, and the target
    equals a one-shot load of everything."""
    orders = spark.read.parquet(f"{SF0001}/orders.parquet")
    landing = tmp_path / "landing"
    orders.where("o_orderstatus = 'F'").write.parquet(str(landing / "part1"))
    spec = MARTS["referrals"].target
    target = ParquetTarget(spec, str(tmp_path / "referrals"))
    ckpt = str(tmp_path / "stream-ckpt")

    def to_query(batch):
        return batch.selectExpr(
            "o_orderkey AS id", "o_custkey AS referred_user_id", "o_orderkey div 4 AS campaign_id",
            "o_totalprice AS commission_amount", "CAST(o_custkey % 40 AS DOUBLE) / 4 AS commission_percentage",
            "CAST(o_custkey % 50 AS INT) AS referral_user_id", "o_orderstatus AS status",
            "o_orderdate AS created_at", "o_orderdate AS updated_at",
        )

    src_glob = str(landing / "*")
    r1 = incremental_load(spark, src_glob, orders.schema, spec, target, to_query, ckpt)
    n1 = target.read(spark).count()
    orders.write.parquet(str(landing / "part2"))  # everything again, incl. the 'F' rows
    r2 = incremental_load(spark, src_glob, orders.schema, spec, target, to_query, ckpt)
    assert sum(r.read for r in r1) == n1
    assert sum(r.already_present for r in r2) == n1
    assert rows(target.read(spark)) == rows(mart_rows(standin_registry(spark, SF0001), "referrals"))


def test_parquet_export_registry_and_cli(spark, tmp_path):
    """Operational tables exported as <root>/<schema>/<table> load like the stand-ins."""
    from martsmith.__main__ import main
    from martsmith.sources import STANDINS, parquet_registry

    src = standin_registry(spark, SF0001)
    root = tmp_path / "exports"
    for name in ("admin.referral_transactions", "accounts.users", "admin.user_bank_infos"):
        schema, table = name.split(".")
        src[name].write.parquet(str(root / schema / table))
    reg = parquet_registry(spark, str(root))
    assert rows(mart_rows(reg, "bank")) == rows(mart_rows(src, "bank"))
    assert main(["--sources", str(root), "--targets", str(tmp_path / "marts"), "--mart", "referrals"]) == 0
    out = spark.read.parquet(str(tmp_path / "marts" / "referrals"))
    assert rows(out) == rows(mart_rows(src, "referrals"))
    assert "admin.referral_transactions" in STANDINS


def test_scale_conf_sizes_partitions():
    from martsmith.session import scale_conf

    conf = scale_conf(2 * 10**12)
    assert int(conf["spark.sql.shuffle.partitions"]) * 256 * 1024 * 1024 >= 2 * 10**12
    assert scale_conf(100 * 10**12)["spark.sql.shuffle.partitions"] == "20000"  # what a driver can keep track of
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "200"


def test_load_all_runs_every_requested_mart(spark, tmp_path):
    from martsmith.plans import load_all

    names = ["referrals", "bank"]
    targets = {n: ParquetTarget(MARTS[n].target, str(tmp_path / n)) for n in names}
    reports = load_all(spark, standin_registry(spark, SF0001), targets, names)
    assert [r.mart for r in reports] == names
    for r in reports:
        assert r.written == targets[r.mart].read(spark).count() > 0


def test_failed_refresh_leaves_the_old_content(spark, tmp_path):
    import pytest

    spec = TargetSpec("r", (("id", "bigint"), ("v", "varchar(5)")), mode="full_refresh")
    target = ParquetTarget(spec, str(tmp_path / "r"))
    target.create_if_missing(spark)
    target.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    before = rows(target.read(spark))
    bad = spark.range(100).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("v"))
    with pytest.raises(Exception, match="no"):
        target.overwrite(bad)
    assert rows(target.read(spark)) == before == [(1, "a"), (2, "b")]
    (tmp_path / "r").rename(tmp_path / "r.old-1")  # died between the two renames
    assert rows(target.read(spark)) == before


def test_replay_unsafe_targets_are_refused(spark):
    import pytest

    for spec in (TARGETS["users"], TARGETS["wallet_withdraw_funds"], TARGETS["wallet_add_funds"]):
        with pytest.raises(ValueError, match="NOT NULL key"):
            incremental_load(spark, "nowhere", spec.schema, spec, None)


def test_ids_that_do_not_fit_are_refused_before_the_write(spark):
    import pytest
    from martsmith.operators.surrogate import assign_surrogate_ids

    with pytest.raises(ValueError, match="do not fit int"):
        assign_surrogate_ids(spark.range(5), (), "row_id", 2**31 - 4)


def test_loads_leave_no_staged_tables(spark, tmp_path):
    import os
    from martsmith.session import scratch_path

    folder = scratch_path(spark, "").removeprefix("file:")
    held = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    for name in ("campaign", "wallet_withdraw_funds"):
        target = ParquetTarget(TARGETS[name], str(tmp_path / name))
        for _ in range(2):
            load_mart(spark, standin_registry(spark, SF0001), name, target)
    assert set(os.listdir(folder)) <= held


def test_null_keys_enter_no_exchange(spark):
    from martsmith.operators.dedup import first_wins

    df = spark.read.parquet(f"{SF0001}/orders.parquet").select(F.col("o_custkey").alias("k"), "o_orderkey")
    plan = first_wins(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    shuffled, beside = plan.split("PushedFilters: [IsNotNull(o_custkey)]")
    assert plan.count("Exchange") == 1 and "Exchange" in shuffled
    assert "PushedFilters: [IsNull(o_custkey)]" in beside and "Exchange" not in beside


def test_ddl_of_a_jdbc_target():
    from martsmith.sinks.targets import column_types, unique_key_ddl

    spec = TargetSpec("r", (("id", "bigint"), ("v", "varchar(5)"), ("w", "varchar(255)")), key=("id", "v"))
    assert column_types(spec) == "`v` VARCHAR(5), `w` VARCHAR(255)"
    assert unique_key_ddl(spec, "db.r") == "ALTER TABLE db.r ADD CONSTRAINT uk_r_id_v UNIQUE (`id`, `v`)"


def test_command_line_of_a_database_run():
    from martsmith.__main__ import parser, sources_of, target_of
    from martsmith.sinks import JdbcTarget

    args = parser().parse_args(["--jdbc-url", "jdbc:x://a", "--jdbc-database", "accounts=acc", "--jdbc-property", "password=p=q",
                                "--num-partitions", "8", "--target-jdbc-url", "jdbc:x://b", "--target-database", "reports",
                                "--target-jdbc-property", "user=u"])
    src = sources_of(args, None)
    users, links = src._defs["accounts.users"], src._defs["wallet.fund_users"]
    assert (users.dbtable, users.partition_column, users.num_partitions, users.properties) == ("acc.users", "id", 8, {"password": "p=q"})
    assert links.dbtable == "wallet.fund_users" and links.partition_column is None
    target = target_of(args, "bank")
    assert isinstance(target, JdbcTarget) and target.dbtable == f"reports.{MARTS['bank'].target.name}"
    assert target._opts()["numPartitions"] == "8" and target._opts()["user"] == "u"


def test_no_standin_column_is_constant_null(spark):
    from martsmith.sources.standins import STANDINS

    src = standin_registry(spark, SF0001)
    for name in STANDINS:
        t = src[name]
        counts = t.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in t.columns]).first()
        assert all(counts), (name, [c for c in t.columns if not counts[c]])
