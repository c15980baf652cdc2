"""JDBC round trip against embedded in-memory Derby (ships with Spark; no server, no port)."""

from __future__ import annotations

import uuid

from martsmith.schemas import TargetSpec
from martsmith.plans.runner import load_frame
from martsmith.sinks import JdbcTarget
from martsmith.sources.registry import JdbcTable

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _url() -> str:
    return f"jdbc:derby:memory:ms{uuid.uuid4().hex[:8]};create=true"


def test_partitioned_read(spark):
    url = _url()
    src = spark.range(0, 100).selectExpr("CAST(id AS INT) AS ID", "CAST(id * 2 AS INT) AS V")
    src.write.format("jdbc").options(url=url, dbtable="SRC", **DRIVER).mode("overwrite").save()
    t = JdbcTable(url, "SRC", properties=DRIVER, partition_column="ID", lower_bound=0, upper_bound=100,
                  num_partitions=4)
    df = t.read(spark)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 100
    plan = df.where("V > 10").select("ID")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(V,10)" in plan


def test_insert_ignore_and_refresh_into_jdbc(spark):
    url = _url()
    spec = TargetSpec("t", (("ID", "int"), ("K", "int"), ("V", "int")), surrogate="ID", key=("K",),
                      mode="insert_ignore")
    target = JdbcTarget(spec, url, "TGT", properties=DRIVER)
    batch = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "K int, V int")
    r1 = load_frame(spark, batch, spec, target)
    r2 = load_frame(spark, batch, spec, target)
    assert (r1.written, r1.deduped_in_batch) == (2, 1)
    assert (r2.written, r2.already_present) == (0, 2)
    got = sorted(tuple(r) for r in target.read(spark).select("ID", "K", "V").collect())
    assert got == [(1, 1, 10), (2, 2, 20)]

    refresh = TargetSpec("t", spec.columns, surrogate="ID", key=("K",), mode="full_refresh")
    rtarget = JdbcTarget(refresh, url, "TGT", properties=DRIVER)
    load_frame(spark, spark.createDataFrame([(3, 30)], "K int, V int"), refresh, rtarget)
    assert [tuple(r) for r in rtarget.read(spark).select("ID", "K", "V").collect()] == [(1, 3, 30)]
    rep = load_frame(spark, spark.createDataFrame([], "K int, V int"), refresh, rtarget)
    assert rep.skipped_empty and rtarget.read(spark).count() == 1


def test_bank_mart_over_jdbc_schemas(spark):
    """The operational tables behind one JDBC server in several schemas (``jdbc_registry``)."""
    from martsmith.plans.runner import mart_rows
    from martsmith.sources import jdbc_registry
    from martsmith.sources.standins import standin_registry
    from tests.conftest import SF0001, rows

    url = _url()
    src = standin_registry(spark, SF0001)
    for name, schema in (("accounts.users", "ACC"), ("admin.user_bank_infos", "ADM")):
        table = name.split(".")[1]
        (src[name].write.format("jdbc").options(url=url, dbtable=f"{schema}.{table}", **DRIVER)
         .mode("overwrite").save())
    reg = jdbc_registry(spark, url, {"accounts": "ACC", "admin": "ADM", "wallet": "WAL"}, DRIVER,
                        partitioning={"accounts.users": ("id", 0, 200, 3)})
    assert reg["accounts.users"].rdd.getNumPartitions() == 3
    assert rows(mart_rows(reg, "bank")) == rows(mart_rows(src, "bank"))


def test_equal_depth_slices_of_gapped_ids(spark):
    """Ids in three clusters far apart: even slices would leave most tasks empty and fill one."""
    url = _url()
    ids = [*range(1000), *range(10**9, 10**9 + 3000), *range(10**12, 10**12 + 50)]
    spark.createDataFrame([(i, i % 7) for i in ids], "ID long, V int").write.format("jdbc").options(url=url, dbtable="SRC", **DRIVER).save()
    even = JdbcTable(url, "SRC", DRIVER, "ID", num_partitions=8).read(spark)
    deep = JdbcTable(url, "SRC", DRIVER, "id", num_partitions=8, slices="depth").read(spark)

    def sizes(df):
        return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()

    assert sorted(r.ID for r in deep.collect()) == sorted(ids)
    assert deep.rdd.getNumPartitions() == 8 and max(sizes(deep)) < 2 * len(ids) / 8 < max(sizes(even))


def test_equal_depth_boundaries():
    import random

    from martsmith.sources.registry import equal_depth, hash_predicates, range_predicates

    def counter(values):
        def count(low, width, cells):
            out = {}
            for v in values:
                if low <= v < low + width * cells:
                    out[(v - low) // width] = out.get((v - low) // width, 0) + 1
            return out
        return count

    r = random.Random(1)
    for values in ([int(r.lognormvariate(10, 3)) for _ in range(4000)], list(range(50)), [7], [7] * 30 + [8], [-5, 0, 5]):
        bounds = equal_depth(min(values), max(values), 6, counter(values))
        edges = [min(values), *bounds, max(values) + 1]
        depth = [sum(a <= v < b for v in values) for a, b in zip(edges, edges[1:])]
        hot = max(values.count(v) for v in set(values))
        assert sum(depth) == len(values) and bounds == sorted(set(bounds)) and len(bounds) <= 5
        assert max(depth) <= max(2 * len(values) / 6, hot + len(values) / 6, 1)
    assert range_predicates("c", []) == ["1 = 1"]
    assert range_predicates("c", [3, 9]) == ["c < 3 OR c IS NULL", "c >= 3 AND c < 9", "c >= 9"]
    assert hash_predicates(["`a`"], 2, "mysql") == [f"MOD(CRC32(CONCAT_WS('|', COALESCE(CAST(`a` AS CHAR), ''))), 2) = {k}" for k in (0, 1)]
    assert "hashtext" in hash_predicates(["a", "b"], 2, "postgresql")[0]
