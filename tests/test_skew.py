"""Skew: one key (or NULL) holding a third of all rows must not land in one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martsmith.operators.dedup import arrival_order, first_wins
from martsmith.operators.joins import skew_safe_left_join
from martsmith.operators.surrogate import stage
from tests.conftest import SF001


def _skewed_lineitem(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    # a third of the rows share one key value
    return li.withColumn("hot", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))


def test_hot_arrival_value_is_split_across_sort_partitions(spark):
    """The id sort ranges over the whole composite order, so a hot leading value is cut by the
    tie-break columns: no sort partition gets the third of the rows that share it."""
    # at this size AQE would rightly merge all range partitions into one or two
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _skewed_lineitem(spark)
        n = df.count()
        ordered = df.orderBy(*arrival_order(df, ["hot"]))
        stamped = stage(ordered.withColumn("__mid", F.monotonically_increasing_id()), "skew-test")
        sizes = [r["n"] for r in stamped.groupBy(F.shiftright("__mid", 33).alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = df.where("hot = 0").count()
    assert hot > n / 4
    assert len(sizes) > 2 and max(sizes) < hot / 2


def test_hot_key_first_wins_is_pre_reduced(spark):
    df = _skewed_lineitem(spark)
    out = first_wins(df, ["hot", "l_linenumber"], ["l_shipdate"])
    expected = df.select("hot", "l_linenumber").distinct().count()
    assert out.count() == expected
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_null_heavy_outer_join_keeps_nulls_out_of_the_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li = spark.read.parquet(f"{SF001}/lineitem.parquet")
        fact = li.select(
            F.when(F.col("l_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("l_orderkey")).alias("k"),
            "l_linenumber",
        )
        dim = spark.read.parquet(f"{SF001}/orders.parquet").select(
            F.col("o_orderkey").alias("ok"), "o_orderstatus")
        out = skew_safe_left_join(fact, dim, "k", "ok", max_broadcast_bytes=0)
        assert out.count() == fact.count()
        assert out.where("k IS NULL AND o_orderstatus IS NULL").count() == fact.where("k IS NULL").count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        no_nulls = skew_safe_left_join(fact.where("k IS NOT NULL"), dim, "k", "ok", max_broadcast_bytes=0)
        base = no_nulls._jdf.queryExecution().executedPlan().toString()
        # the NULL-key rows add a filtered scan and no exchange at all
        assert plan.count("Exchange") == base.count("Exchange")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("mart", ["bank", "users"])
def test_hot_key_stays_split_under_distinct(spark, mart):
    """A third of the fan-out side on one key: the final adaptive plan splits the join although a
    DISTINCT follows, and the rows equal those of the broadcast form."""
    from martsmith.plans.jobs import bank_query, users_query
    from martsmith.sources.standins import standin_registry
    from tests.conftest import SF0001

    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    src = standin_registry(spark, SF0001)
    hot = src["accounts.users"].agg(F.min("id")).first()[0]
    if mart == "bank":
        table, key, query = "admin.user_bank_infos", "user_id", bank_query
    else:
        table, key, query = "accounts.kyc_infos", "namescan_id", users_query
    skewed = src[table]
    value = F.lit(hot).cast(skewed.schema[key].dataType)
    copies = skewed.withColumn(key, value).withColumn("copy", F.explode(F.array_repeat(F.lit(0), 60))).drop("copy")
    src.register(table, skewed.unionAll(copies).repartition(8).persist())  # several map outputs, for AQE to split between
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        split = query(src, strategy="split")
        rows = sorted(map(str, split.collect()))
        final = split._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "skew=true" in final
        assert rows == sorted(map(str, query(src, strategy="broadcast").collect()))
    finally:
        for k in low:
            spark.conf.unset(k)


def test_session_broadcast_bound(spark):
    from martsmith.plans.jobs import campaign_query
    from martsmith.sources.standins import standin_registry
    from tests.conftest import SF0001

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.conf.set("martsmith.broadcastMaxBytes", "0")
        plan = campaign_query(standin_registry(spark, SF0001))._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan
        spark.conf.unset("martsmith.broadcastMaxBytes")
        plan = campaign_query(standin_registry(spark, SF0001))._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset("martsmith.broadcastMaxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
