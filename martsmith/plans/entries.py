"""Checkable queries: one per operator / mart, each ``(spark, sf_dir) -> DataFrame``.

Every entry reads whole test tables (through the stand-ins) and has an
independent DuckDB SQL twin in ``martsmith.plans.oracles``. Load modes are
checked through their pure planning half (existing, incoming -> table content)
so that no entry writes anywhere, except the surrogate id step, which
stages its sorted input under the session's checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martsmith.functions.scalar import (
    PAYMENT_TYPE_LABELS,
    decode_codes,
    full_name,
    json_fields,
    nan_to_null,
)
from martsmith.operators.conform import conform, convert
from martsmith.operators.dedup import (
    distinct_fingerprinted,
    distinct_rows,
    distinct_spellings,
    distinct_stored_rows,
    fingerprinted,
    first_wins,
)
from martsmith.operators.joins import checked_broadcast, skew_safe_left_join, typed_key
from martsmith.operators.loadplan import (
    guarded_refresh_content,
    insert_ignore_report,
    plan_insert_ignore,
)
from martsmith.operators.surrogate import assign_surrogate_ids, max_id, stage
from martsmith.plans.jobs import KYC_JSON_PATHS, MARTS
from martsmith.plans.runner import load_mart, mart_rows
from martsmith.schemas import REFERRALS, TargetSpec, spark_type
from martsmith.session import task_session
from martsmith.sources.standins import standin_registry

Query = Callable[[SparkSession, str], DataFrame]

c = F.col


def _src(spark: SparkSession, sf_dir: str):
    return standin_registry(spark, sf_dir)


def _mart(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mart_rows(_src(spark, sf_dir), name)
    run.__name__ = f"{name}_rows"
    return run


def reserved_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4/5: a column named ``order`` and a quoted alias, read through Spark SQL
    (the frame is passed as a query parameter, no session-wide view)."""
    return spark.sql(
        "SELECT c.id AS campaign_id, c.`order`, c.status AS `on_boarding_status` "
        "FROM {cm} AS c WHERE c.id IS NOT NULL",
        cm=_src(spark, sf_dir)["admin.campaign_masters"],
    )


def bridge_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-07/08: users -> user_types (bridge) -> types, the bridge pre-joined to its dimension."""
    src = _src(spark, sf_dir)
    bt = (
        src["accounts.user_types"].alias("b")
        .join(checked_broadcast(src["accounts.types"]).alias("t"), c("b.type_id") == c("t.id"), "left")
        .select(c("b.user_id").alias("bt_user_id"), c("b.type_id"), c("t.type").alias("user_type"))
    )
    u = src["accounts.users"].select(c("id").alias("user_id"))
    return skew_safe_left_join(u, bt, "user_id", "bt_user_id").select("user_id", "type_id", "user_type")


def orphan_fact_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-17 / FLT-2: users RIGHT JOIN withdraw_funds - every withdrawal kept, orphans get NULL user."""
    src = _src(spark, sf_dir)
    u = src["accounts.users"].select(c("id").alias("user_id"))
    w = src["wallet.withdraw_funds"].select(
        c("user_id").alias("w_user_id"), c("amount"), c("bank"), c("created_at")
    )
    return skew_safe_left_join(w, u, "w_user_id", "user_id").select(
        "user_id", "w_user_id", "amount", "bank", "created_at"
    )


def typed_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-T: integer user id = text ``namescan_id``; non-numeric text matches nothing."""
    src = _src(spark, sf_dir)
    u = src["accounts.users"].where(c("id").isNotNull()).select(c("id").alias("user_id"))
    k = src["accounts.kyc_infos"].select(
        c("id").alias("kyc_id"), c("namescan_id"), typed_key(c("namescan_id")).alias("k_user")
    )
    return skew_safe_left_join(u, k, "user_id", "k_user", "split").select("user_id", "kyc_id", "namescan_id")


_TOP_PATHS = {k: v for k, v in KYC_JSON_PATHS.items() if "[" not in v}
_ARRAY_PATHS = {k: v for k, v in KYC_JSON_PATHS.items() if "[" in v}


def _kyc_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _src(spark, sf_dir)["accounts.kyc_infos"].select(c("id").alias("kyc_id"), c("maala_data"))


def json_fields_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-2/4: eleven top-level paths of the KYC document, one tokenisation per row."""
    return json_fields(_kyc_docs(spark, sf_dir), "maala_data", _TOP_PATHS)


def json_array_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-3: ``$.PassportList[0].Key`` paths; empty list, malformed or missing -> NULL."""
    return json_fields(_kyc_docs(spark, sf_dir), "maala_data", _ARRAY_PATHS)


def json_null_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-4 option: a JSON ``null`` value read as the string 'null'."""
    paths = {"Malaa_Name2": "$.Name_2_En", "Malaa_Passport_Number": KYC_JSON_PATHS["Malaa_Passport_Number"]}
    return json_fields(_kyc_docs(spark, sf_dir), "maala_data", paths, json_null="literal")


def full_name_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-1: ``CONCAT(first, ' ', last)``, NULL when a part is NULL."""
    u = _src(spark, sf_dir)["accounts.users"]
    return u.select(c("id").alias("user_id"), c("first_name"), c("last_name"),
                    full_name("first_name", "last_name").alias("full_name"))


def decode_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-5/6: payment type 1 -> Bank, 2 -> Credit/Debit, anything else -> NULL."""
    a = _src(spark, sf_dir)["wallet.add_funds"]
    return a.select(
        c("transaction_id"), c("payment_type"),
        decode_codes(c("payment_type"), PAYMENT_TYPE_LABELS).alias("payment_label"),
    )


def nan_to_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-7: NaN -> NULL; +-Infinity and ordinary values unchanged."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    raw = li.select(
        c("l_orderkey"), c("l_linenumber"),
        F.when(c("l_discount") == 0, F.lit(float("nan"))).otherwise(c("l_discount")).alias("discount"),
        F.when(c("l_tax") == 0, F.lit(float("inf")))
        .when(c("l_tax") == 0.08, F.lit(float("-inf"))).otherwise(c("l_tax")).alias("tax"),
    )
    return raw.select("l_orderkey", "l_linenumber",
                      nan_to_null("discount").alias("discount"), nan_to_null("tax").alias("tax"))


def distinct_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DST-4: distinct market segments with mixed case, binary vs case-insensitive."""
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    seg = cust.select(
        F.when(c("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(c("c_mktsegment")).alias("segment")
    )
    binary = distinct_rows(seg).agg(F.count(F.lit(1)).alias("n_distinct")) \
        .select(F.lit("binary").alias("collation"), "n_distinct")
    folded = distinct_rows(seg, "UTF8_LCASE").agg(F.count(F.lit(1)).alias("n_distinct")) \
        .select(F.lit("UTF8_LCASE").alias("collation"), "n_distinct")
    return binary.unionByName(folded)


def _probe_field(name: str, sql: str) -> T.StructField:
    dt, n = spark_type(sql)
    return T.StructField(name, dt, True, {"varchar_length": n} if n else {})


def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-8: VARCHAR cut, decimal and integer clamp, bad date -> NULL, label into BIGINT
    -> NULL (``on_bad_cast='null'``) or 0 (``'zero'``)."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    raw = o.select(
        c("o_orderkey"),
        c("o_orderpriority").alias("title"),
        c("o_totalprice").alias("amount"),
        (c("o_totalprice") * 100000).alias("big"),
        F.when(c("o_orderstatus") == "F", F.lit("2024-13-01"))
        .otherwise(c("o_orderdate").cast("date").cast("string")).alias("day"),
        F.when(c("o_orderkey") % 3 == 0, F.lit("Bank"))
        .otherwise((c("o_orderkey") % 3).cast("string")).alias("code"),
    )
    types = {f.name: f.dataType for f in raw.schema.fields}

    def conv(col: str, sql: str, mode: str = "null"):
        return convert(c(col), types[col], _probe_field(col, sql), mode)[0]

    return raw.select(
        c("o_orderkey"),
        conv("title", "varchar(5)").alias("title"),
        conv("amount", "decimal(5,2)").alias("amount"),
        conv("big", "int").alias("big"),
        conv("day", "date").alias("day"),
        conv("code", "bigint").alias("code"),
        conv("code", "bigint", "zero").alias("code_zero"),
    )


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


_LI_KEY = ("l_orderkey", "l_linenumber")


def insert_ignore_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 in batch: first row per (l_orderkey, l_linenumber) by ship date, then all columns."""
    return first_wins(_lineitem(spark, sf_dir), _LI_KEY, ["l_shipdate"])


def insert_ignore_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 against a target: an earlier load of the 'F' lines, then all lines. Old rows stay
    as they are; only unseen keys are added."""
    li = _lineitem(spark, sf_dir)
    existing = plan_insert_ignore(None, li.where(c("l_linestatus") == "F"), _LI_KEY, ["l_shipdate"])
    new = plan_insert_ignore(existing, li, _LI_KEY, ["l_shipdate"])
    return existing.withColumn("load_no", F.lit(1)).unionByName(new.withColumn("load_no", F.lit(2)))


def insert_ignore_nullable_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: withdrawals keyed by a nullable bank id, loaded twice. NULL keys never
    collide, so those rows come in again on the second load."""
    w = _src(spark, sf_dir)["wallet.withdraw_funds"].select(
        c("user_id"), c("amount"), c("bank"), c("created_at"), c("payment_type")
    )
    first = plan_insert_ignore(None, w, ["bank"], ["user_id"])
    second = plan_insert_ignore(first, w, ["bank"], ["user_id"])
    return first.withColumn("load_no", F.lit(1)).unionByName(second.withColumn("load_no", F.lit(2)))


def _distinct_staged(joined: DataFrame) -> DataFrame:
    """The DISTINCT of a mart whose rows are shuffled for the order of their ids anyway: the joined rows are stored and only
    their hashes enter an exchange, so the wide rows pass one exchange and not two."""
    return distinct_stored_rows(stage(joined, "joined"))


def _distinct_marked(joined: DataFrame) -> DataFrame:
    """The same for a load: the hashes are stored with the rows, so that what is shuffled and what the ids need is read without them."""
    return distinct_fingerprinted(stage(fingerprinted(joined), "joined"), lambda rows: stage(rows, "repeated"))


def append_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4 + SNK-7: the keyless users mart appended twice; ids continue after the first load."""
    rows = mart_rows(_src(spark, sf_dir), "users", distinct=_distinct_staged)
    first = assign_surrogate_ids(rows, ["user_id"], "id", 0)
    twice = first.withColumn("load_no", F.explode(F.array(F.lit(1), F.lit(2))))  # the second load has the same order again
    return twice.withColumn("id", (c("id") + (c("load_no") - 1) * F.lit(max_id(first))).cast(first.schema["id"].dataType))


def _referral_rows(src, where=None) -> DataFrame:
    q = src["admin.referral_transactions"]
    if where is not None:
        q = q.where(where)
    q = q.where(c("id").isNotNull()).select(
        c("id"), c("investor_id").alias("referred_user_id"), c("campaign_id"),
        c("commission_amount"), c("commission_percentage"), c("ref_id").alias("referral_user_id"),
        c("status"), c("created_at"), c("updated_at"),
    )
    return conform(q, REFERRALS)


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5 + SRC-4: load A, refresh with B, then refresh with an empty batch -> B stays."""
    src = _src(spark, sf_dir)
    a = _referral_rows(src, c("status") == "F")
    b = _referral_rows(src)
    empty = _referral_rows(src, c("id").isNull())
    return guarded_refresh_content(guarded_refresh_content(a, b), empty)


def surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-7: dense ids above an existing maximum (1000), in transaction-date order."""
    rows = stage(mart_rows(_src(spark, sf_dir), "campaign_transactions"), "transactions")
    return assign_surrogate_ids(rows, ["transaction_date"], "row_id", 1000, "bigint")


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MET-1: the counts of ``insert_ignore_existing`` as one row."""
    li = _lineitem(spark, sf_dir)
    existing = plan_insert_ignore(None, li.where(c("l_linestatus") == "F"), _LI_KEY, ["l_shipdate"])
    return insert_ignore_report(existing, li, _LI_KEY, ["l_shipdate"])


def incremental_referrals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming: the referrals load run incrementally over the orders files
    (``availableNow`` file stream, each micro-batch an insert-ignore), then read back."""
    from martsmith.plans.jobs import referrals_query
    from martsmith.schemas import REFERRALS as spec
    from martsmith.session import scratch_path
    from martsmith.sinks import ParquetTarget
    from martsmith.sources.registry import SourceRegistry
    from martsmith.sources.standins import standin_frame
    from martsmith.streaming import incremental_load

    run = scratch_path(spark, f"incremental-referrals-{uuid.uuid4().hex[:12]}")
    target = ParquetTarget(spec, f"{run}/target")
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema

    def to_query(batch: DataFrame) -> DataFrame:
        rt = standin_frame(batch, "admin.referral_transactions")
        return referrals_query(SourceRegistry(spark, {"admin.referral_transactions": rt}))

    incremental_load(spark, f"{sf_dir.rstrip('/')}/orders.parque[t]", schema, spec, target, to_query,
                     checkpoint_location=f"{run}/stream", base_path=sf_dir)
    return target.read(spark)


def _split_mart(name: str) -> Query:
    """The mart with its fan-out joins in the form that runs at scale, whatever the size."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mart_rows(_src(spark, sf_dir), name, strategy="split")
    run.__name__ = f"{name}_split_rows"
    return run


def typed_key_decimal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-T: integer key = text such as ``'12.0'`` and ``'120e-1'``; a fraction or other text matches nothing."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    number = c("o_custkey").cast("string")
    case = c("o_orderkey") % 8
    text = o.select("o_orderkey", F.when(case == 0, F.concat(number, F.lit(".0"))).when(case == 1, F.concat(number, F.lit("0e-1")))
                    .when(case == 2, F.concat(number, F.lit(".5"))).when(case == 3, F.concat(number, F.lit("abc")))
                    .when(case == 4, F.concat(number, F.lit(".00000000001"))).when(case == 5, F.concat(number, F.lit(".000000000000")))
                    .when(case == 6, F.concat(F.lit("0.0000000000"), number)).otherwise(number).alias("key_text"))
    keyed = text.withColumn("o_key", typed_key(c("key_text")))
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    return skew_safe_left_join(cust, keyed, "c_custkey", "o_key", "split").select("c_custkey", "o_orderkey", "key_text")


def conform_text_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-8 on numeric text: one rounding, clamp of any width, numeric prefix, full dates only."""
    texts = ["0.00499999999995", "123456789012345678901234567890123", "-1e39", "12abc", " 12 ", "2024", "0.005"]
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", (c("o_orderkey") % 8).alias("case_no"))
    raw = o.withColumn("raw", F.coalesce(F.get(F.array(*map(F.lit, texts)), c("case_no").cast("int")),
                                         F.concat(c("o_orderkey").cast("string"), F.lit(".5"))))
    text = T.StringType()

    def conv(sql: str, mode: str = "null"):
        return convert(c("raw"), text, _probe_field("raw", sql), mode)[0]

    return raw.select("o_orderkey", "case_no", conv("decimal(18,2)").alias("amount"), conv("decimal(18,2)", "zero").alias("amount_zero"),
                      conv("int").alias("whole"), conv("date").alias("day"))


def _loads(spark: SparkSession, sf_dir: str, name: str, frames) -> tuple[DataFrame, list]:
    """Production loads of ``frames`` (functions of the registry) one after the other into a fresh
    target under the checkpoint folder: what the target holds then, and the reports."""
    from martsmith.plans.runner import load_frame
    from martsmith.session import scratch_path
    from martsmith.sinks import ParquetTarget

    spec = MARTS[name].target
    target = ParquetTarget(spec, scratch_path(spark, f"load-{name}-{uuid.uuid4().hex[:12]}"))
    src = _src(spark, sf_dir)
    reports = [load_frame(spark, frame(src), spec, target) for frame in frames]
    held = target.read(spark)
    return (held.drop(spec.surrogate) if spec.surrogate else held), reports


def _referrals(where: str = "true"):
    return lambda src: MARTS["referrals"].query(src).where(where)


def load_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2, SNK-6, SNK-10: referrals loaded in part, in full, and in full again."""
    return _loads(spark, sf_dir, "referrals", [_referrals("status = 'F'"), _referrals(), _referrals()])[0]


def load_nullable_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: withdrawals loaded twice; rows with a NULL key come in with each load."""
    return _loads(spark, sf_dir, "wallet_withdraw_funds", [MARTS["wallet_withdraw_funds"].query] * 2)[0]


def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4: the keyless users mart loaded twice."""
    return _loads(spark, sf_dir, "users", [lambda src: MARTS["users"].query(src, distinct=_distinct_marked)] * 2)[0]


def load_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5: a refresh with a part, then with all rows."""
    query = MARTS["issuer_onboardings"].query
    return _loads(spark, sf_dir, "issuer_onboardings", [lambda src: query(src).where("issuer_id % 2 = 0"), query])[0]


def load_empty_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4: a refresh with no rows leaves the target's content."""
    query = MARTS["wallet_add_funds"].query
    return _loads(spark, sf_dir, "wallet_add_funds", [query, lambda src: query(src).where("false")])[0]


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MET-1: the reports of ``load_insert_ignore``'s three loads."""
    reports = _loads(spark, sf_dir, "referrals", [_referrals("status = 'F'"), _referrals(), _referrals()])[1]
    return spark.createDataFrame(
        [(n, r.read, r.deduped_in_batch, r.already_present, r.written, r.skipped_empty) for n, r in enumerate(reports, 1)],
        "load_no int, read long, deduped_in_batch long, already_present long, written long, skipped_empty boolean")


def _versioned(spark: SparkSession, spec, name: str, buckets: int = 0):
    from martsmith.session import scratch_path
    from martsmith.sinks import VersionedTarget

    return VersionedTarget(spec, scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}"), buckets)


def insert_ignore_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 with a key index: referrals loaded in part, in full, and in full again; the anti joins read the bucketed keys."""
    from martsmith.plans.runner import load_frame

    spec = MARTS["referrals"].target
    target, src = _versioned(spark, spec, "indexed", buckets=8), _src(spark, sf_dir)
    for frame in (_referrals("status = 'F'"), _referrals(), _referrals()):
        load_frame(spark, frame(src), spec, target)
    return target.read(spark)


def _keyless_referrals():
    return replace(MARTS["referrals"].target, name="referral_log", key=(), mode="append")


def append_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4, SNK-10: a keyless log appended by run ``a``, ``a`` replayed, and run ``b``: two copies of each row."""
    from martsmith.plans.runner import load_frame

    spec = _keyless_referrals()
    target, src = _versioned(spark, spec, "append-once"), _src(spark, sf_dir)
    for run_id in ("a", "a", "b"):
        load_frame(spark, _referrals()(src), spec, target, run_id=run_id)
    return target.read(spark)


def nullable_key_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3, SNK-10: withdrawals loaded by run ``a``, replayed, and by run ``b``: NULL keys come in twice, not three times."""
    target, src = _versioned(spark, MARTS["wallet_withdraw_funds"].target, "withdraw-once"), _src(spark, sf_dir)
    for run_id in ("a", "a", "b"):
        load_mart(spark, src, "wallet_withdraw_funds", target, run_id=run_id)
    return target.read(spark).drop("id")


def refresh_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5: what a reader holds that came before a refresh, one between the refresh's write and its publication, and one after."""
    from martsmith.operators.conform import conform as conformed

    spec = replace(MARTS["referrals"].target, mode="full_refresh")
    target, src = _versioned(spark, spec, "refresh"), _src(spark, sf_dir)
    rows = conformed(_referrals()(src), spec)
    target.publish(spark, target.overwrite(rows), "whole", {})
    before = target.read(spark)
    written = target.overwrite(rows.where("status = 'F'"))
    between = target.read(spark)
    target.publish(spark, written, "part", {})
    frames = [(before, "before"), (between, "between"), (target.read(spark), "after")]
    return reduce(DataFrame.unionByName, [f.withColumn("reader", F.lit(n)) for f, n in frames])


def incremental_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming into a keyless log: each micro-batch is a run of the ledger, so that a replay adds nothing."""
    from martsmith.plans.jobs import referrals_query
    from martsmith.sources.registry import SourceRegistry
    from martsmith.sources.standins import standin_frame
    from martsmith.streaming import incremental_load

    spec = _keyless_referrals()
    target = _versioned(spark, spec, "incremental-log")

    def to_query(batch: DataFrame) -> DataFrame:
        rt = standin_frame(batch, "admin.referral_transactions")
        return referrals_query(SourceRegistry(spark, {"admin.referral_transactions": rt}))

    incremental_load(spark, f"{sf_dir.rstrip('/')}/orders.parque[t]", spark.read.parquet(f"{sf_dir}/orders.parquet").schema, spec, target, to_query,
                     base_path=sf_dir)
    return target.read(spark)


def surrogate_no_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-7 without a declared order: no sort; ids are dense above the maximum, one per row."""
    rows = assign_surrogate_ids(mart_rows(_src(spark, sf_dir), "campaign"), (), "row_id", 500, "bigint")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id"),
                    F.countDistinct("row_id").alias("n_ids"), F.countDistinct("campaign_id").alias("n_campaigns"))


def json_deep_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-2..4: paths of four steps and more through keys and indices, in both modes; every fifth document is broken off, and a
    JSON null stands for every third priority."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    entry = F.struct(F.struct(c("o_orderkey").alias("d"), F.when(c("o_orderkey") % 3 != 0, c("o_orderpriority")).alias("e")).alias("c"))
    doc = F.to_json(F.struct(F.struct(F.array(entry, F.struct(F.struct(c("o_custkey").alias("d"), c("o_orderstatus").alias("e")).alias("c"))).alias("b")).alias("a"),
                             c("o_orderstatus").alias("s")), {"ignoreNullFields": "false"})
    docs = o.select("o_orderkey", F.when(c("o_orderkey") % 5 == 0, F.left(doc, F.length(doc) - 1)).otherwise(doc).alias("doc"))
    paths = {"first_d": "$.a.b[0].c.d", "first_e": "$.a.b[0].c.e", "second_d": "$.a.b[1].c.d", "second_e": "$.a.b[1].c.e", "third": "$.a.b[2].c.d",
             "status": "$.s", "nowhere": "$.a.x.c"}
    both = json_fields(docs, "doc", paths, keep_doc=True)
    return json_fields(both, "doc", {"first_e_literal": paths["first_e"], "nowhere_literal": paths["nowhere"], "second_e_literal": paths["second_e"]}, json_null="literal")


def distinct_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DST-2 in two levels: line items of which some come twice and some three times."""
    li = _lineitem(spark, sf_dir)
    return distinct_stored_rows(li.unionAll(li.where("l_orderkey % 50 = 0")).unionAll(li.where("l_orderkey % 100 = 0")))


def _mixed_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    segment = F.when(c("c_custkey") % 3 == 0, F.lower("c_mktsegment")).when(c("c_custkey") % 3 == 1, F.initcap("c_mktsegment")).otherwise(c("c_mktsegment"))
    return cust.select("c_custkey", F.when(c("c_custkey") % 17 != 0, segment).alias("segment"), c("c_nationkey").cast("int").alias("nation"))


def distinct_collated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DST-4: distinct (segment, nation) without regard to case; the least spelling stays."""
    return distinct_spellings(_mixed_case(spark, sf_dir).select("segment", "nation"), "UTF8_LCASE")


_COLLATED = TargetSpec("segments", (("c_custkey", "bigint"), ("segment", "varchar(20)"), ("nation", "int")), key=("segment", "nation"),
                       order=("c_custkey",), key_collation="UTF8_LCASE")


def load_collated_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DST-4 in a unique key: keys that differ in case only are one; customers with even numbers first, then all. A segment
    that is NULL collides with nothing."""
    from martsmith.plans.runner import load_frame
    from martsmith.session import scratch_path
    from martsmith.sinks import ParquetTarget

    target = ParquetTarget(_COLLATED, scratch_path(spark, f"collated-{uuid.uuid4().hex[:12]}"))
    rows = _mixed_case(spark, sf_dir)
    for part in (rows.where("c_custkey % 2 = 0"), rows):
        load_frame(spark, part, _COLLATED, target)
    return target.read(spark)


_PROBE = TargetSpec("probe", (("o_orderkey", "bigint"), ("title", "varchar(5)"), ("amount", "decimal(5,2)"), ("day", "date"), ("qty", "int")),
                    not_null=("qty",), key=("o_orderkey",))


def load_rejected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MET-1: the cells that a load changed, by column and rule."""
    from martsmith.plans.runner import load_frame
    from martsmith.session import scratch_path
    from martsmith.sinks import ParquetTarget

    run = scratch_path(spark, f"rejected-{uuid.uuid4().hex[:12]}")
    raw = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", c("o_orderpriority").alias("title"), c("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.when(c("o_orderstatus") == "F", "2024-13-01").otherwise("2024-12-01").alias("day"),
        F.when(c("o_orderkey") % 3 != 0, (c("o_orderkey") % 10).cast("int")).alias("qty"))
    load_frame(spark, raw, _PROBE, ParquetTarget(_PROBE, f"{run}/target"), rejects=f"{run}/rejects")
    return spark.read.parquet(f"{run}/rejects")


def _sized(fn: Query) -> Query:
    """``fn`` in a session whose tasks are sized by what they read."""
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(task_session(spark, sf_dir), sf_dir)
    return run


QUERIES: dict[str, Query] = {name: _sized(fn) for name, fn in {
    "referrals_mart": _mart("referrals"),
    "transactions_mart": _mart("campaign_transactions"),
    "reserved_column": reserved_column,
    "bank_mart": _mart("bank"),
    "campaign_mart": _mart("campaign"),
    "issuer_mart": _mart("issuer_onboardings"),
    "users_mart": _mart("users"),
    "bridge_lookup": bridge_lookup,
    "orphan_fact_join": orphan_fact_join,
    "add_funds_mart": _mart("wallet_add_funds"),
    "withdraw_mart": _mart("wallet_withdraw_funds"),
    "typed_key_join": typed_key_join,
    "json_fields": json_fields_query,
    "json_array_path": json_array_path,
    "json_null_literal": json_null_literal,
    "full_name_concat": full_name_concat,
    "decode_codes": decode_codes_query,
    "nan_to_null": nan_to_null_query,
    "distinct_collated": distinct_collated,
    "conform_types": conform_types,
    "insert_ignore_first_wins": insert_ignore_first_wins,
    "insert_ignore_existing": insert_ignore_existing,
    "insert_ignore_nullable_key": insert_ignore_nullable_key,
    "append_snapshots": append_snapshots,
    "full_refresh": full_refresh,
    "surrogate_id": surrogate_id,
    "load_report": load_report,
    "incremental_referrals": incremental_referrals,
    "bank_mart_split": _split_mart("bank"),
    "campaign_mart_split": _split_mart("campaign"),
    "issuer_mart_split": _split_mart("issuer_onboardings"),
    "users_mart_split": _split_mart("users"),
    "add_funds_mart_split": _split_mart("wallet_add_funds"),
    "withdraw_mart_split": _split_mart("wallet_withdraw_funds"),
    "typed_key_decimal_text": typed_key_decimal_text,
    "conform_text_numbers": conform_text_numbers,
    "load_insert_ignore": load_insert_ignore,
    "load_nullable_key": load_nullable_key,
    "load_append": load_append,
    "load_refresh": load_refresh,
    "load_empty_refresh": load_empty_refresh,
    "load_counts": load_counts,
    "surrogate_no_order": surrogate_no_order,
    "insert_ignore_indexed": insert_ignore_indexed,
    "append_exactly_once": append_exactly_once,
    "nullable_key_exactly_once": nullable_key_exactly_once,
    "refresh_versioned": refresh_versioned,
    "incremental_log": incremental_log,
    "json_deep_paths": json_deep_paths,
    "distinct_collated_rows": distinct_collated_rows,
    "load_collated_key": load_collated_key,
    "distinct_fingerprint": distinct_fingerprint,
    "load_rejected_cells": load_rejected_cells,
}.items()}
