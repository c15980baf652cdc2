"""Stand-ins: the source jobs' operational tables derived from the driver's test tables.

The mart queries are written against the operational schema (``accounts.users``,
``admin.campaign_masters``, ``wallet.fund_users``...). For tests and benchmarks each of
those tables is a projection of one test table (users <- customer, campaign
masters <- orders, KYC documents <- events...), so every mart reads whole test
tables and its work grows with the scale factor. No row is filtered out; the
NULLs, orphans, fan-outs, dirty text and JSON cases the marts must handle are
made by CASE expressions over the data.

Each stand-in column is one SQL expression. Where the two dialects differ a
second expression for DuckDB is given, so the SQL oracle reads exactly the same
inputs (``standin_sql``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from martsmith.schemas import ISSUER_ONBOARDINGS
from martsmith.sources.registry import SourceRegistry, parquet_dir_registry


def _e(spark_sql: str, duck_sql: str | None = None) -> tuple[str, str]:
    return spark_sql, duck_sql if duck_sql is not None else spark_sql


def _null(spark_type: str, duck_type: str | None = None) -> tuple[str, str]:
    return f"CAST(NULL AS {spark_type})", f"CAST(NULL AS {duck_type or spark_type})"


_TS_NULL = _null("TIMESTAMP_NTZ", "TIMESTAMP")
_STR_NULL = _null("STRING", "VARCHAR")


def _str(x: str) -> tuple[str, str]:
    return _e(f"CAST({x} AS STRING)", f"CAST({x} AS VARCHAR)")


def _idiv(a: str, b: int) -> tuple[str, str]:
    return _e(f"({a} div {b})", f"({a} // {b})")


_KYC_JSON_SPARK = (
    "CASE WHEN event_type = 'signup' AND value < 2 THEN '{broken' ELSE "
    "'{\"CivilNumber\": \"' || CAST(event_id AS STRING) || '\", "
    "\"Name_1_En\": \"' || event_type || '\", "
    "\"Name_2_En\": ' || CASE WHEN event_type = 'view' THEN 'null' "
    "ELSE '\"U' || CAST(user_id AS STRING) || '\"' END || ', "
    "\"Name_3_En\": \"N' || CAST(event_id % 7 AS STRING) || '\", "
    "\"Name_6_En\": \"' || upper(event_type) || '\", "
    "\"Gender_Desc_En\": \"' || CASE WHEN user_id % 2 = 0 THEN 'Female' ELSE 'Male' END || '\", "
    "\"Birth_DateOfBirth\": \"' || CASE WHEN event_type = 'purchase' THEN '2024-13-01' "
    "ELSE CAST(CAST(ts AS DATE) AS STRING) END || '\", "
    "\"Birth_Country_Desc_En\": \"C' || CAST(user_id % 25 AS STRING) || '\", "
    "\"Address_Wilayat_Desc_En\": \"W' || CAST(event_id % 11 AS STRING) || '\", "
    "\"Current_MobileNumber\": ' || CAST(event_id AS STRING) || ', "
    "\"Occupation_Desc_En\": \"' || event_type || '\", "
    "\"PassportList\": ' || CASE WHEN event_type = 'click' THEN '[]' ELSE "
    "'[{\"PassportType_PassportNumber\": \"P' || CAST(event_id AS STRING) || '\", "
    "\"PassportType_DateOfIssue\": \"' || CAST(CAST(ts AS DATE) AS STRING) || '\", "
    "\"PassportType_DateOfExpiry\": \"2034-01-01\"}, "
    "{\"PassportType_PassportNumber\": \"Q' || CAST(event_id AS STRING) || '\"}]' END || '}' END"
)

# Stand-in definitions: logical table -> (test table, {column: (spark expr, duckdb expr)}).
STANDINS: dict[str, tuple[str, dict[str, tuple[str, str]]]] = {
    "accounts.users": ("customer", {
        "id": _e("CASE WHEN c_acctbal >= 0 THEN c_custkey END"),
        "email": _e("lower(c_name) || '@example.test'"),
        "first_name": _e("c_name"),
        "last_name": _e("CASE WHEN c_nationkey <> 0 THEN c_mktsegment END"),
        "role_id": _e("c_nationkey % 4"),
        "email_verified_at": _TS_NULL,
        "investor_category_id": _e("c_nationkey % 7"),
        "phone_code": _e("'+' || CAST(c_nationkey AS STRING)", "'+' || CAST(c_nationkey AS VARCHAR)"),
        "phone": _str("c_custkey"),
        "is_approved": _e("CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END"),
        "login_with": _e("c_mktsegment"),
        "is_admin": _e("CASE WHEN c_custkey % 97 = 0 THEN 1 ELSE 0 END"),
        "created_at": _TS_NULL,
        "updated_at": _TS_NULL,
        "gender": _e("CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END"),
        "dob": _null("DATE"),
        "namescan_id": _str("c_custkey"),
        "namescan_match_rate": _null("DECIMAL(5,2)"),
        "kyc_general_match_status": _e("c_mktsegment"),
        "platform_ref": _e("c_name"),
        "maala_result": _STR_NULL,
        "country_id": _e("c_nationkey"),
    }),
    "accounts.countries": ("nation", {"id": _e("n_nationkey"), "name": _e("n_name")}),
    "accounts.cities": ("nation", {"id": _e("n_nationkey")}),
    "accounts.user_types": ("part", {
        "user_id": _idiv("p_partkey", 2),
        "type_id": _e("p_size % 7"),
    }),
    "accounts.types": ("region", {"id": _e("r_regionkey"), "type": _e("r_name")}),
    "accounts.kyc_infos": ("events", {
        "id": _e("event_id"),
        "namescan_id": _e(
            "CASE WHEN event_type = 'error' THEN 'x' || CAST(user_id AS STRING) ELSE CAST(user_id AS STRING) END",
            "CASE WHEN event_type = 'error' THEN 'x' || CAST(user_id AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END",
        ),
        "maala_data": _e(_KYC_JSON_SPARK, _KYC_JSON_SPARK.replace("AS STRING", "AS VARCHAR")),
    }),
    "accounts.kyc_ex_platforms": ("orders", {
        "id": _e("o_orderkey"),
        "kyc_info_id": _idiv("o_orderkey", 2),
        "investor_category_id": _e("CAST(o_custkey % 7 AS INT)"),
        "annual_salary": _e("o_orderpriority"),
        "net_worth": _e("o_orderpriority || ' / ' || o_orderstatus"),
        "status": _e("o_orderstatus"),
    }),
    "accounts.states": ("region", {"id": _e("r_regionkey")}),
    "accounts.aml_stores": ("supplier", {"id": _e("s_suppkey"), "aml_record": _e("s_name")}),
    "accounts.investor_categories": ("region", {
        "id": _e("r_regionkey"), "title": _e("r_name"), "type": _e("lower(r_name)"),
    }),
    "admin.user_bank_infos": ("supplier", {
        "user_id": _idiv("s_suppkey", 2),
        "country_id": _e("s_nationkey"),
        "bank_name": _e("s_name"),
        "ac_name": _e("'AC ' || s_name"),
        "ac_no": _str("s_suppkey"),
        "branch": _e("'BR' || CAST(s_nationkey AS STRING)", "'BR' || CAST(s_nationkey AS VARCHAR)"),
        "swift_code": _e("'SW' || CAST(s_suppkey % 13 AS STRING)", "'SW' || CAST(s_suppkey % 13 AS VARCHAR)"),
        "iban": _e("'IB' || CAST(s_suppkey AS STRING)", "'IB' || CAST(s_suppkey AS VARCHAR)"),
        "home_address": _STR_NULL,
    }),
    "admin.campaign_masters": ("orders", {
        "id": _e("o_orderkey"),
        "user_id": _e("o_custkey"),
        "country_id": _e("CAST(o_custkey % 30 AS INT)"),
        "order": _e("CAST(o_orderkey % 1000 AS INT)"),
        "title": _e("'Campaign ' || CAST(o_orderkey AS STRING)", "'Campaign ' || CAST(o_orderkey AS VARCHAR)"),
        "short_desc": _e("o_orderpriority"),
        "progress_type_id": _null("INT"),
        "start_date": _e("o_orderdate"),
        "end_date": _e("o_orderdate"),
        "min_amount": _e("o_totalprice"),
        "max_amount": _e("o_totalprice"),
        "project_timeline": _e("o_orderpriority"),
        "max_predefined_amount": _null("DECIMAL(18,2)"),
        "min_predefined_amount": _null("DECIMAL(18,2)"),
        "funding_goal": _e("o_totalprice"),
        "currency": _e("'USD'"),
        "max_equity_offered": _null("DECIMAL(10,2)"),
        "min_equity_offered": _null("DECIMAL(10,2)"),
        "divident_target": _null("DECIMAL(10,2)"),
        "roi_after_tax": _null("DECIMAL(10,2)"),
        "irr_after_tax": _null("DECIMAL(10,2)"),
        "recommended_amount": _null("DECIMAL(18,2)"),
        "contributor_table": _STR_NULL,
        "location": _e("o_orderstatus"),
        "admin_aproval": _e("CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"),
        "draft": _e("0"),
        "approved_by": _null("INT"),
        "approved_at": _TS_NULL,
        "timeline_start_date": _TS_NULL,
        "timeline_end_date": _TS_NULL,
        "payout_notify": _e("0"),
        "created_at": _e("o_orderdate"),
        "deleted_at": _TS_NULL,
        "updated_at": _e("o_orderdate"),
        "campaign_type": _e("o_orderpriority"),
        "campaign_end_method": _STR_NULL,
        "campaign_opened_at": _TS_NULL,
        "campaign_closed_at": _TS_NULL,
        "status": _e("o_orderstatus"),
        "is_public": _e("1"),
        "is_private": _e("0"),
        "meta_title": _STR_NULL,
        "campaign_close_request": _e("0"),
    }),
    "admin.countries": ("nation", {
        "id": _e("n_nationkey"), "name": _e("'Country ' || n_name"),
    }),
    "admin.campaign_transactions": ("lineitem", {
        "id": _e("l_orderkey * 10 + l_linenumber"),
        "payment_request_id": _e("l_partkey"),
        "issuer_disbursed_request_id": _e("l_suppkey"),
        "investor_disbursed_request_id": _null("BIGINT"),
        "pre_campaign_fee_request_id": _null("BIGINT"),
        "campaign_id": _e("l_orderkey"),
        "investor_id": _e("l_partkey"),
        "issuer_id": _e("l_suppkey"),
        "transaction_no": _e(
            "'T' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
            "'T' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)",
        ),
        "transaction_type": _e("l_returnflag"),
        "transaction_status": _e("l_linestatus"),
        "payment_method": _e("CASE WHEN l_linenumber % 2 = 0 THEN 'card' ELSE 'bank transfer' END"),
        "amount": _e("l_extendedprice"),
        "charge": _e("l_tax"),
        "currency": _e("'USD'"),
        "rate": _e("l_discount"),
        "base_amount": _e("l_extendedprice"),
        "base_currency": _e("'USD'"),
        "investment_status": _e("l_linestatus"),
        "status": _e("l_returnflag"),
        "remarks": _STR_NULL,
        "transaction_date": _e("l_shipdate"),
        "deal_id": _e("l_orderkey"),
        "deleted_at": _TS_NULL,
        "created_at": _e("l_shipdate"),
        "updated_at": _e("l_shipdate"),
        "affiliate_code": _STR_NULL,
    }),
    "admin.referral_transactions": ("orders", {
        "id": _e("o_orderkey"),
        "investor_id": _e("o_custkey"),
        "campaign_id": _idiv("o_orderkey", 4),
        "commission_amount": _e("o_totalprice"),
        "commission_percentage": _e("CAST(o_custkey % 40 AS DOUBLE) / 4"),
        "ref_id": _e("CAST(o_custkey % 50 AS INT)"),
        "status": _e("o_orderstatus"),
        "created_at": _e("o_orderdate"),
        "updated_at": _e("o_orderdate"),
    }),
    "wallet.fund_users": ("orders", {"user_id": _e("o_custkey"), "fund_id": _e("o_orderkey")}),
    "wallet.add_funds": ("lineitem", {
        "id": _e("l_orderkey"),
        "amount": _e("l_extendedprice"),
        "currency": _e("CASE WHEN l_returnflag = 'R' THEN 'OMR' ELSE 'USD' END"),
        "base_currency": _e("'USD'"),
        "converted_amount": _e("l_extendedprice"),
        "updated_amount": _e("l_quantity"),
        "date": _e("CAST(l_shipdate AS DATE)"),
        "payment_type": _e("l_linenumber"),
        "transaction_id": _e(
            "'TX' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
            "'TX' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)",
        ),
        "is_approved": _e("l_linestatus"),
        "created_at": _e("l_shipdate"),
        "updated_at": _e("l_shipdate"),
    }),
    "wallet.withdraw_funds": ("orders", {
        "user_id": _e("o_custkey"),
        "amount": _e("CAST(o_totalprice AS DECIMAL(18,2))"),
        "currency": _e("o_orderpriority"),
        "base_currency": _e("'USD'"),
        "exchange_rate": _e("CASE WHEN o_orderstatus = 'F' THEN 3.75 ELSE 1.00 END"),
        "converted_amount": _e("o_totalprice"),
        "remaining_balance": _e("CAST(o_totalprice AS DECIMAL(18,2))"),
        "bank": _e("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS STRING) END",
                   "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END"),
        "payment_type": _e("CAST(o_orderkey % 3 AS INT)"),
        "is_processed": _e("o_orderkey % 2"),
        "created_at": _e("o_orderdate"),
        "updated_at": _e("o_orderdate"),
    }),
}


def _issuer_columns() -> dict[str, tuple[str, str]]:
    """issuer_onboardings <- customer: a few mapped columns, the rest typed (and derived below)."""
    mapped = {
        "issuer_id": _e("CASE WHEN c_acctbal >= 0 THEN (c_custkey div 2) * 3 END",
                        "CASE WHEN c_acctbal >= 0 THEN (c_custkey // 2) * 3 END"),
        "issuer_type": _e("c_mktsegment"),
        "email": _e("lower(c_name)"),
        "phone_code": _e("'+' || CAST(c_nationkey AS STRING)", "'+' || CAST(c_nationkey AS VARCHAR)"),
        "phone_no": _e("'000000000000' || CAST(c_custkey AS STRING)",
                       "'000000000000' || CAST(c_custkey AS VARCHAR)"),
        "application_type": _e("CASE WHEN c_custkey % 2 = 0 THEN 'individual' ELSE 'company' END"),
        "min_fag": _e("c_acctbal"),
        "max_fag": _e("c_acctbal * 2"),
        "status": _e("c_mktsegment"),
    }
    duck = {"text": "VARCHAR", "datetime": "TIMESTAMP"}
    spark = {"text": "STRING", "datetime": "TIMESTAMP_NTZ"}
    cols: dict[str, tuple[str, str]] = {"issuer_id": mapped["issuer_id"]}
    for name, sql in ISSUER_ONBOARDINGS.columns:
        if name in ("id", "campaign_id", "issuer_id"):
            continue
        src = "status" if name == "on_boarding_status" else name
        if src in mapped:
            cols[src] = mapped[src]
            continue
        base = sql.split("(")[0]
        if base == "varchar":
            st, dt = "STRING", "VARCHAR"
        elif base == "decimal":
            st = dt = sql.upper()
        else:
            st, dt = spark.get(base, base.upper()), duck.get(base, base.upper())
        cols[src] = _null(st, dt)
    return cols


STANDINS["admin.issuer_onboardings"] = ("customer", _issuer_columns())


# A key of each test table, from which the columns that it has no match for are derived.
_KEYS = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "(l_orderkey * 10 + l_linenumber)", "supplier": "s_suppkey"}


def _derived(key: str, column: str, k: int, kind: str) -> tuple[str, str]:
    """Values of Spark type ``kind`` that differ between rows and between columns (``k``); every
    eleventh is NULL."""
    n, day = f"({key} + {k})", f"({key} * 3 + {k}) % 1500"
    if kind == "STRING":
        one = _e(f"'{column} ' || CAST({n} % 89 AS STRING)", f"'{column} ' || CAST({n} % 89 AS VARCHAR)")
    elif kind == "DATE":
        one = _e(f"date_add(DATE'2020-01-01', CAST({day} AS INT))", f"(DATE '2020-01-01' + CAST({day} AS INTEGER))")
    elif kind == "TIMESTAMP_NTZ":
        one = _e(f"CAST(date_add(DATE'2020-01-01', CAST({day} AS INT)) AS TIMESTAMP_NTZ)",
                 f"CAST(DATE '2020-01-01' + CAST({day} AS INTEGER) AS TIMESTAMP)")
    elif kind.startswith("DECIMAL"):
        one = _e(f"CAST({n} % 9000 * 0.01 AS {kind})")
    else:
        one = _e(f"CAST({n} % 100 AS {kind})")
    return tuple(f"CASE WHEN {key} % 11 <> {k % 11} THEN {x} END" for x in one)


for _table, _columns in STANDINS.values():
    for _k, (_name, (_spark, _)) in enumerate(list(_columns.items())):
        if _spark.startswith("CAST(NULL AS "):
            _columns[_name] = _derived(_KEYS[_table], _name, _k, _spark.removeprefix("CAST(NULL AS ")[:-1])


def standin_registry(spark, sf_dir: str) -> SourceRegistry:
    """Registry of the operational tables, each derived from one test table of ``sf_dir``."""
    raw = parquet_dir_registry(spark, sf_dir)
    reg = SourceRegistry(spark)
    for name, (table, cols) in STANDINS.items():
        reg.register(name, _view(raw, table, cols))
    return reg


def _view(raw: SourceRegistry, table: str, cols: dict[str, tuple[str, str]]):
    def build(_reg: SourceRegistry) -> DataFrame:
        return raw.table(table).selectExpr(*[f"{expr} AS `{c}`" for c, (expr, _) in cols.items()])
    return build


def standin_frame(base: DataFrame, name: str) -> DataFrame:
    """Apply stand-in ``name``'s expressions to ``base``, a frame shaped like its test table
    (e.g. a micro-batch of new files)."""
    _, cols = STANDINS[name]
    return base.selectExpr(*[f"{expr} AS `{c}`" for c, (expr, _) in cols.items()])


def standin_sql(name: str) -> str:
    """DuckDB subquery text producing the same stand-in table (for the SQL oracle)."""
    table, cols = STANDINS[name]
    body = ", ".join(f'{duck} AS "{c}"' for c, (_, duck) in cols.items())
    return f"(SELECT {body} FROM {table})"
