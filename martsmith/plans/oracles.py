"""DuckDB SQL twins of ``martsmith.plans.entries`` (the correctness oracle).

Each statement runs on the raw test tables (``customer``, ``orders``...,
registered as views) and rebuilds the stand-in tables with the same SQL
expressions (``standin_sql``). The mart queries state the rows each mart must
hold: one part per branch, and the rows that find no partner (orphans, users
without accounts, NULL keys) as parts of their own.

DuckDB traps handled here: ``concat`` skips NULLs (``||`` is used), ORDER BY
puts NULLs last (``NULLS FIRST`` everywhere), malformed JSON raises (every
extraction is guarded by ``json_valid``), ``sum`` of BIGINT is HUGEINT (cast).
"""

from __future__ import annotations

from dataclasses import replace

from martsmith.schemas import (
    BANK,
    CAMPAIGN,
    CAMPAIGN_TRANSACTIONS,
    ISSUER_ONBOARDINGS,
    REFERRALS,
    USERS,
    WALLET_ADD_FUNDS,
    WALLET_WITHDRAW_FUNDS,
    TargetSpec,
)
from martsmith.sources.standins import standin_sql


# The KYC documents' paths and the names of what stands there, stated here apart from the queries.
KYC_JSON_PATHS = {
    "Malaa_Civil_Number": "$.CivilNumber",
    "Malaa_Name1": "$.Name_1_En",
    "Malaa_Name2": "$.Name_2_En",
    "Malaa_Name3": "$.Name_3_En",
    "Malaa_LastName": "$.Name_6_En",
    "Malaa_Gender": "$.Gender_Desc_En",
    "Malaa_Date_Of_Birth": "$.Birth_DateOfBirth",
    "Malaa_Birth_Country": "$.Birth_Country_Desc_En",
    "Malaa_Address": "$.Address_Wilayat_Desc_En",
    "Malaa_Mobile": "$.Current_MobileNumber",
    "Malaa_Occupation": "$.Occupation_Desc_En",
    "Malaa_Passport_Number": "$.PassportList[0].PassportType_PassportNumber",
    "Malaa_Passport_Issue_Date": "$.PassportList[0].PassportType_DateOfIssue",
    "Malaa_Passport_Expiry_Date": "$.PassportList[0].PassportType_DateOfExpiry",
}


def q(name: str) -> str:
    return f'"{name}"'


def _duck_type(sql: str) -> str:
    t = sql.lower()
    if t.startswith("decimal"):
        return t.upper()
    return {"int": "INTEGER", "bigint": "BIGINT", "tinyint": "TINYINT", "date": "DATE",
            "datetime": "TIMESTAMP", "timestamp": "TIMESTAMP"}[t]


def conform_sql(spec: TargetSpec, col: str, sql_type: str) -> str:
    """SQL for one target column (text cut to VARCHAR(n), TRY_CAST otherwise, NOT NULL default)."""
    t = sql_type.lower()
    ref = q(col)
    if t.startswith("varchar"):
        n = int(t[t.index("(") + 1:-1])
        e = f"substring(CAST({ref} AS VARCHAR), 1, {n})"
        default = "''"
    elif t == "text":
        e = f"CAST({ref} AS VARCHAR)"
        default = "''"
    else:
        e = f"TRY_CAST({ref} AS {_duck_type(t)})"
        default = "0"
    if col in spec.not_null:
        e = f"COALESCE({e}, {default})"
    return f"{e} AS {ref}"


def _order_list(cols: list[str]) -> str:
    return ", ".join(f"{q(c)} ASC NULLS FIRST" for c in cols)


def mart_sql(spec: TargetSpec, ctes: dict[str, str], query: str) -> str:
    """Wrap a mart query: conform to ``spec``, then first-wins on its key (arrival order =
    the query's ORDER BY captured before conform, then every column)."""
    load = [(n, t) for n, t in spec.columns if n != spec.surrogate]
    cols = [n for n, _ in load]
    arrival = [f"__arrival_{i}" for i in range(len(spec.order))]
    parts = [f"{k} AS {v}" for k, v in ctes.items()]
    parts.append(f"mart_q AS ({query})")
    conformed = [conform_sql(spec, n, t) for n, t in load]
    conformed += [f"{q(o)} AS {q(a)}" for o, a in zip(spec.order, arrival)]
    parts.append(f"mart_c AS (SELECT {', '.join(conformed)} FROM mart_q)")
    select = ", ".join(q(n) for n in cols)
    if not spec.key:
        return f"WITH {', '.join(parts)} SELECT {select} FROM mart_c"
    part = ", ".join(q(k) for k in spec.key)
    order = _order_list(arrival + cols)
    parts.append(f"mart_r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {part} ORDER BY {order}) AS __rn FROM mart_c)")
    null_key = " OR ".join(f"{q(k)} IS NULL" for k in spec.key)
    return f"WITH {', '.join(parts)} SELECT {select} FROM mart_r WHERE __rn = 1 OR {null_key}"


def _json(doc: str, path: str) -> str:
    return f"CASE WHEN json_valid({doc}) THEN json_extract_string({doc}, '{path}') END"


# ---------------------------------------------------------------------------
# the eight marts

REFERRALS_SQL = mart_sql(
    REFERRALS,
    {"rt": standin_sql("admin.referral_transactions")},
    "SELECT id, investor_id AS referred_user_id, campaign_id, commission_amount, commission_percentage, "
    "ref_id AS referral_user_id, status, created_at, updated_at FROM rt WHERE id IS NOT NULL",
)

TRANSACTIONS_SQL = mart_sql(
    CAMPAIGN_TRANSACTIONS,
    {"ct": standin_sql("admin.campaign_transactions")},
    "SELECT " + ", ".join(
        "campaign_id AS campaign_transactions_id" if n == "campaign_transactions_id" else q(n)
        for n, _ in CAMPAIGN_TRANSACTIONS.columns
    ) + " FROM ct WHERE id IS NOT NULL",
)

BANK_SQL = mart_sql(
    BANK,
    {"person": f"(SELECT id FROM {standin_sql('accounts.users')} WHERE id IS NOT NULL)",
     "account": standin_sql("admin.user_bank_infos")},
    # UNION: both parts together hold each row once
    "SELECT person.id AS user_id, bank_name, ac_name, ac_no, branch, swift_code, iban, home_address "
    "FROM account JOIN person ON person.id = account.user_id "
    "UNION SELECT id, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM person "
    "WHERE id NOT IN (SELECT user_id FROM account WHERE user_id IS NOT NULL)",
)

_CAMPAIGN_FROM_C = [n for n, _ in CAMPAIGN.columns
                    if n not in ("id", "campaign_id", "country_name", "user_type_id")]
CAMPAIGN_SQL = mart_sql(
    CAMPAIGN,
    {"campaign": f"(SELECT * FROM {standin_sql('admin.campaign_masters')} WHERE id IS NOT NULL)",
     "owner_type": f"(SELECT user_id AS owner, type_id FROM {standin_sql('accounts.user_types')})",
     "country": f"(SELECT id AS country_key, name AS country_name FROM {standin_sql('admin.countries')})",
     # a campaign once per type of its owner, once if the owner has none or there is no owner
     "typed": "(SELECT campaign.*, type_id AS user_type_id FROM campaign JOIN owner_type ON owner = user_id "
              "UNION ALL SELECT *, NULL FROM campaign WHERE user_id IS NULL "
              "OR user_id NOT IN (SELECT owner FROM owner_type WHERE owner IS NOT NULL))"},
    "SELECT id AS campaign_id, " + ", ".join(q(n) for n in _CAMPAIGN_FROM_C)
    + ", country_name, user_type_id FROM typed LEFT JOIN country ON country_key = country_id",
)

_ISSUER_FROM_I = [n for n, _ in ISSUER_ONBOARDINGS.columns
                  if n not in ("id", "campaign_id", "issuer_id", "on_boarding_status")]
ISSUER_SQL = mart_sql(
    ISSUER_ONBOARDINGS,
    {"onboarding": f"(SELECT * FROM {standin_sql('admin.issuer_onboardings')} WHERE issuer_id IS NOT NULL)",
     "owned": f"(SELECT id AS campaign_id, user_id AS owner FROM {standin_sql('admin.campaign_masters')})",
     "issued": "(SELECT onboarding.*, owned.campaign_id FROM onboarding JOIN owned ON owner = issuer_id "
               "UNION ALL SELECT *, NULL FROM onboarding "
               "WHERE issuer_id NOT IN (SELECT owner FROM owned WHERE owner IS NOT NULL))"},
    "SELECT issuer_id, campaign_id, " + ", ".join(q(n) for n in _ISSUER_FROM_I)
    + ', status AS "on_boarding_status" FROM issued',
)

_USER_OWN = [n for n, _ in USERS.columns if n not in ("id", "user_id", "full_name", "user_created_at", "user_updated_at", "country",
             "user_type", "aml_record", "kyc_id", "kyc_info_id", "kyc_investor_category_id", "annual_salary", "net_worth",
             "kyc_status", "investor_category_title", "investor_category_type", *KYC_JSON_PATHS)]
_KYC_OUT = ["kyc_id", "kyc_info_id", "kyc_investor_category_id", "annual_salary", "net_worth", "kyc_status", *KYC_JSON_PATHS]
USERS_SQL = mart_sql(
    USERS,
    {
        # what is known of a user alone
        "person": "(SELECT who.*, who.first_name || ' ' || who.last_name AS full_name, land.name AS country, "
                  "aml.aml_record, cat.title AS investor_category_title, cat.type AS investor_category_type "
                  f"FROM {standin_sql('accounts.users')} AS who "
                  f"LEFT JOIN {standin_sql('accounts.countries')} AS land ON land.id = who.country_id "
                  f"LEFT JOIN {standin_sql('accounts.aml_stores')} AS aml ON aml.id = who.id "
                  f"LEFT JOIN {standin_sql('accounts.investor_categories')} AS cat ON cat.id = who.investor_category_id "
                  "WHERE who.id IS NOT NULL)",
        # user types by user; a type that is not in the list keeps its row, without a name
        "role": f"(SELECT held.user_id AS of_user, kind.type AS user_type FROM {standin_sql('accounts.user_types')} AS held "
                f"LEFT JOIN {standin_sql('accounts.types')} AS kind ON kind.id = held.type_id)",
        # documents with each of their platform records, or with none
        "document": "(SELECT id AS doc_id, TRY_CAST(namescan_id AS BIGINT) AS of_user, "
                    + ", ".join(f"{_json('maala_data', p)} AS {q(n)}" for n, p in KYC_JSON_PATHS.items())
                    + f" FROM {standin_sql('accounts.kyc_infos')})",
        "platform": "(SELECT id AS kyc_id, kyc_info_id, investor_category_id AS kyc_investor_category_id, annual_salary, net_worth, "
                    f"status AS kyc_status FROM {standin_sql('accounts.kyc_ex_platforms')})",
        "paper": "(SELECT document.*, platform.* FROM document JOIN platform ON kyc_info_id = doc_id "
                 "UNION ALL SELECT *, NULL, NULL, NULL, NULL, NULL, NULL FROM document "
                 "WHERE doc_id IS NULL OR doc_id NOT IN (SELECT kyc_info_id FROM platform WHERE kyc_info_id IS NOT NULL))",
        "with_role": "(SELECT person.*, user_type FROM person JOIN role ON of_user = id "
                     "UNION ALL SELECT *, NULL FROM person WHERE id NOT IN (SELECT of_user FROM role WHERE of_user IS NOT NULL))",
        "with_paper": "(SELECT with_role.*, " + ", ".join(f"paper.{q(n)}" for n in _KYC_OUT) + " FROM with_role JOIN paper ON of_user = id "
                      "UNION ALL SELECT *, " + ", ".join("NULL" for _ in _KYC_OUT)
                      + " FROM with_role WHERE id NOT IN (SELECT of_user FROM paper WHERE of_user IS NOT NULL))",
    },
    "SELECT DISTINCT id AS user_id, full_name, created_at AS user_created_at, updated_at AS user_updated_at, country, user_type, "
    "aml_record, investor_category_title, investor_category_type, "
    + ", ".join(q(n) for n in [*_USER_OWN, *_KYC_OUT]) + " FROM with_paper",
)

_PAYMENT_CASE = ("CASE WHEN {c} = 1 THEN 'Bank' WHEN {c} = 2 THEN 'Credit/Debit' ELSE NULL END")

_FUND_OUT = ["add_funds_" + n for n in ("amount", "currency", "base_currency_USD", "converted_amount_USD", "updated_amount",
             "date", "payment_type", "transaction_id", "status", "created_at", "updated_at")]
ADD_FUNDS_SQL = mart_sql(
    WALLET_ADD_FUNDS,
    {"person": f"(SELECT id AS user_id FROM {standin_sql('accounts.users')})",
     "payment": "(SELECT id AS payment_id, amount AS add_funds_amount, currency AS add_funds_currency, "
                "base_currency AS add_funds_base_currency_USD, converted_amount AS add_funds_converted_amount_USD, "
                "updated_amount AS add_funds_updated_amount, date AS add_funds_date, "
                + _PAYMENT_CASE.format(c="payment_type") + " AS add_funds_payment_type, "
                "transaction_id AS add_funds_transaction_id, is_approved AS add_funds_status, "
                f"created_at AS add_funds_created_at, updated_at AS add_funds_updated_at FROM {standin_sql('wallet.add_funds')})",
     "link": f"(SELECT user_id AS payer, fund_id FROM {standin_sql('wallet.fund_users')})",
     # every link once per payment of its fund, or once without one
     "paid": "(SELECT payer, " + ", ".join(q(n) for n in _FUND_OUT) + " FROM link JOIN payment ON payment_id = fund_id "
             "UNION ALL SELECT payer, " + ", ".join("NULL" for _ in _FUND_OUT) + " FROM link WHERE fund_id IS NULL "
             "OR fund_id NOT IN (SELECT payment_id FROM payment WHERE payment_id IS NOT NULL))"},
    "SELECT DISTINCT user_id, " + ", ".join(q(n) for n in _FUND_OUT) + " FROM paid LEFT JOIN person ON user_id = payer",
)

_DRAWN = {"amount": "amount", "currency": "currency", "base_currency": "base_currency", "exchange_rate": "exchange_rate",
          "converted_amount": "converted_amount", "remaining_balance": "remaining_balance", "bank": "bank_id",
          "is_processed": "status", "created_at": "created_at", "updated_at": "updated_at"}
_ACCOUNT_OUT = ["bank_name", "account_name", "account_num", "country_id", "branch", "iban", "home_address", "swift_code"]
WITHDRAW_SQL = mart_sql(
    WALLET_WITHDRAW_FUNDS,
    {"person": f"(SELECT id AS user_id FROM {standin_sql('accounts.users')} WHERE id IS NOT NULL)",
     "drawn": "(SELECT user_id AS drawer, " + ", ".join(f"{k} AS withdraw_funds_{v}" for k, v in _DRAWN.items())
              + ", " + _PAYMENT_CASE.format(c="payment_type") + " AS withdraw_funds_payment_type "
              f"FROM {standin_sql('wallet.withdraw_funds')})",
     "account": "(SELECT user_id AS holder, bank_name, ac_name AS account_name, ac_no AS account_num, country_id, branch, iban, "
                f"home_address, swift_code FROM {standin_sql('admin.user_bank_infos')})",
     # withdrawals of known users, and those of nobody known; only the former have accounts
     "known": "(SELECT user_id, drawn.* FROM drawn JOIN person ON user_id = drawer)",
     "orphan": "(SELECT * FROM drawn WHERE drawer IS NULL OR drawer NOT IN (SELECT user_id FROM person))"},
    "SELECT * EXCLUDE (drawer, holder) FROM known LEFT JOIN account ON holder = user_id "
    "UNION ALL SELECT NULL AS user_id, * EXCLUDE (drawer), " + ", ".join("NULL" for _ in _ACCOUNT_OUT) + " FROM orphan",
)


# ---------------------------------------------------------------------------
# operator-level queries

RESERVED_COLUMN_SQL = (
    f"SELECT c.id AS campaign_id, c.\"order\", c.status AS \"on_boarding_status\" "
    f"FROM {standin_sql('admin.campaign_masters')} AS c WHERE c.id IS NOT NULL"
)

BRIDGE_LOOKUP_SQL = (
    f"WITH u AS {standin_sql('accounts.users')}, b AS {standin_sql('accounts.user_types')}, "
    f"t AS {standin_sql('accounts.types')} "
    "SELECT u.id AS user_id, b.type_id, t.type AS user_type "
    "FROM u LEFT JOIN b ON u.id = b.user_id LEFT JOIN t ON b.type_id = t.id"
)

ORPHAN_FACT_JOIN_SQL = (
    f"WITH u AS {standin_sql('accounts.users')}, w AS {standin_sql('wallet.withdraw_funds')} "
    "SELECT u.id AS user_id, w.user_id AS w_user_id, w.amount, w.bank, w.created_at "
    "FROM u RIGHT JOIN w ON u.id = w.user_id"
)

TYPED_KEY_JOIN_SQL = (
    f"WITH u AS {standin_sql('accounts.users')}, k AS {standin_sql('accounts.kyc_infos')} "
    "SELECT u.id AS user_id, k.id AS kyc_id, k.namescan_id "
    "FROM u LEFT JOIN k ON u.id = TRY_CAST(k.namescan_id AS BIGINT) WHERE u.id IS NOT NULL"
)


def _json_sql(paths: dict[str, str], literal: bool = False) -> str:
    cols = []
    for n, p in paths.items():
        e = _json("maala_data", p)
        if literal:
            e = (f"CASE WHEN json_valid(maala_data) AND json_type(maala_data, '{p}') = 'NULL' "
                 f"THEN 'null' ELSE {e} END")
        cols.append(f"{e} AS {q(n)}")
    return f"SELECT id AS kyc_id, {', '.join(cols)} FROM {standin_sql('accounts.kyc_infos')}"


JSON_FIELDS_SQL = _json_sql({k: v for k, v in KYC_JSON_PATHS.items() if "[" not in v})
JSON_ARRAY_PATH_SQL = _json_sql({k: v for k, v in KYC_JSON_PATHS.items() if "[" in v})
JSON_NULL_LITERAL_SQL = _json_sql(
    {"Malaa_Name2": "$.Name_2_En", "Malaa_Passport_Number": KYC_JSON_PATHS["Malaa_Passport_Number"]},
    literal=True,
)

FULL_NAME_SQL = (
    "SELECT id AS user_id, first_name, last_name, first_name || ' ' || last_name AS full_name "
    f"FROM {standin_sql('accounts.users')}"
)

DECODE_CODES_SQL = (
    "SELECT transaction_id, payment_type, "
    + _PAYMENT_CASE.format(c="payment_type") + " AS payment_label "
    f"FROM {standin_sql('wallet.add_funds')}"
)

NAN_TO_NULL_SQL = (
    "SELECT l_orderkey, l_linenumber, CASE WHEN isnan(discount) THEN NULL ELSE discount END AS discount, "
    "CASE WHEN isnan(tax) THEN NULL ELSE tax END AS tax FROM ("
    "SELECT l_orderkey, l_linenumber, "
    "CASE WHEN l_discount = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_discount END AS discount, "
    "CASE WHEN l_tax = 0 THEN CAST('Infinity' AS DOUBLE) WHEN l_tax = 0.08 THEN CAST('-Infinity' AS DOUBLE) "
    "ELSE l_tax END AS tax FROM lineitem)"
)

DISTINCT_COLLATED_SQL = (
    "WITH s AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END "
    "AS segment FROM customer) "
    "SELECT 'binary' AS collation, count(DISTINCT segment) AS n_distinct FROM s "
    "UNION ALL SELECT 'UTF8_LCASE' AS collation, count(DISTINCT lower(segment)) AS n_distinct FROM s"
)

CONFORM_TYPES_SQL = (
    "WITH raw AS (SELECT o_orderkey, o_orderpriority AS title, o_totalprice AS amount, "
    "o_totalprice * 100000 AS big, "
    "CASE WHEN o_orderstatus = 'F' THEN '2024-13-01' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day, "
    "CASE WHEN o_orderkey % 3 = 0 THEN 'Bank' ELSE CAST(o_orderkey % 3 AS VARCHAR) END AS code "
    "FROM orders) "
    "SELECT o_orderkey, substring(title, 1, 5) AS title, "
    "CAST(LEAST(GREATEST(amount, -999.99), 999.99) AS DECIMAL(5,2)) AS amount, "
    "CAST(LEAST(GREATEST(round(big), -2147483648), 2147483647) AS INTEGER) AS big, "
    "TRY_CAST(day AS DATE) AS day, TRY_CAST(code AS BIGINT) AS code, "
    "CASE WHEN code IS NOT NULL AND TRY_CAST(code AS BIGINT) IS NULL THEN 0 "
    "ELSE TRY_CAST(code AS BIGINT) END AS code_zero FROM raw"
)

_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_ORDER = _order_list(["l_shipdate"] + [x for x in _LI_COLS if x != "l_shipdate"])
_LI_SELECT = ", ".join(_LI_COLS)


def _li_first_wins(where: str = "") -> str:
    return (f"SELECT {_LI_SELECT} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber "
            f"ORDER BY {_LI_ORDER}) AS rn FROM lineitem {where}) WHERE rn = 1")


FIRST_WINS_SQL = _li_first_wins()

INSERT_IGNORE_EXISTING_SQL = (
    f"WITH ex AS ({_li_first_wins("WHERE l_linestatus = 'F'")}), "
    f"b AS ({_li_first_wins()}), "
    "n AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.l_orderkey = b.l_orderkey "
    "AND ex.l_linenumber = b.l_linenumber)) "
    f"SELECT {_LI_SELECT}, 1 AS load_no FROM ex UNION ALL SELECT {_LI_SELECT}, 2 AS load_no FROM n"
)

_W_COLS = ["user_id", "amount", "bank", "created_at", "payment_type"]
NULLABLE_KEY_SQL = (
    f"WITH w AS (SELECT {', '.join(_W_COLS)} FROM {standin_sql('wallet.withdraw_funds')}), "
    f"r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY bank ORDER BY {_order_list(_W_COLS)}) AS rn FROM w), "
    f"f AS (SELECT {', '.join(_W_COLS)} FROM r WHERE rn = 1 OR bank IS NULL), "
    "s AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM f AS e WHERE e.bank = f.bank)) "
    f"SELECT {', '.join(_W_COLS)}, 1 AS load_no FROM f "
    f"UNION ALL SELECT {', '.join(_W_COLS)}, 2 AS load_no FROM s"
)

_USER_COLS = [n for n, _ in USERS.columns if n != "id"]
_USER_ORDER = _order_list(_USER_COLS)
APPEND_SNAPSHOTS_SQL = (
    f"WITH m AS ({USERS_SQL}), n AS (SELECT count(*) AS n FROM m) "
    f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_USER_ORDER}) AS INTEGER) AS id, m.*, 1 AS load_no FROM m "
    f"UNION ALL SELECT CAST((SELECT n FROM n) + ROW_NUMBER() OVER (ORDER BY {_USER_ORDER}) AS INTEGER) AS id, "
    "m.*, 2 AS load_no FROM m"
)

FULL_REFRESH_SQL = (
    f"WITH rt AS {standin_sql('admin.referral_transactions')}, "
    "q AS (SELECT id, investor_id AS referred_user_id, campaign_id, commission_amount, "
    "commission_percentage, ref_id AS referral_user_id, status, created_at, updated_at "
    "FROM rt WHERE id IS NOT NULL) "
    "SELECT " + ", ".join(conform_sql(REFERRALS, n, t) for n, t in REFERRALS.columns) + " FROM q"
)

_CT_COLS = [n for n, _ in CAMPAIGN_TRANSACTIONS.columns]
SURROGATE_ID_SQL = (
    f"WITH m AS ({TRANSACTIONS_SQL}) "
    "SELECT CAST(1000 + ROW_NUMBER() OVER (ORDER BY "
    + _order_list(["transaction_date"] + [x for x in _CT_COLS if x != "transaction_date"])
    + ") AS BIGINT) AS row_id, m.* FROM m"
)

LOAD_REPORT_SQL = (
    f"WITH ex AS ({_li_first_wins("WHERE l_linestatus = 'F'")}), "
    "g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber), "
    "f AS (SELECT g.n, EXISTS (SELECT 1 FROM ex WHERE ex.l_orderkey = g.l_orderkey "
    "AND ex.l_linenumber = g.l_linenumber) AS present FROM g) "
    "SELECT CAST(sum(n) AS BIGINT) AS read, CAST(sum(n - 1) AS BIGINT) AS deduped_in_batch, "
    "count(*) FILTER (WHERE present) AS already_present, "
    "count(*) FILTER (WHERE NOT present) AS written FROM f"
)

TYPED_KEY_DECIMAL_SQL = (
    "WITH t AS (SELECT o_orderkey, o_custkey, CASE o_orderkey % 8 WHEN 0 THEN o_custkey || '.0' "
    "WHEN 1 THEN o_custkey || '0e-1' WHEN 2 THEN o_custkey || '.5' WHEN 3 THEN o_custkey || 'abc' "
    "WHEN 4 THEN o_custkey || '.00000000001' WHEN 5 THEN o_custkey || '.000000000000' WHEN 6 THEN '0.0000000000' || o_custkey "
    "ELSE CAST(o_custkey AS VARCHAR) END AS key_text FROM orders) "
    "SELECT c_custkey, o_orderkey, key_text FROM customer LEFT JOIN t "
    "ON c_custkey = o_custkey AND (o_orderkey % 8 IN (0, 1, 5, 7) OR o_orderkey % 8 = 6 AND o_custkey = 0)"
)

# the text of each case, and what it must become
CONFORM_TEXT_NUMBERS_SQL = (
    "SELECT o_orderkey, case_no, "
    "CAST(CASE case_no WHEN 0 THEN 0.00 WHEN 1 THEN 9999999999999999.99 WHEN 2 THEN -9999999999999999.99 WHEN 4 THEN 12 "
    "WHEN 5 THEN 2024 WHEN 6 THEN 0.01 WHEN 7 THEN o_orderkey + 0.5 END AS DECIMAL(18,2)) AS amount, "
    "CAST(CASE case_no WHEN 0 THEN 0.00 WHEN 1 THEN 9999999999999999.99 WHEN 2 THEN -9999999999999999.99 WHEN 3 THEN 12 "
    "WHEN 4 THEN 12 WHEN 5 THEN 2024 WHEN 6 THEN 0.01 WHEN 7 THEN o_orderkey + 0.5 END AS DECIMAL(18,2)) AS amount_zero, "
    "CAST(CASE case_no WHEN 0 THEN 0 WHEN 1 THEN 2147483647 WHEN 2 THEN -2147483648 WHEN 4 THEN 12 "
    "WHEN 5 THEN 2024 WHEN 6 THEN 0 WHEN 7 THEN o_orderkey + 1 END AS INTEGER) AS whole, "
    "CAST(NULL AS DATE) AS day FROM (SELECT o_orderkey, o_orderkey % 8 AS case_no FROM orders)"
)

REFERRAL_LOG_SQL = mart_sql(
    replace(REFERRALS, key=()),
    {"rt": standin_sql("admin.referral_transactions")},
    "SELECT id, investor_id AS referred_user_id, campaign_id, commission_amount, commission_percentage, "
    "ref_id AS referral_user_id, status, created_at, updated_at FROM rt WHERE id IS NOT NULL",
)
_REFERRAL_ROWS = f"SELECT * FROM ({REFERRALS_SQL})"
LOAD_NULLABLE_KEY_SQL = (
    # NULL keys come in with each of the two loads, others once
    f"WITH m AS ({WITHDRAW_SQL}) SELECT {', '.join(q(n) for n, _ in WALLET_WITHDRAW_FUNDS.columns if n != 'id')} FROM m "
    f"UNION ALL SELECT {', '.join(q(n) for n, _ in WALLET_WITHDRAW_FUNDS.columns if n != 'id')} FROM m "
    f"WHERE {' OR '.join(q(k) + ' IS NULL' for k in WALLET_WITHDRAW_FUNDS.key)}"
)
LOAD_APPEND_SQL = f"WITH m AS ({USERS_SQL}) SELECT * FROM m UNION ALL SELECT * FROM m"
LOAD_COUNTS_SQL = (
    f"WITH m AS ({REFERRALS_SQL}), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE status = 'F') AS f FROM m), "
    f"raw AS (SELECT count(*) AS n, count(*) FILTER (WHERE status = 'F') AS f FROM {standin_sql('admin.referral_transactions')} WHERE id IS NOT NULL) "
    "SELECT 1 AS load_no, raw.f AS read, raw.f - n.f AS deduped_in_batch, 0 AS already_present, n.f AS written, false AS skipped_empty FROM n, raw "
    "UNION ALL SELECT 2, raw.n, raw.n - n.n, n.f, n.n - n.f, false FROM n, raw "
    "UNION ALL SELECT 3, raw.n, raw.n - n.n, n.n, 0, false FROM n, raw"
)

_MIXED_CASE = ("SELECT c_custkey, CASE WHEN c_custkey % 17 <> 0 THEN CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) "
               "WHEN 1 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) ELSE c_mktsegment END END AS segment, "
               "CAST(c_nationkey AS INTEGER) AS nation FROM customer")
LOAD_COLLATED_KEY_SQL = (
    f"WITH s AS ({_MIXED_CASE}), even AS (SELECT lower(segment) AS k, nation, min(c_custkey) AS first FROM s WHERE c_custkey % 2 = 0 GROUP BY 1, 2), "
    "every AS (SELECT lower(segment) AS k, nation, min(c_custkey) AS first FROM s GROUP BY 1, 2), "
    "kept AS (SELECT coalesce(even.first, every.first) AS c_custkey FROM every LEFT JOIN even USING (k, nation) WHERE k IS NOT NULL) "
    "SELECT s.* FROM s JOIN kept USING (c_custkey) "
    # NULL segments come in with each load
    "UNION ALL SELECT * FROM s WHERE segment IS NULL UNION ALL SELECT * FROM s WHERE segment IS NULL AND c_custkey % 2 = 0"
)

ORACLES: dict[str, str] = {
    "referrals_mart": REFERRALS_SQL,
    "transactions_mart": TRANSACTIONS_SQL,
    "reserved_column": RESERVED_COLUMN_SQL,
    "bank_mart": BANK_SQL,
    "campaign_mart": CAMPAIGN_SQL,
    "issuer_mart": ISSUER_SQL,
    "users_mart": USERS_SQL,
    "bridge_lookup": BRIDGE_LOOKUP_SQL,
    "orphan_fact_join": ORPHAN_FACT_JOIN_SQL,
    "add_funds_mart": ADD_FUNDS_SQL,
    "withdraw_mart": WITHDRAW_SQL,
    "typed_key_join": TYPED_KEY_JOIN_SQL,
    "json_fields": JSON_FIELDS_SQL,
    "json_array_path": JSON_ARRAY_PATH_SQL,
    "json_null_literal": JSON_NULL_LITERAL_SQL,
    "full_name_concat": FULL_NAME_SQL,
    "decode_codes": DECODE_CODES_SQL,
    "nan_to_null": NAN_TO_NULL_SQL,
    "distinct_collated": DISTINCT_COLLATED_SQL,
    "conform_types": CONFORM_TYPES_SQL,
    "insert_ignore_first_wins": FIRST_WINS_SQL,
    "insert_ignore_existing": INSERT_IGNORE_EXISTING_SQL,
    "insert_ignore_nullable_key": NULLABLE_KEY_SQL,
    "append_snapshots": APPEND_SNAPSHOTS_SQL,
    "full_refresh": FULL_REFRESH_SQL,
    "surrogate_id": SURROGATE_ID_SQL,
    "load_report": LOAD_REPORT_SQL,
    "incremental_referrals": REFERRALS_SQL,
    "bank_mart_split": BANK_SQL,
    "campaign_mart_split": CAMPAIGN_SQL,
    "issuer_mart_split": ISSUER_SQL,
    "users_mart_split": USERS_SQL,
    "add_funds_mart_split": ADD_FUNDS_SQL,
    "withdraw_mart_split": WITHDRAW_SQL,
    "typed_key_decimal_text": TYPED_KEY_DECIMAL_SQL,
    "conform_text_numbers": CONFORM_TEXT_NUMBERS_SQL,
    "load_insert_ignore": _REFERRAL_ROWS,
    "load_nullable_key": LOAD_NULLABLE_KEY_SQL,
    "load_append": LOAD_APPEND_SQL,
    "load_refresh": f"SELECT * FROM ({ISSUER_SQL})",
    "load_empty_refresh": f"SELECT * FROM ({ADD_FUNDS_SQL})",
    "load_counts": LOAD_COUNTS_SQL,
    "surrogate_no_order": f"WITH m AS ({CAMPAIGN_SQL}) SELECT count(*) AS n, 501 AS first_id, 500 + count(*) AS last_id, "
                          "count(*) AS n_ids, count(DISTINCT campaign_id) AS n_campaigns FROM m",
    "insert_ignore_indexed": _REFERRAL_ROWS,
    # the log has no key: repeated rows of the source stay
    "append_exactly_once": f"WITH m AS ({REFERRAL_LOG_SQL}) SELECT * FROM m UNION ALL SELECT * FROM m",
    "nullable_key_exactly_once": LOAD_NULLABLE_KEY_SQL,
    "refresh_versioned": f"WITH m AS ({REFERRAL_LOG_SQL}) SELECT *, 'before' AS reader FROM m UNION ALL SELECT *, 'between' FROM m "
                         "UNION ALL SELECT *, 'after' FROM m WHERE status = 'F'",
    "incremental_log": REFERRAL_LOG_SQL,
    # what went into the documents, without a document
    "json_deep_paths": "SELECT o_orderkey, CASE WHEN ok THEN CAST(o_orderkey AS VARCHAR) END AS first_d, CASE WHEN ok AND said THEN o_orderpriority END AS first_e, "
                       "CASE WHEN ok THEN CAST(o_custkey AS VARCHAR) END AS second_d, CASE WHEN ok THEN o_orderstatus END AS second_e, NULL AS third, "
                       "CASE WHEN ok THEN o_orderstatus END AS status, NULL AS nowhere, "
                       "CASE WHEN ok AND said THEN o_orderpriority WHEN ok THEN 'null' END AS first_e_literal, NULL AS nowhere_literal, "
                       "CASE WHEN ok THEN o_orderstatus END AS second_e_literal "
                       "FROM (SELECT *, o_orderkey % 5 <> 0 AS ok, o_orderkey % 3 <> 0 AS said FROM orders)",
    "distinct_collated_rows": f"SELECT min(segment) AS segment, nation FROM ({_MIXED_CASE}) GROUP BY lower(segment), nation",
    "load_collated_key": LOAD_COLLATED_KEY_SQL,
    "distinct_fingerprint": "SELECT DISTINCT * FROM lineitem",
    "load_rejected_cells": "SELECT o_orderkey, 'title' AS \"column\", 'converted' AS rule, o_orderpriority AS value FROM orders WHERE length(o_orderpriority) > 5 "
                           "UNION ALL SELECT o_orderkey, 'amount', 'converted', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) FROM orders "
                           "WHERE CAST(o_totalprice AS DECIMAL(12,2)) > 999.99 "
                           "UNION ALL SELECT o_orderkey, 'day', 'converted', '2024-13-01' FROM orders WHERE o_orderstatus = 'F' "
                           "UNION ALL SELECT o_orderkey, 'qty', 'defaulted', NULL FROM orders WHERE o_orderkey % 3 = 0",
}
