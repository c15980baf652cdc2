"""The eight reporting marts as DataFrame queries over the operational tables.

Each ``*_query(src)`` takes a ``SourceRegistry`` and returns the query-level
result under the source jobs' output column names (before conforming to the
target). ``MARTS`` ties each query to its target spec.

Join plans are written for scale:

* small dimensions (countries, types, categories) go through ``checked_broadcast``;
* chains that hang off a NULL-able key are pre-joined on their own first
  (``kyc_infos`` with ``kyc_ex_platforms``, ``user_types`` with ``types``,
  ``users`` with ``user_bank_infos``) and then joined to the fact once. For left
  joins whose second predicate references only the joined side this is the
  same result, and no join ever hashes the NULL-extended rows of a previous
  outer join into one partition;
* right joins are written as left joins from the preserved fact side;
* fan-out left joins go through ``skew_safe_left_join``: inner join (AQE may
  split a hot key on both sides) + anti join against the distinct keys + the
  NULL-key rows, which never enter an exchange. ``strategy`` fixes its form
  (``"split"`` or ``"broadcast"``) whatever the size;
* joins whose output is unused under DISTINCT are placed last, where the
  optimizer removes them (see ``tests/test_plans.py``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martsmith.functions.scalar import PAYMENT_TYPE_LABELS, decode_codes, full_name, json_fields
from martsmith.operators.dedup import distinct_rows
from martsmith.operators.joins import checked_broadcast, skew_safe_left_join, typed_key
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
from martsmith.sources.registry import SourceRegistry

c = F.col


def bank_query(src: SourceRegistry, strategy: str = "auto") -> DataFrame:
    """JOB-1: users LEFT JOIN user_bank_infos, ids not NULL, DISTINCT."""
    u = src["accounts.users"].where(c("id").isNotNull()).select(c("id").alias("user_id"))
    ub = src["admin.user_bank_infos"].select(
        c("user_id").alias("ub_user_id"), "bank_name", "ac_name", "ac_no", "branch",
        "swift_code", "iban", "home_address",
    )
    q = skew_safe_left_join(u, ub, "user_id", "ub_user_id", strategy).drop("ub_user_id")
    return distinct_rows(q)


_CAMPAIGN_PASSTHROUGH = [
    "order", "title", "short_desc", "user_id", "progress_type_id", "start_date", "end_date",
    "min_amount", "max_amount", "project_timeline", "max_predefined_amount",
    "min_predefined_amount", "funding_goal", "currency", "max_equity_offered",
    "min_equity_offered", "divident_target", "roi_after_tax", "irr_after_tax",
    "recommended_amount", "contributor_table", "location",
]
_CAMPAIGN_PASSTHROUGH_2 = [
    "admin_aproval", "draft", "approved_by", "approved_at", "timeline_start_date",
    "timeline_end_date", "payout_notify", "created_at", "deleted_at", "updated_at",
    "campaign_type", "campaign_end_method", "campaign_opened_at", "campaign_closed_at",
    "status", "is_public", "is_private", "meta_title", "campaign_close_request",
]


def campaign_query(src: SourceRegistry, strategy: str = "auto") -> DataFrame:
    """JOB-2: campaign_masters LEFT JOIN user_types (fan-out) LEFT JOIN admin countries."""
    cm = src["admin.campaign_masters"].where(c("id").isNotNull())
    ut = src["accounts.user_types"].select(c("user_id").alias("ut_user_id"), c("type_id").alias("user_type_id"))
    co = src["admin.countries"].select(c("id").alias("co_id"), c("name").alias("country_name"))
    j = skew_safe_left_join(cm, ut, "user_id", "ut_user_id", strategy)
    j = j.join(checked_broadcast(co), c("country_id") == c("co_id"), "left")
    return j.select(
        c("id").alias("campaign_id"),
        *[c(f"`{n}`") for n in _CAMPAIGN_PASSTHROUGH],
        c("country_name"),
        *[c(n) for n in _CAMPAIGN_PASSTHROUGH_2],
        c("user_type_id"),
    )


def campaign_transactions_query(src: SourceRegistry) -> DataFrame:
    """JOB-3: projection of campaign_transactions, ``campaign_id`` renamed."""
    ct = src["admin.campaign_transactions"]
    cols = [n for n, _ in CAMPAIGN_TRANSACTIONS.columns]
    return ct.where(c("id").isNotNull()).select(
        *[c("campaign_id").alias(n) if n == "campaign_transactions_id" else c(n) for n in cols]
    )


def issuer_onboardings_query(src: SourceRegistry, strategy: str = "auto") -> DataFrame:
    """JOB-4: issuer_onboardings LEFT JOIN campaign_masters on the issuer's user id."""
    i = src["admin.issuer_onboardings"].where(c("issuer_id").isNotNull())
    b = src["admin.campaign_masters"].select(c("id").alias("campaign_id"), c("user_id").alias("b_user_id"))
    passthrough = [n for n, _ in ISSUER_ONBOARDINGS.columns
                   if n not in ("id", "campaign_id", "issuer_id", "on_boarding_status")]
    return skew_safe_left_join(i, b, "issuer_id", "b_user_id", strategy).select(
        c("issuer_id"),
        c("campaign_id"),
        *[c(n) for n in passthrough],
        c("status").alias("on_boarding_status"),
    )


def referrals_query(src: SourceRegistry) -> DataFrame:
    """JOB-5: referral_transactions with two role renames."""
    rt = src["admin.referral_transactions"]
    return rt.where(c("id").isNotNull()).select(
        c("id"),
        c("investor_id").alias("referred_user_id"),
        c("campaign_id"),
        c("commission_amount"),
        c("commission_percentage"),
        c("ref_id").alias("referral_user_id"),
        c("status"),
        c("created_at"),
        c("updated_at"),
    )


# KYC document paths read by the users mart, and their output names.
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

_USER_COLS = [
    "email", "role_id", "email_verified_at", "investor_category_id", "phone_code", "phone",
    "is_approved", "login_with", "is_admin",
]
_USER_COLS_2 = [
    "gender", "dob", "namescan_id", "namescan_match_rate", "kyc_general_match_status",
    "platform_ref", "maala_result",
]


def users_query(src: SourceRegistry, json_null: str = "sql", dead_joins: bool = True, strategy: str = "auto",
                distinct: Callable[[DataFrame], DataFrame] = distinct_rows) -> DataFrame:
    """JOB-6: the users star - 10 left joins, JSON extraction, DISTINCT on 45 columns.

    The KYC documents are parsed once per document (before the fan-out); the
    KYC chain and the user-type bridge are pre-joined on their own, both
    fan-outs go through ``skew_safe_left_join``, and the three unused joins
    come last, where the optimizer removes them. ``distinct`` is the DISTINCT step: a caller that stores the
    rows anyway may take the form for stored rows. No aggregate is then above the unused joins, so each meets its table's
    distinct keys, which add no row and let the optimizer drop the join by itself."""
    u = src["accounts.users"].where(c("id").isNotNull()).alias("u")
    cntrs = checked_broadcast(src["accounts.countries"]).alias("cntrs")
    a = src["accounts.aml_stores"].alias("a")
    ic = checked_broadcast(src["accounts.investor_categories"]).alias("ic")

    # bridge: user_types -> types (JN-07 + JN-08); a user's equal types are one, as under the DISTINCT, before they multiply the rows
    bt = distinct_rows(
        src["accounts.user_types"].alias("b")
        .join(checked_broadcast(src["accounts.types"]).alias("ct"), c("b.type_id") == c("ct.id"), "left")
        .select(c("b.user_id").alias("bt_user_id"), c("ct.type").alias("user_type"))
    )
    # chain: kyc_infos (JSON parsed once) -> kyc_ex_platforms (JN-09 + JN-10)
    k = json_fields(
        src["accounts.kyc_infos"].select(
            c("id").alias("k_id"), typed_key(c("namescan_id")).alias("k_user_id"),
            c("maala_data").alias("k_doc"),
        ),
        "k_doc", KYC_JSON_PATHS, json_null=json_null,
    )
    ke = src["accounts.kyc_ex_platforms"].select(
        c("id").alias("kyc_id"), c("kyc_info_id"),
        c("investor_category_id").alias("kyc_investor_category_id"),
        c("annual_salary"), c("net_worth"), c("status").alias("kyc_status"),
    )
    kyc = skew_safe_left_join(k, ke, "k_id", "kyc_info_id", strategy, preserved_keys=src["accounts.kyc_infos"].select("id")).drop("k_id")

    # both per-user fan-outs go through the skew-safe form: KYC straight off the users
    # scan, then the type bridge off that result (dealt out anew by u_id once, the
    # exchange serves both branches)
    uid = u.select(c("u.id").alias("u_id"), *[c(f"u.`{n}`").alias(f"u_{n}") for n in u.columns if n != "id"])
    by_kyc = skew_safe_left_join(uid, kyc, "u_id", "k_user_id", strategy,
                                 other_keys=src["accounts.kyc_infos"].select(typed_key(c("namescan_id"))))
    j = (
        skew_safe_left_join(by_kyc, bt, "u_id", "bt_user_id", strategy,
                            other_keys=src["accounts.user_types"].select("user_id"), preserved_keys=u.select("id"))
        .join(cntrs, c("u_country_id") == c("cntrs.id"), "left")
        .join(a, c("u_id") == c("a.id"), "left")
        .join(ic, c("u_investor_category_id") == c("ic.id"), "left")
    )
    if dead_joins:
        # JN-06, JN-11, JN-14: written in the source query, no column used.
        def key_set(table: str, key: str, of: str) -> DataFrame:
            return src[table].select(c(key).try_cast(j.schema[of].dataType).alias("id")).distinct()

        j = (
            j.join(key_set("accounts.cities", "id", "u_country_id").alias("cities"), c("u_country_id") == c("cities.id"), "left")
            .join(key_set("accounts.states", "id", "u_id").alias("s"), c("u_id") == c("s.id"), "left")
            .join(key_set("accounts.user_types", "user_id", "u_id").alias("utp"), c("u_id") == c("utp.id"), "left")
        )
    q = j.select(
        c("u_id").alias("user_id"),
        c("u_email").alias("email"),
        full_name(c("u_first_name"), c("u_last_name")).alias("full_name"),
        *[c(f"u_{n}").alias(n) for n in _USER_COLS[1:]],
        c("u_created_at").alias("user_created_at"),
        c("u_updated_at").alias("user_updated_at"),
        *[c(f"u_{n}").alias(n) for n in _USER_COLS_2],
        c("cntrs.name").alias("country"),
        c("user_type"),
        c("a.aml_record"),
        c("kyc_id"), c("kyc_info_id"), c("kyc_investor_category_id"),
        c("annual_salary"), c("net_worth"), c("kyc_status"),
        c("ic.title").alias("investor_category_title"),
        c("ic.type").alias("investor_category_type"),
        *[c(n) for n in KYC_JSON_PATHS],
    )
    return distinct(q)


def wallet_add_funds_query(src: SourceRegistry, strategy: str = "auto") -> DataFrame:
    """JOB-7: users RIGHT JOIN fund_users LEFT JOIN add_funds, payment code decoded, DISTINCT.

    Written from the preserved bridge: fund_users LEFT JOIN add_funds (skew-safe
    fan-out) LEFT JOIN users (unique-key lookup); both joins hang off fund_users,
    so their order does not change the rows."""
    fu = src["wallet.fund_users"].select(c("user_id").alias("fu_user_id"), c("fund_id"))
    u = src["accounts.users"].select(c("id").alias("u_id"))
    a = src["wallet.add_funds"].select(
        c("id").alias("a_id"),
        c("amount").alias("add_funds_amount"),
        c("currency").alias("add_funds_currency"),
        c("base_currency").alias("add_funds_base_currency_USD"),
        c("converted_amount").alias("add_funds_converted_amount_USD"),
        c("updated_amount").alias("add_funds_updated_amount"),
        c("date").alias("add_funds_date"),
        decode_codes(c("payment_type"), PAYMENT_TYPE_LABELS).alias("add_funds_payment_type"),
        c("transaction_id").alias("add_funds_transaction_id"),
        c("is_approved").alias("add_funds_status"),
        c("created_at").alias("add_funds_created_at"),
        c("updated_at").alias("add_funds_updated_at"),
    )
    # the fan-out join (a fund with many add_funds rows) goes skew-safe straight off the
    # bridge scan; the unique-key users lookup follows (AQE splits a hot preserved side)
    j = skew_safe_left_join(fu, a, "fund_id", "a_id", strategy)
    j = j.join(u, c("fu_user_id") == c("u_id"), "left")
    q = j.select(c("u_id").alias("user_id"), *[n for n in a.columns if n != "a_id"])
    return distinct_rows(q)


def wallet_withdraw_funds_query(src: SourceRegistry, strategy: str = "auto") -> DataFrame:
    """JOB-8: users RIGHT JOIN withdraw_funds LEFT JOIN user_bank_infos (on the users-side key).

    The bank join only references ``u.id``, so users are joined to their bank
    infos first and the withdrawals then keep every row (orphans get NULLs)."""
    w = src["wallet.withdraw_funds"].select(
        c("user_id").alias("w_user_id"),
        c("amount").alias("withdraw_funds_amount"),
        c("currency").alias("withdraw_funds_currency"),
        c("base_currency").alias("withdraw_funds_base_currency"),
        c("exchange_rate").alias("withdraw_funds_exchange_rate"),
        c("converted_amount").alias("withdraw_funds_converted_amount"),
        c("remaining_balance").alias("withdraw_funds_remaining_balance"),
        c("bank").alias("withdraw_funds_bank_id"),
        decode_codes(c("payment_type"), PAYMENT_TYPE_LABELS).alias("withdraw_funds_payment_type"),
        c("is_processed").alias("withdraw_funds_status"),
        c("created_at").alias("withdraw_funds_created_at"),
        c("updated_at").alias("withdraw_funds_updated_at"),
    )
    ub = src["admin.user_bank_infos"].select(
        c("user_id").alias("ub_user_id"), c("bank_name"), c("ac_name").alias("account_name"),
        c("ac_no").alias("account_num"), c("country_id"), c("branch"), c("iban"),
        c("home_address"), c("swift_code"),
    )
    # users without an id can never match a withdrawal: filtered before the join
    u = src["accounts.users"].where(c("id").isNotNull()).select(c("id").alias("u_id"))
    ubank = skew_safe_left_join(u, ub, "u_id", "ub_user_id", strategy).drop("ub_user_id")
    # ubank keeps every user, so its key set is the users' ids
    j = skew_safe_left_join(w, ubank, "w_user_id", "u_id", strategy, other_keys=u)
    return j.select(
        c("u_id").alias("user_id"),
        *[n for n in w.columns if n != "w_user_id"],
        *[n for n in ubank.columns if n != "u_id"],
    )


@dataclass(frozen=True)
class MartSpec:
    name: str
    target: TargetSpec
    query: Callable[[SourceRegistry], DataFrame]
    sources: tuple[str, ...]


MARTS: dict[str, MartSpec] = {
    m.name: m
    for m in (
        MartSpec("bank", BANK, bank_query, ("accounts.users", "admin.user_bank_infos")),
        MartSpec("campaign", CAMPAIGN, campaign_query,
                 ("admin.campaign_masters", "accounts.user_types", "admin.countries")),
        MartSpec("campaign_transactions", CAMPAIGN_TRANSACTIONS, campaign_transactions_query,
                 ("admin.campaign_transactions",)),
        MartSpec("issuer_onboardings", ISSUER_ONBOARDINGS, issuer_onboardings_query,
                 ("admin.issuer_onboardings", "admin.campaign_masters")),
        MartSpec("referrals", REFERRALS, referrals_query, ("admin.referral_transactions",)),
        MartSpec("users", USERS, users_query,
                 ("accounts.users", "accounts.countries", "accounts.cities", "accounts.user_types",
                  "accounts.types", "accounts.kyc_infos", "accounts.kyc_ex_platforms",
                  "accounts.states", "accounts.aml_stores", "accounts.investor_categories")),
        MartSpec("wallet_add_funds", WALLET_ADD_FUNDS, wallet_add_funds_query,
                 ("accounts.users", "wallet.fund_users", "wallet.add_funds")),
        MartSpec("wallet_withdraw_funds", WALLET_WITHDRAW_FUNDS, wallet_withdraw_funds_query,
                 ("accounts.users", "wallet.withdraw_funds", "admin.user_bank_infos")),
    )
}
