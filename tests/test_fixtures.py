"""Micro fixtures: one small literal input per trap of the source jobs."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martsmith.functions.scalar import PAYMENT_TYPE_LABELS, decode_codes, full_name, json_fields, nan_to_null
from martsmith.operators.conform import conform
from martsmith.operators.dedup import distinct_rows
from martsmith.plans.jobs import bank_query, campaign_query, users_query, wallet_withdraw_funds_query
from martsmith.plans.runner import load_frame, load_mart, mart_rows
from martsmith.schemas import TargetSpec
from martsmith.sinks import ParquetTarget
from martsmith.sources.registry import SourceRegistry
from martsmith.sources.standins import standin_registry
from tests.conftest import SF0001, rows

_SCHEMAS: dict = {}


def table(spark, name, records):
    """A literal source table with the stand-in's columns; unspecified columns are NULL."""
    if name not in _SCHEMAS:
        raw = standin_registry(spark, SF0001)[name].schema
        _SCHEMAS[name] = T.StructType([T.StructField(f.name, f.dataType, True) for f in raw.fields])
    schema = _SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


def reg(spark, **tables):
    return SourceRegistry(spark, {k.replace("__", "."): v for k, v in tables.items()})


def test_bank_two_accounts(spark):
    src = reg(
        spark,
        accounts__users=table(spark, "accounts.users", [{"id": 1}, {"id": 2}, {"id": None}]),
        admin__user_bank_infos=table(spark, "admin.user_bank_infos", [
            {"user_id": 1, "bank_name": "B"}, {"user_id": 1, "bank_name": "A"},
            {"user_id": 1, "bank_name": "A"},
        ]),
    )
    assert bank_query(src).count() == 3  # DISTINCT folds the exact duplicate; NULL id dropped
    out = rows(mart_rows(src, "bank"), "user_id", "bank_name")
    assert out == [(1, "A"), (2, None)]  # first by total order


def test_bank_late_account(spark, tmp_path):
    target = ParquetTarget(__import__("martsmith").TARGETS["bank"], str(tmp_path / "bank"))
    first = reg(spark, accounts__users=table(spark, "accounts.users", [{"id": 2}]),
                admin__user_bank_infos=table(spark, "admin.user_bank_infos", []))
    second = reg(spark, accounts__users=table(spark, "accounts.users", [{"id": 2}]),
                 admin__user_bank_infos=table(spark, "admin.user_bank_infos",
                                              [{"user_id": 2, "bank_name": "Late"}]))
    load_mart(spark, first, "bank", target)
    report = load_mart(spark, second, "bank", target)
    assert report.already_present == 1 and report.written == 0
    assert rows(target.read(spark), "id", "user_id", "bank_name") == [(1, 2, None)]


def test_campaign_fanout(spark):
    src = reg(
        spark,
        admin__campaign_masters=table(spark, "admin.campaign_masters", [
            {"id": 10, "user_id": 5, "country_id": 1}, {"id": 11, "user_id": 6, "country_id": 99},
        ]),
        accounts__user_types=table(spark, "accounts.user_types", [
            {"user_id": 5, "type_id": 3}, {"user_id": 5, "type_id": 1}, {"user_id": 5, "type_id": 2},
        ]),
        admin__countries=table(spark, "admin.countries", [{"id": 1, "name": "Oman"}]),
    )
    assert campaign_query(src).count() == 4
    assert rows(mart_rows(src, "campaign"), "campaign_id", "user_type_id", "country_name") == [
        (10, 1, "Oman"), (11, None, None)]


def test_issuer_no_campaign(spark):
    src = reg(
        spark,
        admin__issuer_onboardings=table(spark, "admin.issuer_onboardings", [
            {"issuer_id": 7, "email": "a@x"}, {"issuer_id": 7, "email": "b@x"},
            {"issuer_id": 8, "email": "c@x"}, {"issuer_id": None, "email": "d@x"},
        ]),
        admin__campaign_masters=table(spark, "admin.campaign_masters", [
            {"id": 100, "user_id": 8}, {"id": 101, "user_id": 8},
        ]),
    )
    out = rows(mart_rows(src, "issuer_onboardings"), "campaign_id", "issuer_id", "email")
    assert out == [(0, 7, "a@x"), (100, 8, "c@x"), (101, 8, "c@x")]


def _users_src(spark):
    return reg(
        spark,
        accounts__users=table(spark, "accounts.users", [
            {"id": 1, "first_name": "Ann", "last_name": "Lee", "country_id": 1, "investor_category_id": 1},
            {"id": 12, "first_name": "Bo", "last_name": None, "country_id": 2},
        ]),
        accounts__countries=table(spark, "accounts.countries", [{"id": 1, "name": "Oman"}]),
        accounts__cities=table(spark, "accounts.cities", [{"id": 1}, {"id": 1}]),
        accounts__user_types=table(spark, "accounts.user_types", [
            {"user_id": 1, "type_id": 1}, {"user_id": 1, "type_id": 2}]),
        accounts__types=table(spark, "accounts.types", [{"id": 1, "type": "investor"}, {"id": 2, "type": "issuer"}]),
        accounts__kyc_infos=table(spark, "accounts.kyc_infos", [
            {"id": 1, "namescan_id": "1", "maala_data": '{"CivilNumber": "C1", "PassportList": [{"PassportType_PassportNumber": "P1", "PassportType_DateOfIssue": "2020-01-31"}]}'},
            {"id": 2, "namescan_id": "abc", "maala_data": '{"CivilNumber": "C2"}'},
            {"id": 3, "namescan_id": None, "maala_data": None},
            {"id": 4, "namescan_id": "12abc", "maala_data": '{"CivilNumber": "C4"}'},
        ]),
        accounts__kyc_ex_platforms=table(spark, "accounts.kyc_ex_platforms", [
            {"id": 9, "kyc_info_id": 1, "status": "ok"}]),
        accounts__states=table(spark, "accounts.states", [{"id": 1}]),
        accounts__aml_stores=table(spark, "accounts.aml_stores", [{"id": 1, "aml_record": "clean"}]),
        accounts__investor_categories=table(spark, "accounts.investor_categories",
                                            [{"id": 1, "title": "Retail", "type": "retail"}]),
    )


def test_users_dead_joins_do_not_change_rows(spark):
    src = _users_src(spark)
    with_dead = users_query(src, dead_joins=True)
    without = users_query(src, dead_joins=False)
    assert rows(with_dead) == rows(without)
    assert with_dead.count() == 3  # user 1 x 2 types, user 12 alone


def test_kyc_typed_key_and_name(spark):
    out = rows(users_query(_users_src(spark)), "user_id", "kyc_id", "Malaa_Civil_Number", "full_name",
               "Malaa_Passport_Number")
    # only '1' matches (user 1); 'abc' and '12abc' never match, no error
    assert {(r[0], r[1], r[2]) for r in out} == {(1, 9, "C1"), (12, None, None)}
    assert {r[3] for r in out if r[0] == 12} == {None}  # NULL last name -> NULL full name
    conformed = mart_rows(_users_src(spark), "users")
    issue = {r["Malaa_Passport_Issue_Date"] for r in conformed.where("user_id = 1").collect()}
    assert issue == {dt.date(2020, 1, 31)}


def test_json_cases(spark):
    docs = spark.createDataFrame([
        (1, '{"a": "x", "L": [{"k": "e0"}, {"k": "e1"}]}'),
        (2, '{"b": "y"}'),
        (3, '{"a": null, "L": []}'),
        (4, '{broken'),
        (5, None),
        (6, '{"a": 7, "L": [{"k": null}]}'),
    ], "id int, doc string")
    paths = {"a": "$.a", "k0": "$.L[0].k"}
    out = {r["id"]: (r["a"], r["k0"]) for r in json_fields(docs, "doc", paths).collect()}
    assert out == {1: ("x", "e0"), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None),
                   6: ("7", None)}
    lit = {r["id"]: (r["a"], r["k0"]) for r in json_fields(docs, "doc", paths, json_null="literal").collect()}
    assert lit[3] == ("null", None) and lit[6] == ("7", "null") and lit[4] == (None, None)


def test_name_null_part(spark):
    df = spark.createDataFrame([("A", None), ("A", "B")], "f string, l string")
    assert [r[0] for r in df.select(full_name("f", "l")).collect()] == [None, "A B"]


def test_payment_codes(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "p int")
    out = [r[0] for r in df.select(decode_codes("p", PAYMENT_TYPE_LABELS)).collect()]
    assert out == ["Bank", "Credit/Debit", None, None]


def test_addfunds_orphans(spark):
    src = reg(
        spark,
        accounts__users=table(spark, "accounts.users", [{"id": 1}]),
        wallet__fund_users=table(spark, "wallet.fund_users", [
            {"user_id": 1, "fund_id": 10}, {"user_id": 42, "fund_id": 11},
            {"user_id": 1, "fund_id": 98}, {"user_id": 1, "fund_id": 99},
        ]),
        wallet__add_funds=table(spark, "wallet.add_funds", [
            {"id": 10, "transaction_id": "T10", "payment_type": 1},
            {"id": 11, "transaction_id": "T11", "payment_type": 2},
        ]),
    )
    out = rows(mart_rows(src, "wallet_add_funds"), "user_id", "add_funds_transaction_id",
               "add_funds_payment_type")
    # unknown user -> 0; the two missing funds collapse into one row with key ''
    assert out == [(0, "T11", None), (1, "", None), (1, "T10", None)]


def _withdraw_src(spark, withdrawals):
    return reg(
        spark,
        accounts__users=table(spark, "accounts.users", [{"id": 1}, {"id": 2}]),
        wallet__withdraw_funds=table(spark, "wallet.withdraw_funds", withdrawals),
        admin__user_bank_infos=table(spark, "admin.user_bank_infos", [
            {"user_id": 1, "bank_name": "B1"}, {"user_id": 99, "bank_name": "B99"}]),
    )


def test_withdraw_null_bank(spark, tmp_path):
    src = _withdraw_src(spark, [
        {"user_id": 1, "bank": None, "payment_type": 1}, {"user_id": 2, "bank": None, "payment_type": 2},
        {"user_id": 1, "bank": "5", "payment_type": 1}, {"user_id": 2, "bank": "5", "payment_type": 2},
    ])
    target = ParquetTarget(__import__("martsmith").TARGETS["wallet_withdraw_funds"], str(tmp_path / "w"))
    assert load_mart(spark, src, "wallet_withdraw_funds", target).written == 3
    assert load_mart(spark, src, "wallet_withdraw_funds", target).written == 2
    table_rows = target.read(spark)
    assert table_rows.count() == 5
    assert sorted(r.id for r in table_rows.collect()) == [1, 2, 3, 4, 5]
    kept = table_rows.where("withdraw_funds_bank_id = '5'").collect()
    assert [r.user_id for r in kept] == [1]  # first in u.id order


def test_withdraw_orphan_bank(spark):
    src = _withdraw_src(spark, [{"user_id": 99, "bank": "7"}])
    out = wallet_withdraw_funds_query(src).collect()
    assert len(out) == 1 and out[0].user_id is None and out[0].bank_name is None


def test_nan_cells(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (1.5,)], "x double")
    out = [r[0] for r in df.select(nan_to_null("x")).collect()]
    assert out[0] is None and out[1] == math.inf and out[2] == -math.inf and out[3] is None and out[4] == 1.5


def test_conform_limits(spark):
    spec = TargetSpec(
        "probe",
        (("s", "varchar(3)"), ("d", "decimal(5,2)"), ("day", "date"), ("n", "bigint"), ("t", "tinyint"),
         ("k", "varchar(10)")),
        not_null=("k",),
    )
    df = spark.createDataFrame([
        ("abcdef", 12345.678, "2024-13-01", "Bank", 300, None),
        ("ab", -99999.0, "2024-02-29", "12", -300, "x"),
        (None, 1.005, None, None, 5, "y"),
    ], "s string, d double, day string, n string, t int, k string")
    out = [tuple(r) for r in conform(df, spec).collect()]
    assert out[0] == ("abc", Decimal("999.99"), None, None, 127, "")
    assert out[1] == ("ab", Decimal("-999.99"), dt.date(2024, 2, 29), 12, -128, "x")
    assert out[2][1] == Decimal("1.01") and out[2][3] is None
    zero = [tuple(r) for r in conform(df, spec, on_bad_cast="zero").collect()]
    assert zero[0][3] == 0 and zero[2][3] is None  # NULL stays NULL, only bad text becomes 0
    counted = conform(df, spec, count_coerced=True).agg(F.sum("__coerced_cells")).first()[0]
    assert counted == 8  # row 1: cut, clamp, bad date, bad number, tinyint clamp, default; row 2: two clamps


def test_refresh_empty_keeps_target(spark, tmp_path):
    spec = TargetSpec("r", (("id", "bigint"), ("v", "varchar(10)")), key=("id",), mode="full_refresh")
    target = ParquetTarget(spec, str(tmp_path / "r"))
    full = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id long, v string")
    rep = load_frame(spark, full, spec, target)
    assert rep.written == 2 and rep.deduped_in_batch == 1
    rep = load_frame(spark, full.where("id < 0"), spec, target)
    assert rep.skipped_empty
    assert rows(target.read(spark)) == [(1, "a"), (2, "b")]
    rep = load_frame(spark, full.where("id = 2"), spec, target)
    assert rows(target.read(spark)) == [(2, "b")]


def test_append_twice(spark, tmp_path):
    spec = TargetSpec("a", (("id", "int"), ("v", "varchar(10)")), surrogate="id", mode="append", order=("v",))
    target = ParquetTarget(spec, str(tmp_path / "a"))
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "v string")
    load_frame(spark, df, spec, target)
    load_frame(spark, df, spec, target)
    out = rows(target.read(spark), "id", "v")
    assert out == [(1, "a"), (2, "b"), (3, "c"), (4, "a"), (5, "b"), (6, "c")]


@pytest.mark.parametrize("collation,expected", [(None, 3), ("UTF8_LCASE", 2), ("UNICODE_CI_AI", 1)])
def test_collation(spark, collation, expected):
    df = spark.createDataFrame([("Bank",), ("bank",), ("Bänk",)], "v string")
    assert distinct_rows(df, collation).count() == expected


def test_collated_insert_ignore_key(spark, tmp_path):
    spec = TargetSpec("c", (("k", "varchar(10)"), ("v", "int")), key=("k",), key_collation="UTF8_LCASE")
    target = ParquetTarget(spec, str(tmp_path / "c"))
    load_frame(spark, spark.createDataFrame([("Bank", 1)], "k string, v int"), spec, target)
    rep = load_frame(spark, spark.createDataFrame([("BANK", 2), ("bank", 3), ("Other", 4)], "k string, v int"),
                     spec, target)
    assert rep.written == 1 and rep.already_present == 1 and rep.deduped_in_batch == 1
    assert rows(target.read(spark)) == [("Bank", 1), ("Other", 4)]


def test_users_json_null_option(spark):
    src = standin_registry(spark, SF0001)
    default = mart_rows(src, "users").where("Malaa_Name2 = 'null'").count()
    literal = mart_rows(src, "users", json_null="literal").where("Malaa_Name2 = 'null'").count()
    assert default == 0 and literal > 0


@pytest.mark.parametrize("collation,expected", [(None, 3), ("UTF8_LCASE", 2), ("UTF8_LCASE_RTRIM", 1)])
def test_collation_trailing_blanks(spark, collation, expected):
    """Server collations ignore trailing blanks in comparisons: the ``_RTRIM`` collations."""
    df = spark.createDataFrame([("Bank",), ("bank ",), ("BANK",)], "v string")
    assert distinct_rows(df, collation).count() == expected


def test_json_paths_of_any_depth(spark):
    from martsmith.functions.scalar import json_fields, path_steps, path_tree

    assert path_steps("$.a.b[0].c") == ["a", "b", 0, "c"] and path_steps("$[2].x") == [2, "x"]
    for bad in ("a.b", "$", "$.a-b", "$.a[x]", "$.a[*]"):
        with pytest.raises(ValueError):
            path_steps(bad)
    assert path_tree({"p": "$.a.b", "q": "$.a.c", "r": "$.a"}) == {"a": {"b": {None: ["p"]}, "c": {None: ["q"]}, None: ["r"]}}
    docs = spark.createDataFrame([('{"a":{"b":[{"c":"x"},{"c":null}],"n":1.50},"t":"q"}',), ('[[1,{"k":"deep"}]]',), ("{broken",), (None,), ("{}",)], "doc string")
    paths = {"x": "$.a.b[0].c", "null": "$.a.b[1].c", "list": "$.a.b", "n": "$.a.n", "t": "$.t", "deep": "$[0][1].k"}
    got = [tuple(r) for r in json_fields(docs, "doc", paths).collect()]
    assert got[0] == ("x", None, '[{"c":"x"},{"c":null}]', "1.5", "q", None) or got[0] == ("x", None, '[{"c":"x"},{"c":null}]', "1.50", "q", None)
    assert got[1] == (None, None, None, None, None, "deep") and got[2:] == [(None,) * 6] * 3
    literal = json_fields(docs, "doc", paths, json_null="literal")
    assert [tuple(r) for r in literal.collect()] == [(*got[0][:1], "null", *got[0][2:]), *got[1:]]
    assert literal._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 1


def test_distinct_by_fingerprint(spark):
    from martsmith.operators.dedup import distinct_stored_rows

    rows = [(k % 40 if k % 3 else None, f"v{k % 5}" if k % 4 else None, float(k % 2)) for k in range(500)] + [(1000 + k, "single", 0.0) for k in range(300)]
    df = spark.createDataFrame(rows, "k int, v string, d double")
    for bound in (None, 0, 16):  # in two levels, and beyond the bound in one
        got = sorted(map(str, distinct_stored_rows(df, bound).collect()))
        assert got == sorted(map(str, df.distinct().collect()))
    assert distinct_stored_rows(df.limit(0)).count() == 0


def test_rows_that_share_a_fingerprint_both_stay(spark, monkeypatch):
    from martsmith.operators import dedup

    monkeypatch.setattr(dedup.F, "xxhash64", lambda *cols: F.lit(7).cast("long"))  # every row collides
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, None), (None, None)], "k int, v string")
    assert dedup.distinct_stored_rows(df).count() == 3


def test_distinct_of_fingerprinted_rows(spark):
    from martsmith.operators.dedup import FINGERPRINT, distinct_fingerprinted, fingerprinted

    rows = [(k % 40 if k % 3 else None, f"v{k % 5}" if k % 4 else None, float(k % 2)) for k in range(500)] + [(1000 + k, "single", 0.0) for k in range(300)]
    df, stored = spark.createDataFrame(rows, "k int, v string, d double"), []

    def store(part):
        stored.append(part.count())
        return part

    collided = df.withColumns({n: F.lit(7).cast("long") for n in FINGERPRINT})  # rows that merely share a fingerprint both stay
    for marked in (fingerprinted(df), collided):
        for bound in (None, 0, 16):
            got = distinct_fingerprinted(marked, store, bound)
            assert got.columns == marked.columns
            assert sorted(map(str, got.drop(*FINGERPRINT).collect())) == sorted(map(str, df.distinct().collect()))
    assert len(stored) == 6
    single = fingerprinted(df.where("v = 'single'"))
    assert distinct_fingerprinted(single, store) is single and distinct_fingerprinted(fingerprinted(df.limit(0)), store).count() == 0


@pytest.mark.parametrize("advised", ["2k", "64m"])
def test_ids_in_ranges(spark, tmp_path, advised):
    """Ids by ranges of stored rows: dense, in the declared order with NULLs first, a hot value spread over ranges."""
    from datetime import datetime

    from martsmith.operators.surrogate import number_in_ranges

    made = spark.range(6000).select(
        F.when(F.col("id") % 10 != 0, F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") * 7919) % 1000)).alias("u"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("s"), (F.col("id") % 13).cast("string"))).alias("s"),
        F.lit(datetime(2024, 3, 1)).cast("timestamp_ntz").alias("t"), F.xxhash64("id").alias("tie"), F.col("id").alias("n"))
    made.write.parquet(str(tmp_path / "rows"))
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advised)
    rows = own.read.parquet(str(tmp_path / "rows"))
    for order in (["u"], ["s", "u", "t"]):
        numbered = number_in_ranges(rows, rows.select(*order, "tie"), order, ["tie"], "no", 100)
        numbered.withColumn("part", F.spark_partition_id()).write.mode("overwrite").parquet(str(tmp_path / "out"))
        got = own.read.parquet(str(tmp_path / "out")).orderBy("no").collect()
        assert [r.no for r in got] == list(range(101, 6101)) and sorted(r.n for r in got) == list(range(6000))
        keys = [tuple((r[c] is not None, r[c]) for c in (*order, "tie")) for r in got]
        assert keys == sorted(keys)
        if advised == "2k":  # a third of the rows has one value
            sizes = {r.part: 0 for r in got}
            for r in got:
                sizes[r.part] += 1
            assert len(sizes) > 20 and max(sizes.values()) < 600
    none = rows.limit(0)
    assert number_in_ranges(none, none.select("u", "tie"), ["u"], ["tie"], "no").count() == 0
    with pytest.raises(ValueError, match="do not fit tinyint"):
        number_in_ranges(rows, rows.select("u", "tie"), ["u"], ["tie"], "no", id_type="tinyint")


def test_rejected_cells(spark, tmp_path):
    from martsmith.plans.runner import load_frame
    from martsmith.schemas import TargetSpec
    from martsmith.sinks import ParquetTarget

    spec = TargetSpec("r", (("k", "int"), ("v", "varchar(3)"), ("n", "tinyint")), not_null=("n",), key=("k",))
    raw = spark.createDataFrame([(1, "abcd", "12"), (2, "ok", "999"), (3, None, "x"), (4, "ok", None)], "k int, v string, n string")
    report = load_frame(spark, raw, spec, ParquetTarget(spec, str(tmp_path / "t")), rejects=str(tmp_path / "cells"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "cells")).collect())
    assert got == [(1, "v", "converted", "abcd"), (2, "n", "converted", "999"), (3, "n", "defaulted", "x"), (4, "n", "defaulted", None)]
    assert report.coerced_cells == len(got) and report.written == 4


def test_distinct_spellings(spark):
    from martsmith.operators.dedup import distinct_spellings

    df = spark.createDataFrame([("ab", 1), ("AB", 1), ("Ab", 2), (None, 1), (None, 1), ("ab", None), ("AB", None)], "v string, k int")
    got = sorted(map(tuple, distinct_spellings(df, "UTF8_LCASE").collect()), key=str)
    assert got == sorted([("AB", 1), ("Ab", 2), (None, 1), ("AB", None)], key=str)


def test_oracle_paths_are_those_of_the_mart():
    from martsmith.plans import jobs, oracles

    assert oracles.KYC_JSON_PATHS == jobs.KYC_JSON_PATHS and oracles.KYC_JSON_PATHS is not jobs.KYC_JSON_PATHS
