from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from martsmith.llm.toolcalls import calls_of, canonical, levels, link_tool_calls, op10_tool_calls

from .conftest import SF

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>, level int, errors int"
RESULTS = "conv_id long, turn long, call_id string, content string, json int"
FIELDS = [("a", "string", True), ("b", "integer", False), ("c", "number", False), ("d", "array", False), ("e", "object", False), ("f", "boolean", False), ("g", "null", False)]


@pytest.fixture(scope="module")
def schemas(spark):
    return spark.createDataFrame([("f", FIELDS), ("f", FIELDS), ("free", [])], "name string, fields array<struct<name:string,type:string,required:boolean>>")


def run(spark, schemas, calls, results=()):
    own = spark.createDataFrame([(*c, 0, 0) for c in calls], CALLS)
    rows = link_tool_calls(own, spark.createDataFrame([(*r, 0) for r in results], RESULTS), schemas).collect()
    return {(r.conv_id, r.call_id): r for r in rows}, rows


def test_links_and_errors(spark, schemas):
    got, rows = run(spark, schemas, [
        (1, 0, "x", "f", '{"c": 1.50, "a":"q\\u00e9\\n", "e": {"z":1, "b":[{"q":2,"p":null}]}, "d":[], "f":true, "g":null}', []),
        (1, 0, "x", "f", '{"c": 1.50, "a":"q\\u00e9\\n", "e": {"z":1, "b":[{"q":2,"p":null}]}, "d":[], "f":true, "g":null}', []),
        (1, 1, "y", "f", '{"a": 3, "b": 1.5, "z": 1}', ["x", "gone"]), (1, 2, "z", "f", 'nope "x"', ["y", "x", "x"]),
        (1, 3, "u", "g", "[1]", ["v"]), (1, 4, "v", "f", '{"a":"k"}', ["u"]), (1, 5, "w", "f", None, ["u"]), (2, 0, "x", "free", "{}", None),
        (2, 1, "late", "f", "{}", ["x"]), (2, 1, "late", "a", "{}", ["x"]), (None, 1, "x", "f", "{}", None), (3, 1, None, "f", "{}", None),
    ], [(1, 3, "x", 'res "1"'), (1, 9, "x", "later"), (1, 4, "nocall", "zz"), (1, 4, None, "zz"), (1, 4, "y", None)])
    assert {k: r.status for k, r in got.items() if None not in k} == {
        (1, "x"): "linked", (1, "y"): "linked", (1, "z"): "unanswered", (1, "u"): "unanswered", (1, "v"): "unanswered",
        (1, "w"): "unanswered", (1, "nocall"): "orphan", (2, "x"): "unanswered", (2, "late"): "unanswered"}
    assert sum(r.status == "unidentified" for r in rows) == 3 and len(rows) == 12
    assert [got[1, k].level for k in "xyzuvw"] == [0, 1, 2, None, None, None] and got[2, "late"].level == 1
    assert got[1, "x"].errors == [] and (got[1, "x"].n_calls, got[1, "x"].n_results) == (2, 2)
    assert got[1, "y"].errors == ["type:a", "type:b", "unknown:z", "depends:gone"]
    assert got[1, "z"].errors == ["not_json"] and got[1, "w"].errors == ["not_json"] and got[1, "u"].errors == ["not_object", "no_schema"]
    assert got[2, "late"].errors == ["no_schema"] and got[2, "late"].n_calls == 2  # the least name is kept
    assert got[1, "x"].json == ('{"arguments":{"a":"qé\\n","c":1.5,"d":[],"e":{"b":[{"p":null,"q":2}],"z":1},"f":true,"g":null},'
                                '"depends_on":[],"id":"x","name":"f","result":"res \\"1\\""}')
    for r in rows:
        if r.json is not None:
            assert json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json
    assert json.loads(got[1, "z"].json)["arguments"] == 'nope "x"' and json.loads(got[1, "w"].json)["arguments"] is None


@pytest.mark.parametrize("block", [4096, 0])
def test_levels_of_random_graphs(spark, block):
    r = random.Random(3)
    deps = {(c, f"n{i}"): [f"n{j}" for j in r.sample(range(i), min(i, r.randint(0, 3)))] for c in range(6) for i in range(9)}
    rows = [(*k, v) for k, v in deps.items()]
    r.shuffle(rows)
    memo = {}

    def level(key):
        if key not in memo:
            memo[key] = max((level((key[0], d)) + 1 for d in deps[key]), default=0)
        return memo[key]

    got = levels(spark.createDataFrame(rows, "conv_id long, call_id string, depends_on array<string>"), block)
    assert {(x.conv_id, x.call_id): x.level for x in got.collect()} == {k: level(k) for k in deps}


@pytest.mark.parametrize("block", [4096, 0])
def test_long_chains_cycles_and_mixtures(spark, monkeypatch, block):
    """A chain of 300 calls, a cycle of 3 with a tail, and a diamond on top of a chain."""
    from martsmith.llm import toolcalls

    rounds = []
    monkeypatch.setattr(toolcalls, "staged", lambda df, name, f=toolcalls.staged: rounds.append(name) or f(df, name))
    rows = [(1, f"c{i}", [f"c{i - 1}"] if i else []) for i in range(300)]
    rows += [(2, "a", ["c"]), (2, "b", ["a"]), (2, "c", ["b"]), (2, "tail", ["a"]), (2, "both", ["tail", "free"]), (2, "free", [])]
    rows += [(3, f"c{i}", [f"c{i - 1}"] if i else []) for i in range(20)]
    rows += [(3, "l", ["c19"]), (3, "r", ["c7", "c19"]), (3, "top", ["l", "r", "c0"]), (3, "self", ["self"])]
    got = {(x.conv_id, x.call_id): x.level for x in levels(spark.createDataFrame(rows, "conv_id long, call_id string, depends_on array<string>"), block).collect()}
    want = {(1, f"c{i}"): i for i in range(300)} | {(2, "free"): 0} | {(3, f"c{i}"): i for i in range(20)}
    assert got == want | {(3, "l"): 20, (3, "r"): 20, (3, "top"): 21}
    assert rounds.count("call-levels") <= 12


def test_empty(spark, schemas):
    assert run(spark, schemas, [], [])[1] == []
    assert [r.status for r in run(spark, schemas, [], [(1, 1, "x", "c")])[1]] == ["orphan"]


def test_odd_conversations(spark, schemas):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", None), (None, 2, "user", "b"), (1, None, "user", "c"), (1, 4, "user", ""), (2, 0, "system", "s"), (2, 3, None, "t")]
    calls, results, others = calls_of(spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, call_id int"))
    got = link_tool_calls(calls, results, schemas).collect()
    assert sorted(r.status for r in got) == ["linked", "unanswered", "unidentified", "unidentified"]
    assert sorted(tuple(r) for r in others.collect()) == [(2, 0), (2, 3)]


def test_every_turn_has_a_row(spark):
    got = op10_tool_calls(spark, SF)
    turns = spark.read.parquet(f"{SF}/conversations.parquet").groupBy(
        F.when(F.col("role").isin("user", "assistant"), F.col("role")).otherwise("other").alias("role")).count().collect()
    turns = {r.role: r["count"] for r in turns}
    sums = got.agg(F.sum("n_calls"), F.sum("n_results"), F.count_if(F.col("status") == "other")).first()
    assert list(sums) == [turns["user"], turns["assistant"], turns.get("other", 0)]
    kinds = {e.split(":")[0] for r in got.select("errors").collect() for e in r.errors.split(",")}
    assert {"not_json", "not_object", "no_schema", "missing", "type", "unknown"} <= kinds


@pytest.mark.parametrize(("text", "want"), [
    ("[1.0, 1e2, 100, 1.10e-7, -0.0, 0.50, 1E+3, 12300]", "[1,100,100,0.00000011,0,0.5,1000,12300]"),
    ('{"b":"1.0, 1e2 -0.0 \\"2.50\\"","a":[true,null,-1.50]}', '{"a":[true,null,-1.5],"b":"1.0, 1e2 -0.0 \\"2.50\\""}'),
    ("[1e300, 1.5e-30, 123456789012345678901234567890.10]", "[1e300,1.5e-30,123456789012345678901234567890.1]"), ("[]", "[]"), ('"x"', '"x"'),
])
def test_numbers_have_one_form(spark, text, want):
    frame = spark.createDataFrame([(text,)], "text string")
    got = frame.select(canonical(F.to_json(F.try_parse_json("text")))).first()[0]
    assert got == want and json.loads(got) == json.loads(text)


@pytest.mark.parametrize("order", [1, -1])
def test_a_ladder_takes_few_rounds(spark, monkeypatch, order):
    """1,000 calls, each on the two before it."""
    from martsmith.llm import toolcalls

    rounds = []
    monkeypatch.setattr(toolcalls, "staged", lambda df, name, f=toolcalls.staged: rounds.append(name) or f(df, name))
    rows = [(1, order * i, f"c{i}", [f"c{i - 1}", f"c{i - 2}"][:i]) for i in range(1000 if order > 0 else 100)]
    got = levels(spark.createDataFrame(rows, "conv_id long, turn long, call_id string, depends_on array<string>")).collect()
    assert {(x.call_id, x.level) for x in got} == {(f"c{i}", i) for i in range(len(rows))}
    assert len(rounds) <= 20
