"""Chat formatting: tool calls linked to results, ordered, validated and written as canonical JSON.

1. Calls and results are reduced to one per (conversation, call id), then hash-joined on both columns: a
   conversation that holds a third of all calls is spread by call id.
2. A call depends on the calls whose results its arguments name. Its level is the length of the longest
   chain of dependencies below it. A conversation of up to ``BLOCK`` calls is one row, whose calls get their levels in
   order of their turns, over and over until nothing changes: once, if calls depend on earlier ones. Larger conversations
   are never gathered; there a dependency on a call whose level is known becomes, round after round, a number, and one on a
   call with a single dependency is led past that call (twice as far each round): a chain
   of n calls takes about log2(n) rounds of joins, each staged, a denser graph up to its depth. Calls in a cycle, or above one, keep
   a null level. Within a conversation, (level, turn, call_id) is a topological order.
3. Arguments are parsed (variant) and checked against the schema of the call's tool: known fields,
   required ones, and types. Schemas are sent to all tasks if they are few, joined otherwise.
4. Canonical JSON: keys sorted at every depth, no white space, null results kept, and one form per number: without an
   exponent and closing zeros up to 38 digits, else the shortest that gives the same floating-point number.

Built from DataFrame functions alone. Of several calls (results) of one id the least by turn, then content, is
kept and the number told. Rows without a conversation or call id can't be linked: they come back with
status ``unidentified``, as many as there are. A result without a call is ``orphan``, a call without a
result ``unanswered``. A dependency on a call that isn't there is an error of the call, and no edge.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.llm.common import staged, table
from martsmith.session import scratch_path

KEY = ["conv_id", "call_id"]
BLOCK = 4096
ERRORS = "array<string>"

#: JSON-schema type: pattern of the parser's type names.
TYPES = {
    "string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$",
    "null": "^VOID$", "object": "^OBJECT.*$", "array": "^ARRAY.*$",
}


def _known(rows: DataFrame) -> Column:
    return F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()


def levels(calls: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, call_id, level) of ``calls`` (conv_id, call_id, depends_on and, if there, turn), one row per call with a level."""
    sizes = calls.groupBy("conv_id").agg((F.count(F.lit(1)) <= block).alias("small"))
    split = staged(calls.select(*KEY, F.col("turn") if "turn" in calls.columns else F.lit(0).alias("turn"), "depends_on").join(sizes, "conv_id"), "call-sizes")
    return levels_in_rows(split.where("small")).unionByName(levels_by_rounds(split.where("not small")))


def levels_in_rows(calls: DataFrame) -> DataFrame:
    """``levels`` of conversations that fit a row."""
    rows = calls.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "call_id", "depends_on"))).alias("calls"))
    rows = rows.withColumn("ids", F.transform("calls", lambda x: x["call_id"]))
    # numbers of the calls that each call waits for; those that aren't there don't count
    rows = rows.withColumn("needs", F.transform("calls", lambda x: F.filter(F.transform(
        F.array_distinct(x["depends_on"]), lambda d: (F.array_position("ids", d) - 1).cast("int")), lambda p: p >= 0)))
    unknown = F.array_repeat(F.lit(None).cast("long"), F.size("ids"))
    places = F.sequence(F.lit(0), F.size("ids") - 1)

    def once(before: Column) -> Column:
        """All levels in order: by those found in this pass, and for later calls by those of the pass before."""
        def step(done: Column, i: Column) -> Column:
            below = F.transform(F.get("needs", i), lambda p: F.when(p < i, F.get(done, p)).otherwise(F.get(before, p)))
            level = F.when(F.size(below) == 0, F.lit(0).cast("long")).when(~F.exists(below, lambda x: x.isNull()), F.array_max(below) + 1)
            return F.concat(done, F.array(level))

        return F.aggregate(places, F.array().cast("array<long>"), step)

    start = F.struct(once(unknown).alias("now"), unknown.alias("before"))
    found = F.aggregate(places, start, lambda s, _: F.when(s["now"].eqNullSafe(s["before"]), s).otherwise(
        F.struct(once(s["now"]).alias("now"), s["now"].alias("before"))), lambda s: s["now"])
    pairs = rows.select("conv_id", F.explode(F.arrays_zip(F.col("ids").alias("call_id"), found.alias("level"))).alias("x"))
    return pairs.select("conv_id", "x.call_id", "x.level").where("level is not null")


def levels_by_rounds(calls: DataFrame) -> DataFrame:
    """``levels`` of conversations of any size."""
    spark = calls.sparkSession
    path = scratch_path(spark, f"call-levels-{uuid.uuid4().hex[:12]}")
    nodes = staged(calls.select(*KEY), "calls")
    edges = calls.select("conv_id", "call_id", F.explode(F.array_distinct("depends_on")).alias("target"))
    there = nodes.select("conv_id", F.col("call_id").alias("target"))
    # level(call) is the greatest of weight + level(target), over its rows; a row without a target is a number
    waiting = staged(edges.join(there, ["conv_id", "target"], "left_semi").select(*KEY, "target", F.lit(1).cast("long").alias("weight")), "call-edges")
    found = nodes.join(waiting, KEY, "left_anti").withColumn("level", F.lit(0).cast("long"))
    while True:
        found.write.mode("append").parquet(path)
        known = spark.read.schema(found.schema).parquet(path)
        if waiting.isEmpty():
            return known
        by_target = known.select("conv_id", F.col("call_id").alias("target"), "level")
        single = waiting.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("target").alias("next"), F.min("weight").alias("step")).where(
            "n = 1 and next is not null").select("conv_id", F.col("call_id").alias("target"), "next", "step")
        moved = waiting.join(by_target, ["conv_id", "target"], "left").join(single, ["conv_id", "target"], "left").select(
            *KEY, F.when(F.col("level").isNull(), F.coalesce("next", "target")).alias("target"),
            # no chain is that long: in a cycle weights double without end
            F.least(F.lit(1 << 60), F.col("weight") + F.coalesce("level", "step", F.lit(0))).alias("weight"))
        merged = staged(moved.groupBy(*KEY, "target").agg(F.max("weight").alias("weight")), "call-edges")
        found = staged(merged.groupBy(*KEY).agg(F.count("target").alias("open"), F.max("weight").alias("level")).where("open = 0").drop("open"), "call-levels")
        if found.isEmpty():  # a call whose dependencies all have levels gets one: the rest waits for itself
            return known
        waiting = staged(merged.join(found, KEY, "left_anti"), "call-edges")


def problems(calls: DataFrame, schemas: DataFrame, max_broadcast_rows: int = 100_000) -> DataFrame:
    """``calls`` (with name, arguments) and ``parsed`` (variant or null) and ``errors``: not_json, not_object, no_schema,
    missing:field, type:field, unknown:field, in that order and by field."""
    known = schemas.groupBy(F.col("name").alias("tool")).agg(F.min("fields").alias("fields"))
    if known.count() <= max_broadcast_rows:
        known = F.broadcast(known)
    both = calls.withColumn("parsed", F.try_parse_json("arguments")).join(known, F.col("name") == F.col("tool"), "left")
    is_object = F.schema_of_variant("parsed").startswith("OBJECT")
    both = both.withColumn("given", F.when(is_object, F.transform(
        F.map_entries(F.col("parsed").cast("map<string,variant>")),
        lambda e: F.struct(e["key"].alias("name"), F.schema_of_variant(e["value"]).alias("type")))))
    fields, given = F.col("fields"), F.col("given")
    missing = F.transform(F.filter(fields, lambda f: f["required"] & ~F.exists(given, lambda g: g["name"] == f["name"])),
                          lambda f: F.concat(F.lit("missing:"), f["name"]))
    fits = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    wrong = F.transform(F.filter(given, lambda g: F.exists(fields, lambda f: (f["name"] == g["name"]) & ~F.coalesce(
        F.regexp_like(g["type"], F.element_at(fits, f["type"])), F.lit(False)))), lambda g: F.concat(F.lit("type:"), g["name"]))
    unknown = F.transform(F.filter(given, lambda g: ~F.exists(fields, lambda f: f["name"] == g["name"])),
                          lambda g: F.concat(F.lit("unknown:"), g["name"]))
    none = F.array().cast(ERRORS)
    errors = F.concat(
        F.when(F.col("parsed").isNull(), F.array(F.lit("not_json"))).when(~is_object, F.array(F.lit("not_object"))).otherwise(none),
        F.when(fields.isNull(), F.array(F.lit("no_schema"))).otherwise(none),
        *[F.coalesce(F.array_sort(x), none) for x in (missing, wrong, unknown)])
    return both.withColumn("errors", errors).drop("tool", "fields", "given")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls``: conv_id, turn, call_id, name, arguments (JSON text), depends_on (array of call ids);
    ``results``: conv_id, turn, call_id, content; ``schemas``: name, fields (array of name, type, required).

    (conv_id, call_id, status, level, turn, n_calls, n_results, errors, json): one row per call or result id."""
    own = calls.select(*KEY, "turn", "name", "arguments", F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"))
    answers = results.select(*KEY, "turn", "content")
    one_call = own.where(_known(own)).groupBy(*KEY).agg(
        F.min(F.struct("turn", "name", "arguments", "depends_on")).alias("call"), F.count(F.lit(1)).alias("n_calls")).select(*KEY, "call.*", "n_calls")
    one_call = staged(one_call, "tool-calls")
    one_result = answers.where(_known(answers)).groupBy(*KEY).agg(
        F.min(F.struct("turn", "content")).alias("result"), F.count(F.lit(1)).alias("n_results"))
    linked = one_call.join(one_result, KEY, "full")
    wanted = one_call.select(*KEY, F.explode(F.array_distinct("depends_on")).alias("on"))
    lost = wanted.join(one_call.select("conv_id", F.col("call_id").alias("on")), ["conv_id", "on"], "left_anti").groupBy(*KEY).agg(
        F.array_sort(F.collect_set(F.concat(F.lit("depends:"), F.col("on")))).alias("lost"))
    whole = problems(linked, schemas).join(levels(one_call), KEY, "left").join(lost, KEY, "left")
    is_call = F.col("n_calls").isNotNull()
    status = F.when(~is_call, "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("linked")
    errors = F.when(is_call, F.concat("errors", F.coalesce("lost", F.array().cast(ERRORS)))).otherwise(F.array().cast(ERRORS))
    # the arguments as they were parsed, or as a string if they aren't JSON; members in the order of their names
    members = [("arguments", F.coalesce(canonical(F.to_json("parsed")), _json_text("arguments"))),
               ("depends_on", F.to_json(F.array_sort(F.array_distinct("depends_on")))),
               ("id", _json_text("call_id")), ("name", _json_text("name")), ("result", _json_text("result.content"))]
    json = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), F.coalesce(v, F.lit("null"))) for k, v in members]), F.lit("}"))
    out = whole.select(*KEY, status.alias("status"), "level", F.coalesce("turn", "result.turn").alias("turn"),
                       F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
                       errors.alias("errors"), F.when(is_call, json).alias("json"))
    for rows, is_a_call in ((own.where(~_known(own)), True), (answers.where(~_known(answers)), False)):
        out = out.unionByName(rows.select(
            *KEY, F.lit("unidentified").alias("status"), F.lit(None).cast("int").alias("level"), "turn", F.lit(int(is_a_call)).cast("long").alias("n_calls"),
            F.lit(int(not is_a_call)).cast("long").alias("n_results"), F.array().cast(ERRORS).alias("errors"), F.lit(None).cast("string").alias("json")))
    return out


def _json_text(name: str) -> Column:
    """A string as a JSON string; null stays null."""
    text = F.regexp_extract(F.to_json(F.struct(F.col(name).alias("a"))), r'(?s)^\{"a":(.*)\}$', 1)
    return F.when(F.col(name).isNotNull(), text)


TOKEN = r'"(?:[^"\\]|\\.)*"|-?[0-9][0-9.eE+-]*|[^"0-9-]+'


def canonical(json: Column) -> Column:
    """JSON text with its numbers in one form; strings stay as they are."""
    def number(t: Column) -> Column:
        exact = t.try_cast("decimal(38,18)")
        spelled = F.when(~t.contains("E"), t).when(exact.cast("double") == t.try_cast("double"), exact.cast("string"))
        plain = F.regexp_replace(F.regexp_replace(spelled, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
        plain = F.when(plain == "-0", "0").otherwise(plain)
        return F.coalesce(plain, F.regexp_replace(F.regexp_replace(t, r"\.0E", "e"), "E", "e"))

    tokens = F.regexp_extract_all(json, F.lit(TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), number(t)).otherwise(t)), "")


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and other turns of plain conversations: a user's turn calls the assistant with its text and the number of
    its turn, after the call two turns before; the assistant's turn is the result of the call one turn before.

    So that every check of arguments meets cases, the length of the text decides on some faults: by its remainder modulo 16 the
    arguments are broken off (0), a list (1), have the turn as text (2) or without the text (3), with a field too many (4), name a
    tool without a schema (5), or have the turn with an exponent (6)."""
    def name(back: int) -> Column:
        return F.concat_ws("_", F.lit("call"), F.col("conv_id"), F.col("turn") - back)

    with_id = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    case = F.length("text") % 16
    turn, text = F.coalesce(F.col("turn").cast("string"), F.lit("null")), F.coalesce(_json_text("text"), F.lit("null"))
    whole = F.concat(F.lit('{"turn":'), turn, F.lit(',"text":'), text, F.lit("}"))
    arguments = (F.when(case == 0, F.substr(whole, F.lit(1), F.length(whole) - 1)).when(case == 1, F.concat(F.lit("["), turn, F.lit(","), text, F.lit("]")))
                 .when(case == 2, F.concat(F.lit('{"turn":"'), turn, F.lit('","text":'), text, F.lit("}")))
                 .when(case == 3, F.concat(F.lit('{"turn":'), turn, F.lit("}")))
                 .when(case == 4, F.concat(F.lit('{"turn":'), turn, F.lit(',"text":'), text, F.lit(',"note":1.50}')))
                 .when((case == 6) & F.col("turn").isNotNull(), F.concat(F.lit('{"turn":'), turn, F.lit('.0e0,"text":'), text, F.lit("}")))
                 .otherwise(whole))
    calls = conversations.where("role = 'user'").select(
        "conv_id", "turn", F.when(with_id, name(0)).alias("call_id"), F.when(case == 5, "helper").otherwise("assistant").alias("name"), arguments.alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(name(2))).otherwise(F.array().cast("array<string>")).alias("depends_on"))
    results = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", F.when(with_id, name(1)).alias("call_id"), F.col("text").alias("content"))
    return calls, results, conversations.where("role is null or role not in ('user', 'assistant')").select("conv_id", "turn")


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, call_id, status, level, turn, n_calls, n_results, errors (comma-joined), json of the calls and results
    that the conversations' turns make; turns that are neither have the status ``other``."""
    calls, results, others = calls_of(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame([("assistant", [("text", "string", True), ("turn", "integer", True)])],
                                    "name string, fields array<struct<name:string,type:string,required:boolean>>")
    linked = link_tool_calls(calls, results, schemas).withColumn("errors", F.array_join("errors", ","))
    none = F.lit(0).cast("long")
    return linked.unionByName(others.select(
        "conv_id", F.lit(None).cast("string").alias("call_id"), F.lit("other").alias("status"), F.lit(None).cast("long").alias("level"), "turn",
        none.alias("n_calls"), none.alias("n_results"), F.lit("").alias("errors"), F.lit(None).cast("string").alias("json")))


# For conversations with one row per turn, as the table has them.
OP10_SQL = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id, text, length(text) % 16 AS kind,
         to_json(text) AS x, CAST(turn AS VARCHAR) AS t
  FROM conversations WHERE role = 'user'
), results AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'assistant'
), told AS (
  SELECT *, CASE kind WHEN 5 THEN 'helper' ELSE 'assistant' END AS name,
    CASE kind WHEN 0 THEN 'not_json' WHEN 1 THEN 'not_object' WHEN 2 THEN 'type:turn' WHEN 3 THEN 'missing:text'
              WHEN 4 THEN 'unknown:note' WHEN 5 THEN 'no_schema' WHEN 6 THEN 'type:turn' END AS fault,
    CASE kind WHEN 0 THEN CAST(to_json('{"turn":' || t || ',"text":' || x) AS VARCHAR)
              WHEN 1 THEN '[' || t || ',' || x || ']' WHEN 2 THEN '{"text":' || x || ',"turn":"' || t || '"}'
              WHEN 3 THEN '{"turn":' || t || '}' WHEN 4 THEN '{"note":1.5,"text":' || x || ',"turn":' || t || '}'
              ELSE '{"text":' || x || ',"turn":' || t || '}' END AS arguments
  FROM calls
), edges AS (
  SELECT c.conv_id, c.turn, p.turn IS NOT NULL AS has
  FROM calls c LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.turn = c.turn - 2
), levels AS (
  SELECT conv_id, turn, 0 AS level FROM edges WHERE NOT has
  UNION ALL
  SELECT c.conv_id, c.turn, l.level + 1 FROM levels l JOIN calls c ON c.conv_id = l.conv_id AND c.turn = l.turn + 2
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
       CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
       l.level, coalesce(c.turn, r.turn) AS turn,
       CASE WHEN c.call_id IS NULL THEN 0 ELSE 1 END AS n_calls, CASE WHEN r.call_id IS NULL THEN 0 ELSE 1 END AS n_results,
       concat_ws(',', c.fault, CASE WHEN c.turn >= 2 AND NOT e.has THEN 'depends:call_' || c.conv_id || '_' || (c.turn - 2) END) AS errors,
       CASE WHEN c.call_id IS NOT NULL THEN
         '{"arguments":' || c.arguments || ',"depends_on":['
         || CASE WHEN c.turn >= 2 THEN '"call_' || c.conv_id || '_' || (c.turn - 2) || '"' ELSE '' END
         || '],"id":"' || c.call_id || '","name":"' || c.name || '","result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || '}' END AS json
FROM told c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
LEFT JOIN levels l ON l.conv_id = c.conv_id AND l.turn = c.turn
LEFT JOIN edges e ON e.conv_id = c.conv_id AND e.turn = c.turn
UNION ALL
SELECT conv_id, NULL, 'other', NULL, turn, 0, 0, '', NULL FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""
