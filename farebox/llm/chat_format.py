"""Chat formatting with linked tool calls, in DataFrame operations.

Messages are rows (conversation, turn, role, text). A text that is a JSON object
may carry the tools of a conversation ({"tools": [{"name", "parameters"}]}), calls
({"tool_calls": [{"id", "name", "arguments"}]}) or, with the role tool, a result
({"tool_call_id", ...}). Calls and results are joined by conversation and id. The
order is topological: a result stands behind the message of its call, whatever its
turn says. Arguments are checked against the schema of their tool level by level:
each level's values are rows that meet their own schema, and give the rows of the
next.

The result stays one row per message with its sort key: a conversation may hold a
third of all rows and is never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import stored

_TOOLS = "array<struct<name:string,parameters:variant>>"
_CALLS = "array<struct<id:string,name:string,arguments:variant>>"


def canonical(text: Column) -> Column:
    """The JSON of a text with sorted keys and no white space; null if it is none."""
    return F.to_json(F.try_parse_json(text))


def _type_of(v: Column) -> Column:
    """JSON type of a variant."""
    kind = F.schema_of_variant(v)
    return (F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
            .when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
            .when(kind == "BIGINT", "integer").when(kind == "VOID", "null").otherwise("number"))


def _at(v: Column, path: str, kind: str) -> Column:
    """What a variant holds at a path, if it is of that kind."""
    return F.try_variant_get(v, path, kind)


def parsed(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str
           ) -> DataFrame:
    """Messages with their JSON parts; only a text that begins with a brace is read."""
    text = F.col(text_col)
    obj = F.when(F.substring(F.ltrim(text), 1, 1) == "{", text)
    call_id = F.when(F.col(role_col) == "tool", F.get_json_object(obj, "$.tool_call_id"))
    return messages.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).alias("role"), text.alias("text"), obj.alias("obj"),
        call_id.alias("call_id"))


def _calls() -> Column:
    """The calls with an id of an assistant's message."""
    inside = F.from_json(F.col("obj"), f"tool_calls {_CALLS}")["tool_calls"]
    return F.when((F.col("role") == "assistant") & F.col("obj").contains("tool_calls"),
                  F.filter(inside, lambda c: c["id"].isNotNull()))


def _message_key() -> Column:
    """Equal for copies of a message, also without a conversation or a turn."""
    return F.sha2(F.to_json(F.struct("conv_id", "turn", "obj"), {"ignoreNullFields": "false"}), 256)


def calls_of(rows: DataFrame) -> DataFrame:
    """(message, conv_id, turn, at, call_id, name, arguments): the calls of the
    distinct messages, arguments as JSON; a text of JSON counts as what it holds."""
    found = (rows.where(F.col("obj").contains("tool_calls") & (F.col("role") == "assistant"))
             .select(_message_key().alias("message"), "conv_id", "turn", "obj", "role").distinct()
             .select("message", "conv_id", "turn", F.posexplode(_calls()).alias("at", "c")))
    arguments = F.col("c.arguments")
    inside = F.coalesce(F.try_parse_json(_at(arguments, "$", "string")), arguments)
    return found.select("message", "conv_id", "turn", "at", F.col("c.id").alias("call_id"),
                        F.col("c.name").alias("name"), F.to_json(inside).alias("arguments"))


def tools_of(rows: DataFrame) -> DataFrame:
    """(conv_id, name, schema): the last definition of each tool, its schema as JSON."""
    inside = F.from_json(F.col("obj"), f"tools {_TOOLS}")
    return (rows.where(F.col("obj").contains("tools") & (F.col("role") == "system"))
            .select("conv_id", "turn", "obj", F.posexplode(inside["tools"]).alias("at", "t"))
            .groupBy("conv_id", F.col("t.name").alias("name"))
            .agg(F.max_by(F.struct(F.to_json("t.parameters").alias("schema")),
                          F.struct("turn", "obj", "at")).alias("d"))
            .select("conv_id", "name", "d.schema"))


def _meets(v: Column, s: Column) -> Column:
    """Whether a value meets what its schema says of the value itself: type (one or a
    list of them), enum, const, required, and no property beyond the named ones."""
    kind = _type_of(v)
    types = F.coalesce(_at(s, "$.type", "array<string>"), F.array(_at(s, "$.type", "string")))
    of_type = _at(s, "$.type", "variant").isNull() | F.exists(types, lambda t: (t == kind) | (
        (t == "number") & (kind == "integer")))
    one = F.to_json(v)
    choice = _at(s, "$.enum", "array<variant>")
    in_choice = choice.isNull() | F.exists(choice, lambda e: F.to_json(e) == one)
    const = _at(s, "$.const", "variant")
    is_const = const.isNull() | (F.to_json(const) == one)
    held = _at(v, "$", "map<string,variant>")
    keys = F.map_keys(held)
    required = F.coalesce(_at(s, "$.required", "array<string>"), F.array().cast("array<string>"))
    named = F.map_keys(_at(s, "$.properties", "map<string,variant>"))
    more = _at(s, "$.additionalProperties", "variant")
    closed = named.isNotNull() & (more.isNull() | (F.to_json(more) == "false"))
    complete = (kind != "object") | (
        F.forall(required, lambda k: F.array_contains(keys, k))
        & (~closed | F.forall(keys, lambda k: F.array_contains(named, k))))
    return F.coalesce(of_type, F.lit(False)) & F.coalesce(in_choice & is_const, F.lit(False)) \
        & F.coalesce(complete, F.lit(False))


def _inner(v: Column, s: Column) -> Column:
    """The values inside a value, each with its schema, as (v, s) of JSON."""
    pair = lambda x, t: F.struct(F.to_json(x).alias("v"), F.to_json(t).alias("s"))
    held = _at(v, "$", "map<string,variant>")
    props = _at(s, "$.properties", "map<string,variant>")
    more, items = _at(s, "$.additionalProperties", "variant"), _at(s, "$.items", "variant")
    of_keys = F.transform(F.map_keys(held), lambda k: pair(F.element_at(held, k), F.coalesce(
        F.element_at(props, k), more)))
    of_items = F.transform(_at(v, "$", "array<variant>"), lambda x: pair(x, items))
    kind = _type_of(v)
    found = F.when(kind == "object", of_keys).when(kind == "array", of_items)
    return F.filter(found, lambda p: p["s"].startswith("{"))


def breaches(pairs: DataFrame) -> DataFrame:
    """The keys of values (key, v, s; JSON) that break their schema at some depth.
    Schemas are as deep as they are: the levels end when no value has one."""
    found = None
    level = pairs
    while True:
        level = stored(level.select("key", "v", "s"), "chat-values")
        if level.isEmpty():
            break
        read = level.select("key", F.try_parse_json("v").alias("v"), F.try_parse_json("s").alias("s"))
        v, s = F.col("v"), F.col("s")
        bad = read.where(~_meets(v, s)).select("key")
        found = bad if found is None else found.union(bad)
        level = read.select("key", F.explode(_inner(v, s)).alias("p")).select("key", "p.v", "p.s")
    return level.select("key") if found is None else found.distinct()


def checked_calls(rows: DataFrame) -> DataFrame:
    """Calls with (key, valid): valid is null without a schema, else whether the
    arguments are an object that meets it."""
    calls = calls_of(rows).join(tools_of(rows), ["conv_id", "name"], "left").withColumn(
        "key", F.concat_ws("-", "message", "at"))
    calls = stored(calls, "chat-calls")
    held = F.coalesce(F.ltrim("arguments").startswith("{"), F.lit(False))
    checked = F.col("schema").startswith("{")
    bad = breaches(calls.where(checked & held).select("key", F.col("arguments").alias("v"),
                                                      F.col("schema").alias("s")))
    wrong = F.col("wrong").isNotNull() | ~held
    return calls.join(bad.withColumn("wrong", F.lit(True)), "key", "left").select(
        "message", "conv_id", "turn", "call_id", F.when(checked, ~wrong).alias("valid"))


def format_chat(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, order_turn, order_rank (the
    conversation's order is by order_turn, order_rank, turn), message (canonical
    JSON), n_calls, calls_valid, linked.

    n_calls counts the calls of a message and calls_valid those that are valid or
    have no schema; linked says of a result whether its call is there, and is null
    for other messages. A result with an unknown id keeps its turn. Null roles,
    turns and texts stay null in the JSON; a null conversation links with nothing
    and has no schemas; repeated messages and repeated ids are all kept, each
    message with its own counts (a result links with the first call of its id). An
    empty table gives none; other columns are ignored."""
    rows = parsed(messages, conv_col, turn_col, role_col, text_col)
    calls = checked_calls(rows)
    per_message = calls.groupBy("message").agg(
        F.count_if(F.coalesce("valid", F.lit(True))).alias("good"))
    first = calls.where("conv_id is not null").groupBy("conv_id", "call_id").agg(
        F.min("turn").alias("call_turn"), F.lit(True).alias("called"))
    results = rows.where("call_id is not null").join(first, ["conv_id", "call_id"], "left")
    others = rows.where("call_id is null").withColumn(
        "n_calls", F.greatest(F.coalesce(F.size(_calls()), F.lit(0)), F.lit(0)))
    plain = others.where("n_calls = 0").select(
        "conv_id", "turn", "role", F.col("turn").alias("order_turn"), F.lit(0).alias("order_rank"),
        _message("obj"), F.lit(0).cast("long").alias("n_calls"),
        F.lit(0).cast("long").alias("calls_valid"), F.lit(None).cast("boolean").alias("linked"))
    calling = others.where("n_calls > 0").withColumn("message", _message_key()).join(
        per_message, "message", "left").select(
        "conv_id", "turn", "role", F.col("turn"), F.lit(0), _message("obj"),
        F.col("n_calls").cast("long"),
        F.coalesce("good", F.lit(0)).cast("long"), F.lit(None).cast("boolean"))
    linked = F.coalesce("called", F.lit(False))
    answers = results.select(
        "conv_id", "turn", "role",
        F.when(linked, F.greatest("call_turn", "turn")).otherwise(F.col("turn")),
        F.when(linked, 1).otherwise(0), _message("obj"), F.lit(0).cast("long"),
        F.lit(0).cast("long"), linked)
    return plain.union(calling).union(answers)


def _message(obj: str) -> Column:
    """{"content", "role"} with sorted keys; a JSON content in its canonical form."""
    content = F.coalesce(canonical(F.col(obj)), F.col("text"))
    return F.to_json(F.struct(content.alias("content"), F.col("role").alias("role")),
                     {"ignoreNullFields": "false"}).alias("message")
