"""Chat formatting: tool calls and their results linked, ordered, checked and written as canonical JSON.

Only DataFrame operations are used. A message becomes one event, or one per tool call in it:

- a tool call: an assistant's text that is a JSON object with ``tool_calls``, a list of objects with
  ``id``, ``name``, ``arguments`` and, where a call needs the result of another, ``after``. ``content``
  beside them is a reply, numbered before the calls;
- a tool result: a tool's text that is a JSON object with ``tool_call_id`` and ``content``;
- a request: a user's text, which calls for a reply. It is a call of ``reply`` with the identifier
  ``turn-N``, after the message before it;
- a reply: any other text of an assistant, the result of the request in the turn before. Of an object whose
  list of calls is empty it is the ``content``, or the whole text where there is none;
- a note: everything else.

Calls and results meet in hash joins on (conversation, identifier), never a conversation in one task, so a
conversation with a third of all messages is spread like others. The topological order is the depth of
an event below those it depends on, found by pointer doubling in as many joins as the logarithm of the
longest chain; within a depth the turn decides. An event that depends on itself has no depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.sources.scratch import stored

#: arguments of each tool and their types, as schema_of_variant names them
Schemas = dict[str, dict[str, str]]
REPLY: Schemas = {"reply": {"prompt": "STRING", "turn": "BIGINT"}}
CALLS = "struct<content:string,tool_calls:array<struct<id:string,name:string,arguments:string,after:string>>>"
RESULT = "struct<tool_call_id:string,content:string>"
CALL, TOOL_RESULT, NOTE = "call", "result", "note"
KEYS = ["conv_id", "id"]


def canonical(json: Column) -> Column:
    """JSON with keys in code point order and without spaces; null where it is not valid."""
    return F.to_json(F.try_parse_json(json))


def events(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) to conv_id, turn, number, role, kind, id, parent, tool, arguments, content."""
    text = F.coalesce("text", F.lit(""))
    object_like = F.trim(text).startswith("{")
    parsed = F.when((F.col("role") == "assistant") & object_like, F.from_json(text, CALLS))
    # nothing is said beside calls where the content is empty
    said = F.when(parsed["tool_calls"].isNotNull() & (parsed["content"] != ""), parsed["content"])
    calls = F.when(F.size(parsed["tool_calls"]) > 0, parsed["tool_calls"])
    result = F.when((F.col("role") == "tool") & object_like, F.from_json(text, RESULT))
    base = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(said, text).alias("content"),
        said.isNotNull().alias("says"),
        calls.alias("calls"),
        result.alias("result"),
    )
    is_tool = F.col("result.tool_call_id").isNotNull()
    own = F.concat(F.lit("turn-"), F.col("turn").cast("string"))
    before = F.concat(F.lit("turn-"), (F.col("turn") - 1).cast("string"))
    asks, replies = F.col("role") == "user", F.col("role") == "assistant"
    plain = base.where(F.col("calls").isNull() | F.col("says")).select(
        "conv_id",
        "turn",
        F.lit(0).alias("number"),
        "role",
        F.when(asks, CALL).when(replies | is_tool, TOOL_RESULT).otherwise(NOTE).alias("kind"),
        F.when(is_tool, F.concat(F.lit("result-"), "result.tool_call_id")).otherwise(own).alias("id"),
        F.when(is_tool, F.col("result.tool_call_id")).when(asks | replies, before).alias("parent"),
        F.when(asks, "reply").alias("tool"),
        F.when(asks, F.to_json(F.struct(F.col("content").alias("prompt"), "turn"))).alias("arguments"),
        F.when(is_tool, F.col("result.content")).when(~asks | asks.isNull(), F.col("content")).alias("content"),
    )
    tool_calls = base.where(F.col("calls").isNotNull()).select(
        "conv_id", "turn", "role", "says", F.posexplode("calls").alias("number", "call")
    )
    made = tool_calls.select(
        "conv_id",
        "turn",
        (F.col("number") + F.col("says").cast("int")).alias("number"),
        "role",
        F.lit(CALL).alias("kind"),
        "call.id",
        F.col("call.after").alias("parent"),
        F.col("call.name").alias("tool"),
        "call.arguments",
        F.lit(None).cast("string").alias("content"),
    )
    return plain.unionByName(made)


def depths(nodes: DataFrame) -> DataFrame:
    """(conv_id, id, parent) with unique ids to (conv_id, id, depth); events on or below a cycle get none."""

    def above(frame: DataFrame, *more: Column) -> DataFrame:
        return frame.select(F.col("conv_id").alias("above_conv"), F.col("id").alias("above_id"), *more)

    def met(frame: DataFrame, other: DataFrame) -> DataFrame:
        same = F.col("conv_id").eqNullSafe(F.col("above_conv")) & (F.col("up") == F.col("above_id"))
        return frame.join(other.hint("shuffle_hash"), same, "left")

    linked = met(nodes.select("conv_id", "id", F.col("parent").alias("up")), above(nodes))
    reach = linked.select("conv_id", "id", F.col("above_id").alias("up"), F.col("above_id").isNotNull().cast("long").alias("depth"))
    reach = stored(reach, "reach")
    longest, covered = reach.count(), 1
    while covered <= longest and not reach.where("up IS NOT NULL").isEmpty():
        # events that have reached the top are done; the others go on from where they point to
        further = above(reach, F.col("up").alias("above_up"), F.col("depth").alias("above_depth"))
        moved = met(reach.where("up IS NOT NULL"), further).select(
            "conv_id", "id", F.col("above_up").alias("up"), (F.col("depth") + F.coalesce("above_depth", F.lit(0))).alias("depth")
        )
        reach = stored(reach.where("up IS NULL").unionByName(moved), "reach")
        covered *= 2
    return reach.select("conv_id", "id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def argument_problems(schemas: Schemas) -> Column:
    """What is wrong with the arguments of a call, one entry per fault."""
    given = F.try_parse_json("arguments")
    found = F.when(given.isNull(), F.array(F.lit("bad json")))
    for tool, wanted in schemas.items():
        faults = [
            F.when(kind.isNull(), f"missing {name}").when(kind != wanted_kind, f"wrong type {name}")
            for name, wanted_kind in wanted.items()
            for kind in [F.schema_of_variant(F.try_variant_get(given, f"$.{name}", "variant"))]
        ]
        extra = F.transform(
            F.array_sort(F.array_except(F.json_object_keys("arguments"), F.array(*map(F.lit, wanted)))),
            lambda name: F.concat(F.lit("unexpected "), name),
        )
        checked = F.concat(F.array_compact(F.array(*faults)), F.coalesce(extra, F.array().cast("array<string>")))
        found = found.when(F.col("tool") == tool, checked)
    return found.otherwise(F.array(F.lit("unknown tool")))


def format_chat(messages: DataFrame, schemas: Schemas = REPLY) -> DataFrame:
    """One row per event: conv_id, turn, number, kind, id, linked_id, depth, problems, valid, json.

    ``linked_id`` is the call a result answers, or the event a call comes after, where it exists. Problems
    are told in a fixed order: of the arguments, ``repeated id`` (all but the first in turn order have
    it), ``no call``, ``no result``, ``cycle``. Null ids of conversations are one conversation; a null turn,
    role or text is a note or message like others, null text being empty. Repeated messages repeat their
    ids. An empty table gives no rows; other columns are not read.
    """
    rows = stored(events(messages), "events")
    order = F.struct("turn", "number", F.xxhash64("kind", "parent", "arguments", "content"))
    firsts = rows.where("id IS NOT NULL").groupBy(*KEYS).agg(
        F.min_by(F.struct("parent", "kind"), order).alias("event"), F.min(order).alias("first"), F.count(F.lit(1)).alias("times")
    )
    nodes = stored(firsts.select(*KEYS, "event.parent", "event.kind", "first", "times"), "nodes")
    answers = rows.where(F.col("kind") == TOOL_RESULT).groupBy("conv_id", F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("answers")
    )
    named = [frame.withColumnsRenamed({"conv_id": "other_conv", "id": "other_id"}) for frame in (
        nodes.select(*KEYS, "first", "times"), depths(nodes), answers,
    )]
    same = F.col("conv_id").eqNullSafe(F.col("other_conv")) & (F.col("id") == F.col("other_id"))
    out = rows
    for frame in named:
        out = out.join(frame.hint("shuffle_hash"), same, "left").drop("other_conv", "other_id")
    parents = nodes.select(F.col("conv_id").alias("other_conv"), F.col("id").alias("linked_id"), F.col("kind").alias("linked_kind"))
    on_parent = F.col("conv_id").eqNullSafe(F.col("other_conv")) & (F.col("parent") == F.col("linked_id"))
    out = out.join(parents.hint("shuffle_hash"), on_parent, "left").drop("other_conv")

    is_call, is_result = F.col("kind") == CALL, F.col("kind") == TOOL_RESULT
    problems = F.concat(
        F.when(is_call, argument_problems(schemas)).otherwise(F.array().cast("array<string>")),
        F.array_compact(
            F.array(
                F.when((F.col("times") > 1) & (order != F.col("first")), "repeated id"),
                F.when(is_result & F.coalesce(F.col("linked_kind") != CALL, F.lit(True)), "no call"),
                F.when(is_call & F.col("answers").isNull(), "no result"),
                F.when(F.col("id").isNotNull() & F.col("depth").isNull(), "cycle"),
            )
        ),
    )
    # keys in code point order; absent parts are left out
    json = F.to_json(
        F.struct(
            F.try_parse_json("arguments").alias("arguments"),
            "content",
            "conv_id",
            "id",
            F.col("linked_id").alias("link"),
            "role",
            "tool",
            "turn",
        )
    )
    return out.select(
        "conv_id",
        "turn",
        "number",
        "kind",
        "id",
        "linked_id",
        "depth",
        F.array_join(problems, ", ").alias("problems"),
        (F.size(problems) == 0).alias("valid"),
        json.alias("json"),
    )


def op9_chat(spark, sf_dir: str) -> DataFrame:
    return format_chat(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP9_SQL = r"""
WITH RECURSIVE events AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS content,
           CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'note' END AS kind
    FROM conversations
),
linked AS (
    SELECT e.*, p.turn AS parent_turn, p.kind AS parent_kind, n.kind AS next_kind
    FROM events e
    LEFT JOIN events p ON p.conv_id = e.conv_id AND p.turn = e.turn - 1 AND e.kind <> 'note'
    LEFT JOIN events n ON n.conv_id = e.conv_id AND n.turn = e.turn + 1
),
levels AS (
    SELECT conv_id, turn, 0::BIGINT AS depth FROM linked WHERE parent_turn IS NULL
    UNION ALL
    SELECT l.conv_id, l.turn, v.depth + 1 FROM linked l JOIN levels v ON v.conv_id = l.conv_id AND v.turn = l.parent_turn
),
checked AS (
    SELECT *, concat_ws(', ',
        CASE WHEN kind = 'result' AND parent_kind IS DISTINCT FROM 'call' THEN 'no call' END,
        CASE WHEN kind = 'call' AND next_kind IS DISTINCT FROM 'result' THEN 'no result' END) AS problems,
        'turn-' || turn AS id, CASE WHEN parent_turn IS NOT NULL THEN 'turn-' || parent_turn END AS linked_id
    FROM linked JOIN levels USING (conv_id, turn)
)
SELECT conv_id, turn, 0::INTEGER AS number, kind, id, linked_id, depth, problems, problems = '' AS valid,
       '{' || concat_ws(',',
           CASE WHEN kind = 'call' THEN '"arguments":{"prompt":' || to_json(content) || ',"turn":' || turn || '}' END,
           CASE WHEN kind <> 'call' THEN '"content":' || to_json(content) END,
           '"conv_id":' || conv_id, '"id":"' || id || '"',
           '"link":"' || linked_id || '"',
           '"role":"' || role || '"',
           CASE WHEN kind = 'call' THEN '"tool":"reply"' END,
           '"turn":' || turn) || '}' AS json
FROM checked
"""
