"""Chat formatting with tool-call linking, in DataFrame operations only.

Events of a conversation are messages, calls and results.  A result is joined
with its call by (conversation, call id); a call may name a parent call whose
result its arguments use.  The topological generation of every event comes from
pointer doubling over the parents: each round joins every call with its current
ancestor, so a chain of n calls takes log2(n) rounds, and calls that never reach
a root are on or behind a cycle.  (generation, turn) orders a conversation so
that a call follows the result it needs, without a task that holds one.

Arguments are parsed as JSON variants and checked against the tool's schema;
every event is serialised as canonical JSON: keys sorted, no white space, null
fields left out.

Status of a call: ``ok``, ``unanswered`` (no result), ``unknown_tool``,
``not_json`` (no JSON object), ``invalid`` (see ``errors``), ``no_parent``
(names a parent that is not there), ``cycle``; of a result: ``ok`` or
``orphan``; of a message: ``ok``.  The first that applies, in the order
cycle, no_parent, unknown_tool, not_json, invalid, unanswered.

Cases: identical events are one event with ``copies``; of calls that share an id
the one with the smallest (turn, name, arguments) is linked and the others are
``duplicate``; several results of one call are all linked; null conversation or
call ids link with nothing; a null text is a message without content; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockledger.llm.common import saved

#: For each tool its arguments as (type, required).
TOOLS = {"reply": {"prompt": ("STRING", True), "turn": ("BIGINT", True), "language": ("STRING", False)}}

EVENT = ["conv_id", "turn", "kind", "call_id", "name", "arguments", "parent_id", "content"]


def as_events(conversations: DataFrame) -> DataFrame:
    """Turns as events: a user turn calls ``reply``, the turn after it is its result.

    The call's parent is the call that the assistant turn before it answers.
    Every other turn is a message.  All links are equalities of (conversation,
    turn), so no conversation is gathered.
    """
    c = conversations.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.col("role").alias("role"), F.col("text").alias("text"))
    is_call = F.coalesce((F.col("role") == "user") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.lit(False))
    is_result = F.coalesce((F.col("role") == "assistant") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.lit(False))
    one_before = c.filter(is_result).select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit(True).alias("after_answer")).distinct()
    two_before = c.filter(is_call).select("conv_id", (F.col("turn") + 2).alias("turn"), F.lit(True).alias("after_call")).distinct()
    c = c.join(one_before, ["conv_id", "turn"], "left").join(two_before, ["conv_id", "turn"], "left")

    def ident(t: Column) -> Column:
        return F.concat(F.lit("call-"), t)

    turn = F.col("turn")
    return c.select(
        "conv_id", "turn",
        F.when(is_call, "call").when(is_result, "result").otherwise("message").alias("kind"),
        F.when(is_call, ident(turn)).when(is_result, ident(turn - 1)).alias("call_id"),
        F.when(is_call, "reply").when(~is_result, F.col("role")).alias("name"),
        F.when(is_call, F.to_json(F.struct(F.col("text").alias("prompt"), turn.alias("turn")))).alias("arguments"),
        F.when(is_call & F.col("after_answer") & F.col("after_call"), ident(turn - 2)).alias("parent_id"),
        F.when(~is_call, F.col("text")).alias("content"))


def generations(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, generation, rootless) of calls (conv_id, call_id, parent_id) with unique ids.

    ``generation`` counts the calls above; null on or behind a cycle.
    ``rootless``: a parent is named that is no call.
    """
    ids = calls.select("conv_id", F.col("call_id").alias("pid"), F.lit(True).alias("there"))
    state = (calls.join(ids.withColumnRenamed("pid", "parent_id"), ["conv_id", "parent_id"], "left")
             .select("conv_id", "call_id", F.when(F.col("there"), F.col("parent_id")).alias("up"),
                     F.when(F.col("there"), 1).otherwise(0).cast("long").alias("steps"),
                     (F.col("parent_id").isNotNull() & F.col("there").isNull()).alias("rootless")))
    state = saved(state, "chat-generations")
    todo, most = state.filter("up is not null").count(), calls.count()
    rounds = 0
    while todo and 2 ** rounds <= most:
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"))
        state = (state.join(above, ["conv_id", "up"], "left")
                 .select("conv_id", "call_id", F.col("up2").alias("up"),
                         (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"), "rootless"))
        state = saved(state, "chat-generations")
        todo = state.filter("up is not null").count()
        rounds += 1
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("steps")).alias("generation"), "rootless")


def argument_errors(tools: dict) -> Column:
    """What is wrong with ``arguments`` (variant ``v``) of the tool ``name``: sorted strings, null for an unknown tool."""
    out = F.lit(None).cast("array<string>")
    for tool, schema in tools.items():
        found = []
        for arg, (kind, required) in sorted(schema.items()):
            there = F.array_contains("keys", arg)
            path = f"$['{arg}']"
            type_ = F.schema_of_variant(F.try_variant_get("v", path, "variant"))
            is_null = type_ == "VOID"
            bad = there & (~type_.isin(kind) if not required else is_null | ~type_.isin(kind))
            if not required:
                bad = bad & ~is_null
            found.append(F.when(bad, F.lit(f"type:{arg}")))
            if required:
                found.append(F.when(~there, F.lit(f"missing:{arg}")))
        extra = F.transform(F.array_except("keys", F.array(*[F.lit(a) for a in schema])), lambda k: F.concat(F.lit("unknown:"), k))
        errors = F.array_sort(F.concat(F.array_compact(F.array(*found)), extra))
        out = F.when(F.col("name") == tool, errors).otherwise(out)
    return out


def linked(events: DataFrame, tools: dict | None = None) -> DataFrame:
    """(conv_id, turn, kind, call_id, generation, status, errors, n_results, copies, json) of each event.

    ``generation`` of a call is twice the number of calls above it, that of its
    results one more, so that results stand between a call and its children;
    messages have none.
    """
    tools = TOOLS if tools is None else tools
    ev = saved(events.select(*EVENT).groupBy(*EVENT).agg(F.count("*").alias("copies")), "chat-events")
    has_id = "conv_id is not null and call_id is not null"
    calls = ev.filter("kind = 'call'")
    w = Window.partitionBy("conv_id", "call_id").orderBy("turn", "name", "arguments", "parent_id", "content")
    # Calls without an id share none, so they stay out of the window.
    calls = (calls.filter(has_id).withColumn("n", F.row_number().over(w))
             .unionByName(calls.filter(f"not ({has_id})").withColumn("n", F.lit(1))))
    firsts = saved(calls.filter("n = 1").filter(has_id).select("conv_id", "call_id", "parent_id"), "chat-calls")
    gen = saved(generations(firsts).withColumn("known", F.lit(True)), "chat-linked")
    answered = ev.filter("kind = 'result'").filter(has_id).groupBy("conv_id", "call_id").agg(F.count("*").alias("n_results"))

    calls = calls.withColumn("v", F.try_parse_json("arguments")).withColumn("keys", F.json_object_keys("arguments"))
    calls = (calls.join(gen, ["conv_id", "call_id"], "left").join(answered, ["conv_id", "call_id"], "left")
             .withColumn("is_object", F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)))
             .withColumn("errors", F.when(F.col("is_object"), argument_errors(tools))))
    known_tool = F.coalesce(F.col("name").isin(*tools), F.lit(False))
    status = (F.when(F.col("n") > 1, "duplicate")
              .when(F.col("known") & F.col("generation").isNull(), "cycle")
              .when(F.col("rootless"), "no_parent")
              .when(~known_tool, "unknown_tool").when(~F.col("is_object"), "not_json")
              .when(F.size("errors") > 0, "invalid")
              .when(F.coalesce("n_results", F.lit(0)) == 0, "unanswered").otherwise("ok"))
    # Variants print their keys sorted; text that is no JSON object stays a string.
    args = F.when(F.col("is_object"), F.to_json("v")).otherwise(_text("arguments"))
    call_json = F.concat(
        F.lit('{"arguments":'), args, F.lit(',"id":'), _text("call_id"),
        F.lit(',"name":'), _text("name"),
        F.when(F.col("parent_id").isNotNull(), F.concat(F.lit(',"parent":'), _text("parent_id"))).otherwise(""),
        F.lit(',"type":"call"}'))
    same = ["conv_id", "turn", "kind", "call_id", "generation", "status", "errors", "n_results", "copies", "json"]
    calls = (calls.withColumn("status", status).withColumn("json", call_json)
             .withColumn("generation", 2 * F.col("generation"))
             .withColumn("n_results", F.coalesce("n_results", F.lit(0))).select(*same))

    no_errors, none = F.lit(None).cast("array<string>"), F.lit(None).cast("long")
    results = (ev.filter("kind = 'result'").join(gen, ["conv_id", "call_id"], "left")
               .withColumn("status", F.when(F.col("known"), "ok").otherwise("orphan"))
               .withColumn("errors", no_errors).withColumn("n_results", none)
               .withColumn("generation", 2 * F.col("generation") + 1)
               .withColumn("json", F.to_json(F.struct("content", F.col("call_id").alias("id"), F.lit("result").alias("type"))))
               .select(*same))
    messages = (ev.filter("kind = 'message' or kind is null or kind not in ('call', 'result')")
                .withColumn("status", F.lit("ok")).withColumn("errors", no_errors).withColumn("n_results", none)
                .withColumn("generation", none)
                .withColumn("json", F.to_json(F.struct("content", F.col("name").alias("role"), F.lit("message").alias("type"))))
                .select(*same))
    return calls.unionByName(results).unionByName(messages)


def _text(column: str) -> Column:
    """A string column as JSON; ``null`` where it is null."""
    whole = F.to_json(F.struct(F.col(column).alias("x")))  # {"x":...}
    return F.when(F.col(column).isNull(), "null").otherwise(whole.substr(F.lit(6), F.length(whole) - 6))


#: DuckDB SQL of the query over conversations.
SQL = """
WITH RECURSIVE c AS (
  SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS BIGINT) AS turn, role, text, count(*) AS copies
  FROM conversations GROUP BY ALL),
u AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS n, text FROM c WHERE role = 'user'),
a AS (SELECT conv_id, turn, count(*) AS n FROM c WHERE role = 'assistant' GROUP BY ALL),
g AS (SELECT conv_id, turn, 0 AS generation FROM u WHERE n = 1
        AND NOT ((conv_id, turn - 1) IN (SELECT (conv_id, turn) FROM a) AND (conv_id, turn - 2) IN (SELECT (conv_id, turn) FROM u))
      UNION ALL
      SELECT u.conv_id, u.turn, g.generation + 1 FROM g JOIN a ON a.conv_id = g.conv_id AND a.turn = g.turn + 1
      JOIN u ON u.conv_id = g.conv_id AND u.turn = g.turn + 2 AND u.n = 1),
calls AS (
  SELECT u.conv_id, u.turn, 'call' AS kind, 'call-' || u.turn AS call_id, 2 * g.generation AS generation,
         CASE WHEN u.n > 1 THEN 'duplicate' WHEN u.text IS NULL THEN 'invalid' WHEN a.n IS NULL THEN 'unanswered' ELSE 'ok' END AS status,
         CASE WHEN u.text IS NULL THEN 'missing:prompt' ELSE '' END AS errors, coalesce(a.n, 0) AS n_results,
         '{"arguments":{' || CASE WHEN u.text IS NULL THEN '' ELSE '"prompt":' || CAST(to_json(u.text) AS VARCHAR) || ',' END || '"turn":' || u.turn
           || '},"id":"call-' || u.turn || '","name":"reply"' || CASE WHEN g.generation > 0 THEN ',"parent":"call-' || (u.turn - 2) || '"' ELSE '' END
           || ',"type":"call"}' AS json, u.text
  FROM u JOIN g USING (conv_id, turn) LEFT JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1),
results AS (
  SELECT c.conv_id, c.turn, 'result' AS kind, 'call-' || (c.turn - 1) AS call_id, 2 * g.generation + 1 AS generation,
         CASE WHEN g.generation IS NULL THEN 'orphan' ELSE 'ok' END AS status, NULL AS errors, NULL AS n_results,
         '{' || CASE WHEN c.text IS NULL THEN '' ELSE '"content":' || CAST(to_json(c.text) AS VARCHAR) || ',' END
           || '"id":"call-' || (c.turn - 1) || '","type":"result"}' AS json, c.copies
  FROM c LEFT JOIN g ON g.conv_id = c.conv_id AND g.turn = c.turn - 1 WHERE role = 'assistant'),
messages AS (
  SELECT conv_id, turn, 'message' AS kind, NULL AS call_id, NULL AS generation, 'ok' AS status, NULL AS errors, NULL AS n_results,
         '{' || CASE WHEN text IS NULL THEN '' ELSE '"content":' || CAST(to_json(text) AS VARCHAR) || ',' END
           || CASE WHEN role IS NULL THEN '' ELSE '"role":' || CAST(to_json(role) AS VARCHAR) || ',' END || '"type":"message"}' AS json, copies
  FROM c WHERE role IS NULL OR role NOT IN ('user', 'assistant'))
SELECT k.conv_id, k.turn, k.kind, k.call_id, CAST(k.generation AS BIGINT) AS generation, k.status, k.errors,
       CAST(k.n_results AS BIGINT) AS n_results, c.copies, k.json
FROM calls k JOIN c ON c.role = 'user' AND c.conv_id = k.conv_id AND c.turn = k.turn AND c.text IS NOT DISTINCT FROM k.text
UNION ALL SELECT conv_id, turn, kind, call_id, CAST(generation AS BIGINT), status, errors, CAST(n_results AS BIGINT), copies, json FROM results
UNION ALL SELECT conv_id, turn, kind, call_id, CAST(generation AS BIGINT), status, errors, CAST(n_results AS BIGINT), copies, json FROM messages
"""
