"""Chat formatting: tool calls linked to their results.

Calls and results are hash-joined on (conversation, call id).  Every message
gets a place in its conversation in topological order: a result comes after
its call, a call after the results it depends on, and all else stays in turn
order.  Arguments are checked against the tool's schema, and each message is
serialised as canonical JSON (keys sorted, no blanks, nulls left out).

Order: a message's effective turn is the largest turn among it and all it
depends on; messages of one effective turn follow their links.  Both are found
by passing values along the links until nothing changes, which takes no round
for conversations that are in order already.  The result is one row for each
message, never one value for a whole conversation, and ranks are found in
buckets, so a conversation of any length is spread over tasks.

Defined cases: of several calls with one id in a conversation the earliest
(turn, then position, then content by its hash) is the call, the others are
unlinked and marked duplicate, and so for results; of rows equal in all of that one, whichever, is
the call; calls without a result, and results without a
call, stay and are unlinked; a call is valid if its arguments are a JSON object
that fits the schema of its tool (no schema: not valid); links that form a
circle keep turn order and are marked; null texts are left out of the JSON;
repeated rows are separate messages; null conversations are one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.ordering import ranked
from ledgerlens.session import ensure_checkpoint_dir

#: Turns that one window partition of the ranking spans.
BUCKET_TURNS = 4096

_CALLS = "struct<tool_calls: array<struct<id: string, name: string, arguments: string, after: array<string>>>>"
_RESULT = "struct<tool_call_id: string, content: string>"
_NO_CONVERSATION = -(1 << 63)


def parse(conversations: DataFrame) -> DataFrame:
    """The messages of a table (conv_id, turn, role, text), one row each:
    conv, turn, part, role, kind, call_id, name, arguments, after, content.

    An assistant text that is a JSON object with ``tool_calls`` (each with
    ``id``, ``name``, ``arguments`` and, if it waits for other calls, their ids
    in ``after``) holds calls; a text of the role ``tool`` that is a JSON object
    with ``tool_call_id`` and ``content`` is a result.
    """
    text = F.col("text")
    opens = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")    # blanks that JSON allows
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_CONVERSATION)).alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), "role", "text",
        F.when((F.col("role") == "assistant") & opens, F.from_json(text, _CALLS)).alias("c"),
        F.when((F.col("role") == "tool") & opens, F.from_json(text, _RESULT)).alias("r"))
    called = F.col("c.tool_calls")
    has_calls = F.coalesce(F.size(called) > 0, F.lit(False))
    rows = rows.select("conv", "turn", "role", "text", "r", F.posexplode(
        F.when(has_calls, called).otherwise(F.array(F.lit(None).cast(
            "struct<id: string, name: string, arguments: string, after: array<string>>")))).alias("part", "call"))
    is_call, is_result = F.col("call").isNotNull(), F.col("r.tool_call_id").isNotNull()
    return rows.select(
        "conv", "turn", "part", "role",
        F.when(is_call, "call").when(is_result, "result").otherwise("message").alias("kind"),
        F.coalesce("call.id", "r.tool_call_id").alias("call_id"), F.col("call.name").alias("name"),
        F.col("call.arguments").alias("arguments"), F.col("call.after").alias("after"),
        F.when(is_call, F.lit(None)).when(is_result, F.col("r.content")).otherwise(F.col("text")).alias("content"))


def fits(fields: Column) -> Column:
    """Whether ``__object`` (a map of variants, null if the arguments are no
    JSON object) has all required fields and only known ones, each of its
    type.  ``fields``: array of (field, type, required)."""
    kinds = {"integer": "BIGINT", "string": "STRING", "boolean": "BOOLEAN"}

    def typed(f):
        kind = F.schema_of_variant(F.element_at(F.col("__object"), f["field"]))
        number = kind.startswith("DECIMAL") | (kind == "BIGINT") | (kind == "DOUBLE") | (kind == "FLOAT")
        out = F.when(f["type"] == "number", number).when(f["type"] == "object", kind.startswith("OBJECT")).when(
            f["type"] == "array", kind.startswith("ARRAY"))
        for name, of in kinds.items():
            out = out.when(f["type"] == name, kind == of)
        return F.coalesce(out, F.lit(False))

    present = F.forall(fields, lambda f: F.when(F.map_contains_key("__object", f["field"]), typed(f))
                       .otherwise(~f["required"]))
    known = F.forall(F.map_keys("__object"), lambda name: F.exists(fields, lambda f: f["field"] == name))
    return F.coalesce(present & known, F.lit(False))


def _node(kind: Column, call_id: Column) -> Column:
    return F.concat(kind, F.lit(":"), call_id)


def _links(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): the first call and first result of each id, as
    (conv, node, turn, at_turn, part, h, linked), and what must come before what."""
    at = F.struct("turn", "part", "h")
    first = (messages.where("call_id is not null").groupBy("conv", "kind", "call_id").agg(F.min(at).alias("at"))
             .select("conv", "kind", "call_id", "at.*"))
    both = first.groupBy("conv", "call_id").agg(F.count(F.lit(1)).alias("sides"))
    nodes = first.join(both, ["conv", "call_id"]).select(
        "conv", _node(F.col("kind"), F.col("call_id")).alias("node"), "turn", F.col("turn").alias("at_turn"), "part", "h",
        (F.col("sides") == 2).alias("linked")).checkpoint()
    answered = nodes.where("linked and node like 'call:%'").select(
        "conv", F.col("node").alias("src"), F.concat(F.lit("result:"), F.substring("node", 6, 1 << 30)).alias("dst"))
    waits = (messages.where("kind = 'call' and after is not null and call_id is not null")
             .select("conv", "turn", "part", "h", F.col("call_id"), F.explode("after").alias("a")).where("a is not null"))
    waits = waits.join(nodes.select("conv", "node", "turn", "part", "h"), ["conv", "turn", "part", "h"]).where(
        F.col("node") == _node(F.lit("call"), F.col("call_id")))
    # A call waits for the result of another, or for the call itself if it has none.
    known = nodes.select(F.col("conv").alias("c"), F.col("node").alias("src"), "linked")
    waits = waits.join(known, (F.col("conv") == F.col("c")) & (
        F.when(F.col("linked"), F.concat(F.lit("result:"), F.col("a"))).otherwise(F.concat(F.lit("call:"), F.col("a")))
        == F.col("src")))
    waits = waits.select("conv", "src", F.col("node").alias("dst")).where("src <> dst")
    return nodes, answered.unionByName(waits).distinct().checkpoint()


def _effective_turns(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` with ``turn`` raised to that of all they depend on, ``depth`` among
    nodes of one turn, and ``circular``."""
    state = nodes
    while True:
        before = state.select(F.col("conv").alias("c"), F.col("node").alias("s"), F.col("turn").alias("t"))
        least = (edges.join(before, (F.col("conv") == F.col("c")) & (F.col("src") == F.col("s")))
                 .groupBy(F.col("conv").alias("c2"), F.col("dst").alias("d")).agg(F.max("t").alias("least")))
        raised = least.join(state, (F.col("c2") == F.col("conv")) & (F.col("d") == F.col("node"))).where(
            "least > turn").select("c2", "d", "least").checkpoint()
        if raised.isEmpty():
            break
        state = (state.join(raised, (F.col("c2") == F.col("conv")) & (F.col("d") == F.col("node")), "left")
                 .withColumn("turn", F.greatest("turn", F.coalesce("least", "turn"))).drop("c2", "d", "least")
                 .checkpoint())
    turns = state.select(F.col("conv").alias("c"), F.col("node").alias("n"), F.col("turn").alias("t"))
    other = turns.select(F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("t").alias("t2"))
    open_edges = (edges.join(turns, (F.col("conv") == F.col("c")) & (F.col("src") == F.col("n")))
                  .join(other, (F.col("conv") == F.col("c2")) & (F.col("dst") == F.col("n2")))
                  .where("t = t2").select("conv", "src", "dst").checkpoint())
    depths = None
    level = 0
    while not open_edges.isEmpty():
        # Nodes that wait for nothing take this level; what they hold up is free of them.
        waiting = open_edges.select("conv", F.col("dst").alias("src")).distinct()
        free = open_edges.select("conv", "src").distinct().join(waiting, ["conv", "src"], "left_anti")
        left = open_edges.join(free, ["conv", "src"], "left_anti").checkpoint()
        ended = open_edges.select("conv", F.col("dst").alias("src")).distinct().join(
            left.select("conv", "src").union(left.select("conv", "dst")).distinct(), ["conv", "src"], "left_anti")
        rows = free.withColumn("depth", F.lit(level)).unionByName(ended.withColumn("depth", F.lit(level + 1)))
        stuck = free.isEmpty()
        if stuck:
            rows = open_edges.select("conv", "src").union(open_edges.select("conv", "dst")).distinct().withColumn(
                "depth", F.lit(-1))
        depths = rows if depths is None else depths.unionByName(rows)
        if stuck:
            break
        open_edges, level = left, level + 1
    if depths is None:
        return state.withColumn("depth", F.lit(0)).withColumn("circular", F.lit(False))
    depths = depths.groupBy(F.col("conv").alias("c"), F.col("src").alias("s")).agg(
        F.max("depth").alias("depth"), (F.min("depth") < 0).alias("circular"))
    return (state.join(depths, (F.col("conv") == F.col("c")) & (F.col("node") == F.col("s")), "left")
            .withColumn("depth", F.greatest(F.coalesce("depth", F.lit(0)), F.lit(0)))
            .withColumn("circular", F.coalesce("circular", F.lit(False))).drop("c", "s"))


def format_chat(spark: SparkSession, conversations: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, position, turn, role, kind, call_id, linked, duplicate, valid, circular, json) of each message.

    ``schemas`` has a row (name, field, type, required) for each argument of
    each tool; the types are those of JSON.  It is a registry, not data: it is
    grouped to a row for each tool and joined, by shuffle or not as Spark finds
    its size.
    """
    ensure_checkpoint_dir(spark)
    messages = parse(conversations)
    messages = messages.withColumn("h", F.xxhash64("role", "kind", "call_id", "name", "arguments", "content"))
    nodes, edges = _links(messages)
    turns = _effective_turns(nodes, edges).select(
        F.col("conv").alias("n_conv"), "node", F.col("turn").alias("effective"), "at_turn", "part", "h", "depth", "circular", "linked")
    own = ((F.col("m.conv") == F.col("n.n_conv")) & (_node(F.col("kind"), F.col("call_id")) == F.col("node"))
           & (F.col("m.turn") == F.col("n.at_turn")) & (F.col("m.part") == F.col("n.part")) & (F.col("m.h") == F.col("n.h")))
    rows = messages.alias("m").join(turns.alias("n"), own, "left").select(
        "m.*", F.coalesce("effective", "turn").alias("effective"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("circular", F.lit(False)).alias("circular"), F.coalesce("linked", F.lit(False)).alias("linked"),
        F.col("node").isNotNull().alias("first"))
    fields = schemas.groupBy(F.col("name").alias("tool")).agg(
        F.collect_set(F.struct("field", "type", "required")).alias("fields"))
    rows = rows.join(fields, F.col("name") == F.col("tool"), "left")
    rows = rows.withColumn("bucket", F.floor(F.col("effective") / BUCKET_TURNS).cast("long"))
    order = ["effective", "depth", "turn", "part", "h"]
    placed = ranked(rows, ["conv"], "bucket", order)
    # Equal rows stand together in the order that ranked them, so this window needs no shuffle of its own.
    copy = F.row_number().over(Window.partitionBy("conv", "bucket", *order).orderBy("__rank"))
    placed = placed.withColumn("first", F.col("first") & (copy == 1))
    value = F.try_parse_json("arguments")
    placed = placed.withColumn("__value", value).withColumn(
        "__object", F.expr("try_cast(__value as map<string, variant>)"))
    is_call = F.col("kind") == "call"
    valid = F.when(is_call, fits(F.col("fields")))
    raw = F.when(F.col("__value").isNull(), F.col("arguments"))
    body = F.to_json(F.struct(
        F.col("__value").alias("arguments"), raw.alias("arguments_text"), "call_id", "content", "name", "role", "turn"))
    return placed.select(
        F.when(F.col("conv") != _NO_CONVERSATION, F.col("conv")).alias("conv_id"), F.col("__rank").alias("position"),
        "turn", "role", "kind", "call_id", (F.col("linked") & F.col("first")).alias("linked"),
        (F.col("call_id").isNotNull() & ~F.col("first")).alias("duplicate"), valid.alias("valid"), "circular",
        body.alias("json"))
