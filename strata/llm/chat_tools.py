"""Tool calls of chats: linked to their results, ordered, validated and written as canonical JSON.

``link`` takes calls (conversation, identifier, name, JSON arguments, position
in the conversation, identifiers of the calls whose results they need) and
results (identifier, position, content). All of it is joins and expressions:

* an identifier names a call within its conversation: calls, needs and
  results meet in joins by conversation and identifier, all of them sorted:
  either side grows with the input, so none is broadcast. Results and
  repeated identifiers are combined before they are joined, and an
  identifier that many rows name is dealt to several tasks;
* in a conversation whose calls only need earlier ones, the position is a
  topological number already. Only conversations in which some call needs a
  later one are peeled, level by level, until no call is left or only cycles;
* arguments are parsed once to a variant, which keeps keys sorted, and checked
  by expressions made from a JSON Schema subset (``problems``);
* ``record`` is the canonical JSON of a link: keys sorted at every level, no
  blanks, fields that are null left out.

Status, the first that holds: orphan_result (a result that no call of its
conversation has asked for), no_id (no identifier or no conversation),
duplicate_id (an earlier call of the conversation has the identifier),
bad_json (the arguments are null or not JSON), unknown_tool, invalid,
missing_need, cycle, unanswered, ok.

Defined results: a null identifier or conversation links nothing, a result
without one is left out; of several results the first
by position, then content, is linked and ``n_results`` counts them; of calls
with one identifier at one position none is earlier; a null list of needs is
empty, repeated and null needs count once and not at all; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import dealt_join, n_words, sorted_join
from strata.sources.checkpoint import materialize

KEY = ["conv_id", "call_id"]
# How the types of JSON Schema look in a variant's schema.
TYPES = {"string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$",
         "boolean": "^BOOLEAN$", "object": "^OBJECT<", "array": "^ARRAY<", "null": "^VOID$"}


def problems(arguments: Column, schema: dict) -> Column:
    """Array of what a schema finds wrong with an object: property:rule, in the schema's order. Rules: type,
    required, enum, minimum, maximum, minLength, maxLength, pattern; additionalProperties of the object."""
    found = [F.when(~kind_is(arguments, "object"), "object:type")]
    properties = schema.get("properties", {})
    for name, rules in properties.items():
        value = F.try_variant_get(arguments, f"$['{name}']", "variant")
        missing = value.isNull()
        if name in schema.get("required", ()):
            found.append(F.when(missing, f"{name}:required"))
        if "type" in rules:
            found.append(F.when(~missing & ~kind_is(value, rules["type"]), f"{name}:type"))
        text, number = F.try_variant_get(arguments, f"$['{name}']", "string"), F.try_variant_get(arguments, f"$['{name}']", "double")
        is_text, is_number = ~missing & kind_is(value, "string"), ~missing & kind_is(value, "number")
        tests = {"enum": lambda x: ~missing & ~text.isin(*map(str, x)), "minimum": lambda x: is_number & (number < x), "maximum": lambda x: is_number & (number > x),
                 "minLength": lambda x: is_text & (F.length(text) < x), "maxLength": lambda x: is_text & (F.length(text) > x), "pattern": lambda x: is_text & ~text.rlike(x)}
        found += [F.when(test(rules[rule]), f"{name}:{rule}") for rule, test in tests.items() if rule in rules]
    if schema.get("additionalProperties") is False:
        keys = F.map_keys(F.try_variant_get(arguments, "$", "map<string,variant>"))
        found.append(F.when(F.size(F.array_except(keys, F.array(*[F.lit(p) for p in properties]).cast("array<string>"))) > 0, "object:additionalProperties"))
    return F.array_compact(F.array(*found))


def kind_is(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike(TYPES[kind]), F.lit(False))


def checked(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls`` with ``_json`` (the arguments as a variant, null if they aren't JSON) and ``problems``
    (null for a tool without a schema)."""
    calls = calls.withColumn("_json", F.try_parse_json("arguments"))
    found = F
    for name, schema in schemas.items():
        found = found.when(F.col("name") == name, problems(F.col("_json"), schema))
    return calls.withColumn("problems", found.otherwise(None) if schemas else F.lit(None).cast("array<string>"))


def order(calls: DataFrame) -> DataFrame:
    """One row per conversation and identifier: ``topo`` (a topological number within the conversation, null in or behind
    a cycle) and ``n_missing`` (needs that are no call). ``calls``: conv_id, call_id, position, needs; stored."""
    named = calls.dropna("any", subset=KEY)
    own = materialize(named.groupBy(*KEY).agg(F.min("position").alias("position")))
    needs = materialize(named.select(*KEY, F.explode(F.array_distinct("needs")).alias("need")).where("need is not null").distinct())
    needed = own.select("conv_id", F.col("call_id").alias("need"), F.col("position").alias("need_position"), F.lit(True).alias("is_call"))
    edges = materialize(sorted_join(dealt_join(needs, needed, ["conv_id", "need"], F.col("call_id")), own, KEY))
    missing = edges.where("is_call is null").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_missing"))
    edges = edges.where("is_call")
    ahead = materialize(edges.where("coalesce(need_position >= position, true)").select("conv_id").distinct())
    numbered = own.select(*KEY, F.col("position").cast("long").alias("topo"))
    if ahead.take(1):
        peel = materialize(dealt_join(own, ahead, ["conv_id"], F.col("call_id"), "left_semi").select(*KEY))
        done = levels(peel, sorted_join(edges, peel, KEY, "left_semi").select(*KEY, "need"))
        numbered = sorted_join(numbered, peel, KEY, "left_anti").select(*KEY, "topo").union(sorted_join(peel, done, KEY, "left").select(*KEY, "level"))
    return sorted_join(numbered, missing, KEY, "left").withColumn("n_missing", F.coalesce("n_missing", F.lit(0)))


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``conv_id``, ``call_id`` and ``level`` of the calls that can be put in order: a round takes those without open needs."""
    done, level = None, 0
    while True:
        ready = materialize(sorted_join(nodes, edges.select(*KEY).distinct(), KEY, "left_anti"))
        if not ready.take(1):
            return done if done is not None else ready.withColumn("level", F.lit(0).cast("long"))
        placed = ready.withColumn("level", F.lit(level).cast("long"))
        done = placed if done is None else done.union(placed)
        nodes = materialize(sorted_join(nodes, ready, KEY, "left_anti"))
        edges = materialize(sorted_join(edges, ready.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_anti"))
        level += 1


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each call and each result without a call: conv_id, call_id, position, name, status, topo, problems,
    n_results, arguments (canonical), result and record."""
    calls = materialize(calls.select("conv_id", "call_id", "name", "arguments", "position", F.coalesce("needs", F.array().cast("array<string>")).alias("needs")))
    answers = results.dropna("any", subset=KEY).groupBy(*KEY).agg(F.min(F.struct("position", "content")).alias("_r"), F.count(F.lit(1)).cast("long").alias("n_results"))
    answers = materialize(answers.select(*KEY, F.col("_r.position").alias("_at"), F.col("_r.content").alias("result"), "n_results"))
    first = calls.dropna("any", subset=KEY).groupBy(*KEY).agg(F.min("position").alias("_first"))
    known = sorted_join(sorted_join(order(calls), first, KEY), answers.drop("_at"), KEY, "left")
    linked = dealt_join(checked(calls, schemas), known, KEY, F.xxhash64("arguments"))
    n_results = F.coalesce("n_results", F.lit(0).cast("long"))
    status = (F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), "no_id").when(F.col("position") > F.col("_first"), "duplicate_id").when(F.col("_json").isNull(), "bad_json")
              .when(F.col("problems").isNull(), "unknown_tool").when(F.size("problems") > 0, "invalid").when(F.col("n_missing") > 0, "missing_need")
              .when(F.col("topo").isNull(), "cycle").when(n_results == 0, "unanswered").otherwise("ok"))
    linked = linked.select("conv_id", "call_id", "position", "name", status.alias("status"), "topo", "problems", n_results.alias("n_results"),
                           "_json", "result", "needs")
    lost = sorted_join(answers, first, KEY, "left_anti").select(
        *KEY, F.col("_at").alias("position"), F.lit(None).cast("string").alias("name"), F.lit("orphan_result").alias("status"),
        F.lit(None).cast("long").alias("topo"), F.lit(None).cast("array<string>").alias("problems"), "n_results", F.try_parse_json(F.lit(None).cast("string")).alias("_json"),
        "result", F.array().cast("array<string>").alias("needs"))
    fields = {"arguments": F.col("_json"), "call_id": F.col("call_id"), "name": F.col("name"), "needs": F.col("needs"), "order": F.col("topo"),
              "result": F.col("result"), "status": F.col("status")}
    rows = linked.unionByName(lost).withColumn("record", F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])))
    return rows.withColumn("arguments", F.to_json("_json")).drop("_json", "needs")


# The tools as which the turns of plain conversations are taken.
TURN_SCHEMAS = {
    "configure": {"type": "object", "required": ["text"], "additionalProperties": False, "properties": {"text": {"type": "string", "minLength": 1}}},
    "reply": {"type": "object", "required": ["text", "turn", "words"], "additionalProperties": False, "properties": {
        "text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}, "words": {"type": "integer", "minimum": 1, "maximum": 400}}},
}


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations (conv_id, turn, role, text): a system turn configures and a user turn
    asks for a reply; each needs the call two turns before it, or the first turn. An assistant turn is the result of
    the turn before it. Identifiers are numbers of turns, so every conversation has the same ones. Other roles, and turns without a conversation or number, are no calls."""
    turns = turns.where("conv_id is not null and turn is not null")
    at = lambda n: F.concat(F.lit("call_"), n.cast("string"))
    text = F.coalesce("text", F.lit(""))
    asked = F.to_json(F.struct(text.alias("text"), F.col("turn"), n_words(F.col("text")).alias("words")))
    needs = F.when((F.col("role") == "user") & (F.col("turn") > 0), F.array(at(F.greatest(F.col("turn") - 2, F.lit(0)).cast("long")))).otherwise(F.array().cast("array<string>"))
    calls = turns.where("role in ('system', 'user')").select(
        "conv_id", at(F.col("turn")).alias("call_id"), F.when(F.col("role") == "system", "configure").otherwise("reply").alias("name"),
        F.when(F.col("role") == "system", F.to_json(F.struct(text.alias("text")))).otherwise(asked).alias("arguments"), F.col("turn").alias("position"), needs.alias("needs"))
    results = turns.where("role = 'assistant'").select("conv_id", at(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content"))
    return calls, results
