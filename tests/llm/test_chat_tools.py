import json

from pyspark.sql import functions as F

from strata.llm import chat_tools, common
from strata.sources.checkpoint import materialize

SCHEMA = {"add": {"type": "object", "required": ["a", "b"], "additionalProperties": False, "properties": {
    "a": {"type": "integer", "minimum": 0}, "b": {"type": "number", "maximum": 10}, "how": {"type": "string", "enum": ["fast", "slow"], "pattern": "^[a-z]+$"}, "o": {"type": "object"}}}}
CALLS = "conv_id long, call_id string, name string, arguments string, position long, needs array<string>, status string"
RESULTS = "conv_id long, call_id string, position long, content string, status string"


def linked(spark, calls, results, schemas=SCHEMA):
    df = chat_tools.link(spark.createDataFrame([(*c, "old") for c in calls], CALLS), spark.createDataFrame([(*r, "old") for r in results], RESULTS), schemas)
    return df.collect()


def test_links_and_statuses(spark):
    good = '{"b": 1.50, "a": 2}'
    calls = [(1, "x", "add", good, 1, []), (1, "y", "add", good, 3, ["x", "x", None]), (1, "x", "add", good, 5, []), (1, None, "add", good, 6, None),
             (2, "j", "add", "{bad", 1, []), (2, "n", "add", None, 2, []), (2, "u", "other", "{}", 3, []), (2, "i", "add", '{"a": -1, "b": "z", "q": 1}', 4, []),
             (2, "m", "add", good, 5, ["nowhere"]), (2, "w", "add", good, 6, None), (None, "v", "add", good, None, None)]
    results = [(1, "x", 2, "three"), (1, "x", 4, "again"), (1, "y", 4, None), (2, "m", 6, "r"), (3, "lost", 1, "?"), (3, "lost", 0, "!"), (3, None, 1, "z")]
    rows = linked(spark, calls, results)
    got = sorted((str(r["call_id"]), r["status"], r["n_results"]) for r in rows)
    assert got == sorted([("x", "ok", 2), ("y", "ok", 1), ("x", "duplicate_id", 2), ("None", "no_id", 0), ("j", "bad_json", 0), ("n", "bad_json", 0), ("u", "unknown_tool", 0),
                          ("i", "invalid", 0), ("m", "missing_need", 1), ("w", "unanswered", 0), ("lost", "orphan_result", 2), ("v", "no_id", 0)])
    by_id = {r["call_id"]: r for r in rows if r["status"] != "duplicate_id"}
    assert by_id["i"]["problems"] == ["a:minimum", "b:type", "object:additionalProperties"]
    assert by_id["x"]["result"] == "three" and by_id["lost"]["result"] == "!"
    assert by_id["x"]["record"] == '{"arguments":{"a":2,"b":1.5},"call_id":"x","name":"add","needs":[],"order":1,"result":"three","status":"ok"}'


def test_canonical_json(spark):
    texts = ['{"b":{"z":1,"y":[3,{"d":1,"c":2}]},"a":"\\u00e9\\n\\"/"}', '{"a": 1e2, "b": null}', "[1]", '"x"']
    rows = linked(spark, [(1, str(i), "t", t, i, []) for i, t in enumerate(texts)], [], {"t": {"type": "object"}})
    got = {r["call_id"]: r for r in rows}
    assert got["0"]["arguments"] == '{"a":"é\\n\\"/","b":{"y":[3,{"c":2,"d":1}],"z":1}}'
    assert got["2"]["problems"] == ["object:type"] and got["3"]["status"] == "invalid" and got["1"]["problems"] == []
    assert all(json.loads(r["record"])["call_id"] == r["call_id"] for r in rows)


def test_order_with_later_needs_and_cycles(spark):
    calls = [(1, "a", "t", "{}", 1, ["b"]), (1, "b", "t", "{}", 2, ["c"]), (1, "c", "t", "{}", 3, []), (1, "d", "t", "{}", 4, ["a", "c"]),
             (2, "p", "t", "{}", 1, ["q"]), (2, "q", "t", "{}", 2, ["p"]), (2, "r", "t", "{}", 3, ["q"]), (2, "s", "t", "{}", 4, []), (3, "k", "t", "{}", 7, []), (3, "l", "t", "{}", 9, ["k"])]
    topo = {r["call_id"]: r["topo"] for r in linked(spark, calls, [], {"t": {}})}
    assert topo == {"a": 2, "b": 1, "c": 0, "d": 3, "p": None, "q": None, "r": None, "s": 0, "k": 7, "l": 9}


def test_turns(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", None), (2, 0, "assistant", "lost"), (2, 1, "user", "é"), (3, 0, "user", "x"), (3, 0, "user", "x"),
            (None, 0, "user", "x"), (4, None, "user", "x"), (5, 0, None, "x"), (5, 2, "user", " ")]
    turns = spark.createDataFrame([(*r, "old") for r in rows], "conv_id long, turn long, role string, text string, status string")
    got = sorted((r["conv_id"], r["call_id"], r["status"]) for r in chat_tools.link(*chat_tools.turns_as_calls(turns), chat_tools.TURN_SCHEMAS).collect())
    assert got == sorted([(1, "call_0", "unanswered"), (1, "call_1", "ok"), (1, "call_3", "invalid"), (2, "call_-1", "orphan_result"), (2, "call_1", "missing_need"),
                          (3, "call_0", "unanswered"), (3, "call_0", "unanswered"), (5, "call_2", "invalid")])
    assert chat_tools.link(*chat_tools.turns_as_calls(turns.where(F.lit(False))), chat_tools.TURN_SCHEMAS).collect() == []


def test_conversations_with_the_same_identifiers(spark):
    """Identifiers repeat in every conversation: each has its own calls, results, order, cycles and missing needs."""
    calls = [(c, i, "t", "{}", p, n) for c in (1, 2) for i, p, n in (("call_1", 1, []), ("call_2", 2, ["call_1"]))]
    calls += [(3, "call_1", "t", "{}", 1, ["call_2"]), (3, "call_2", "t", "{}", 2, ["call_1"]), (4, "call_1", "t", "{}", 9, ["call_2"]), (4, "call_2", "t", "{}", 10, []), (5, "call_2", "t", "{}", 1, ["call_1"])]
    results = [(1, "call_1", 3, "one"), (2, "call_1", 3, "two"), (2, "call_2", 4, "three"), (5, "call_1", 2, "lost"), (None, "call_1", 2, "nowhere")]
    got = {(r["conv_id"], r["call_id"]): (r["status"], r["topo"], r["n_results"], r["result"]) for r in linked(spark, calls, results, {"t": {}})}
    assert got == {(1, "call_1"): ("ok", 1, 1, "one"), (1, "call_2"): ("unanswered", 2, 0, None), (2, "call_1"): ("ok", 1, 1, "two"), (2, "call_2"): ("ok", 2, 1, "three"),
                   (3, "call_1"): ("cycle", None, 0, None), (3, "call_2"): ("cycle", None, 0, None), (4, "call_1"): ("unanswered", 1, 0, None), (4, "call_2"): ("unanswered", 0, 0, None),
                   (5, "call_2"): ("missing_need", 1, 0, None), (5, "call_1"): ("orphan_result", None, 1, "lost")}


def test_no_side_that_grows_is_broadcast(spark, monkeypatch):
    """A stored table's compressed file may be far smaller than its rows: the driver is not to hold them."""
    plans = []

    def seen(df, name=None):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return materialize(df, name)

    monkeypatch.setattr(chat_tools, "materialize", seen)
    monkeypatch.setattr(common, "materialize", seen)
    calls = [(c, i, "t", "{}", p, n, "old") for c in range(4) for i, p, n in (("a", 1, ["b"]), ("b", 2, []), ("c", 3, ["a", "nowhere"]))]
    results = [(c, "b", 4, "r", "old") for c in range(5)]
    rows = chat_tools.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), {"t": {}})
    plans.append(rows._jdf.queryExecution().sparkPlan().toString())
    assert len(rows.collect()) == 13
    assert sum("SortMergeJoin" in p for p in plans) >= 8 and not [p for p in plans if "Broadcast" in p]


def test_dealt_join(spark, monkeypatch):
    """Keys with many rows are dealt out, others and null keys too, with the rows of a plain join."""
    left = materialize(spark.createDataFrame([(k, f"x{i}") for k, n in ((1, 50), (2, 3), (3, 1), (None, 20)) for i in range(n)], "k long, v string"))
    right = spark.createDataFrame([(1, "one"), (2, "two"), (4, "four"), (None, "none")], "k long, w string")
    for share in (common.SHARE, 4):
        monkeypatch.setattr(common, "SHARE", share)
        for how in ("left", "inner", "left_semi", "left_anti"):
            got = common.dealt_join(left, right, ["k"], F.col("v"), how)
            want = left.join(right, ["k"], how)
            assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())), (share, how)
    plan = common.dealt_join(left, right, ["k"], F.col("v"))._jdf.queryExecution().sparkPlan().toString()
    assert "_salt" in plan and "SortMergeJoin" in plan
