import json
from collections import Counter, defaultdict

import pytest

from tessera.llm import tool_calls as X

TOOLS = {
    "search": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 10}, "mode": {"type": "string", "enum": ["a", "b"]}}, "required": ["query"], "additionalProperties": False},
    "calc": {"properties": {"x": {"type": "number"}, "list": {"type": "array"}, "o": {"type": "object"}, "f": {"type": "boolean"}}},
}
MESSAGES, CALLS, RESULTS = "conv_id long, turn long, role string, text string", "conv_id long, turn long, call_id string, name string, arguments string, after array<string>", "conv_id long, turn long, call_id string, content string"


def run(spark, messages=(), calls=(), results=()):
    out = X.formatted(spark.createDataFrame(list(messages), MESSAGES), spark.createDataFrame(list(calls), CALLS), spark.createDataFrame(list(results), RESULTS), TOOLS)
    return sorted(out.collect(), key=lambda r: (r.conv_id is None, r.conv_id, r.position))


def test_links_problems_and_json(spark):
    rows = run(
        spark, [(1, 0, "system", 'say "hi"\n')],
        [(1, 1, "a", "search", '{"query": "é\\u00e9", "limit": 3}', None), (1, 1, "b", "search", '{"limit": 99, "mode": "c", "more": {"z": 1, "a": [1, 2.5, null]}}', []),
         (1, 2, "c", "calc", '{"x": "1", "list": {}, "o": [], "f": 1}', None), (1, 2, "d", "calc", '{"x": 1.5, "list": [], "o": {}, "f": true}', None),
         (1, 3, "e", "none", "{broken", None), (1, 4, "f", "search", None, None), (1, 5, "g", "search", '{"query": "x", "limit": 2.5}', None)],
        [(1, 2, "a", "found"), (1, 3, "a", "found again"), (1, 9, "zz", "nobody asked")])
    by = {r.call_id: r for r in rows if r.n_calls or r.call_id != "a"}
    assert [r.position for r in rows] == list(range(10))
    assert by["a"].json == '{"arguments":{"limit":3,"query":"éé"},"call_id":"a","kind":"call","name":"search","result_turn":2,"text":"found","turn":1}'
    assert by["a"].n_results == 1 and by["a"].problems == []
    again = next(r for r in rows if r.call_id == "a" and not r.n_calls)
    assert again.kind == "orphan" and again.problems == ["repeated identifier"] and json.loads(again.json)["text"] == "found again"
    assert by["b"].problems == ["limit: above 10", "mode: none of its values", "query: missing", "undeclared arguments"]
    assert json.loads(by["b"].json)["arguments"] == {"limit": 99, "mode": "c", "more": {"a": [1, 2.5, None], "z": 1}}
    assert '{"a":[1,2.5,null],"z":1}' in by["b"].json
    assert by["c"].problems == ["f: no boolean", "list: no array", "o: no object", "x: no number"] and by["d"].problems == []
    assert by["e"].problems == ["arguments are no JSON object", "unknown tool"] and json.loads(by["e"].json)["arguments_text"] == "{broken" and "arguments" not in json.loads(by["e"].json)
    assert by["f"].problems == ["arguments are no JSON object"] and by["g"].problems == ["limit: no integer"]
    assert by["zz"].kind == "orphan" and by[None].json == '{"kind":"message","role":"system","text":"say \\"hi\\"\\n","turn":0}'


def test_topological_order(spark):
    calls = [
        (1, 1, "a", "calc", "{}", ["c"]), (1, 2, "b", "calc", "{}", []), (1, 3, "c", "calc", "{}", ["d", "b"]), (1, 5, "d", "calc", "{}", None),
        (1, 5, "e", "calc", "{}", ["d"]), (1, 6, "f", "calc", "{}", ["a", "unknown"]),
        (2, 1, "a", "calc", "{}", ["b"]), (2, 2, "b", "calc", "{}", ["a"]), (2, 3, "c", "calc", "{}", ["b"]), (2, 4, "d", "calc", "{}", []), (2, 5, "s", "calc", "{}", ["s"]),
    ]
    rows = run(spark, calls=calls)
    one = [r.call_id for r in rows if r.conv_id == 1]
    assert one == ["b", "d", "c", "e", "a", "f"]
    waits = {r.call_id: r.problems for r in rows if r.conv_id == 2}
    assert waits["a"] == waits["b"] == waits["s"] == ["waits for itself"] and waits["d"] == []
    assert waits["c"] == []  # its turn comes after the whole cycle


@pytest.mark.parametrize("in_a_row", [1024, 2])
def test_behind_and_before_a_cycle(spark, monkeypatch, in_a_row):
    """y waits for the cycle a-b (turns 3 and 4) and is told apart from it; x is waited for by it."""
    monkeypatch.setattr(X, "GROUP_CALLS", in_a_row)
    calls = [(1, 3, "a", "calc", "{}", ["b"]), (1, 4, "b", "calc", "{}", ["a", "x"]), (1, 1, "y", "calc", "{}", ["a"]), (1, 1, "z", "calc", "{}", ["y"]), (1, 5, "x", "calc", "{}", []), (1, 9, "w", "calc", "{}", ["z"])]
    rows = run(spark, calls=calls)
    found = {r.call_id: r.problems for r in rows}
    assert found == {"a": ["waits for itself"], "b": ["waits for itself"], "y": ["waits for a cycle"], "z": ["waits for a cycle"], "x": [], "w": []}
    assert [r.call_id for r in rows][0] == "x" and [r.call_id for r in rows][-1] == "w"


def test_cycle_among_many_calls_takes_few_writes(spark, monkeypatch):
    n = 1000
    calls = [(1, k, f"c{k}", "calc", "{}", [f"c{k - 1}"] if k else []) for k in range(n)]
    calls += [(2, k, f"c{k}", "calc", "{}", [f"c{(k + 1) % 40}"] if k < 40 else []) for k in range(n)]
    calls += [(3, 0, f"c{k}", "calc", "{}", [f"c{k + 1}"]) for k in range(300)]
    writes = []
    import tessera.llm.components as C

    for module in (X, C):
        monkeypatch.setattr(module, "stored", lambda df, name, real=X.stored: (writes.append(name), real(df, name))[1])
    rows = run(spark, calls=calls)
    assert len(writes) < 60, Counter(writes)
    found = Counter((r.conv_id, tuple(r.problems)) for r in rows)
    assert found == {(1, ()): n, (2, ("waits for itself",)): 40, (2, ()): n - 40, (3, ()): 300}
    assert [r.call_id for r in rows if r.conv_id == 3] == [f"c{k}" for k in reversed(range(300))]
    assert [r.call_id for r in rows if r.conv_id == 1] == [f"c{k}" for k in range(n)]


def test_repeated_identifiers_pair_in_order(spark):
    rows = run(spark, calls=[(1, 1, "call_1", "search", '{"query":"A"}', None), (1, 5, "call_1", "search", '{"query":"B"}', None), (1, 5, "call_1", "search", '{"query":"B"}', None),
                             (1, 7, "call_1", "search", '{"query":"C"}', None), (1, 8, "x", "calc", "{}", ["call_1"])],
               results=[(1, 2, "call_1", "to A"), (1, 6, "call_1", "to B"), (2, 6, "call_1", "elsewhere")])
    seen = [(r.kind, r.n_calls, r.n_results, r.problems, json.loads(r.json).get("arguments", {}).get("query"), json.loads(r.json).get("text")) for r in rows]
    assert seen == [("call", 1, 1, [], "A", "to A"), ("call", 2, 1, ["repeated identifier"], "B", "to B"), ("call", 1, 0, ["repeated identifier"], "C", None),
                    ("call", 1, 0, [], None, None), ("orphan", 0, 1, [], None, "elsewhere")]


def test_hot_groups_are_cut_into_ranges(spark, monkeypatch):
    """One null conversation with a third of all rows, in one turn and in many; one identifier with many calls and results."""
    monkeypatch.setattr(X, "SMALL_GROUP", 5)
    messages = [(None, None, "user", f"m{k % 7}") for k in range(60)] + [(k, 1, "user", "x") for k in range(60)]
    calls = [(9, k % 3, "hot", "calc", f'{{"x": {k}}}', None) for k in range(40)]
    results = [(9, k, "hot", f"r{k}") for k in range(45)]
    rows = run(spark, messages, calls, results)
    assert len(rows) == 60 + 60 + 45
    for conv, n in ((None, 60), (9, 46)):
        assert [r.position for r in rows if r.conv_id == conv] == list(range(n))
    hot = [(r.kind, json.loads(r.json)) for r in rows if r.call_id == "hot"]
    pairs = sorted(((j["turn"], int(j["text"][1:])) for kind, j in hot if kind == "call"), key=lambda p: p[1])
    assert [t for t, _ in pairs] == sorted(t for t, _ in pairs) and [r for _, r in pairs] == list(range(40))
    assert sorted(int(j["text"][1:]) for kind, j in hot if kind == "orphan") == list(range(40, 45))


def test_order_of_random_graphs(spark):
    import random

    rng, calls, deps = random.Random(5), [], {}
    for conv in range(12):
        n = rng.randint(1, 9)
        order = rng.sample(range(n), n)
        for k in range(n):
            after = [f"c{order[j]}" for j in range(k) if rng.random() < 0.4]
            deps[conv, f"c{order[k]}"] = after
            calls.append((conv, rng.randint(0, 4), f"c{order[k]}", "calc", "{}", after))
    rows = run(spark, calls=calls)
    at = {(r.conv_id, r.call_id): r.position for r in rows}
    assert len(at) == len(calls) and all(not r.problems for r in rows)
    assert all(at[c, d] < at[c, k] for (c, k), after in deps.items() for d in after)


def test_repeats_nulls_and_empty_tables(spark):
    rows = run(
        spark, [(None, None, None, None), (3, 1, "system", ""), (3, 1, "system", "")],
        [(3, 1, "a", "calc", "{}", None), (3, 0, "a", "search", '{"query":"first"}', None), (3, 1, None, "calc", "{}", None), (None, 2, "a", None, None, None)],
        [(3, 5, None, "no id"), (None, 7, "a", None), (3, None, "a", "x" * 100_000)])
    by = defaultdict(list)
    for r in rows:
        by[r.conv_id].append(r)
    assert [sorted(r.position for r in v) for v in by.values()] == [list(range(len(v))) for v in by.values()]
    assert Counter((r.kind, r.call_id) for r in by[3]) == {("call", "a"): 2, ("message", None): 2, ("unlinked", None): 2}
    first, second = (r for r in by[3] if r.kind == "call")
    assert first.n_calls == 1 and json.loads(first.json)["name"] == "search" and len(json.loads(first.json)["text"]) == 100_000
    assert json.loads(second.json)["name"] == "calc" and second.problems == ["repeated identifier"]
    assert Counter((r.kind, r.n_calls, r.n_results) for r in by[None]) == {("message", 0, 0): 1, ("call", 1, 1): 1}
    assert run(spark) == []


def test_every_turn_is_an_event(spark, table):
    """Plain Python over the same derived tool use."""
    talk = table("conversations")
    given = [tuple(r) for r in talk.select("conv_id", "turn", "role").collect()]
    rows = X.op8_tool_calls(talk).collect()
    roles = {(c, t): r for c, t, r in given}
    users = [k for k, r in roles.items() if r == "user"]
    linked = [k for k, r in roles.items() if r == "assistant" and roles.get((k[0], k[1] - 1)) == "user"]
    assert Counter(r.kind for r in rows if r.kind) == Counter({k: n for k, n in {
        "call": len(users), "orphan": sum(r == "assistant" for r in roles.values()) - len(linked), "message": sum(r == "system" for r in roles.values())}.items() if n})
    assert sum(r.n_results for r in rows if r.kind == "call") == len(linked)
    assert all(json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json for r in rows)


@pytest.mark.parametrize("columns", ["*", "conv_id, turn, role, cast(null as string) as text"])
def test_plan_runs_no_python(spark, table, columns):
    table("conversations").createOrReplaceTempView("talk_")
    plan = X.op8_tool_calls(spark.sql(f"select {columns}, 'x' as json, 'y' as call_id from talk_"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD", "Cartesian", "NestedLoop"))
