"""Chat formatting: tool calls linked to their results, ordered, validated, as canonical JSON.

Only DataFrame and SQL functions; no Python runs on the executors.

1. Equal calls, and equal results, of a conversation are one event with a count.  Those of one identifier are
   numbered in the order of their turns, and a hash join links the k-th call to the k-th result.
2. Topological order: a call comes after the (first) calls it names in ``after``.  Its place is
   (release, depth): release is the latest turn it has to wait for, depth its level among calls of
   equal release.  Where all dependencies agree with the turns that is (turn, 0).  In the other
   conversations the dependencies' connected groups are found by star contraction, in rounds logarithmic
   in their size, and each group of up to ``GROUP_CALLS`` calls is solved inside one row: places are raised along
   the dependencies until nothing changes.  Larger groups are raised a level a round, over tables.  A depth that
   reaches the group's number of calls proves a cycle; the same along the reversed dependencies tells the
   calls of a cycle ("waits for itself"; those between two cycles too) from the calls behind one ("waits for a cycle").
3. Arguments are parsed to VARIANT and checked against the tool's schema in the row itself.
4. Every event is one row with a canonical JSON text (keys in order, no blanks, absent values left
   out) and a gapless position in its conversation.  Numbering takes one window per
   conversation; those with over 1/1000 of all rows are cut into ranges of their order instead.  A
   conversation is never gathered into one value.

Defined results: a call or result without identifier is an event of its own (``unlinked``); a
result that no call is left for is an ``orphan``; calls and results of an identifier after its first ones
have the problem "repeated identifier"; a null turn comes first; null conversations
are one conversation; arguments that are no JSON object stand in the JSON as ``arguments_text`` and are reported;
equal messages get consecutive positions; empty inputs give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import HEAVY_SHARE, attach, stored
from tessera.llm.components import components
from tessera.operators.positional import global_row_number

#: Rows of a group that one window may number, whatever their share.
SMALL_GROUP = 64
#: Calls of a group of dependencies that are solved in one row.
GROUP_CALLS = 1024
_KINDS = {
    "string": ("STRING",), "integer": ("BIGINT", "DECIMAL"), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "boolean": ("BOOLEAN",),
    "object": ("OBJECT",), "array": ("ARRAY",), "null": ("VOID",),
}
Tools = dict[str, dict]


def _problem(condition: Column, text: str) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(text))


def _integral(value: Column, kind: Column) -> Column:
    return ~kind.startswith("DECIMAL") | kind.endswith(",0)")


def argument_problems(tools: Tools) -> Column:
    """Sorted problems of a call with columns name, arguments (JSON text) and args (VARIANT)."""
    kind = F.expr("schema_of_variant(args)")
    unknown = _problem(F.col("name").isNull() | ~F.col("name").isin(*tools), "unknown tool")
    no_object = _problem(kind.isNull() | ~kind.startswith("OBJECT"), "arguments are no JSON object")
    found = [unknown, no_object]
    for tool, schema in tools.items():
        here = (F.col("name") == tool) & kind.startswith("OBJECT")
        keys = F.json_object_keys("arguments")
        for name, rule in schema.get("properties", {}).items():
            value = f"try_variant_get(args, '$[\"{name}\"]', 'variant')"
            of = F.expr(f"schema_of_variant({value})")
            present = F.array_contains(keys, name)
            if name in schema.get("required", ()):
                found.append(_problem(here & ~present, f"{name}: missing"))
            if kinds := _KINDS.get(rule.get("type")):
                fits = reduce(lambda a, b: a | b, [of.startswith(k) for k in kinds])
                if rule["type"] == "integer":
                    fits = fits & _integral(F.expr(value), of)
                found.append(_problem(here & present & ~fits, f"{name}: no {rule['type']}"))
            number = F.expr(f"try_variant_get(args, '$[\"{name}\"]', 'double')")
            if "minimum" in rule:
                found.append(_problem(here & present & (number < rule["minimum"]), f"{name}: below {rule['minimum']}"))
            if "maximum" in rule:
                found.append(_problem(here & present & (number > rule["maximum"]), f"{name}: above {rule['maximum']}"))
            if "enum" in rule:
                text = F.expr(f"try_variant_get(args, '$[\"{name}\"]', 'string')")
                found.append(_problem(here & present & (text.isNull() | ~text.isin(*rule["enum"])), f"{name}: none of its values"))
        if not schema.get("additionalProperties", True):
            extra = F.array_except(keys, F.array(*[F.lit(n) for n in schema.get("properties", {})]).cast("array<string>"))
            found.append(_problem(here & (F.size(extra) > 0), "undeclared arguments"))
    return F.array_sort(F.array_compact(F.array(*found)))


def _key(conv: Column) -> Column:
    return F.when(conv.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), conv.cast("string")))


def _numbered(rows: DataFrame, group: list[str], order: list[str], alias: str) -> DataFrame:
    """``rows`` (stored) numbered from 1 within each ``group`` by ``order`` (nulls first), groups with a large share in ranges."""
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    # fewer than HEAVY_SHARE groups by definition
    heavy = stored(counts.where((F.col("_n") * HEAVY_SHARE > total) & (F.col("_n") > SMALL_GROUP)).select(*group), "tool-heavy")
    window = W.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    if heavy.isEmpty():
        return rows.withColumn(alias, F.row_number().over(window).cast("long"))
    few = rows.join(F.broadcast(heavy), group, "left_anti").withColumn(alias, F.row_number().over(window).cast("long"))
    placed = global_row_number(rows.join(F.broadcast(heavy), group, "left_semi"), [*group, *order], "_rn")
    first = placed.groupBy(*group).agg(F.min("_rn").alias("_first"))
    many = placed.join(F.broadcast(first), group).withColumn(alias, (F.col("_rn") - F.col("_first") + 1).cast("long"))
    return few.unionByName(many.drop("_rn", "_first"))


def _raised(turns: Column, deps: Column, n: Column) -> Column:
    """Of each call of a group, by place in ``turns``: (release, depth) after waiting for its ``deps`` (places), depth up to ``n``."""
    start = F.transform(turns, lambda t: F.struct(t.alias("release"), F.lit(0).cast("long").alias("depth")))

    def wait(state: Column) -> Column:
        def one(own: Column, k: Column) -> Column:
            waited = F.transform(F.get(deps, k), lambda d: F.struct(
                F.get(state, d)["release"].alias("release"), F.least(F.get(state, d)["depth"] + 1, n).alias("depth")))
            return F.greatest(own, F.coalesce(F.array_max(waited), own))

        return F.transform(state, one)

    begin = F.struct(F.array().cast("array<struct<release:bigint,depth:bigint>>").alias("last"), start.alias("now"))
    # a depth of n needs n rounds on the cycle and up to n more behind it; rounds after the last change cost a comparison
    turn = lambda s, _: F.when(s["last"] == s["now"], s).otherwise(F.struct(s["now"].alias("last"), wait(s["now"]).alias("now")))
    return F.aggregate(F.sequence(F.lit(1).cast("long"), 2 * n + 1), begin, turn)["now"]


def _small_groups(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(ck, call_id, k, release, depth, behind, before) of groups that fit a row; ``nodes``: (root, ck, call_id, k, turn, n)."""
    calls = nodes.groupBy("ck", "root").agg(F.array_sort(F.collect_list(F.struct("call_id", "k", "turn"))).alias("calls"), F.max("n").alias("n"))
    waits = edges.groupBy("ck", "root").agg(F.collect_list(F.struct("call_id", "k", "dep")).alias("waits"))
    rows = calls.join(waits, ["ck", "root"])
    first = F.filter("calls", lambda c: c["k"] == 1)
    place = F.map_from_entries(F.transform(first, lambda c: F.struct(c["call_id"], F.array_position(F.col("calls"), c) - 1)))
    rows = rows.withColumn("at", place)
    ahead = F.transform("calls", lambda c: F.transform(
        F.filter("waits", lambda e: (e["call_id"] == c["call_id"]) & (e["k"] == c["k"])), lambda e: F.element_at(F.col("at"), e["dep"]).cast("int")))
    rows = rows.withColumn("ahead", ahead)
    places = F.sequence(F.lit(0), F.size("calls") - 1)
    back = F.transform(places, lambda k: F.filter(places, lambda j: F.array_contains(F.get("ahead", j), k)))
    rows = rows.withColumn("now", _raised(F.col("calls.turn"), F.col("ahead"), F.col("n")))
    cyclic = F.exists("now", lambda p: p["depth"] >= F.col("n"))
    still = F.transform("calls", lambda _: F.lit(0).cast("long"))
    rows = rows.withColumn("back", F.when(cyclic, back))
    rows = rows.withColumn("led", F.when(cyclic, _raised(still, F.col("back"), F.col("n"))))
    each = rows.select("ck", "n", F.posexplode("calls").alias("_k", "c"), "now", "led")
    return each.select(
        "ck", "c.call_id", "c.k", F.get("now", "_k")["release"].alias("release"), F.get("now", "_k")["depth"].alias("depth"),
        (F.get("now", "_k")["depth"] >= F.col("n")).alias("behind"), F.coalesce(F.get("led", "_k")["depth"] >= F.col("n"), F.lit(False)).alias("before"))


def _levels(nodes: DataFrame, edges: DataFrame, child: list[str], parent: list[str]) -> DataFrame:
    """(ck, call_id, k, release, depth) of the large groups, raised a level a round.

    ``edges`` have both ends (ck, call_id, k, dep, dep_k); ``child`` names the end that waits for ``parent``.
    """
    waiting = stored(edges.groupBy("ck", *parent).agg(F.count(F.lit(1)).alias("w")), "tool-waiting")
    total = waiting.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    now = stored(nodes.select("ck", "call_id", "k", F.col("turn").alias("release"), F.lit(0).cast("long").alias("depth"), "n"), "tool-places")
    while total:
        at = now.select("ck", F.col("call_id").alias(parent[0]), F.col("k").alias(parent[1]), "release", "depth")
        seen = attach(edges, waiting.join(at, ["ck", *parent]), ["ck", *parent], "w", total, F.xxhash64(*child))
        least = seen.groupBy("ck", F.col(child[0]).alias("call_id"), F.col(child[1]).alias("k")).agg(F.max(F.struct("release", (F.col("depth") + 1).alias("depth"))).alias("least"))
        joined = now.join(least, ["ck", "call_id", "k"], "left")
        raised = joined.withColumn("_p", F.greatest(F.struct("release", "depth"), F.col("least"))).withColumn("_d", F.least(F.col("_p.depth"), F.col("n")))
        raised = raised.withColumn("moved", (F.col("_p.release") > F.col("release")) | (F.col("_d") > F.col("depth")))
        raised = stored(raised.select("ck", "call_id", "k", F.col("_p.release").alias("release"), F.col("_d").alias("depth"), "n", "moved"), "tool-places")
        now = raised.drop("moved")
        if raised.where("moved").isEmpty():
            break
    return now


def _places(calls: DataFrame) -> DataFrame:
    """(ck, call_id, k, release, depth, behind, before) of the calls whose place isn't (turn, 0); ``calls``: (ck, call_id, k, turn, after)."""
    known = calls.select("ck", "call_id", "k", F.coalesce("turn", F.lit(-1).cast("long")).alias("turn"), "after")
    edges = known.select("ck", "call_id", "k", "turn", F.explode("after").alias("dep"))
    # a call that many wait for is one row here; its turn goes out to those waiting by attach, which splits them
    waited = edges.groupBy("ck", "dep").agg(F.count(F.lit(1)).alias("w"))
    first = known.where("k = 1").select("ck", F.col("call_id").alias("dep"), F.col("turn").alias("dep_turn"))
    waited = stored(waited.join(first, ["ck", "dep"]), "tool-waited")
    total = waited.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    found = attach(edges, waited, ["ck", "dep"], "w", max(total, 1), F.xxhash64("call_id", "k")).where("dep_turn is not null").drop("w")
    found = stored(found, "tool-dependencies")
    late = found.where("dep_turn >= turn").groupBy("ck").agg(F.count(F.lit(1)).alias("late"))
    of = stored(found.groupBy("ck").agg(F.count(F.lit(1)).alias("w")).join(late, "ck", "left"), "tool-late")
    node = lambda *c: F.xxhash64(*c)  # noqa: E731 - equal hashes would only join two groups
    if of.where("late > 0").isEmpty():
        return known.where(F.lit(False)).select("ck", "call_id", "k", F.col("turn").alias("release"), F.lit(0).cast("long").alias("depth"), F.lit(False).alias("behind"), F.lit(False).alias("before"))
    total = of.agg(F.sum("w")).first()[0]
    edges = attach(found, of, ["ck"], "w", total, F.xxhash64("call_id", "k", "dep")).where("late > 0")
    edges = edges.withColumn("u", node("ck", "call_id", "k")).withColumn("v", node("ck", "dep", F.lit(1).cast("long")))
    edges = stored(edges.select("ck", "call_id", "k", "dep", F.lit(1).cast("long").alias("dep_k"), "u", "v"), "tool-edges")
    pairs = edges.select("u", "v")
    roots = components(pairs).unionByName(pairs.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
    nodes = known.withColumn("node", node("ck", "call_id", "k")).join(roots, "node").select("root", "node", "ck", "call_id", "k", "turn")
    sizes = nodes.groupBy("ck", "root").agg(F.count(F.lit(1)).alias("n"))
    nodes = stored(attach(nodes, stored(sizes, "tool-groups"), ["ck", "root"], "n", max(1, nodes.count()), F.col("node")), "tool-nodes")
    placed = edges.join(nodes.select(F.col("node").alias("u"), "ck", "root", "n").distinct(), ["ck", "u"])
    small, big = F.col("n") <= GROUP_CALLS, F.col("n") > GROUP_CALLS
    out = _small_groups(nodes.where(small), placed.where(small))
    large = nodes.where(big)
    if large.isEmpty():
        return out
    waits = stored(placed.where(big).select("ck", "call_id", "k", "dep", "dep_k"), "tool-large")
    ahead = _levels(large, waits, ["call_id", "k"], ["dep", "dep_k"])
    cyclic = ahead.select("*", (F.col("depth") >= F.col("n")).alias("behind"))
    if cyclic.where("behind").isEmpty():
        return out.unionByName(cyclic.select("ck", "call_id", "k", "release", "depth", "behind", F.lit(False).alias("before")))
    still = large.withColumn("turn", F.lit(0).cast("long"))
    led = _levels(still, waits, ["dep", "dep_k"], ["call_id", "k"]).select("ck", "call_id", "k", (F.col("depth") >= F.col("n")).alias("before"))
    return out.unionByName(cyclic.join(led, ["ck", "call_id", "k"]).select("ck", "call_id", "k", "release", "depth", "behind", "before"))


def formatted(messages: DataFrame, calls: DataFrame, results: DataFrame, tools: Tools) -> DataFrame:
    """One row per event: conv_id, position, kind, call_id, n_calls, n_results, problems, json.

    messages: (conv_id, turn, role, text); calls: (conv_id, turn, call_id, name, arguments, after
    array<string>); results: (conv_id, turn, call_id, content).  n_calls and n_results: equal rows the event stands for.
    """
    after = F.coalesce(F.array_sort(F.array_distinct(F.col("after").cast("array<string>"))), F.array().cast("array<string>"))
    given = calls.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col("call_id").cast("string").alias("call_id"), F.col("name").cast("string").alias("name"),
        F.col("arguments").cast("string").alias("arguments"), F.array_compact(after).alias("after"), _key(F.col("conv_id")).alias("ck"))
    answers = results.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col("call_id").cast("string").alias("call_id"), F.col("content").cast("string").alias("content"),
        _key(F.col("conv_id")).alias("ck"))
    asked = given.where("call_id is not null").groupBy(*given.columns).agg(F.count(F.lit(1)).alias("n_calls"))
    asked = asked.withColumn("digest", F.md5(F.concat_ws("|", "name", "arguments", F.array_join("after", ",")).cast("binary")))
    asked = stored(_numbered(stored(asked, "tool-asked"), ["ck", "call_id"], ["turn", "digest"], "k").drop("digest"), "tool-calls")
    answered = answers.where("call_id is not null").groupBy(*answers.columns).agg(F.count(F.lit(1)).alias("n_results"))
    answered = stored(answered.withColumn("digest", F.md5(F.col("content").cast("binary"))), "tool-answered")
    answered = _numbered(answered, ["ck", "call_id"], ["turn", "digest"], "k").select(
        "ck", "call_id", "k", F.col("conv_id").alias("r_conv"), F.struct("turn", "content").alias("r"), "n_results")
    keys = ["ck", "call_id", "k"]
    linked = asked.join(_places(asked), keys, "left").join(answered.hint("shuffle_hash"), keys, "full_outer")
    linked = linked.select(
        F.coalesce("conv_id", "r_conv").alias("conv_id"), "ck", F.when(F.col("n_calls").isNull(), "orphan").otherwise("call").alias("kind"), "call_id", "k",
        F.coalesce("turn", "r.turn").alias("turn"), F.coalesce("release", "turn", F.when(F.col("n_calls").isNull(), F.col("r.turn")), F.lit(-1)).alias("release"),
        F.coalesce("depth", F.lit(0)).alias("depth"), "name", "arguments", "after", F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"), F.col("r.content").alias("text"), F.col("r.turn").alias("result_turn"),
        F.coalesce(F.col("behind") & F.col("before"), F.lit(False)).alias("cyclic"), F.coalesce(F.col("behind") & ~F.col("before"), F.lit(False)).alias("blocked"),
        F.lit(None).cast("string").alias("role"))
    none = {"call_id": "string", "name": "string", "arguments": "string", "after": "array<string>", "result_turn": "long", "role": "string", "text": "string"}

    def single(df: DataFrame, kind: str, n_calls: int, n_results: int, **columns: str) -> DataFrame:
        own = {"n_calls": F.lit(n_calls).cast("long"), "n_results": F.lit(n_results).cast("long"), "cyclic": F.lit(False), "blocked": F.lit(False), "depth": F.lit(0).cast("long")}
        own |= {c: F.col(columns[c]) if c in columns else F.lit(None).cast(t) for c, t in none.items()}
        turn = F.col("turn").cast("long")
        own |= {"conv_id": F.col("conv_id"), "ck": _key(F.col("conv_id")), "kind": F.lit(kind), "k": F.lit(1).cast("long"), "turn": turn, "release": F.coalesce(turn, F.lit(-1))}
        return df.select(*[own[c].alias(c) for c in linked.columns])

    events = linked.unionByName(single(messages.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")), "message", 0, 0, role="role", text="text"))
    events = events.unionByName(single(given.where("call_id is null"), "unlinked", 1, 0, name="name", arguments="arguments", after="after"))
    events = events.unionByName(single(answers.where("call_id is null"), "unlinked", 0, 1, text="content"))
    events = events.withColumn("args", F.expr("try_parse_json(arguments)"))
    own = [_problem(F.col("cyclic"), "waits for itself"), _problem(F.col("blocked"), "waits for a cycle"), _problem(F.col("k") > 1, "repeated identifier")]
    checked = F.when(F.col("n_calls") > 0, argument_problems(tools)).otherwise(F.array().cast("array<string>"))
    events = events.withColumn("problems", F.array_sort(F.concat(checked, F.array_compact(F.array(*own)))))
    is_object = F.coalesce(F.expr("schema_of_variant(args) like 'OBJECT%'"), F.lit(False))
    record = F.struct(
        F.when(F.size("after") > 0, F.col("after")).alias("after"), F.when(is_object, F.col("args")).alias("arguments"), F.when(~is_object, F.col("arguments")).alias("arguments_text"),
        F.col("call_id").alias("call_id"), F.col("kind").alias("kind"), F.col("name").alias("name"), F.when(F.size("problems") > 0, F.col("problems")).alias("problems"),
        F.col("result_turn").alias("result_turn"), F.col("role").alias("role"), F.col("text").alias("text"), F.col("turn").alias("turn"))
    events = events.withColumn("json", F.to_json(record)).withColumn("digest", F.md5(F.col("json").cast("binary")))
    events = events.select("conv_id", "ck", "kind", "call_id", "n_calls", "n_results", "problems", "json", "release", "depth", "turn", "k", "digest")
    # equal messages are told apart by their place in the stored table
    events = stored(events.withColumn("row", F.monotonically_increasing_id()), "tool-events")
    out = _numbered(events, ["ck"], ["release", "depth", "turn", "kind", "call_id", "k", "digest", "row"], "position")
    return out.select("conv_id", (F.col("position") - 1).alias("position"), "kind", "call_id", "n_calls", "n_results", "problems", "json")


# --- the query: tool use derived from the conversations -----------------------------------------

TOOLS: Tools = {
    "ask": {"properties": {"limit": {"type": "integer", "minimum": 0, "maximum": 4}, "query": {"type": "string"}}, "required": ["query", "limit"], "additionalProperties": False},
    "note": {"properties": {"query": {"type": "string"}, "strict": {"type": "boolean"}}, "required": ["query"], "additionalProperties": False},
}


def derived(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Messages, calls and results: a user's turn calls a tool with its text, and the next turn, if it is the
    assistant's, is the result.  Texts of even length use ``ask``; those divisible by three wait for the
    user's next call; those divisible by five give the limit as a string.  Other turns are messages.
    """
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text")

    def call_id(turn: Column) -> Column:
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))

    limit = F.when(n % 5 == 0, F.concat(F.lit('"'), F.col("turn").cast("string"), F.lit('"'))).otherwise(F.col("turn").cast("string"))
    quoted = F.expr("substring(to_json(struct(text)), 9, length(to_json(struct(text))) - 9)")
    arguments = F.when(n % 2 == 0, F.concat(F.lit('{"query": '), quoted, F.lit(', "limit": '), limit, F.lit("}"))).otherwise(
        F.concat(F.lit('{"strict": '), F.when(n % 7 == 0, F.lit("1")).otherwise(F.lit("true")), F.lit(', "query": '), quoted, F.lit("}")))
    calls = rows.where("role = 'user'").select(
        "conv_id", "turn", call_id(F.col("turn")).alias("call_id"), F.when(n % 2 == 0, "ask").otherwise("note").alias("name"), arguments.alias("arguments"),
        F.when(n % 3 == 0, F.array(call_id(F.col("turn") + 2))).otherwise(F.array().cast("array<string>")).alias("after"))
    results = rows.where("role = 'assistant'").select("conv_id", "turn", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return rows.where("role is null or role not in ('user', 'assistant')"), calls, results


def op8_tool_calls(conversations: DataFrame) -> DataFrame:
    found = formatted(*derived(conversations), TOOLS)
    return found.select("conv_id", "position", "kind", "call_id", "n_calls", "n_results", F.array_join("problems", "; ").alias("problems"), "json")


ORACLE_SQL = """
with recursive rows_ as (
  select conv_id, turn, role, coalesce(text, '') as text, length(coalesce(text, '')) as n from conversations),
u as (
  select *, 'call_' || conv_id || '_' || turn as call_id, case when n % 2 = 0 then 'ask' else 'note' end as name,
         case when n % 3 = 0 then 'call_' || conv_id || '_' || (turn + 2) end as dep,
         case when n % 2 = 0 then '{"query": ' || to_json(text) || ', "limit": ' || case when n % 5 = 0 then '"' || turn || '"' else '' || turn end || '}'
              else '{"strict": ' || case when n % 7 = 0 then '1' else 'true' end || ', "query": ' || to_json(text) || '}' end as arguments
  from rows_ where role = 'user'),
c as (
  select *, row_number() over (partition by conv_id, call_id order by turn nulls first, md5(name || '|' || arguments || '|' || coalesce(dep, ''))) as k
  from (select conv_id, call_id, turn, name, text, n, dep, arguments, count(*) as n_calls from u group by all)),
r as (
  select *, row_number() over (partition by conv_id, call_id order by turn nulls first, md5(text)) as k
  from (select conv_id, 'call_' || conv_id || '_' || (turn - 1) as call_id, turn, text, count(*) as n_results
        from rows_ where role = 'assistant' group by all)),
chain as (
  select conv_id, call_id, k, turn, turn as last, 0 as depth, n % 3 = 0 as waits from c
  union all
  select w.conv_id, w.call_id, w.k, w.turn, d.turn, w.depth + 1, d.n % 3 = 0
  from chain w join c d on d.conv_id = w.conv_id and d.turn = w.last + 2 and d.k = 1 where w.waits),
place as (select conv_id, call_id, k, max(last) as "release", max(depth) as depth from chain group by 1, 2, 3),
calls_ as (
  select c.conv_id, 'call' as kind, c.call_id, c.k, c.turn, p."release", p.depth, c.n_calls, coalesce(r.n_results, 0) as n_results,
         array_to_string(list_sort(list_filter([
           case when c.n % 2 = 0 and c.n % 5 = 0 then 'limit: no integer' end,
           case when c.n % 2 = 0 and c.turn > 4 then 'limit: above 4' end,
           case when c.k > 1 then 'repeated identifier' end,
           case when c.n % 2 = 1 and c.n % 7 = 0 then 'strict: no boolean' end], lambda x: x is not null)), '; ') as problems,
         c.n, c.text, c.name, r.turn as r_turn, r.text as r_text
  from c join place p using (conv_id, call_id, k) left join r using (conv_id, call_id, k)),
events as (
  select conv_id, kind, call_id, k, turn, "release", depth, n_calls, n_results, problems,
         '{' || case when n % 3 = 0 then '"after":["call_' || conv_id || '_' || (turn + 2) || '"],' else '' end
         || '"arguments":{' || case when n % 2 = 0
              then '"limit":' || case when n % 5 = 0 then '"' || turn || '"' else '' || turn end || ',"query":' || to_json(text)
              else '"query":' || to_json(text) || ',"strict":' || case when n % 7 = 0 then '1' else 'true' end end
         || '},"call_id":"' || call_id || '","kind":"call","name":"' || name || '"'
         || case when problems <> '' then ',"problems":["' || replace(problems, '; ', '","') || '"]' else '' end
         || case when r_turn is not null then ',"result_turn":' || r_turn || ',"text":' || to_json(r_text) else '' end
         || ',"turn":' || turn || '}' as json
  from calls_
  union all
  select r.conv_id, 'orphan', r.call_id, r.k, r.turn, r.turn, 0, 0, r.n_results, case when r.k > 1 then 'repeated identifier' else '' end,
         '{"call_id":"' || r.call_id || '","kind":"orphan"' || case when r.k > 1 then ',"problems":["repeated identifier"]' else '' end
         || ',"result_turn":' || r.turn || ',"text":' || to_json(r.text) || ',"turn":' || r.turn || '}'
  from r anti join c using (conv_id, call_id, k)
  union all
  select conv_id, 'message', null, 1, turn, turn, 0, 0, 0, '',
         '{"kind":"message","role":' || to_json(role) || ',"text":' || to_json(text) || ',"turn":' || turn || '}'
  from rows_ where role not in ('user', 'assistant'))
select conv_id, row_number() over (partition by conv_id order by "release", depth, turn, kind, call_id nulls first, k, md5(json)) - 1 as position,
       kind, call_id, cast(n_calls as bigint) as n_calls, cast(n_results as bigint) as n_results, problems, json
from events
"""
