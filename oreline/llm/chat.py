"""Tool-call linking: calls joined with results, ordered, validated, serialised. JVM only.

Calls and results meet by identifier in a hash join. A call may name calls that
it depends on; calls are put in levels, a call one above the highest it depends
on, by rounds that each take every call whose dependencies are done. Arguments
are parsed once and checked against the schema of their tool, and each linked
call becomes one line of canonical JSON (keys sorted, no white space).

Cases: a call without a result is ``unanswered``, a result without a call is
``orphan``, and of several results of one identifier the first by turn is linked,
the others are ``repeated`` (``link_calls`` only counts them, as its SQL twin does;
``link_rows`` has a row with its content for each result, ``turn_rows`` for each turn); an identifier used by several calls keeps them all,
each linked to the same result; calls on a cycle, or behind one, have no level;
unknown dependencies are ignored; arguments that are no JSON object are invalid;
a tool without a schema is ``unknown tool``. Null identifiers link with nothing.
Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import require, stored

TURN_RANGE = 1024  # turns of a conversation that are numbered in one task

# JSON types by the name Spark gives to parsed values.
TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "DOUBLE|DECIMAL.*|BIGINT|FLOAT",
    "boolean": "BOOLEAN",
    "array": "ARRAY<.*>",
    "object": "OBJECT<.*>",
    "null": "VOID",
}


def levels(calls: DataFrame, max_rounds: int = 10000) -> DataFrame:
    """``(call_id, level)`` of ``calls(call_id, depends_on array)``; null level on cycles.

    Calls with one dependency are links of chains: each jumps to what its target
    points at, twice as far every round, until it stands on a call with none or
    several dependencies. Only the latter are then taken level by level, so a long
    conversation costs a number of rounds logarithmic in its length.
    """
    ids = calls.where("call_id is not null").select("call_id").distinct()
    edges = calls.select("call_id", F.explode("depends_on").alias("needs")).distinct()
    edges = edges.join(ids.select(F.col("call_id").alias("needs")), "needs", "left_semi")
    edges = stored(edges.where("call_id is not null").select("call_id", "needs"), "edges")
    many = edges.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("needs").alias("needs"))
    nodes = stored(ids.join(many, "call_id", "left").fillna(0, ["n"]), "nodes")
    link = F.col("n") == 1
    steps = stored(
        nodes.select(
            "call_id",
            F.when(link, F.col("needs")).otherwise(F.col("call_id")).alias("target"),
            F.when(link, 1).otherwise(0).cast("long").alias("steps"),
            (~link).alias("there"),
        ),
        "steps",
    )
    # After this many doublings only links on a cycle, or behind one, are not there.
    for _ in range(steps.count().bit_length()):
        far = steps.where("not there")
        if far.isEmpty():
            break
        ahead = steps.select(
            F.col("call_id").alias("at"),
            F.col("target").alias("next"),
            F.col("steps").alias("more"),
            F.col("there").alias("arrived"),
        )
        moved = far.join(ahead, F.col("target") == F.col("at")).select(
            "call_id", F.col("next").alias("target"), F.col("steps") + F.col("more"), "arrived"
        )
        steps = stored(steps.where("there").union(moved), "steps")

    ranked = nodes.where("n = 0").select("call_id", F.lit(0).cast("long").alias("level"))
    joints = nodes.where("n > 1").select("call_id")
    reach = steps.select(F.col("call_id").alias("needs"), "target", "steps")
    waiting = edges.join(joints, "call_id", "left_semi").join(reach, "needs")
    waiting = stored(waiting.select("call_id", "target", (F.col("steps") + 1).alias("steps")), "waiting")
    ready, seen = ranked, None
    for _ in range(max_rounds):
        if waiting.isEmpty():
            break
        met = waiting.join(ready.select(F.col("call_id").alias("target"), "level"), "target")
        met = met.select("call_id", (F.col("steps") + F.col("level")).alias("level"))
        seen = met if seen is None else seen.union(met)
        seen = stored(seen.groupBy("call_id").agg(F.max("level").alias("level")), "seen")
        done = ready.select(F.col("call_id").alias("target"))
        waiting = stored(waiting.join(done, "target", "left_anti").select(*waiting.columns), "waiting")
        ready = stored(seen.join(waiting, "call_id", "left_anti"), "ready")
        if ready.isEmpty():
            break
        seen = seen.join(ready, "call_id", "left_anti")
        ranked = ranked.union(ready)
    else:
        raise RuntimeError(f"dependencies are deeper than {max_rounds} joints")
    level = ranked.select(F.col("call_id").alias("target"), "level")
    return steps.join(level, "target", "left").select(
        "call_id", F.when(F.col("there"), F.col("level") + F.col("steps")).alias("level")
    )


def checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with ``parsed``, ``errors`` (sorted texts) against ``schemas(tool, field, type, required)``."""
    kinds = F.lit(None).cast("string")
    for name, pattern in TYPES.items():
        kinds = F.coalesce(kinds, F.when(F.col("type") == name, pattern))
    known = schemas.select("tool", "field", kinds.alias("pattern"), "required").groupBy("tool")
    known = known.agg(F.collect_list(F.struct("field", "pattern", "required")).alias("fields"))
    parsed = F.try_parse_json(F.col("arguments"))
    out = calls.join(known.withColumnRenamed("tool", "known_tool"), F.col("tool") == F.col("known_tool"), "left")
    out = out.withColumn("parsed", parsed)
    shape = F.schema_of_variant("parsed")
    given = F.from_json(F.when(shape.startswith("OBJECT"), F.to_json("parsed")), "map<string,variant>")
    out = out.withColumn("given", given)
    errors = F.expr(
        """array_sort(concat(
          transform(filter(fields, f -> f.required and not coalesce(map_contains_key(given, f.field), false)),
                    f -> concat('missing ', f.field)),
          transform(filter(fields, f -> map_contains_key(given, f.field)
                      and not schema_of_variant(given[f.field]) rlike concat('^(', f.pattern, ')$')),
                    f -> concat('type of ', f.field)),
          transform(filter(map_keys(given), k -> not exists(fields, f -> f.field = k)),
                    k -> concat('unknown ', k))))"""
    )
    out = out.withColumn(
        "errors",
        F.when(F.col("fields").isNull(), F.array(F.lit("unknown tool")))
        .when(F.col("given").isNull(), F.array(F.lit("arguments are no object")))
        .otherwise(errors),
    )
    return out.drop("known_tool", "fields", "given")


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, and per result without a call.

    ``calls(call_id, tool, arguments, depends_on)``, ``results(call_id, turn,
    content)``. Returns call_id, tool, level, result_turn, n_results, status
    (linked, unanswered, orphan), valid, errors and json.
    """
    require(calls, "call_id", "tool", "arguments", "depends_on")
    require(results, "call_id", "turn", "content")
    require(schemas, "tool", "field", "type", "required")
    answers = results.groupBy("call_id").agg(
        F.min(F.struct("turn", "content")).alias("first"), F.count(F.lit(1)).alias("n_results")
    )
    answers = answers.select("call_id", "first", "n_results", F.lit(True).alias("has_result"))
    asked = calls.select("call_id", "tool", "arguments", "depends_on", F.lit(True).alias("has_call"))
    ready = checked(asked, schemas)
    ready = ready.join(levels(calls), "call_id", "left")
    both = ready.join(answers, "call_id", "full_outer")
    valid = F.when(F.col("has_call"), F.size("errors") == 0)
    line = F.struct(
        F.col("parsed").alias("arguments"),
        F.col("call_id").alias("id"),
        F.col("level").alias("level"),
        F.col("first.content").alias("result"),
        F.col("tool").alias("tool"),
    )
    status = F.when(F.col("has_call").isNull(), "orphan").when(F.col("has_result"), "linked")
    return both.select(
        "call_id",
        "tool",
        "level",
        F.col("first.turn").alias("result_turn"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.coalesce(status, F.lit("unanswered")).alias("status"),
        valid.alias("valid"),
        F.array_join("errors", "; ").alias("errors"),
        F.when(F.col("has_call"), F.to_json(line)).alias("json"),
    )


def link_rows(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and one per result, each with its own content.

    Tables as for ``link_calls``. Returns call_id, kind (call, result), turn, status
    (linked, unanswered, repeated, orphan), level, valid, errors, content and json.
    Only results have a turn and content; a call's arguments stand in its json.
    """
    asked = link_calls(calls, results, schemas).where("status <> 'orphan'").select(
        "call_id",
        F.lit("call").alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        "status",
        "level",
        "valid",
        "errors",
        F.lit(None).cast("string").alias("content"),
        "json",
    )
    # Equal results are counted and dealt out again: one of them is the first.
    each = results.groupBy("call_id", "turn", "content").agg(F.count(F.lit(1)).alias("n"))
    each = stored(each, "results")
    first = each.groupBy("call_id").agg(F.min(F.struct("turn", "content")).alias("first"))
    known = calls.where("call_id is not null").select("call_id").distinct()
    first = first.join(known, "call_id")
    met = each.join(first, "call_id", "left").withColumn("copy", F.explode(F.expr("sequence(1L, n)")))
    is_first = (F.col("copy") == 1) & F.struct("turn", "content").eqNullSafe(F.col("first"))
    status = F.when(F.col("first").isNull(), "orphan").when(is_first, "linked").otherwise("repeated")
    met = met.withColumn("status", status)
    line = F.struct("content", F.col("call_id").alias("id"), "status", "turn")
    answers = met.select(
        "call_id",
        F.lit("result").alias("kind"),
        F.col("turn").cast("long").alias("turn"),
        "status",
        F.lit(None).cast("long").alias("level"),
        F.lit(None).cast("boolean").alias("valid"),
        F.lit(None).cast("string").alias("errors"),
        "content",
        F.to_json(line).alias("json"),
    )
    return asked.union(answers)


def turn_rows(turns: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per turn: ``link_rows`` of its calls and results, and the other turns.

    Turns that neither call nor answer have their role as kind and status, no
    call_id, and their text as content and in the json.
    """
    calls, results = calls_of(turns)
    rest = turns.where("role is null or role not in ('user', 'assistant')")
    kind = F.coalesce("role", F.lit("no role"))
    line = F.struct(F.col("text").alias("content"), "conv_id", "role", "turn")
    rest = rest.select(
        F.lit(None).cast("string").alias("call_id"),
        kind.alias("kind"),
        F.col("turn").cast("long").alias("turn"),
        kind.alias("status"),
        F.lit(None).cast("long").alias("level"),
        F.lit(None).cast("boolean").alias("valid"),
        F.lit(None).cast("string").alias("errors"),
        F.col("text").alias("content"),
        F.to_json(line).alias("json"),
    )
    return link_rows(calls, results, schemas).union(rest)


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a table of conversation turns stands for.

    A user turn calls the tool ``reply`` with its text and needs the call before it
    in its conversation; an assistant turn is the result of the last call. Ranges of
    turns are looked through one by one, and the last call is carried over the ranges.
    Other turns give neither (see ``turn_rows``).
    """
    require(turns, "conv_id", "turn", "role", "text")
    turns = turns.select("conv_id", "turn", "role", "text")
    turns = turns.withColumn("part", F.expr(f"cast(turn as bigint) div {TURN_RANGE}"))
    line = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    user = F.when(F.col("role") == "user", F.col("turn"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = turns.groupBy("conv_id", "part").agg(F.max(user).alias("last"))
    ranges = ranges.select(
        F.col("conv_id").alias("of"), F.col("part").alias("with"), F.max("last").over(earlier).alias("carried")
    )
    before = F.last(user, ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    seen = turns.withColumns({"call_turn": F.last(user, ignorenulls=True).over(line), "before": before})
    seen = seen.join(ranges, F.expr("conv_id <=> of and part <=> with"))
    seen = seen.withColumn("call_turn", F.coalesce("call_turn", "carried"))
    before = F.coalesce("before", "carried")
    # Not a constant: joins by tool stay hash joins.
    tool = F.when(F.col("role") == "user", F.lit("reply"))
    seen = seen.withColumns({"needs_turn": before, "tool": tool})
    name = lambda turn: F.concat_ws("-", F.lit("call"), "conv_id", turn)
    calls = seen.where("role = 'user'").select(
        name("turn").alias("call_id"),
        "tool",
        F.to_json(F.struct(F.col("turn"), F.col("text"))).alias("arguments"),
        F.when(F.col("needs_turn").isNull(), F.array().cast("array<string>"))
        .otherwise(F.array(name("needs_turn")))
        .alias("depends_on"),
    )
    results = seen.where("role = 'assistant'").select(
        F.when(F.col("call_turn").isNotNull(), name("call_turn"))
        .otherwise(name("turn"))
        .alias("call_id"),
        "turn",
        F.col("text").alias("content"),
    )
    return calls, results
