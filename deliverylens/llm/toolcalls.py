"""Chat formatting by tool-call linking: hash-join calls and results by identifier,
topologically order the calls, validate their arguments against schemas, and serialise
canonical JSON. DataFrame functions throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.storage import written

KEY = ["conv_id", "call_id"]
# what schema_of_variant calls the types of JSON Schema
TYPES = {
    "string": "STRING",
    "integer": "(BIGINT|DECIMAL\\(\\d+,0\\))",
    "number": "(BIGINT|DECIMAL.*|DOUBLE|FLOAT)",
    "boolean": "BOOLEAN",
    "array": "ARRAY.*",
    "object": "OBJECT.*",
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # a JSON Schema type
    required: bool = True
    least: float | None = None  # of a number, or of a string's length
    most: float | None = None


def schema_errors(fields: tuple[Field, ...], arguments: Column) -> Column:
    """What is wrong with a JSON text of arguments, as an array of texts in the order
    of the fields; null arguments count as malformed."""
    parsed = F.try_parse_json(arguments)
    checks = []
    for f in fields:
        value = F.try_variant_get(parsed, f"$.{f.name}", "variant")
        kind = F.schema_of_variant(value)
        given = value.isNotNull() & (kind != "VOID")
        if f.required:
            checks.append(F.when(~given, f"{f.name}: missing"))
        right = kind.rlike(f"^{TYPES[f.kind]}$")
        checks.append(F.when(given & ~right, f"{f.name}: not {f.kind}"))
        size = F.length(F.try_variant_get(parsed, f"$.{f.name}", "string")).cast("double")
        if f.kind != "string":
            size = F.try_variant_get(parsed, f"$.{f.name}", "double")
        if f.least is not None:
            checks.append(F.when(given & right & (size < f.least), f"{f.name}: below {f.least:g}"))
        if f.most is not None:
            checks.append(F.when(given & right & (size > f.most), f"{f.name}: above {f.most:g}"))
    extra = F.array_except(F.json_object_keys(arguments), F.array(*(F.lit(f.name) for f in fields)))
    found = F.concat(
        F.array_compact(F.array(*checks)),
        F.coalesce(F.transform(F.array_sort(extra), lambda k: F.concat(k, F.lit(": unknown"))), F.array()),
    )
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, found).otherwise(F.array(F.lit("arguments: not an object")))


def validate(tool: Column, arguments: Column, schemas: dict[str, tuple[Field, ...]]) -> Column:
    """The errors of each call's arguments by the schema of its tool."""
    errors = F.array(F.lit("tool: unknown"))
    for name, fields in schemas.items():
        errors = F.when(tool == name, schema_errors(fields, arguments)).otherwise(errors)
    return errors


def _chains(single: DataFrame, n: int) -> DataFrame:
    """(conv_id, call_id, up, far) for calls with one need each: the first call up the
    chain that is no such call, and how far it is. Each round doubles the length of
    what is skipped, so rounds follow the logarithm of the longest chain. Calls on a
    ring, or behind one, are left out."""
    inner = single.select("conv_id", F.col("call_id").alias("up"), F.lit(True).alias("inner"))
    steps = written(
        single.join(inner, ["conv_id", "up"], "left").select(
            *KEY, "up", F.lit(1).cast("long").alias("far"), F.col("inner").isNull().alias("done")
        ),
        "chains",
    )
    reach = 1
    while reach <= n and not steps.where("not done").isEmpty():
        ahead = steps.select(
            "conv_id",
            F.col("call_id").alias("up"),
            F.col("up").alias("next"),
            F.col("far").alias("more"),
            F.col("done").alias("ended"),
        )
        moved = (
            steps.where("not done")
            .join(ahead, ["conv_id", "up"])
            .select(*KEY, F.col("next").alias("up"), (F.col("far") + F.col("more")).alias("far"), F.col("ended").alias("done"))
        )
        steps = written(steps.where("done").unionAll(moved), "chains")
        reach *= 2
    return steps.where("done").drop("done")


def topological_levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls: 0 for those that need no other call, else one
    more than the highest level they need. Calls on a cycle, or behind one, are left out.

    Needs that name no call of the conversation count for nothing. Chains of calls with
    one need each are skipped in steps that double; what is left, calls with several
    needs, goes in rounds, one for each such call on the longest path. Each round is
    written to the shared folder, and nothing but counts comes to the driver.
    """
    nodes = written(calls.select(*KEY).where("conv_id is not null and call_id is not null").distinct(), "calls")
    edges = written(
        calls.select(*KEY, F.explode("needs").alias("need"))
        .where("conv_id is not null and call_id is not null")
        .distinct()
        .join(nodes.select("conv_id", F.col("call_id").alias("need")), ["conv_id", "need"], "left_semi"),
        "needs",
    )
    needed = written(edges.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("up")), "needed")
    chains = _chains(written(needed.where("n = 1").select(*KEY, "up"), "single"), nodes.count())
    placed = written(nodes.join(needed, KEY, "left_anti").withColumn("level", F.lit(0).cast("long")), "level")
    # calls with several needs, each need as the end of its chain
    several = edges.join(needed.where("n > 1").select(*KEY), KEY, "left_semi")
    over = chains.select("conv_id", F.col("call_id").alias("need"), "up", "far")
    open_ = written(
        several.join(over, ["conv_id", "need"], "left").select(
            *KEY,
            F.coalesce("up", "need").alias("need"),
            (1 + F.coalesce("far", F.lit(0))).alias("far"),
            F.lit(None).cast("long").alias("at"),
        ),
        "open",
    )
    levels, last = [placed], placed
    while not last.isEmpty() and not open_.isEmpty():
        below = last.select("conv_id", F.col("call_id").alias("need"), "level")
        reached = written(
            open_.join(below, ["conv_id", "need"], "left").select(
                *KEY, "need", "far", F.coalesce("at", F.col("level") + F.col("far")).alias("at")
            ),
            "open",
        )
        last = written(
            reached.groupBy(*KEY)
            .agg(F.every(F.col("at").isNotNull()).alias("ready"), F.max("at").alias("level"))
            .where("ready")
            .drop("ready"),
            "level",
        )
        levels.append(last)
        open_ = written(reached.join(last, KEY, "left_anti"), "open")
    ends = levels[0]
    for level in levels[1:]:
        ends = ends.unionAll(level)
    ends = written(ends, "ends")
    tops = ends.select("conv_id", F.col("call_id").alias("up"), "level")
    return ends.unionAll(
        chains.join(tops, ["conv_id", "up"]).select(*KEY, (F.col("level") + F.col("far")).alias("level"))
    )


def link_tools(calls: DataFrame, results: DataFrame, schemas: dict[str, tuple[Field, ...]]) -> DataFrame:
    """One row for each call, and one for each identifier that only results carry.

    calls: conv_id, call_id, turn, tool, arguments (JSON), needs (array of call ids);
    results: conv_id, call_id, turn, content. Returned: conv_id, call_id, turn, tool,
    level, result_turn, n_results, status, errors and json, the call with its result
    as canonical JSON (keys sorted, no white space, absent values left out).

    The earliest result of an identifier answers it (of one turn, the smallest text);
    n_results counts all of them. status is the first that fits: orphan (a result
    without a call), cyclic, invalid, unanswered, ok. Rows without conv_id or call_id
    link with nothing: such calls have level 0. Repeated calls stay and share the
    result. Null arguments are no object; null needs are none. Other columns are not
    read. Either table may be empty.

    Rows stand on their own, so no conversation is ever gathered in one task; within a
    conversation (level, turn, call_id) is an order in which each call follows what it needs.
    """
    calls = written(
        calls.select(*KEY, "turn", "tool", "arguments", F.coalesce("needs", F.array()).alias("needs")), "tool-calls"
    )
    answers = written(
        results.groupBy(*KEY).agg(
            F.min(F.struct("turn", "content")).alias("answer"), F.count(F.lit(1)).alias("n_results")
        ),
        "answers",
    )
    levels = topological_levels(calls)
    linked = (
        calls.join(answers, KEY, "left")
        .join(levels, KEY, "left")
        .withColumn("level", F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), 0).otherwise(F.col("level")))
        .withColumn("errors", validate(F.col("tool"), F.col("arguments"), schemas))
        .withColumn(
            "status",
            F.when(F.col("level").isNull(), "cyclic")
            .when(F.size("errors") > 0, "invalid")
            .when(F.col("n_results").isNull(), "unanswered")
            .otherwise("ok"),
        )
    )
    orphans = answers.join(calls.select(*KEY).distinct(), KEY, "left_anti").select(
        *KEY,
        F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("string").alias("tool"),
        F.lit(None).cast("string").alias("arguments"),
        "answer",
        "n_results",
        F.lit(None).cast("long").alias("level"),
        F.expr("cast(array() as array<string>)").alias("errors"),
        F.lit("orphan").alias("status"),
    )
    return linked.drop("needs").unionByName(orphans).select(
        *KEY,
        F.col("turn").cast("long").alias("turn"),
        "tool",
        F.col("level").cast("long").alias("level"),
        F.col("answer.turn").cast("long").alias("result_turn"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        "status",
        F.array_join("errors", "; ").alias("errors"),
        canonical_json().alias("json"),
    )


def canonical_json() -> Column:
    """A linked row as JSON: parsed values serialise with their keys in order, and the
    fields of the structs below stand in order too."""
    return F.to_json(
        F.struct(
            # a call's arguments that are no JSON stay as the text that they are
            F.try_parse_json("arguments").alias("arguments"),
            F.when(F.try_parse_json("arguments").isNull(), F.col("arguments")).alias("arguments_text"),
            F.col("call_id").alias("call_id"),
            F.col("tool").alias("name"),
            F.col("answer.content").alias("result"),
        )
    )


# --- tool transcripts of plain conversations ---

SCHEMAS = {
    "ask": (Field("limit", "integer", least=1, most=300), Field("query", "string", least=1)),
    "look_up": (Field("limit", "integer", least=20), Field("query", "string", least=1, most=200)),
}


def calls_of(messages: DataFrame) -> DataFrame:
    """A call for each user message: it asks with the message's text, and needs the call
    of two turns before."""
    name = lambda turn: F.concat_ws("-", F.lit("call"), F.col("conv_id"), turn)
    return messages.where("role = 'user'").select(
        "conv_id",
        name(F.col("turn")).alias("call_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("turn") % 4 < 2, "ask").otherwise("look_up").alias("tool"),
        F.to_json(F.struct(F.col("text").alias("query"), F.length("text").alias("limit"))).alias("arguments"),
        F.array(name(F.col("turn") - 2)).alias("needs"),
    )


def results_of(messages: DataFrame) -> DataFrame:
    """A result for each assistant message, of the call of the turn before."""
    return messages.where("role = 'assistant'").select(
        "conv_id",
        F.concat_ws("-", F.lit("call"), F.col("conv_id"), F.col("turn") - 1).alias("call_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("text").alias("content"),
    )


def other_messages(messages: DataFrame) -> DataFrame:
    """Messages of neither users nor assistants (of a system, of any other or no role), in the
    columns of ``link_tools``: they carry no call, keep their turn, and have the status
    ``message`` and their content and role as canonical JSON."""
    none = lambda kind: F.lit(None).cast(kind)
    return messages.where("role is null or role not in ('user', 'assistant')").select(
        "conv_id",
        none("string").alias("call_id"),
        F.col("turn").cast("long").alias("turn"),
        none("string").alias("tool"),
        none("long").alias("level"),
        none("long").alias("result_turn"),
        F.lit(0).cast("long").alias("n_results"),
        F.lit("message").alias("status"),
        F.lit("").alias("errors"),
        F.to_json(F.struct(F.col("text").alias("content"), "role")).alias("json"),
    )


def chat_rows(messages: DataFrame) -> DataFrame:
    """All messages of conversations as linked calls, orphan results and other messages. Every
    row of ``messages`` is one of these, or a result that counts in one's ``n_results``."""
    return link_tools(calls_of(messages), results_of(messages), SCHEMAS).unionByName(other_messages(messages))
