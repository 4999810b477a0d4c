"""Tool-call linking for chat formatting, in Spark's own functions only.

Calls and results are joined by identifier, each side first reduced to one row an
identifier. Calls form a forest by the call they follow; a call's level, its topological
order, comes from pointer doubling: a chain of ``n`` calls takes about ``log2(n)`` joins,
also where one conversation holds a third of all calls. Arguments are parsed as variants,
checked against the tool's parameters, and written as canonical JSON: keys in order, no
white space.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.plans.slices import PERSON, Timeline, previous
from souk.plans.tables import materialize

# JSON types and what a variant's type starts with.
TYPES = {
    "string": ["STRING"], "integer": ["BIGINT"], "boolean": ["BOOLEAN"],
    "number": ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"], "object": ["OBJECT"], "array": ["ARRAY"],
}

#: Characters up to which ``try_parse_json`` takes a string.
LONG = 20_000_000


def link(calls: DataFrame, results: DataFrame, parameters: DataFrame) -> DataFrame:
    """A row per identifier of a call or a result.

    ``calls`` has call_id, parent_id, position, name, arguments (JSON); ``results`` has
    call_id, position, content; ``parameters`` has name, parameter, type, required.

    Returns call_id, level, position, status, name, valid, problems, n_calls, n_results,
    message. ``level`` counts the calls before it on the way to its first one: 0 where the
    parent is NULL or no call, NULL in or behind a cycle and for results without a call.
    Sorting by (level, position, call_id) is a topological order. ``status`` is answered,
    early (the result stands before its call), unanswered or orphan. Of rows that share an
    identifier the first by position counts, ties by the other columns; their numbers
    are returned. ``problems`` is sorted: ``syntax``, ``tool``, ``missing x``, ``type x``,
    ``unknown x``. A JSON null counts as missing. NULL identifiers are dropped, parameters
    that repeat count once, extra columns are ignored. Arguments of more than ``LONG``
    characters of which a variant can't be made have the problem ``too long`` instead of
    ``syntax``, and stand in ``message`` as the text they are.
    """
    calls = calls.select("call_id", "parent_id", "position", "name", "arguments").dropna(
        subset=["call_id"])
    calls = materialize(_first(calls, ["position", "name", "arguments", "parent_id"], "n_calls"))
    answers = _first(
        results.select("call_id", "position", "content").dropna(subset=["call_id"]),
        ["position", "content"], "n_results",
    ).withColumnsRenamed({"position": "answered_at", "call_id": "answer_id"})
    checked = _checked(calls, parameters)
    levelled = checked.join(levels(calls).withColumnRenamed("call_id", "node"),
                            F.col("call_id") == F.col("node"), "left")
    linked = levelled.join(answers, F.col("call_id") == F.col("answer_id"), "full")
    asked, answered = F.col("n_calls").isNotNull(), F.col("n_results").isNotNull()
    status = (
        F.when(~asked, "orphan").when(~answered, "unanswered")
        .when(F.col("answered_at") < F.col("position"), "early").otherwise("answered")
    )
    # Fields in order make canonical JSON, and unlike a variant hold a text of any length.
    rest = (F.col("content"), F.col("id"), F.col("name"))
    parsed = F.coalesce(_parsed("arguments"), F.to_variant_object(F.struct()))
    message = F.when(
        F.array_contains("problems", "too long"), F.to_json(F.struct("arguments", *rest))
    ).otherwise(F.to_json(F.struct(parsed.alias("arguments"), *rest)))
    return linked.select(
        F.coalesce("call_id", "answer_id").alias("call_id"), "level",
        F.coalesce("position", "answered_at").alias("position"), status.alias("status"), "name",
        F.when(asked, F.size("problems") == 0).alias("valid"), "problems",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.coalesce("call_id", "answer_id").alias("id"), "arguments", "content",
    ).withColumn("message", message).drop("id", "arguments", "content")


def _parsed(arguments: str) -> Column:
    """JSON as a variant, whose keys are in order. Only ``from_json`` takes long strings."""
    long = F.from_json(arguments, F.lit("variant"), {"maxStringLen": str(2**31 - 1)})
    return F.coalesce(F.try_parse_json(arguments), F.when(F.length(arguments) > LONG, long))


def _first(rows: DataFrame, columns: list[str], count: str) -> DataFrame:
    """One row per call_id, and how many there were."""
    ordered = F.struct(*(F.col(c) for c in columns))
    first = rows.groupBy("call_id").agg(F.min(ordered).alias("row"), F.count("*").alias(count))
    return first.select("call_id", "row.*", count)


def levels(calls: DataFrame) -> DataFrame:
    """Rows (call_id, level) of ``calls`` (call_id, parent_id), whose call_ids differ.

    Every node knows an ancestor and how far it is; joining the ancestor's own doubles the
    distance. Nodes whose ancestor is a root are done and take no further part.
    """
    known = calls.select(F.col("call_id").alias("known"))
    nodes = materialize(
        calls.join(known, F.col("parent_id") == F.col("known"), "left")
        .select("call_id", F.col("known").alias("above"),
                F.when(F.col("known").isNull(), 0).otherwise(1).cast("long").alias("steps"))
    )
    rounds = math.ceil(math.log2(max(2, nodes.count()))) + 1
    for _ in range(rounds):
        if nodes.filter("above IS NOT NULL").isEmpty():
            break
        ancestors = nodes.select(
            F.col("call_id").alias("at"), F.col("above").alias("next"), F.col("steps").alias("more"))
        nodes = materialize(
            nodes.join(ancestors, F.col("above") == F.col("at"), "left").select(
                "call_id", F.col("next").alias("above"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        )
    # What still has an ancestor after that many doublings goes round in a circle.
    return nodes.select("call_id", F.when(F.col("above").isNull(), F.col("steps")).alias("level"))


def _checked(calls: DataFrame, parameters: DataFrame) -> DataFrame:
    """``calls`` with ``problems``. A tool's parameters fit a row; they are part of a prompt."""
    tools = parameters.select("name", "parameter", "type", "required").dropna(
        subset=["name"]).groupBy(F.col("name").alias("tool")).agg(
        F.collect_set(F.struct("parameter", "type", "required")).alias("parameters"))
    given = F.col("given")

    def problem(p: Column) -> Column:
        value = F.try_variant_get(
            given, F.concat(F.lit('$["'), p.parameter, F.lit('"]')), "variant")
        kind = F.schema_of_variant(value)
        fits = F.lit(False)
        for name, starts in TYPES.items():
            of_kind = F.lit(False)
            for start in starts:
                of_kind = of_kind | kind.startswith(start)
            fits = fits | ((p.type == name) & of_kind)
        absent = value.isNull() | (kind == "VOID")
        return F.when(absent & p.required, F.concat(F.lit("missing "), p.parameter)).when(
            ~absent & ~fits, F.concat(F.lit("type "), p.parameter))

    known = F.col("parameters.parameter")
    unknown = F.transform(
        F.array_except(F.coalesce(F.json_object_keys("arguments"), F.array().cast("array<string>")),
                       F.filter(known, lambda p: p.isNotNull())),
        lambda key: F.concat(F.lit("unknown "), key))
    wrong = F.filter(F.transform("parameters", problem), lambda p: p.isNotNull())
    is_object = F.coalesce(F.schema_of_variant(given).startswith("OBJECT"), F.lit(False))
    problems = (
        F.when(given.isNull() & (F.length("arguments") > LONG), F.array(F.lit("too long")))
        .when(~is_object, F.array(F.lit("syntax")))
        .when(F.col("parameters").isNull(), F.array(F.lit("tool")))
        .otherwise(F.array_sort(F.concat(wrong, unknown)))
    )
    return calls.withColumn("given", _parsed("arguments")).join(
        tools, F.col("name") == F.col("tool"), "left"
    ).withColumn("problems", problems).drop("given", "tool", "parameters")


# --- conversations ----------------------------------------------------------------------------

#: What the user turns of a conversation call, as its tools.
PARAMETERS = (
    ("open", "text", "string", True),
    ("open", "turn", "integer", True),
    ("reply", "text", "string", True),
    ("reply", "turn", "integer", True),
    ("reply", "after", "integer", True),
)
_SPEAKERS = ("user", "assistant")


def calls_of(conversations: DataFrame) -> DataFrame:
    """Every user turn as a call: ``open`` for a conversation's first, ``reply`` after another."""
    users = conversations.filter("role = 'user'")
    before = _before(users.select("conv_id", "turn")).withColumnsRenamed(
        {"conv_id": "of", "turn": "at"})
    arguments = F.to_json(F.struct("text", "turn", F.col("before").alias("after")))
    return users.join(
        before, (F.col("conv_id") == F.col("of")) & (F.col("turn") == F.col("at"))
    ).select(
        _call_id(F.col("turn")).alias("call_id"), _call_id(F.col("before")).alias("parent_id"),
        F.col("turn").alias("position"),
        F.when(F.col("before").isNull(), "open").otherwise("reply").alias("name"),
        arguments.alias("arguments"),
    )


def _before(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, before): of each turn the one before it in ``turns``, or NULL.

    Turns that repeat are one. A conversation with a large share of all turns is cut into slices.
    """
    line = Timeline(turns.withColumnRenamed("conv_id", PERSON).distinct(), ["turn"])
    rows = line.carry(
        totals={"slice_last": F.max("turn")}, state={"last_before": previous("slice_last")})
    before = F.coalesce(F.lag("turn").over(line.window), "last_before")
    return rows.select(F.col(PERSON).alias("conv_id"), "turn", before.alias("before"))


def results_of(conversations: DataFrame) -> DataFrame:
    """Every assistant turn as the result of the call one turn before."""
    turn = F.col("turn")
    return conversations.filter("role = 'assistant'").select(
        _call_id(turn - 1).alias("call_id"), turn.alias("position"), F.col("text").alias("content"))


def context_of(conversations: DataFrame) -> DataFrame:
    """Every turn of another role as a row of ``link``'s columns, with the status ``context``."""
    other = ~F.coalesce(F.col("role").isin(*_SPEAKERS), F.lit(False))
    context = conversations.filter(other).groupBy("conv_id", "turn", "role").agg(
        F.min("text").alias("content"), F.count("*").alias("n_results"))
    call_id = F.concat(_call_id(F.col("turn")), F.lit(":"), F.coalesce("role", F.lit("")))
    return context.select(
        call_id.alias("call_id"), F.lit(None).cast("long").alias("level"),
        F.col("turn").alias("position"), F.lit("context").alias("status"),
        F.lit(None).cast("string").alias("name"), F.lit(None).cast("boolean").alias("valid"),
        F.lit(None).cast("array<string>").alias("problems"),
        F.lit(0).cast("long").alias("n_calls"), "n_results",
        F.to_json(F.struct("content", call_id.alias("id"), "role")).alias("message"),
    )


def _call_id(turn: Column) -> Column:
    return F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))


def linked_turns(conversations: DataFrame) -> DataFrame:
    """``link`` over the turns of ``conversations`` (conv_id, turn, role, text).

    User turns are calls, each after the user turn before it, however many turns lie
    between; assistant turns are results. A turn of another role, or of none, has the status
    ``context`` and a message of its content, id (conversation:turn:role) and role; of those
    that repeat the smallest text counts, ``n_results`` of them. Turns with a NULL
    conversation or number are dropped. No turns give no rows; other columns are ignored.
    """
    turns = conversations.select("conv_id", "turn", "role", "text").dropna(
        subset=["conv_id", "turn"])
    spark = conversations.sparkSession
    parameters = spark.createDataFrame(
        PARAMETERS, "name string, parameter string, type string, required boolean")
    return link(calls_of(turns), results_of(turns), parameters).unionByName(context_of(turns))


#: The rows of ``linked_turns``, problems joined by commas, in DuckDB's SQL.
ORACLE = r"""
WITH turns AS (SELECT * FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
firsts AS (
  SELECT conv_id, turn, arg_min(text, coalesce(text, '')) AS text, count(*) AS n_calls
  FROM turns WHERE role = 'user' GROUP BY conv_id, turn),
calls AS (
  SELECT conv_id || ':' || turn AS call_id, turn AS position, text, n_calls,
         lag(turn) OVER of_conversation AS before, row_number() OVER of_conversation - 1 AS level
  FROM firsts WINDOW of_conversation AS (PARTITION BY conv_id ORDER BY turn)),
results AS (
  SELECT conv_id || ':' || (turn - 1) AS call_id, min(turn) AS answered_at, min(text) AS content, count(*) AS n_results
  FROM turns WHERE role = 'assistant' GROUP BY conv_id, turn)
SELECT coalesce(c.call_id, r.call_id) AS call_id, CAST(c.level AS BIGINT) AS level,
       coalesce(c.position, answered_at) AS position,
       CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
       CASE WHEN c.call_id IS NOT NULL THEN CASE WHEN before IS NULL THEN 'open' ELSE 'reply' END END AS name,
       CASE WHEN c.call_id IS NOT NULL THEN c.text IS NOT NULL END AS valid,
       CASE WHEN c.call_id IS NOT NULL THEN CASE WHEN c.text IS NULL THEN 'missing text' ELSE '' END END AS problems,
       coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
       '{"arguments":{' || CASE WHEN c.call_id IS NULL THEN '' ELSE
           CASE WHEN before IS NOT NULL THEN '"after":' || before || ',' ELSE '' END
           || CASE WHEN c.text IS NOT NULL THEN '"text":' || to_json(c.text) || ',' ELSE '' END
           || '"turn":' || c.position END || '}'
         || CASE WHEN content IS NOT NULL THEN ',"content":' || to_json(content) ELSE '' END
         || ',"id":' || to_json(coalesce(c.call_id, r.call_id))
         || CASE WHEN c.call_id IS NULL THEN '' WHEN before IS NULL THEN ',"name":"open"' ELSE ',"name":"reply"' END
         || '}' AS message
FROM calls c FULL JOIN results r ON c.call_id = r.call_id
UNION ALL
SELECT conv_id || ':' || turn || ':' || coalesce(role, ''), NULL, turn, 'context', NULL, NULL, NULL, 0, count(*),
       '{' || CASE WHEN min(text) IS NOT NULL THEN '"content":' || to_json(min(text)) || ',' ELSE '' END
         || '"id":' || to_json(conv_id || ':' || turn || ':' || coalesce(role, ''))
         || CASE WHEN role IS NOT NULL THEN ',"role":' || to_json(role) ELSE '' END || '}'
FROM turns WHERE coalesce(role NOT IN ('user', 'assistant'), true) GROUP BY conv_id, turn, role
"""
