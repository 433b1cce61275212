"""Tool calls and their results in chats: linked, ordered, checked, serialised.

Calls and results meet in a hash join on the call's identifier. Calls are
ordered by dependence: a call's level is one more than the highest level of
the calls it waits for. Levels are found round by round over tables in the
shared folder; a round resolves every call whose dependencies are resolved, in
all chats at once. Arguments are checked against the tool's schema, and a
linked call becomes canonical JSON: keys in order, no blanks.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import WORD, only
from blotter.runtime import materialise

#: (tool, argument, type, required, least value or length)
SCHEMAS = (
    ("configure", "instruction", "STRING", True, 1),
    ("configure", "strict", "BOOLEAN", False, None),
    ("reply", "depth", "BIGINT", False, 0),
    ("reply", "prompt", "STRING", True, 20),
    ("reply", "words", "BIGINT", True, 5),
)
CALL = ("conv_id", "turn", "call_id", "name", "arguments", "waits_for")
RESULT = ("conv_id", "turn", "call_id", "content")


def resolved_levels(calls: DataFrame) -> DataFrame:
    """``call_id``, ``level``: rounds until all calls waited for are done.

    ``calls``: ``call_id`` and ``waits_for`` (ids). An id that no call has is
    not waited for. Calls in a circle, or behind one, have no level. The
    number of rounds is the longest chain's length; each reads only calls
    that are still open.
    """
    ids = materialise(calls.where("call_id is not null").select("call_id").distinct(), "calls")
    edges = (
        calls.select("call_id", F.explode("waits_for").alias("needs"))
        .where("call_id is not null and needs is not null")
        .distinct()
        .join(ids.select(F.col("call_id").alias("needs")), "needs")
    )
    edges = materialise(edges, "waits")
    open_ids, levels, level = ids, [], 0
    while True:
        done = materialise(open_ids.join(edges.select("call_id").distinct(), "call_id", "left_anti"), "done")
        if done.isEmpty():
            break
        levels.append(done.withColumn("level", F.lit(level)))
        open_ids = materialise(open_ids.join(done, "call_id", "left_anti"), "open")
        if open_ids.isEmpty():
            break
        edges = materialise(
            edges.join(done.select(F.col("call_id").alias("needs")), "needs", "left_anti"), "waits"
        )
        level += 1
    out = open_ids.withColumn("level", F.lit(None).cast("int"))
    for some in levels:
        out = out.unionByName(some)
    return out


def _errors(name: Column, parsed: Column, schemas=SCHEMAS) -> Column:
    """What the schema of the tool ``name`` finds wrong with its arguments, in order."""
    tools = sorted({s[0] for s in schemas})
    found = F.when(~F.coalesce(name.isin(tools), F.lit(False)), F.array(F.lit("unknown tool")))
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    found = found.when(~is_object, F.array(F.lit("arguments are no object")))
    keys = F.map_keys(F.from_json(F.to_json(parsed), "map<string,string>"))
    for tool in tools:
        mine = sorted(s[1:] for s in schemas if s[0] == tool)
        checks = []
        for argument, kind, required, least in mine:
            value = F.try_variant_get(parsed, f"$.{argument}", "variant")
            missing = value.isNull() | F.is_variant_null(value)
            if required:
                checks.append(F.when(missing, F.lit(f"{argument}: missing")))
            typed = F.schema_of_variant(value) == kind
            checks.append(F.when(~missing & ~typed, F.lit(f"{argument}: type")))
            if least is not None:
                size = F.length(value.cast("string")) if kind == "STRING" else F.try_variant_get(
                    parsed, f"$.{argument}", "bigint"
                )
                checks.append(F.when(~missing & typed & (size < least), F.lit(f"{argument}: too small")))
        extra = F.array_sort(F.array_except(keys, F.array(*[F.lit(m[0]) for m in mine])))
        checks = F.filter(F.array(*checks), lambda e: e.isNotNull())
        unknown = F.transform(extra, lambda k: F.concat(k, F.lit(": unknown")))
        found = found.when(name == tool, F.concat(checks, unknown))
    return found


def link(calls: DataFrame, results: DataFrame, schemas=SCHEMAS) -> DataFrame:
    """One row per call and per result without a call.

    ``calls`` has the columns ``CALL`` and ``results`` those of ``RESULT``;
    others are ignored. Columns of the rows: ``conv_id``, ``turn``,
    ``call_id``, ``name``, ``level``, ``status``, ``errors``, ``n_results``,
    ``json``. The order of a chat is ``level``, ``turn``, ``call_id``.

    Rows that repeat a call are one call; an id with different calls keeps the
    first by turn and says ``duplicate id``. Of several results the first by
    turn counts. ``status`` is the first that holds of ``orphan result``,
    ``duplicate id``, ``circular``, ``invalid`` (see ``errors``),
    ``unanswered``, ``ok``. Calls and results without an id link to nothing.
    Null and empty arguments are no object. Empty tables give no rows.
    """
    calls, results = only(calls, **{c: c for c in CALL}), only(results, **{c: c for c in RESULT})
    call = F.struct("turn", "conv_id", "name", "arguments", "waits_for")
    one = (
        calls.where("call_id is not null")
        .groupBy("call_id")
        .agg(F.min(call).alias("c"), (F.min(call) != F.max(call)).alias("twice"))
        .select("call_id", "twice", "c.*")
    )
    nameless = calls.where("call_id is null").withColumn("twice", F.lit(False))
    one = materialise(one.unionByName(nameless), "linked-calls")
    answers = (
        results.where("call_id is not null")
        .groupBy("call_id")
        .agg(F.min(F.struct("turn", "content", "conv_id")).alias("r"), F.count("*").alias("n_results"))
    )
    answers = materialise(answers, "answers")
    levels = resolved_levels(one)
    parsed = F.try_parse_json("arguments")
    linked = (
        one.join(answers, "call_id", "left")
        .join(levels, "call_id", "left")
        .withColumn("level", F.when(F.col("call_id").isNull(), F.lit(0)).otherwise(F.col("level")))
        .withColumn("parsed", parsed)
        .withColumn("errors", F.coalesce(_errors(F.col("name"), F.col("parsed"), schemas), F.array().cast("array<string>")))
    )
    status = (
        F.when(F.col("twice"), "duplicate id")
        .when(F.col("level").isNull(), "circular")
        .when(F.size("errors") > 0, "invalid")
        .when(F.col("r").isNull(), "unanswered")
        .otherwise("ok")
    )
    text = F.to_json(
        F.struct(
            F.coalesce("parsed", F.parse_json(F.to_json(F.col("arguments").cast("variant")))).alias("arguments"),
            F.col("call_id").alias("id"),
            "name",
            F.col("r.content").alias("result"),
        )
    )
    columns = ["conv_id", "turn", "call_id", "name", "level", "status", "errors", "n_results", "json"]
    rows = linked.withColumns(
        {"status": status, "n_results": F.coalesce("n_results", F.lit(0).cast("long")), "json": text}
    ).select(columns)
    lone = answers.join(one.select("call_id").distinct(), "call_id", "left_anti").select("call_id", "r.*", "n_results")
    unnamed = results.where("call_id is null").withColumn("n_results", F.lit(1).cast("long"))
    orphans = lone.unionByName(unnamed.select(lone.columns)).select(
        "conv_id",
        "turn",
        "call_id",
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("int").alias("level"),
        F.lit("orphan result").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        "n_results",
        F.to_json(F.struct(F.col("call_id").alias("id"), F.col("content").alias("result"))).alias("json"),
    )
    return rows.unionByName(orphans)


def chats_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read out of plain chats.

    A system turn calls ``configure`` and a user turn ``reply``; its id is
    chat and turn. A turn waits for the one at half its number, if that is a
    call too. An assistant's turn is the result of the turn before it. Rows
    with other roles, or without chat or turn, are neither.
    """
    rows = only(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    named = lambda turn: F.concat_ws("-", "conv_id", turn)
    rows = rows.where("conv_id is not null and turn is not null")
    half = F.floor(F.col("turn") / 2).cast("long")
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)))
    reply = F.to_json(
        F.struct(words.alias("words"), F.col("text").alias("prompt"), half.alias("depth"))
    )
    configure = F.to_json(F.struct(F.lit(True).alias("strict"), F.col("text").alias("instruction")))
    calls = rows.where("role in ('system', 'user')").select(
        "conv_id",
        "turn",
        named(F.col("turn")).alias("call_id"),
        F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"),
        F.when(F.col("role") == "user", reply).otherwise(configure).alias("arguments"),
        F.when(half < F.col("turn"), F.array(named(half))).otherwise(F.array().cast("array<string>")).alias("waits_for"),
    )
    results = rows.where("role = 'assistant'").select(
        "conv_id", "turn", named(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results
