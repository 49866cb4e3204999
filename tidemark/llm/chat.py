"""Chat formatting with tool-call linking, in DataFrame operations only.

A message whose text is a JSON object with ``tool_calls`` (objects with id, name, arguments and, if a call needs the results of others,
``after``: their ids) makes calls; a ``tool`` message whose text is an object with ``tool_call_id`` is a result. Every other text is taken as it is.
Calls and results are linked by a hash join on (conversation, id); arguments are checked against their tool's schema; every unit becomes
a line of canonical JSON (keys sorted, no blanks); and (at, level, turn, seq) sorts a conversation's units so that calls come before
their results and those before the calls that need them.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import written
from ._skew import lookup

# The types that a JSON schema names, as Spark's variant type names them.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*", "null": "VOID"}


CHECKED = set("type enum const minimum maximum exclusiveMinimum exclusiveMaximum minLength maxLength pattern required properties additionalProperties items minItems maxItems".split())
SILENT = set("title description default examples $schema $id $comment deprecated".split())  # say nothing about values


def _type_fits(value: Column, kinds: str | list[str]) -> Column:
    names = [kinds] if isinstance(kinds, str) else kinds
    return F.schema_of_variant(value).rlike("^(" + "|".join(TYPES[k] for k in names) + ")$")


def _path(steps: tuple[str, ...]) -> str:
    return "$" + "".join(f"[{json.dumps(s)}]" if '"' not in s and "'" not in s else f"['{s}']" for s in steps)


def schema_errors(value: Column, schema: dict, steps: tuple[str, ...] = ()) -> list[Column]:
    """An expression for each demand of a JSON schema (``CHECKED``), null if the value meets it, else a message. An absent value meets all.

    A schema that demands anything else is an error: its demand would go unchecked.
    """
    unknown = sorted(set(schema) - CHECKED - SILENT)
    if unknown or not isinstance(schema.get("additionalProperties", True), bool) or not isinstance(schema.get("items", {}), dict):
        raise ValueError(f"schema of {'/'.join(steps) or 'arguments'}: can't check {', '.join(unknown) or 'its additionalProperties or items'}")
    here = F.try_variant_get(value, _path(steps), "variant") if steps else value
    name = "/".join(steps) or "arguments"
    out: list[Column] = []

    def demand(ok: Column, message: str) -> None:
        out.append(F.when(here.isNotNull() & ~F.coalesce(ok, F.lit(False)), F.lit(f"{name}: {message}")))

    if "type" in schema:
        demand(_type_fits(here, schema["type"]), f"not {schema['type'] if isinstance(schema['type'], str) else ' or '.join(schema['type'])}")
    for word, values in (("enum", schema.get("enum")), ("const", [schema["const"]] if "const" in schema else None)):
        if values is not None:
            demand(F.to_json(here).isin([canonical_text(v) for v in values]), f"not in {word}")
    number, text = F.try_variant_get(value, _path(steps), "double"), F.try_variant_get(value, _path(steps), "string")
    for word, sign in (("minimum", 1), ("maximum", -1)):
        if word in schema:
            bad = sign * number < sign * schema[word]
            demand(~F.coalesce(bad, F.lit(False)), f"beyond {word}")
    for word, sign in (("exclusiveMinimum", 1), ("exclusiveMaximum", -1)):
        if word in schema:
            demand(~F.coalesce(sign * number <= sign * schema[word], F.lit(False)), f"beyond {word}")
    for word, sign in (("minLength", 1), ("maxLength", -1)):
        if word in schema:
            demand(~F.coalesce(_type_fits(here, "string") & (sign * F.length(text) < sign * schema[word]), F.lit(False)), f"beyond {word}")
    if "pattern" in schema:
        demand(~F.coalesce(_type_fits(here, "string") & ~text.rlike(schema["pattern"]), F.lit(False)), "not of the pattern")
    keys = F.coalesce(F.json_object_keys(F.to_json(here)), F.array().cast("array<string>"))
    is_object = F.schema_of_variant(here).rlike("^OBJECT")
    for k in schema.get("required", []):
        out.append(F.when(is_object & ~F.array_contains(keys, k), F.lit(f"{'/'.join((*steps, k))}: missing")))
    if schema.get("additionalProperties") is False:
        extra = F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>")))
        out.append(F.when(is_object & (F.size(extra) > 0), F.concat(F.lit(f"{name}: unknown "), F.array_join(extra, ", "))))
    for k, inner in schema.get("properties", {}).items():
        out += schema_errors(value, inner, (*steps, k))
    items = F.try_variant_get(value, _path(steps), "array<variant>")
    for word, sign in (("minItems", 1), ("maxItems", -1)):
        if word in schema:
            demand(~F.coalesce(items.isNotNull() & (sign * F.size(items) < sign * schema[word]), F.lit(False)), f"beyond {word}")
    if schema.get("items"):
        only_type = set(schema["items"]) <= {"type"} | SILENT

        def broken(x: Column) -> Column:
            return reduce(Column.__or__, [e.isNotNull() for e in schema_errors(x, schema["items"])], F.lit(False))

        message = f"items not {schema['items']['type']}" if only_type and "type" in schema["items"] else "items not by their schema"
        demand(~F.coalesce(F.exists(items, broken), F.lit(False)), message)
    return out


def canonical_text(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def canonical(value: Column) -> Column:
    """A JSON text with sorted keys and without blanks; null if it isn't JSON, or repeats a key."""
    return F.to_json(F.try_parse_json(value))


def _line(**fields: Column) -> Column:
    """An object of (already canonical) JSON texts, keys sorted."""
    parts = [F.concat(F.lit(("{" if k == 0 else ",") + json.dumps(name) + ":"), text) for k, (name, text) in enumerate(sorted(fields.items()))]
    return F.concat(*parts, F.lit("}"))


def _quoted(text: Column) -> Column:
    """A string as JSON; null stays JSON null."""
    inner = F.to_json(F.struct(text.alias("x")))
    return F.when(text.isNull(), F.lit("null")).otherwise(F.substr(inner, F.lit(6), F.length(inner) - 6))


def split_units(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Messages (all turns), calls and results."""
    df = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    body = F.when(F.col("text").rlike(r"^\s*\{"), F.try_parse_json("text"))
    calls = F.try_variant_get(body, "$.tool_calls", "array<variant>")
    df = df.withColumns({"calls": calls, "answers": F.when(F.col("role") == "tool", F.try_variant_get(body, "$.tool_call_id", "string"))})
    content = F.when(calls.isNotNull(), F.try_variant_get(body, "$.content", "string")).otherwise(F.col("text"))
    messages = df.filter("answers IS NULL").select("conv_id", "turn", "role", content.alias("content"), F.coalesce(F.size("calls"), F.lit(0)).cast("long").alias("n_calls"))
    call = df.filter(F.size("calls") > 0).select("conv_id", "turn", F.posexplode("calls").alias("seq", "c"))
    arguments = F.coalesce(F.try_variant_get("c", "$.arguments", "variant"), F.try_variant_get("c", "$.function.arguments", "variant"))
    stated = F.try_variant_get(arguments, "$", "string")
    is_text = F.schema_of_variant(arguments) == "STRING"
    calls = call.select(
        "conv_id",
        "turn",
        F.col("seq").cast("long").alias("seq"),
        F.try_variant_get("c", "$.id", "string").alias("call_id"),
        F.coalesce(F.try_variant_get("c", "$.name", "string"), F.try_variant_get("c", "$.function.name", "string")).alias("name"),
        F.when(is_text, F.try_parse_json(stated)).otherwise(arguments).alias("arguments"),
        F.coalesce(F.try_variant_get("c", "$.after", "array<string>"), F.array().cast("array<string>")).alias("after"),
    )
    results = df.filter("answers IS NOT NULL").select("conv_id", "turn", F.col("answers").alias("call_id"), F.try_variant_get(body, "$.content", "variant").alias("content"))
    return messages, calls, results


def _gathered(tables: list[tuple[int, DataFrame]], new: DataFrame) -> list[tuple[int, DataFrame]]:
    """A list of tables with one more: equally large ones are merged, so that few are held and a row is seldom written again."""
    tables = [*tables, (0, new)]
    while len(tables) > 1 and tables[-1][0] == tables[-2][0]:
        (size, a), (_, b) = tables.pop(), tables.pop()
        merged = written(a.unionByName(b), "chat")
        tables.append((size + 1, merged))
    return tables


def _ordered(firsts: DataFrame) -> DataFrame:
    """``at`` and ``level`` of each first call (key, turn, answer_turn, after), by rounds: a call follows when all that it needs are placed.

    A round sends what the calls placed in the round before decide to the calls that need them, and writes no others. A call that many others need is split off by
    :func:`lookup`. Calls on a cycle, or behind one, are never placed and are left out.
    """
    needs = firsts.select("key", "turn", F.explode(F.array_distinct("after")).alias("need"))
    needs = written(needs.withColumn("need", F.struct(F.col("key.conv_id").alias("conv_id"), F.col("need").alias("call_id"))), "chat")
    start = firsts.select("key", F.lit(0).alias("level"), F.col("turn").alias("at"))
    if needs.isEmpty():
        return start
    total = needs.count()
    needed = needs.groupBy("need").agg(F.count("*").alias("n_need")).join(firsts.select(F.col("key").alias("need"), F.col("answer_turn").alias("need_answer")), "need")
    needed = written(needed, "chat")
    known = written(lookup(needs, needed, "need", "n_need", total).filter("n_need IS NOT NULL").drop("n_need"), "chat")
    waiting = written(known.groupBy("key").agg(F.count("*").alias("n")), "chat")
    front = written(start.join(waiting.select("key"), "key", "left_anti"), "chat")
    placed, pending = [(0, front)], None
    while True:
        senders = front.select(F.col("key").alias("need"), F.col("level").alias("need_level"), F.col("at").alias("need_at")).join(needed.select("need", "n_need"), "need")
        sent = lookup(known, senders, "need", "n_need", total).filter("need_level IS NOT NULL")
        sent = sent.select("key", "turn", F.lit(1).cast("long").alias("got"), F.col("need_level").alias("l"), F.greatest("need_at", F.coalesce("need_answer", "need_at")).alias("t"))
        heard = (sent if pending is None else sent.unionByName(pending)).groupBy("key", "turn").agg(F.sum("got").alias("got"), F.max("l").alias("l"), F.max("t").alias("t"))
        heard = written(heard.join(waiting, "key"), "chat")
        front = written(heard.filter("got = n").select("key", (F.col("l") + 2).alias("level"), F.greatest("turn", "t").alias("at")), "chat")
        if front.isEmpty():
            break
        pending = heard.filter("got < n").select("key", "turn", "got", "l", "t")
        placed = _gathered(placed, front)
    return reduce(DataFrame.unionByName, [df for _, df in placed])


UNIT = ["conv_id", "at", "level", "turn", "seq", "kind", "call_id", "status", "errors", "json"]


def linked(turns: DataFrame, tools: dict[str, dict], conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row for every message, call and result: conv_id, at, level, turn, seq, kind, call_id, status, errors, json.

    ``tools`` has each tool's JSON schema of its arguments. Status of a call: ``ok``, ``unanswered``, ``duplicate`` (its id was used before; the first call by turn counts),
    ``cyclic``; ``errors`` says what is wrong with its name, arguments or needs. Of a result: ``ok``, ``duplicate`` or ``orphan`` (no call has its id).
    A call without an id can't be answered. Messages have status ``ok``; null roles and texts are JSON null. Text that isn't a JSON object, or repeats a
    key, is plain text. Rows that repeat a turn each have a row, of which one call and one result count and the others are duplicates. Very long texts are kept whole; nulls in conv_id or turn are kept, and such calls are linked to none. An empty table gives an empty result.
    """
    messages, calls, results = split_units(turns, conv_col, turn_col, role_col, text_col)
    none, no_errors = F.lit(None).cast("string"), F.array().cast("array<string>")
    line = _line(content=_quoted(F.col("content")), role=_quoted(F.col("role")))
    out = messages.select("conv_id", F.col("turn").alias("at"), F.lit(0).cast("long").alias("level"), "turn", F.lit(-1).cast("long").alias("seq"), F.lit("message").alias("kind"), none.alias("call_id"), F.lit("ok").alias("status"), no_errors.alias("errors"), line.alias("json"))
    # Rows that are alike in all are told apart by a number, which stays once it is written.
    calls, results = (written(df.withColumn("row", F.monotonically_increasing_id()), "chat") for df in (calls, results))
    if calls.isEmpty() and results.isEmpty():
        return out.select(UNIT)
    key = F.when(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull(), F.struct("conv_id", "call_id"))
    calls, results = calls.withColumn("key", key), results.withColumn("key", key)
    result_line = F.concat(F.to_json("content"), F.lit(""))
    answers = results.filter("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("turn", F.coalesce(result_line, F.lit("null")).alias("text"), "row")).alias("answer"), F.count("*").alias("n_results"))
    first = calls.filter("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("turn", "seq", "row")).alias("first"), F.min_by("after", F.struct("turn", "seq", "row")).alias("after"), F.count("*").alias("n_calls"))
    joined = written(first.join(answers, "key", "full").withColumns({"n_calls": F.coalesce("n_calls", F.lit(0)), "n_results": F.coalesce("n_results", F.lit(0))}), "chat")
    placed = _ordered(written(joined.filter("first IS NOT NULL").select("key", "first.turn", F.col("answer.turn").alias("answer_turn"), "after"), "chat"))
    known = joined.join(placed, "key", "left").withColumn("rows", F.col("n_calls") + F.col("n_results")).drop("after")
    known = written(known, "chat")
    total = max(1, calls.count() + results.count())
    checks = [F.when(~F.col("name").isin(list(tools)) | F.col("name").isNull(), F.concat(F.lit("unknown tool "), F.coalesce("name", F.lit("null")))), F.when(F.col("arguments").isNull(), F.lit("arguments: no JSON"))]
    for tool, schema in tools.items():
        checks += [F.when(F.col("name") == tool, e) for e in schema_errors(F.col("arguments"), schema)]
    needed = calls.filter("key IS NOT NULL").select("key", F.explode(F.array_distinct("after")).alias("n"))
    needed = needed.withColumn("need", F.struct(F.col("key.conv_id").alias("conv_id"), F.col("n").alias("call_id")))
    missing = needed.join(joined.filter("first IS NOT NULL").select(F.col("key").alias("need")), "need", "left_anti").groupBy("key").agg(F.array_sort(F.collect_set("n")).alias("missing"))
    calls = calls.withColumn("errors", F.array_compact(F.array(*checks)))
    calls = lookup(calls, known.join(missing, "key", "left"), "key", "rows", total)
    is_first = F.col("first.row").eqNullSafe(F.col("row"))
    status = F.when(F.col("key").isNull(), "unanswered").when(~is_first, "duplicate").when(F.col("level").isNull(), "cyclic").when(F.col("n_results") == 0, "unanswered").otherwise("ok")
    errors = F.concat("errors", F.coalesce(F.transform("missing", lambda m: F.concat(F.lit("after: no call "), m)), no_errors))
    line = _line(arguments=F.coalesce(F.to_json("arguments"), F.lit("null")), id=_quoted(F.col("call_id")), name=_quoted(F.col("name")))
    calls = calls.select("conv_id", F.when(is_first, F.coalesce("at", "turn")).otherwise(F.col("turn")).alias("at"), F.when(is_first, F.coalesce("level", F.lit(0)) + 1).otherwise(1).cast("long").alias("level"), "turn", "seq", F.lit("call").alias("kind"), "call_id", status.alias("status"), errors.alias("errors"), line.alias("json"))
    results = lookup(results, known, "key", "rows", total)
    text = F.coalesce(result_line, F.lit("null"))
    is_answer = F.col("answer.row").eqNullSafe(F.col("row"))
    status = F.when(F.col("first").isNull(), "orphan").when(is_answer, "ok").otherwise("duplicate")
    line = _line(content=text, role=F.lit('"tool"'), tool_call_id=_quoted(F.col("call_id")))
    results = results.select("conv_id", F.greatest(F.col("turn"), F.coalesce("at", "turn")).alias("at"), (F.coalesce("level", F.lit(0)) + 2).cast("long").alias("level"), "turn", F.lit(0).cast("long").alias("seq"), F.lit("result").alias("kind"), "call_id", status.alias("status"), no_errors.alias("errors"), line.alias("json"))
    return out.select(UNIT).unionByName(calls.select(UNIT)).unionByName(results.select(UNIT))
