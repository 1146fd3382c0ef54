"""Tool calls of chats: linked to their results, ordered, validated against schemas and written as canonical JSON.

Calls meet results and levels in one grouping by the identifier, and schemas in a hash join on the tool's name. A call
may refer to other calls' results; its level is the length of its longest chain of references. Calls on a cycle are
never ready and keep a null level. What later steps read again is written first, so every plan stays short.
"""

from __future__ import annotations

import json
import math
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import map_batches, written
from souk.operators.ordered import global_rank


def canonical(value: Any) -> str:
    """JSON with sorted keys, no white space and no escapes beyond the necessary."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v),
}


def violation(value: Any, schema: dict, at: str = "$") -> str | None:
    """The first way in which a value breaks a schema (the usual keywords of JSON Schema), or None."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(TYPES[k](value) for k in kinds):
        return f"{at}: not {' or '.join(kinds)}"
    if "enum" in schema and all(canonical(value) != canonical(x) for x in schema["enum"]):
        return f"{at}: not in enum"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        return f"{at}: length"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if not schema.get("minimum", -math.inf) <= value <= schema.get("maximum", math.inf):
            return f"{at}: range"
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", math.inf):
            return f"{at}: items"
        found = (violation(x, schema["items"], f"{at}[{i}]") for i, x in enumerate(value)) if "items" in schema else ()
        return next((x for x in found if x), None)
    if isinstance(value, dict):
        missing = sorted(set(schema.get("required", [])) - set(value))
        if missing:
            return f"{at}: no {missing[0]}"
        known = schema.get("properties", {})
        for name in sorted(value):
            if name in known:
                found = violation(value[name], known[name], f"{at}.{name}")
                if found:
                    return found
            elif schema.get("additionalProperties", True) is False:
                return f"{at}: unknown {name}"
    return None


#: Closed calls of so many rounds are written as one table, so that no plan grows with the rounds.
MERGED = 16

#: Above every true level; lengths on a cycle, which grow without end, stop here.
FAR = 2**31 - 1


def _nodes(edges: DataFrame) -> DataFrame:
    """Per call of ``edges``: how many references are open, the last of them with its length, and the least level so far."""
    return edges.groupBy("call_id").agg(
        F.count("needs").alias("open"), F.max("needs").alias("to"), F.max("hops").alias("by"), F.max("base").alias("floor")
    )


def _nearer(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of the open calls, one round on: past calls with a single open reference, and closed where they lead to a closed call."""
    there = nodes.select(F.col("call_id").alias("_key"), "open", "to", "by", "floor")
    met = edges.withColumn("_key", F.coalesce("needs", "call_id")).join(there, "_key").filter("needs is not null or open > 0")
    past, far = F.col("needs").isNotNull() & (F.col("open") == 1), F.lit(FAR).cast("bigint")
    jumped = met.select(
        "call_id", F.when(past, F.col("to")).otherwise(F.col("needs")).alias("needs"),
        F.when(past, F.least(F.col("hops") + F.col("by"), far)).otherwise(F.col("hops")).alias("hops"),
        F.when(past, F.greatest("base", F.least(F.col("hops") + F.col("floor"), far))).otherwise(F.col("base")).alias("base"),
    )
    closed = nodes.filter("open = 0").select(F.col("call_id").alias("needs"), F.col("floor").alias("_level"))
    return jumped.join(closed, "needs", "left").select(
        "call_id", F.when(F.col("_level").isNull(), F.col("needs")).alias("needs"), F.when(F.col("_level").isNull(), F.col("hops")).alias("hops"),
        F.greatest("base", F.col("_level") + F.col("hops")).alias("base"),
    ).groupBy("call_id", "needs").agg(F.max("hops").alias("hops"), F.max("base").alias("base"))


def _deep(ids: DataFrame, references: DataFrame) -> DataFrame:
    """``(call_id, level)`` of the calls that refer to calls of ``ids``; null on and behind a cycle.

    An edge ``(call_id, needs, hops, base)`` says that the call is at least ``hops`` above ``needs``, and on ``base`` at
    least; without ``needs`` only the latter. A round closes the calls whose references are all closed, and leads edges
    past calls with one open reference, so a chain of such calls takes rounds by the logarithm of its length. Each round
    is written and read with its true size (a checkpoint keeps the estimate of its plan, which joins square from round
    to round until the driver is busy with the number's digits); the driver learns two counts.
    """
    known = written(
        references.select("call_id", "needs").distinct().join(ids.select(F.col("call_id").alias("needs")), "needs", "left_semi").join(ids, "call_id", "left_semi"),
        "references",
    )
    referring = known.select(F.col("call_id").alias("needs"), F.lit(True).alias("_refers")).distinct()
    edges = known.join(referring, "needs", "left").select(
        "call_id", F.when(F.col("_refers"), F.col("needs")).alias("needs"), F.when(F.col("_refers"), F.lit(1).cast("bigint")).alias("hops"),
        F.when(F.col("_refers"), F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("base"),
    ).groupBy("call_id", "needs").agg(F.max("hops").alias("hops"), F.max("base").alias("base"))
    parts: list[DataFrame] = []
    while True:
        edges = written(edges, "edges")
        nodes = written(_nodes(edges), "nodes")
        parts.append(nodes.filter("open = 0").select("call_id", F.col("floor").cast("int").alias("level")))
        done, left = nodes.agg(F.count_if(F.col("open") == 0), F.count_if(F.col("open") > 0)).first()
        if not done or not left:
            return reduce(DataFrame.unionByName, [*parts, nodes.filter("open > 0").select("call_id", F.lit(None).cast("int").alias("level"))])
        if len(parts) == MERGED:
            parts = [written(reduce(DataFrame.unionByName, parts), "levels")]
        edges = _nearer(edges, nodes)


def levels(calls: DataFrame, references: DataFrame) -> DataFrame:
    """``(call_id, level)`` for every call: 0 without references, else one more than the deepest call referred to.

    ``references`` holds ``(call_id, needs)``; those to unknown calls do not count. Calls on a cycle, or that refer to
    one, have a null level.
    """
    ids = calls.select("call_id").distinct()
    found = _deep(ids, references).withColumn("_deep", F.lit(True))
    return ids.join(found, "call_id", "left").select("call_id", F.when(F.col("_deep"), F.col("level")).otherwise(F.lit(0)).alias("level"))


def _numbered(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results with ``entry``, their number among those of one kind and identifier, and those of repeated identifiers.

    Only repeated identifiers are ranked, and where there are none the table is not shuffled.
    """
    often = written(entries.groupBy("kind", "call_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("kind", "call_id"), "repeated")
    first = F.lit(1).cast("bigint")
    if often.isEmpty():
        return entries.withColumn("entry", first), often.select("kind", "call_id", first.alias("entry"))
    is_call = F.col("kind") == "call"
    order = {"_conv": F.when(is_call, F.col("conv_id")), "_turn": F.when(is_call, F.col("turn"))}
    many = entries.join(often, ["kind", "call_id"], "left_semi").withColumns(order)
    ranked = global_rank(many, ["kind", "call_id"], [*order, "name", "text", "conv_id", "turn"], "entry").drop(*order).withColumn("entry", F.col("entry").cast("bigint"))
    once = entries.join(often, ["kind", "call_id"], "left_anti").withColumn("entry", first)
    return once.unionByName(ranked), ranked.select("kind", "call_id", "entry")


def _met(entries: DataFrame, references: DataFrame) -> DataFrame:
    """A row per call with the result of its identifier and number, result without call, and turn: the input of ``link``'s checks.

    A call, its result and its level come together in one grouping by identifier and number, of three rows at most.
    """
    named = entries.filter("kind in ('call', 'result') and call_id is not null")
    numbered, repeated = _numbered(named)
    depth = _deep(named.filter("kind = 'call'").select("call_id").distinct(), references)
    more = repeated.filter("kind = 'call' and entry > 1").join(depth, "call_id").select("call_id", "entry", "level")
    depth = depth.withColumn("entry", F.lit(1).cast("bigint")).unionByName(more).withColumn("kind", F.lit("level"))
    pairs = numbered.unionByName(depth, allowMissingColumns=True).repartition("call_id", "entry").groupBy("call_id", "entry").agg(
        F.max(F.when(F.col("kind") == "call", F.struct("conv_id", "turn", "name", "text"))).alias("call"),
        F.max(F.when(F.col("kind") == "result", F.struct("conv_id", "turn", "text"))).alias("result"),
        F.max(F.when(F.col("kind") == "level", F.struct("level"))).alias("deep"),
    )
    called = F.col("call").isNotNull()

    def either(name):
        return F.when(called, F.col(f"call.{name}")).otherwise(F.col(f"result.{name}")).alias(name)

    level = F.when(called, F.when(F.col("deep").isNotNull(), F.col("deep.level")).otherwise(F.lit(0)))
    linked = pairs.select(
        either("conv_id"), either("turn"), "call_id", F.col("call.name").alias("name"), F.col("call.text").alias("arguments"), level.alias("level"),
        (called & F.col("result").isNotNull()).alias("linked"), F.col("result.text").alias("content"), F.when(called, "call").otherwise("result").alias("kind"), "entry",
    )
    is_call = F.col("kind") == "call"
    loose = entries.filter("kind not in ('call', 'result') or call_id is null").select(
        "conv_id", "turn", "call_id", "name", F.when(is_call, F.col("text")).alias("arguments"), F.lit(None).cast("int").alias("level"),
        F.lit(False).alias("linked"), F.when(~is_call, F.col("text")).alias("content"), "kind", F.lit(1).cast("bigint").alias("entry"),
    )
    return linked.unionByName(loose)


def link(calls: DataFrame, results: DataFrame, tools: DataFrame, references: DataFrame, turns: DataFrame | None = None) -> DataFrame:
    """One row per call, result without call, and turn: ``conv_id, position, call_id, level, linked, valid, problem, record``.

    ``calls`` holds ``(conv_id, turn, call_id, name, arguments)`` with arguments as JSON text, ``results``
    ``(call_id, content)`` and possibly ``(conv_id, turn)``, ``tools`` ``(name, schema)``, ``turns`` ``(conv_id, turn,
    role, content)`` of no call. ``position`` numbers a conversation's calls by level, turn and identifier (cycles
    last), so a call follows all it refers to; results without call and turns come after them. ``record`` is the
    canonical JSON of the linked call. Several calls of one identifier are numbered by (conversation, turn, name,
    arguments) and several results by content; equal numbers meet, and records from the second on hold theirs as
    ``entry``. A result without call is not valid. A null identifier links to nothing, and turns have none and are
    neither valid nor not. Arguments that are null, not JSON, or of an unknown tool are not valid, and their text stays
    as it is in the record. Rows that are equal in all columns count once. Empty tables give no rows; other columns
    are ignored.
    """
    types = dict(calls.dtypes)
    own = [F.col(c) if c in results.columns else F.lit(None).cast(types[c]).alias(c) for c in ("conv_id", "turn")]
    entries = calls.select(F.lit("call").alias("kind"), "conv_id", "turn", "call_id", "name", F.col("arguments").alias("text")).unionByName(
        results.select(F.lit("result").alias("kind"), *own, "call_id", F.lit(None).cast("string").alias("name"), F.col("content").alias("text"))
    )
    if turns is not None:
        none = [F.lit(None).cast("string").alias(c) for c in ("call_id", "name")]
        entries = entries.unionByName(turns.select(_turn_kind(F.col("role")).alias("kind"), "conv_id", "turn", *none, F.col("content").alias("text")))
    return _records(written(entries.distinct(), "chats"), tools, references)


def _turn_kind(role: Column) -> Column:
    return F.coalesce(F.concat(F.lit("turn "), role), F.lit("turn"))


def _records(entries: DataFrame, tools: DataFrame, references: DataFrame) -> DataFrame:
    """``link`` of the distinct rows ``(kind, conv_id, turn, call_id, name, text)``, which should be written: they are read several times."""
    schemas = tools.groupBy("name").agg(F.min("schema").alias("schema"))
    rows = _met(entries, references).join(schemas, "name", "left")
    kinds = dict(rows.dtypes)
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, call_id string, level int, linked boolean, valid boolean, problem string, record string, entry bigint"

    def start():
        known: dict[str, dict] = {}

        def one(name, arguments, content, linked, call_id, text, kind, entry, turn) -> tuple[bool | None, str | None, str]:
            number = {"entry": entry} if entry > 1 else {}
            if kind == "result":
                return False, "no call", canonical({"id": call_id, "result": content} | number)
            if kind != "call":
                return None, None, canonical({"content": content, "role": kind[5:] if kind != "turn" else None, "turn": turn})
            try:
                value = json.loads(arguments, parse_constant=lambda c: {}[c])
                if text is None:
                    problem = "unknown tool"
                else:
                    problem = violation(value, known.setdefault(text, json.loads(text)))
            except (TypeError, ValueError, KeyError, RecursionError):
                value, problem = arguments, "not JSON"
            record = {"arguments": value, "id": call_id, "name": name, "result": content if linked else None} | number
            return problem is None, problem, canonical(record)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = [batch.column(c).to_pylist() for c in ("name", "arguments", "content", "linked", "call_id", "schema", "kind", "entry", "turn")]
            valid, problem, record = zip(*map(one, *columns))
            kept = [batch.column(c) for c in ("conv_id", "turn", "call_id", "level", "linked")]
            arrays = [*kept, pa.array(valid, pa.bool_()), pa.array(problem, pa.string()), pa.array(record), batch.column("entry")]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "turn", "call_id", "level", "linked", "valid", "problem", "record", "entry"])

        return step

    # written, because a range partitioning reads its input twice
    checked = written(map_batches(rows, start, schema), "records")
    ranked = global_rank(
        checked.withColumn("_level", F.coalesce("level", F.lit(2**31 - 1))).withColumn("_tie", F.xxhash64("record")),
        ["conv_id"], ["_level", "turn", "call_id", "entry", "_tie"], "position",
    )
    return ranked.select("conv_id", F.col("position").cast("bigint").alias("position"), "call_id", "level", "linked", "valid", "problem", "record")


#: The tool that stands for an assistant's answer, and its schema.
ANSWER = "answer"
ANSWER_SCHEMA = {
    "type": "object",
    "required": ["query"],
    "properties": {"query": {"type": "string", "minLength": 60}, "refs": {"type": "array", "items": {"type": "string"}}},
    "additionalProperties": False,
}


def chat_entries(chats: DataFrame) -> DataFrame:
    """Calls, results and other turns of plain chats, as ``(kind, conv_id, turn, call_id, name, text, needs)`` without repeated rows.

    Every user turn calls ``answer``, and the next assistant turn is its result. A call refers (``needs``) to the call at
    half its turn, if that turn is a user's. Repeated turns with other texts are calls or results of the same identifier;
    turns without conversation or number are no calls; a null text asks with an empty query. One join with the turns of
    users tells a call's reference and whether an assistant's turn is a result.
    """

    def name(turn):
        return F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    asks = F.coalesce((F.col("role") == "user") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.lit(False))
    answers = F.coalesce(F.col("role") == "assistant", F.lit(False))
    turns = chats.select("conv_id", "turn", "role", "text", asks.alias("_asks")).withColumn(
        "_other", F.when(F.col("_asks"), F.expr("turn div 2")).when(answers, F.expr("try_subtract(turn, 1)"))
    )
    users = turns.filter("_asks").select("conv_id", F.col("turn").cast("bigint").alias("_other"), F.lit(True).alias("_known")).distinct()
    met = turns.join(users, ["conv_id", "_other"], "left").withColumn("_text", F.coalesce("text", F.lit("")))
    needs = F.when(F.col("_asks") & F.col("_known") & (F.col("_other") < F.col("turn")), name(F.col("_other")))
    gives = answers & F.coalesce("_known", F.lit(False))
    refs = F.when(F.col("needs").isNotNull(), F.array("needs"))
    return met.withColumn("needs", needs).select(
        F.when(F.col("_asks"), "call").when(gives, "result").otherwise(_turn_kind(F.col("role"))).alias("kind"), "conv_id", "turn",
        F.when(F.col("_asks"), name(F.col("turn"))).when(gives, name(F.col("_other"))).alias("call_id"),
        F.when(F.col("_asks"), ANSWER).alias("name"),
        F.when(F.col("_asks"), F.to_json(F.struct(refs.alias("refs"), F.col("_text").alias("query")))).when(gives, F.col("_text")).otherwise(F.col("text")).alias("text"),
        "needs",
    ).distinct()


def format_chats(chats: DataFrame, whole: bool = False) -> DataFrame:
    """Canonical calls of plain chats (see ``chat_entries`` and ``link``), with the digest of each record.

    With ``whole``, the turns that are neither call nor result are rows too.
    """
    entries = chat_entries(chats)
    entries = written(entries if whole else entries.filter("kind in ('call', 'result')"), "chats")
    tools = chats.sparkSession.createDataFrame([(ANSWER, canonical(ANSWER_SCHEMA))], "name string, schema string")
    references = entries.filter("needs is not null").select("call_id", "needs")
    return _records(entries.drop("needs"), tools, references).withColumn("record_sha256", F.sha2(F.col("record").cast("binary"), 256))
