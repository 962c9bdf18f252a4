"""Chat formatting: records of many layouts become canonical turns, and turns one reversible training text.

DataFrame functions only. A layout is known by its schema fingerprint, a hash of its nested field paths, which selects
a declarative mapping.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

TURNS = "array<struct<role:string,text:string>>"

#: The template's own marks: before a role, between role and text, after a text.
TURN, SAY, END = "<|turn|>", "<|say|>", "<|end|>"

#: Strings that this or another template, or a tokenizer, takes for control.
CONTROLS = (
    TURN, SAY, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
    "<|startoftext|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>",
)
BREAK = "\\"


def paths(kind: DataType, prefix: str = "") -> list[str]:
    """All field paths of a type; arrays add ``[]``, maps ``{}``, leaves nothing."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in paths(f.dataType, f"{prefix}.{f.name.lower()}" if prefix else f.name.lower())]
    if isinstance(kind, ArrayType):
        return paths(kind.elementType, f"{prefix}[]")
    if isinstance(kind, MapType):
        return paths(kind.valueType, prefix + "{}")
    return [prefix]


def schema_fingerprint(field_paths: list[str]) -> str:
    """The hash of a set of field paths: their order, and repeats, do not count."""
    return hashlib.sha256("\n".join(sorted(set(field_paths))).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """One layout: the paths that mark it, and its turns as a SQL expression of type ``TURNS`` over those fields.

    ``rows`` names key, order, role and text of a layout that has a row for each turn.
    """

    name: str
    fields: tuple[str, ...]
    turns: str = ""
    rows: tuple[str, str, str, str] | None = None

    @property
    def fingerprint(self) -> str:
        return schema_fingerprint(list(self.fields))


def _said(role: str, field: str) -> str:
    return f"named_struct('role', '{role}', 'text', {field})"


#: Roles of other layouts and the canonical role.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
_ROLE = "coalesce(element_at(map(" + ", ".join(f"'{a}', '{b}'" for a, b in ROLES.items()) + "), lower({0})), lower({0}))"


def _listed(field: str, role: str, text: str) -> str:
    return f"transform({field}, m -> named_struct('role', {_ROLE.format('m.' + role)}, 'text', m.{text}))"


MAPPINGS = (
    Mapping("turn rows", ("conv_id", "turn", "role", "text"), rows=("conv_id", "turn", "role", "text")),
    Mapping("prompt and response", ("prompt", "response"), f"array({_said('user', 'prompt')}, {_said('assistant', 'response')})"),
    Mapping("prompt and completion", ("prompt", "completion"),
            f"array({_said('user', 'prompt')}, {_said('assistant', 'completion')})"),
    Mapping("instruction", ("instruction", "output"),
            f"array({_said('user', 'instruction')}, {_said('assistant', 'output')})"),
    Mapping("instruction with input", ("instruction", "input", "output"), "array(" + _said(
        "user", "if(coalesce(input, '') = '', instruction, concat(coalesce(instruction, ''), '\\n\\n', input))",
    ) + f", {_said('assistant', 'output')})"),
    Mapping("messages", ("messages[].role", "messages[].content"), _listed("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), _listed("conversations", "from", "value")),
    Mapping("system and messages", ("system", "messages[].role", "messages[].content"),
            f"concat(array({_said('system', 'system')}), {_listed('messages', 'role', 'content')})"),
)


def mapping_of(df: DataFrame, key: str | None, known: tuple[Mapping, ...] = MAPPINGS) -> Mapping:
    """The mapping for the layout of ``df``; ``key`` is not part of a layout with one row per record.

    Columns beside a known layout do not hide it: of the mappings whose paths all occur, the one with most paths is
    taken, ties by order in ``known``.
    """
    have = [p for p in paths(df.schema) if key is None or p != key.lower()]
    exact = {m.fingerprint: m for m in known}.get(schema_fingerprint(have))
    if exact:
        return exact
    whole = set(paths(df.schema))
    fitting = [m for m in known if set(m.fields) <= (whole if m.rows else set(have))]
    if not fitting:
        raise ValueError(f"no mapping knows the layout {sorted(have)}")
    return max(fitting, key=lambda m: len(m.fields))


def canonical(df: DataFrame, key: str = "conv_id", known: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(``conv_id``, ``turns``) of the records in ``df``, whatever their layout.

    A layout with a row for each turn is gathered by its key and ordered by turn, then role, then text, NULLs first;
    repeated rows are repeated turns, and a NULL key is one conversation. A conversation becomes one value, as the
    training text it is made for. NULL roles and texts are empty; a record whose list of messages is NULL has no turns.
    An empty table gives an empty table.
    """
    mapping = mapping_of(df, key, known)
    if mapping.rows:
        conv, turn, role, text = (F.col(f"`{c}`") for c in mapping.rows)
        gathered = df.groupBy(conv.alias("conv_id")).agg(
            F.array_sort(F.collect_list(F.struct(turn.alias("o"), role.alias("role"), text.alias("text")))).alias("turns"))
    else:
        gathered = df.select(F.col(f"`{key}`").alias("conv_id"), F.expr(mapping.turns).alias("turns"))
    clean = F.transform(
        F.coalesce("turns", F.array()),
        lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")),
    )
    return gathered.select("conv_id", clean.cast(TURNS).alias("turns"))


#: Layouts of JSON records: what ``schema_of_variant`` says of a record, hashed, selects the schema to read it with.
JSON_LAYOUTS = {
    "prompt STRING, response STRING": "prompt and response",
    "prompt STRING, completion STRING": "prompt and completion",
    "instruction STRING, output STRING": "instruction",
    "instruction STRING, input STRING, output STRING": "instruction with input",
    "messages ARRAY<STRUCT<role: STRING, content: STRING>>": "messages",
    "conversations ARRAY<STRUCT<`from`: STRING, value: STRING>>": "conversations",
    "system STRING, messages ARRAY<STRUCT<role: STRING, content: STRING>>": "system and messages",
}


def json_fingerprint(record: Column) -> Column:
    """The fingerprint of each JSON text's own layout: its nested field paths with their types, hashed."""
    said = F.schema_of_variant(F.try_parse_json(record))
    return F.substring(F.sha2(F.regexp_replace(said, r"\b(VOID|VARIANT)\b", "STRING"), 256), 1, 16)


def canonical_json(df: DataFrame, record: str = "record", key: str = "conv_id") -> DataFrame:
    """(``conv_id``, ``turns``, ``layout``) of JSON records whose layouts differ from row to row.

    Each record's fingerprint selects its mapping; a record of no known layout, or that is no JSON, has NULL for both.
    """
    by_name = {m.name: m for m in MAPPINGS}
    shapes = []
    for schema, name in JSON_LAYOUTS.items():
        kind = StructType.fromDDL(schema)
        parts = sorted((f.name, f.dataType) for f in kind.fields)
        said = "OBJECT<" + ", ".join(f"{n}: {_variant_name(t)}" for n, t in parts) + ">"
        shapes.append((hashlib.sha256(said.encode()).hexdigest()[:16], schema, by_name[name]))
    marked = df.select(F.col(f"`{key}`").alias("conv_id"), F.col(f"`{record}`").alias("__r")).withColumn(
        "__f", json_fingerprint(F.col("__r")))
    turns, layout = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    for i, (mark, schema, _) in enumerate(shapes):
        marked = marked.withColumn(f"__p{i}", F.when(F.col("__f") == mark, F.from_json("__r", schema)))
    for i, (mark, schema, mapping) in enumerate(shapes):
        names = [f.name for f in StructType.fromDDL(schema).fields]
        expr = mapping.turns
        for n in names:
            expr = _qualified(expr, n, f"__p{i}.`{n}`")
        turns = F.when(F.col("__f") == mark, F.expr(expr).cast(TURNS)).otherwise(turns)
        layout = F.when(F.col("__f") == mark, F.lit(mapping.name)).otherwise(layout)
    clean = F.transform(turns, lambda t: F.struct(
        F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return marked.select("conv_id", clean.alias("turns"), layout.alias("layout"))


def _variant_name(kind: DataType) -> str:
    if isinstance(kind, ArrayType):
        return f"ARRAY<{_variant_name(kind.elementType)}>"
    if isinstance(kind, StructType):
        return "OBJECT<" + ", ".join(f"{n}: {_variant_name(t)}" for n, t in sorted((f.name, f.dataType) for f in kind)) + ">"
    return kind.simpleString().upper()


def _qualified(expr: str, name: str, path: str) -> str:
    return re.sub(rf"(?<![\w'.`]){name}(?![\w'`])", path, expr)


def escaped(text: Column) -> Column:
    """``text`` without control strings; ``unescaped`` gives it back.

    Back-slashes are doubled, then one is put behind the first character of each control string. A single back-slash
    at that place can only come from here, since all others are in pairs.
    """
    text = F.replace(text, F.lit(BREAK), F.lit(BREAK * 2))
    for c in CONTROLS:
        text = F.replace(text, F.lit(c), F.lit(c[0] + BREAK + c[1:]))
    return text


def unescaped(text: Column) -> Column:
    for c in reversed(CONTROLS):
        text = F.replace(text, F.lit(c[0] + BREAK + c[1:]), F.lit(c))
    return F.replace(text, F.lit(BREAK * 2), F.lit(BREAK))


def formatted(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """``turns`` with ``segments`` and ``formatted``: per turn the mark and role, the text, the closing mark.

    ``segments`` are the pieces of ``formatted`` in order, each with ``loss``: true for texts of the role ``learn``.
    """
    pieces = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit(TURN), escaped(t["role"]), F.lit(SAY)).alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(t["text"]).alias("text"), (t["role"] == learn).alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
    )))
    made = turns.withColumn("segments", pieces)
    return made.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` (of ``formatted``) with ``read``, the turns parsed from ``formatted``, and ``loss``, the learned texts."""
    parts = F.filter(F.split("formatted", r"<\|end\|>"), lambda p: p != "")
    turn = lambda p: F.struct(
        unescaped(F.substring_index(F.substring(p, len(TURN) + 1, 2**31 - 1), SAY, 1)).alias("role"),
        unescaped(F.substring_index(p, SAY, -1)).alias("text"))
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    return chats.withColumn("read", F.transform(parts, turn)).withColumn("loss", loss)
