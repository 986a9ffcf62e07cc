"""Chat formatting: records of different layouts become canonical turns and one template. DataFrame functions only.

A record's fingerprint is the hash of its nested field paths (those that any mapping knows). It selects a declarative
mapping, which says where roles and texts stand. The template marks turns by control strings; the same strings inside
texts are escaped, so the formatted text can be read back exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout's fields, and its turns as an expression of a struct with these fields."""

    name: str
    schema: T.StructType
    turns: Callable[[Column], Column]

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256("\n".join(sorted(paths(self.schema))).encode()).hexdigest()


def paths(schema: T.DataType, before: str = "") -> set[str]:
    """Nested field paths of leaves; ``[]`` stands for the elements of a list."""
    if isinstance(schema, T.StructType):
        return {p for f in schema for p in paths(f.dataType, f"{before}.{f.name}" if before else f.name)}
    if isinstance(schema, T.ArrayType):
        return paths(schema.elementType, f"{before}[]")
    return {before}


def _turn(role: str | Column, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else F.coalesce(role, F.lit(""))
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _pair(question: Column, answer: Column) -> Column:
    return F.array(_turn("user", question), _turn("assistant", answer))


def _list(items: Column, role: str, text: str, names: dict[str, str] | None = None) -> Column:
    def turn(item: Column) -> Column:
        said = item[role]
        for old, new in (names or {}).items():
            said = F.when(item[role] == old, F.lit(new)).otherwise(said)
        return _turn(said, item[text])

    return F.transform(items, turn)


def _instruction(r: Column) -> Column:
    given = F.coalesce(r["input"], F.lit(""))
    question = F.when(given == "", r["instruction"]).otherwise(F.concat_ws("\n\n", r["instruction"], given))
    return _pair(question, r["output"])


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _items(name: str, fields: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(name, T.ArrayType(fields))])


MAPPINGS = (
    Mapping("turns", _items("turns", T.StructType([T.StructField("turn", T.LongType()), *_texts("role", "text")])), lambda r: _list(r["turns"], "role", "text")),
    Mapping("messages", _items("messages", _texts("role", "content")), lambda r: _list(r["messages"], "role", "content")),
    Mapping(
        "from_value", _items("conversations", _texts("from", "value")),
        lambda r: _list(r["conversations"], "from", "value", {"human": "user", "gpt": "assistant"}),
    ),
    Mapping("prompt_response", _texts("prompt", "response"), lambda r: _pair(r["prompt"], r["response"])),
    Mapping("prompt_completion", _texts("prompt", "completion"), lambda r: _pair(r["prompt"], r["completion"])),
    Mapping("instruction", _texts("instruction", "output"), lambda r: _pair(r["instruction"], r["output"])),
    Mapping("instruction_input", _texts("instruction", "input", "output"), _instruction),
)
KNOWN_PATHS = sorted({p for m in MAPPINGS for p in paths(m.schema)})
LISTS = sorted({p.split("[]")[0] for p in KNOWN_PATHS if "[]" in p})


#: Texts of any length; the reader's own limit is 20 million characters.
WHOLE = {"maxStringLen": str(2**31 - 1)}


def json_fingerprint(fields: Column) -> Column:
    """Fingerprint of a JSON object, given as a map of its fields' texts; all elements of its lists count. Null if
    it is no object."""

    def under(name: str) -> Column:
        items = F.from_json(fields[name], "array<map<string, string>>", WHOLE)
        keys = F.transform(F.coalesce(items, F.array()), lambda item: F.coalesce(F.map_keys(item), F.array()))
        return F.transform(F.array_distinct(F.flatten(keys)), lambda key: F.concat(F.lit(f"{name}[]."), key))

    nested = [under(name) for name in LISTS]
    known = F.array_intersect(F.concat(F.map_keys(fields), *nested), F.array(*[F.lit(p) for p in KNOWN_PATHS]))
    return F.sha2(F.array_join(F.array_sort(known), "\n"), 256)


def json_turns(records: DataFrame, record: str) -> DataFrame:
    """Adds ``layout`` and ``turns`` to records of JSON text. Both are null where no mapping fits or the text is no
    object; such rows are kept for the caller to set aside. A null text or role is empty."""
    # A column of its own, so that the record is opened once.
    opened = records.withColumn("_fields", F.from_json(record, "map<string, string>", WHOLE))
    with_print = opened.withColumn("_print", json_fingerprint(F.col("_fields"))).drop("_fields")
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in MAPPINGS:
        here = F.col("_print") == m.fingerprint
        layout = F.when(here, m.name).otherwise(layout)
        turns = F.when(here, m.turns(F.from_json(record, m.schema, WHOLE)).cast(TURNS)).otherwise(turns)
    return with_print.withColumns({"layout": layout, "turns": turns}).drop("_print")


def typed_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """Adds ``layout`` and ``turns`` to records held in a struct column; its own schema gives the fingerprint."""
    schema = records.schema[record].dataType
    seen = paths(schema) & set(KNOWN_PATHS)
    wanted = hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()
    fitting = [m for m in MAPPINGS if m.fingerprint == wanted]
    if not fitting:
        raise ValueError(f"no mapping has the fields {sorted(seen)}")
    return records.withColumns({"layout": F.lit(fitting[0].name), "turns": fitting[0].turns(F.col(record)).cast(TURNS)})


def conversations_of(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn as ``turns`` of each conversation, in order of turn, role and text (nulls first)."""
    said = F.struct(F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    return rows.groupBy(F.col(key).alias("conv_id")).agg(F.sort_array(F.collect_list(said)).alias("turns"))


def json_record(turns: Column) -> Column:
    """Turns as a JSON record in the layout that their form asks for: a question with its answer is a prompt and a
    response, a talk of user and assistant alone has ``from`` and ``value``, any other has messages."""
    said = lambda t, name: F.coalesce(t[name], F.lit(""))
    roles = F.transform(turns, lambda t: said(t, "role"))
    one_pair = F.struct(said(F.get(turns, F.lit(0)), "text").alias("prompt"), said(F.get(turns, F.lit(1)), "text").alias("response"))
    speaker = lambda t: F.when(t["role"] == "user", "human").otherwise("gpt").alias("from")
    talk = F.transform(turns, lambda t: F.struct(speaker(t), said(t, "text").alias("value")))
    messages = F.transform(turns, lambda t: F.struct(said(t, "role").alias("role"), said(t, "text").alias("content")))
    return (
        F.when(roles == F.array(F.lit("user"), F.lit("assistant")), F.to_json(one_pair))
        .when(F.forall(roles, lambda r: r.isin("user", "assistant")), F.to_json(F.struct(talk.alias("conversations"))))
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )


def escaped(text: Column) -> Column:
    """One more backslash between ``<`` and ``|``, wherever only backslashes stand between them."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_turns(records: DataFrame, learned: str = "assistant") -> DataFrame:
    """Adds ``segments`` and ``formatted`` to rows with ``turns``.

    ``segments`` are the pieces of the formatted text in order, each with ``loss``: true for the texts of role
    ``learned`` alone, which is the loss mask. ``formatted`` joins them. No turns give an empty text, null turns null.
    Every step is linear in a conversation's length; one conversation is built in one row.
    """
    def pieces(t: Column) -> Column:
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            piece(F.concat(F.lit(OPEN), _escaped_role(t["role"]), F.lit("\n")), F.lit(False)),
            piece(escaped(t["text"]), t["role"] == learned),
            piece(F.lit(CLOSE), F.lit(False)),
        )

    with_pieces = records.withColumn("segments", F.flatten(F.transform("turns", pieces)))
    return with_pieces.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """Turns read back from a formatted text."""
    split = F.split(formatted, r"<\|im_start\|>")
    parts = F.slice(split, F.lit(2), F.size(split) - 1)

    def turn(part: Column) -> Column:
        at = F.instr(part, "\n")
        body = F.substr(part, at + 1)
        return F.struct(
            _unescaped_role(F.substr(part, F.lit(1), at - 1)).alias("role"),
            unescaped(F.substr(body, F.lit(1), F.char_length(body) - len(CLOSE))).alias("text"),
        )

    return F.transform(parts, turn)


def masked_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def format_conversations(rows: DataFrame, **columns: str) -> DataFrame:
    """Conversations given by turn, formatted: ``conv_id``, ``layout``, ``turns``, ``segments``, ``formatted``.

    Every conversation is made a JSON record in one of three layouts, and the fingerprint of each record selects the
    mapping that reads it. Null texts and roles are empty; rows that repeat stay, and ties on the turn go by role and
    text. A null id is a conversation of its own. An empty table gives no row; other columns are not read.
    """
    records = conversations_of(rows, **columns).select("conv_id", json_record(F.col("turns")).alias("record"))
    return format_turns(json_turns(records, "record")).drop("record")


def digests(formatted: DataFrame) -> DataFrame:
    """Digests of what ``formatted`` and ``segments`` hold, read back from them."""
    back = formatted.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("back"), masked_text(F.col("segments")).alias("masked"))
    lines = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
