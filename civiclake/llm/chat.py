"""Chat formatting with schema fingerprints, in SQL functions only.

A source's fingerprint hashes its sorted nested field paths.  It selects a
declarative mapping (``LAYOUTS``) that says which column holds what, and one
projection turns any of the known layouts into canonical turns
(conv_id, turn, role, text).  Turns of a conversation are rendered as

    <|turn|>ROLE\\nTEXT<|end|>

with control strings inside role and text broken by a backslash after their
first character, backslashes doubled, and line feeds of a role escaped.
So a turn's marks occur only where a turn begins or ends, and unescaping
gives every text back.  The loss mask lists the assistants' text spans.

A null role or text is empty.  A conversation whose array of messages is null
or empty stays, as the empty text.  Rows of one turn number are ordered by role
and text; repeated rows are turns of their own; a null conversation id is a
conversation.  An empty table gives an empty result, and other columns are
not read unless the layout names them.  A conversation becomes one string, so
its turns meet in one row by definition.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

TURN, END = "<|turn|>", "<|end|>"
#: Strings that tokenizers and chat templates give a meaning (fixed values).
CONTROLS = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``rows``: conv, turn, role, text columns, a row a turn.
    ``messages``: an array column with role and text fields (paths inside an element).
    ``pairs``: columns that each are a turn of a fixed role, in order; empty ones are left out if ``optional``.
    """

    kind: str
    conv: str
    columns: tuple[tuple[str, str], ...]
    messages: str = ""
    optional: tuple[str, ...] = ()
    #: Role names of this layout in canonical form.
    roles: tuple[tuple[str, str], ...] = ()


def field_paths(kind: DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a type; array elements under []."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths: list[str]) -> str:
    """Hash of the sorted paths, lower case."""
    return hashlib.sha256("\n".join(sorted(p.lower() for p in paths)).encode()).hexdigest()[:16]


SHAREGPT = (("human", "user"), ("gpt", "assistant"))
#: Known layouts by the field paths they need.
LAYOUTS: dict[tuple[str, ...], Layout] = {
    ("conv_id", "turn", "role", "text"): Layout("rows", "conv_id", (("turn", "turn"), ("role", "role"), ("text", "text"))),
    ("id", "messages[].role", "messages[].content"): Layout("messages", "id", (("role", "role"), ("text", "content")), "messages"),
    ("id", "conversations[].from", "conversations[].value"): Layout("messages", "id", (("role", "from"), ("text", "value")), "conversations", roles=SHAREGPT),
    ("id", "prompt", "response"): Layout("pairs", "id", (("user", "prompt"), ("assistant", "response"))),
    ("id", "prompt", "completion"): Layout("pairs", "id", (("user", "prompt"), ("assistant", "completion"))),
    ("id", "question", "answer"): Layout("pairs", "id", (("user", "question"), ("assistant", "answer"))),
    ("id", "instruction", "input", "output"): Layout("pairs", "id", (("system", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
    ("id", "system", "prompt", "response"): Layout("pairs", "id", (("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
}
BY_FINGERPRINT = {fingerprint(list(paths)): (paths, layout) for paths, layout in LAYOUTS.items()}


def layout_of(schema: StructType) -> Layout:
    """The layout of a schema: by its fingerprint, or else by that of the largest known set of
    paths among its own (further columns do not change a layout)."""
    own = field_paths(schema)
    if found := BY_FINGERPRINT.get(fingerprint(own)):
        return found[1]
    present = {p.lower() for p in own}
    fits = [paths for paths in LAYOUTS if present >= set(paths)]
    if not fits:
        raise ValueError(f"no layout has the fields {sorted(own)}")
    best = max(fits, key=lambda p: (len(p), p))
    return BY_FINGERPRINT[fingerprint(list(best))][1]


def canonical_turns(df: DataFrame, layout: Layout | None = None) -> DataFrame:
    """conv_id, turn, role, text of any known layout; a conversation without messages has one row, its role null."""
    layout = layout or layout_of(df.schema)
    names = dict(layout.columns)
    if layout.kind == "rows":
        out = df.select(F.col(layout.conv).alias("conv_id"), F.col(names["turn"]).cast("long").alias("turn"), F.col(names["role"]).alias("role"), F.col(names["text"]).alias("text"))
    elif layout.kind == "messages":
        each = df.select(F.col(layout.conv).alias("conv_id"), F.posexplode_outer(layout.messages).alias("turn", "m"))
        out = each.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("m")[names["role"]].alias("role"), F.col("m")[names["text"]].alias("text"))
    else:
        turns = [F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), F.col(c).cast("string").alias("text"), F.lit(c in layout.optional).alias("optional")) for i, (role, c) in enumerate(layout.columns)]
        each = df.select(F.col(layout.conv).alias("conv_id"), F.explode(F.array(*turns)).alias("m"))
        out = each.where(~F.col("m.optional") | (F.coalesce(F.col("m.text"), F.lit("")) != "")).select("conv_id", "m.turn", "m.role", "m.text")
    role = F.col("role").cast("string")
    for name, canonical in layout.roles:
        role = F.when(F.col("role") == name, F.lit(canonical)).otherwise(role)
    role, text = F.coalesce(role, F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    if layout.kind == "messages":  # posexplode_outer gives no place where there is no message
        role, text = F.when(F.col("turn").isNotNull(), role), F.when(F.col("turn").isNotNull(), text)
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def escape(text: Column) -> Column:
    """Double backslashes, and break each control string by one after its first character."""
    controls = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROLS)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(controls), F.lit("\\\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted (the rendered conversation) and loss_mask (array of start, end in
    characters of formatted, end exclusive: the escaped text of each assistant turn)."""
    head = F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    turn = F.struct("turn", "role", "text", head.alias("head"), escape(F.col("text")).alias("body"))
    each = turns.select("conv_id", F.when(F.col("role").isNotNull(), turn).alias("t"))
    convs = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    formatted = F.concat_ws("", F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(END))))
    # character positions by a running sum over the turns
    spans = F.expr(
        f"""aggregate(t, named_struct('at', 0L, 'spans', cast(array() as array<struct<start: bigint, end: bigint>>)),
        (a, x) -> named_struct(
            'at', a.at + length(x.head) + length(x.body) + {len(END)},
            'spans', if(x.role = 'assistant', array_append(a.spans, named_struct('start', a.at + length(x.head), 'end', a.at + length(x.head) + length(x.body))), a.spans)),
        a -> a.spans)"""
    )
    return convs.select("conv_id", formatted.alias("formatted"), spans.alias("loss_mask"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text) and loss_texts (texts under the mask) from the rendered form."""
    parts = F.slice(F.split("formatted", re.escape(END)), 1, F.size(F.split("formatted", re.escape(END))) - 1)
    head = rf"(?s)^{re.escape(TURN)}((?:[^\\\n]|\\.)*)\n"

    def turn(p: Column) -> Column:
        role = F.regexp_extract(p, head, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(p, F.length(role) + len(TURN) + 2)).alias("text"))

    masked = F.transform("loss_mask", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", "formatted", F.transform(parts, turn).alias("turns"), masked.alias("loss_texts"))
