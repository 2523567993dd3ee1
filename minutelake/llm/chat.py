"""Chat formatting, in DataFrame functions alone.

The nested field paths of a table (or of each JSON record) are hashed to a fingerprint, which selects a declarative
mapping from its layout - turns in rows, message lists, prompt and response, instruction and output - to canonical
turns (conversation, turn, role, text). The template marks each turn by control strings and escapes those inside texts
by one more backslash, so texts come back as they were; the loss mask tells where in a turn the text to learn lies.

Edge cases: null roles and texts are empty, and so are null parts of a record. Equal turn numbers are ordered by role
and text, null numbers first. Repeated rows are turns of their own. A null conversation is a conversation. Fields that
no layout knows are ignored. A table of no known layout is an error; a record of none has null turns. An empty table
gives no rows. A conversation becomes one string, so its turns meet in one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutelake.llm.common import table

# the template: <s>[INST]role, line end, text[/INST]</s>
OPEN, CLOSE = "<s>[INST]", "[/INST]</s>"
CLOSE_PATTERN = r"\[/INST\]</s>"
CONTROL = r"/?(?:s>|INST\])"
ESCAPE = (rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")
UNESCAPE = (rf"([<\[])\\(\\*)({CONTROL})", "$1$2$3")
LEARNED = "assistant"

#: names of roles in other layouts
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Turns lie in a list of (role, text) elements, or in fields that have a role each (joined by an empty line)."""

    name: str
    listed: tuple[str, str, str] | None = None
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def paths(self) -> list[str]:
        if self.listed:
            return [f"{self.listed[0]}[].{x}" for x in self.listed[1:]]
        return [x for _, fields in self.parts for x in fields]

    def schema(self) -> str:
        if self.listed:
            return f"`{self.listed[0]}` array<struct<`{self.listed[1]}`:string,`{self.listed[2]}`:string>>"
        return ", ".join(f"`{x}` string" for x in self.paths())

    def turns(self, field: Callable[[str], Column]) -> Column:
        """array<struct<role, text>> of the record whose fields ``field`` gives."""
        if self.listed:
            name, role, text = self.listed
            return F.transform(field(name), lambda m: said(role_of(m[role]), m[text]))
        return F.array(*[said(F.lit(role), F.array_join(F.filter(F.array(*[field(x) for x in fields]), lambda x: F.length(x) > 0), "\n\n")) for role, fields in self.parts])


ROWS = Layout("rows", parts=(("", ("role", "text", "turn")),))
LAYOUTS = (
    ROWS,
    Layout("messages", listed=("messages", "role", "content")),
    Layout("from_value", listed=("conversations", "from", "value")),
    Layout("instruction", parts=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_input", parts=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("prompt_completion", parts=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", parts=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system_prompt_response", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question_answer", parts=(("user", ("question",)), ("assistant", ("answer",)))),
)
#: the layout with most fields is asked first
BY_SIZE = sorted(LAYOUTS, key=lambda x: -len(x.paths()))


def said(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def role_of(role: Column) -> Column:
    out = role
    for name, ours in ROLES.items():
        out = F.when(role == name, ours).otherwise(out)
    return out


def fingerprint(paths: Iterable[str], layout: Layout) -> str:
    """Hash of the field paths, without those that the layout doesn't have."""
    return hashlib.md5(",".join(sorted(set(paths) & set(layout.paths()))).encode()).hexdigest()


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested paths of the leaves of a type; ``[]`` marks list elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    return field_paths(kind.elementType, f"{at}[]") if isinstance(kind, T.ArrayType) else [at]


def layout_of(df: DataFrame) -> Layout:
    paths = field_paths(df.schema)
    found = next((x for x in BY_SIZE if fingerprint(paths, x) == fingerprint(x.paths(), x)), None)
    if found is None:
        raise ValueError(f"no layout has these fields: {sorted(paths)}")
    return found


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turn, role, text) of a table of any known layout."""
    layout = layout_of(df)
    if layout is ROWS:
        row = said(F.col("role").cast("string"), F.col("text"))
        return df.select("conv_id", F.col("turn").cast("long").alias("turn"), row["role"].alias("role"), row["text"].alias("text"))
    return exploded(df.select(F.col(id_col).alias("conv_id"), layout.turns(lambda x: F.col(f"`{x}`")).alias("turns")))


def canonical_records(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv_id, turn, role, text) of JSON records, each of a layout of its own.

    Records that give no turn are those of ``unreadable_records``: none is lost between the two.
    """
    return exploded(df.select(F.col(id_col).alias("conv_id"), record_turns(F.col(json_col)).alias("turns")))


def unreadable_records(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv_id, record, reason) of JSON records without turns: ``no layout`` (also null or not JSON), or ``no turns``."""
    found = df.select(F.col(id_col).alias("conv_id"), F.col(json_col).alias("record"), record_turns(F.col(json_col)).alias("turns"))
    reason = F.when(F.col("turns").isNull(), F.lit("no layout")).otherwise(F.lit("no turns"))
    return found.where(F.col("turns").isNull() | (F.size("turns") == 0)).select("conv_id", "record", reason.alias("reason"))


def exploded(df: DataFrame) -> DataFrame:
    return df.select("conv_id", F.posexplode("turns").alias("turn", "said")).select("conv_id", F.col("turn").cast("long").alias("turn"), "said.role", "said.text")


def record_turns(record: Column) -> Column:
    """Turns of a JSON record by the mapping that its nested field paths select; null where none does."""
    none = F.array().cast("array<string>")
    top = F.coalesce(F.json_object_keys(record), none)

    def element_paths(layout: Layout) -> Column:
        """Of all elements, as one may lack what others have; an empty list could have all that the layout asks for."""
        name = layout.listed[0]
        elements = F.from_json(F.get_json_object(record, f"$.{name}"), "array<string>")
        keys = F.flatten(F.transform(elements, lambda x: F.coalesce(F.json_object_keys(x), none)))
        found = F.transform(keys, lambda k: F.concat(F.lit(f"{name}[]."), k))
        return F.coalesce(F.when(F.size(elements) == 0, F.array(*[F.lit(x) for x in layout.paths()])).otherwise(found), none)

    nested = [element_paths(x) for x in LAYOUTS if x.listed]
    paths = F.array_sort(F.array_distinct(F.concat(top, *nested)))

    def mark(layout: Layout) -> Column:
        return F.md5(F.array_join(F.filter(paths, lambda p: p.isin(layout.paths())), ",").cast("binary"))

    def turns(layout: Layout) -> Column:
        parsed = F.from_json(record, layout.schema())
        return layout.turns(lambda x: parsed[x])

    out = F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in reversed([x for x in BY_SIZE if x is not ROWS]):
        out = F.when(mark(layout) == fingerprint(layout.paths(), layout), turns(layout)).otherwise(out)
    return out


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask) of canonical turns.

    loss_mask: (turn, start, length) of each text to learn: characters of the turn's own piece of ``formatted``.
    """
    head = F.concat(F.lit(OPEN), F.url_encode("role"), F.lit("\n"))
    text = F.regexp_replace("text", F.lit(ESCAPE[0]), F.lit(ESCAPE[1]))
    rows = turns.select("conv_id", "turn", "role", "text", head.alias("head"), text.alias("escaped"))
    piece = F.struct("turn", "role", F.concat("head", "escaped", F.lit(CLOSE)).alias("piece"), F.length("head").alias("start"), F.length("escaped").alias("length"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("held"))
    mask = F.filter(F.transform("held", lambda x, i: F.struct(x["role"].alias("role"), i.alias("turn"), x["start"].alias("start"), x["length"].alias("length"))), lambda x: x["role"] == LEARNED)
    return held.select("conv_id", F.array_join(F.transform("held", lambda x: x["piece"]), "").alias("formatted"), F.transform(mask, lambda x: F.struct(x["turn"].alias("turn"), x["start"].alias("start"), x["length"].alias("length"))).alias("loss_mask"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE[0]), F.lit(UNESCAPE[1]))


def read_chats(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, learned): the turns and the texts under the loss mask, read back."""
    pieces = F.split("formatted", CLOSE_PATTERN)
    rows = formatted.select("conv_id", "formatted", "loss_mask", F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("pieces"))

    def read(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), "\n", 1)
        return F.struct(F.url_decode(role).alias("role"), unescaped(F.substr(piece, F.length(role) + len(OPEN) + 2)).alias("text"))

    learned = F.transform("loss_mask", lambda m: unescaped(F.substr(F.get("pieces", m["turn"]), m["start"] + 1, m["length"])))
    return rows.select("conv_id", "formatted", F.transform("pieces", read).alias("turns"), learned.alias("learned"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    back = read_chats(format_chats(canonical_turns(rows.unionByName(more))))
    said_all = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said_all, 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


OP3_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, x, CASE x WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(x)),
e AS (SELECT *, '<s>[INST]' || role || chr(10) || regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') || '[/INST]</s>' AS piece FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
