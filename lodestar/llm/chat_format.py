"""Chat formatting: records of many layouts become canonical turns, and turns
become one training text with a loss mask.  Native column functions only."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Word joiner: put behind the first character of a control string inside a
# text, so that the string is no longer there; doubled where it occurs itself.
ESCAPE = "⁠"
# Strings that chat templates give a meaning.
CONTROL = ["<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]
CONTROL_RE = r"(<\||<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\])"
# A variant takes no string of more characters than this, and no record over 128 MiB.
VARIANT_MOST = 20_000_000
LONG_TEXTS = {"maxStringLen": str(2 ** 31 - 1)}
TURN_TYPE = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """A declarative mapping: ``paths`` are the nested field paths of a
    record of this layout.  Either ``each`` names an array whose elements
    hold a role and a text, or ``fixed`` lists (role, fields): one turn per
    entry, its text the non-empty fields joined by a blank line."""

    name: str
    each: tuple[str, str, str] | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def paths(self) -> list[str]:
        if self.each:
            return sorted(f"{self.each[0]}[].{n}" for n in self.each[1:])
        return sorted({n for _, names in self.fixed for n in names})

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256("\n".join(self.paths).encode()).hexdigest()


SHARE_ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("messages", each=("messages", "role", "content")),
    Layout("messages_text", each=("messages", "role", "text")),
    Layout("turns", each=("conversations", "from", "value"), roles=SHARE_ROLES),
    Layout("prompt_completion", fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system_prompt_response",
           fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("instruction", fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_input", fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("question_answer", fixed=(("user", ("question",)), ("assistant", ("answer",)))),
)


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, f"(?={CONTROL_RE})(.)", f"$2{ESCAPE}")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"(?s){ESCAPE}(.)", "$1")


def field_paths(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Sorted nested field paths of a variant, of those fields that any
    layout knows; fields that none knows do not change a fingerprint."""
    roots = sorted({p.split("[].")[0] for x in layouts for p in x.paths})
    inner = sorted({p.split("[].")[1] for x in layouts for p in x.paths if "[]." in p})
    found = []
    for root in roots:
        kind = F.schema_of_variant(F.try_variant_get(record, f"$.{root}", "variant"))
        names = F.array_distinct(F.filter(F.regexp_extract_all(kind, F.lit(r"`?(\w+)`?: "), F.lit(1)),
                                          lambda n: n.isin(inner)))
        found.append(F.when(kind.isNull(), F.array().cast("array<string>"))
                     .when(kind.startswith("ARRAY<OBJECT<"), F.transform(names, lambda n: F.concat(F.lit(f"{root}[]."), n)))
                     .when(kind.startswith("ARRAY<"), F.array(F.lit(f"{root}[]")))
                     .otherwise(F.array(F.lit(root))))
    return F.array_sort(F.flatten(F.array(*found)))


def record_paths(kind: T.StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> list[str]:
    """``field_paths`` of the records of a schema."""
    roots = {p.split("[].")[0] for x in layouts for p in x.paths}
    inner = {p.split("[].")[1] for x in layouts for p in x.paths if "[]." in p}
    found = []
    for f in kind.fields:
        if f.name not in roots:
            continue
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            found += [f"{f.name}[].{n}" for n in f.dataType.elementType.names if n in inner]
        else:
            found.append(f"{f.name}[]" if isinstance(f.dataType, T.ArrayType) else f.name)
    return sorted(found)


def _long_paths(record: Column, layouts: tuple[Layout, ...]) -> Column:
    """``field_paths`` of a record that is too long for a variant, read as a
    map of JSON texts."""
    roots = sorted({p.split("[].")[0] for x in layouts for p in x.paths})
    inner = sorted({p.split("[].")[1] for x in layouts for p in x.paths if "[]." in p})
    found = []
    for root in roots:
        text = record[root]
        rows = F.from_json(text, "array<map<string,string>>", LONG_TEXTS)
        names = F.array_distinct(F.flatten(F.transform(rows, lambda m: F.map_keys(m))))
        names = F.filter(names, lambda n: n.isin(inner))
        objects = (F.size(rows) > 0) & F.forall(rows, lambda m: m.isNotNull())
        found.append(F.when(~F.array_contains(F.map_keys(record), root), F.array().cast("array<string>"))
                     .when(objects, F.transform(names, lambda n: F.concat(F.lit(f"{root}[]."), n)))
                     .when(F.ltrim(text).startswith("["), F.array(F.lit(f"{root}[]")))
                     .otherwise(F.array(F.lit(root))))
    return F.array_sort(F.flatten(F.array(*found)))


def fingerprint(paths: Column) -> Column:
    return F.sha2(F.array_join(paths, "\n"), 256)


def _turns_of(get: Callable[[str, str], Column], layout: Layout) -> Column:
    """``get`` reads a field of the record as a type."""
    def named(role: Column) -> Column:
        if not layout.roles:
            return role
        table = F.create_map(*[F.lit(x) for pair in layout.roles.items() for x in pair])
        return F.coalesce(F.try_element_at(table, F.lower(role)), role)

    if layout.each:
        root, role, text = layout.each
        rows = get(root, f"array<struct<`{role}`:string,`{text}`:string>>")
        return F.transform(rows, lambda m: F.struct(
            F.coalesce(named(m[role].cast("string")), F.lit("")).alias("role"),
            F.coalesce(m[text].cast("string"), F.lit("")).alias("text")))
    turns = []
    for role, names in layout.fixed:
        parts = F.array(*[get(n, "string") for n in names])
        body = F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), "\n\n")
        turns.append(F.struct(F.lit(role).alias("role"), body.alias("text")))
    return F.array(*turns)


def canonical_turns(records: DataFrame, raw_col: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """JSON records in ``raw_col`` -> the input's columns plus ``fingerprint``
    (hash of the record's nested field paths), ``layout`` (the mapping it
    selects) and ``turns`` (array of role, text).

    A record that is null, no JSON, or of a fingerprint without mapping has a
    null ``layout`` and no turns; it stays as a row, so nothing is lost
    unseen.  Null roles and texts are empty; an empty message list is the
    layout of its array and has no turns.  Input columns of the three names
    are replaced.  Records too long for a variant (a text of over 20 million
    characters, or over 128 MiB) are read as maps of JSON texts."""
    own = ("fingerprint", "layout", "turns")
    base = records.select(*[F.col(f"`{c}`") for c in records.columns if c.lower() not in own])
    raw, record, large = F.col(raw_col), F.col("__record"), F.col("__large")
    read = base.withColumn("__record", F.try_parse_json(raw))
    read = read.withColumn("__large", F.when(record.isNull() & (F.octet_length(raw) >= VARIANT_MOST),
                                             F.from_json(raw, "map<string,string>", LONG_TEXTS)))
    with_paths = read.withColumn("fingerprint", fingerprint(
        F.when(large.isNotNull(), _long_paths(large, layouts)).otherwise(field_paths(record, layouts))))

    def of_variant(name: str, kind: str) -> Column:
        return F.try_variant_get(record, f"$.{name}", kind)

    def of_map(name: str, kind: str) -> Column:
        return large[name] if kind == "string" else F.from_json(large[name], kind, LONG_TEXTS)

    layout, turns = F.lit(None).cast("string"), F.array().cast(TURN_TYPE)
    for x in layouts:
        hit = F.col("fingerprint") == x.fingerprint
        if x.each:  # an empty list has no fields to tell by
            hit = hit | (F.col("fingerprint") == hashlib.sha256(f"{x.each[0]}[]".encode()).hexdigest())
        layout = F.when(hit & layout.isNull(), F.lit(x.name)).otherwise(layout)
        found = F.when(large.isNotNull(), _turns_of(of_map, x)).otherwise(_turns_of(of_variant, x))
        turns = F.when(hit, F.coalesce(found, F.array().cast(TURN_TYPE))).otherwise(turns)
    return with_paths.withColumns({"layout": layout, "turns": turns}).drop("__record", "__large")


def typed_turns(records: DataFrame, record_col: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``canonical_turns`` of records that are structs: the fingerprint of
    their schema selects one mapping for all, and no JSON is written or read,
    so no text is too long for it."""
    own = ("fingerprint", "layout", "turns")
    base = records.select(*[F.col(f"`{c}`") for c in records.columns if c.lower() not in own])
    mark = hashlib.sha256("\n".join(record_paths(records.schema[record_col].dataType, layouts)).encode()).hexdigest()
    layout = next((x for x in layouts if x.fingerprint == mark), None)
    none = F.array().cast(TURN_TYPE)
    record = F.col(f"`{record_col}`")
    turns = F.coalesce(_turns_of(lambda n, kind: record[n].cast(kind) if kind == "string" else record[n], layout), none) if layout else none
    return base.withColumns({"fingerprint": F.lit(mark), "layout": F.lit(layout.name if layout else None).cast("string"), "turns": turns})


def format_chat(df: DataFrame, turns_col: str = "turns") -> DataFrame:
    """Adds ``formatted`` (every turn between markers, control strings inside
    roles and texts escaped) and ``mask``: runs of (chars, loss) in code
    points that cover ``formatted`` in order; loss is on for the texts of
    assistant turns alone.  No turns give an empty text."""
    safe = F.transform(F.col(turns_col), lambda t: F.struct(
        escape(t["role"]).alias("role"), escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")))
    pieces = F.transform(safe, lambda t: F.concat(F.lit(TURN), t["role"], F.lit(TEXT), t["text"], F.lit(END)))

    def run(chars: Column, loss: Column) -> Column:
        return F.struct(chars.cast("long").alias("chars"), loss.alias("loss"))

    mask = F.flatten(F.transform(safe, lambda t: F.array(
        run(F.char_length(t["role"]) + len(TURN) + len(TEXT), F.lit(False)),
        run(F.char_length(t["text"]), t["loss"]), run(F.lit(len(END)), F.lit(False)))))
    return df.withColumns({"formatted": F.array_join(pieces, ""), "mask": mask})


def read_chat(formatted: Column) -> Column:
    """The turns back from a formatted text."""
    whole = r"(?s)<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>"
    roles = F.regexp_extract_all(formatted, F.lit(whole), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(whole), F.lit(2))
    return F.zip_with(roles, texts, lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text")))


def conversation_structs(turn_rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows -> one ``messages`` record per
    conversation, rows by turn (null turn last; ties by role, then text;
    repeated rows stay).  A conversation is one training text, so its rows
    meet in one output row."""
    row = F.struct(F.col("turn").isNull().alias("late"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("content"))
    rows = F.array_sort(F.collect_list(row))
    return turn_rows.groupBy("conv_id").agg(F.struct(F.transform(
        rows, lambda r: F.struct(r["role"].alias("role"), r["content"].alias("content"))).alias("messages")).alias("record"))


def conversation_records(turn_rows: DataFrame) -> DataFrame:
    """``conversation_structs`` with the records as JSON."""
    return conversation_structs(turn_rows).select("conv_id", F.to_json("record").alias("record"))
