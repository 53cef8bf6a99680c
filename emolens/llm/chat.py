"""Chat formatting by schema fingerprints.

Records come in several layouts: a prompt with a response, an instruction with
an output, lists of messages with (role, content) or (from, value).  The
nested field paths that a record fills are hashed into its fingerprint, and
the fingerprint selects a declarative `Mapping` that turns the record into
canonical turns (role, text).  A template lays the turns out as one text with
a loss mask over the assistant's texts; `read_back` parses such a text again.

Template: `<|im_start|>`, role, newline, text, `<|im_end|>`, newline for each
turn.  In texts and roles a control string cannot occur: `<`, any backslashes
and `|` get one backslash more, which is undone by taking one away; roles
also write `%` and the newline as %25 and %0A, so that the first newline ends
the role.  The loss mask is the list of code-point spans [start, end) of the
escaped assistant texts.

All of it is column expressions.  The only shuffle gathers the rows of a
conversation (`records`); a record, like any cell, must fit a task.

Cases: a null text or role is empty; rows of a null conversation are records
of their own, so that they meet in no task; turns of one number are ordered by
role, then text, a null turn first; repeated rows are turns of their own; an
empty text is a turn of no characters; a record whose fingerprint no mapping
has keeps its row, with null turns; an empty table gives no rows; columns that
are not named take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns.  Either ``fields``, (role, path) in turn
    order, or ``each``, an array with the fields ``role`` and ``text``, whose
    role names ``roles`` translates.  ``optional`` paths may be absent."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    roles: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = field(default=())

    def paths(self) -> set[str]:
        return {p for _, p in self.fields} if self.fields else {f"{self.each}[].{self.role}", f"{self.each}[].{self.text}"}

    def fingerprints(self) -> list[str]:
        """One for each set of its optional paths that may be absent."""
        return [path_hash(self.paths() - set(gone)) for n in range(len(self.optional) + 1)
                for gone in combinations(self.optional, n)]

    def turns(self, record: Column) -> Column:
        if self.fields:
            made = F.array(*(F.struct(F.lit(r).alias("role"), _at(record, p).alias("text")) for r, p in self.fields))
            return F.filter(made, lambda t: t["text"].isNotNull()) if self.optional else made
        names = F.create_map(*(F.lit(x) for pair in self.roles for x in pair)) if self.roles else None

        def turn(t: Column) -> Column:
            role = t[self.role]
            known = F.coalesce(names[role], role) if self.roles else role
            return F.struct(F.coalesce(known, F.lit("")).alias("role"), F.coalesce(t[self.text], F.lit("")).alias("text"))

        return F.transform(_at(record, self.each), turn)


MAPPINGS = (
    Mapping("prompt", fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction", fields=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
            optional=("system",)),
    Mapping("share", each="conversations", role="from", text="value", roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("messages", each="messages", role="role", text="content"),
)


def path_hash(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _at(record: Column, path: str) -> Column:
    for name in path.split("."):
        record = record.getField(name)
    return record


def field_paths(schema: StructType, record: Column) -> dict[str, Column]:
    """Every nested path to a scalar, arrays as ``name[]``, with the condition
    that the record fills it."""
    out: dict[str, Column] = {}

    def inside(reach, name: str):
        return lambda test: reach(lambda x: test(x.getField(name)))

    def any_of(reach):
        return lambda test: reach(lambda x: F.coalesce(F.exists(x, test), F.lit(False)))

    def walk(kind, path: str, reach):
        if isinstance(kind, StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name, inside(reach, f.name))
        elif isinstance(kind, ArrayType):
            walk(kind.elementType, path + "[]", any_of(reach))
        else:
            out[path] = reach(lambda x: x.isNotNull())

    walk(schema, "", lambda test: test(record))
    return out


def fingerprint(schema: StructType, record: Column) -> Column:
    """SHA-256 of the sorted nested paths that a record fills."""
    paths = field_paths(schema, record)
    filled = F.concat_ws("\n", *(F.when(paths[p], F.lit(p)) for p in sorted(paths)))
    return F.sha2(filled.cast("binary"), 256)


def canonical_turns(rows: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``rows`` with ``layout``, the name of the mapping that the record's
    fingerprint selects, and ``turns``; both null where none does."""
    schema, col = rows.schema[record].dataType, F.col(record)
    mark = F.col("fingerprint")
    here = set(field_paths(schema, col))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:
        if m.paths() <= here:
            hit = mark.isin(m.fingerprints())
            name, turns = F.when(hit, F.lit(m.name)).otherwise(name), F.when(hit, m.turns(col).cast(TURNS)).otherwise(turns)
    return rows.withColumn("fingerprint", fingerprint(schema, col)).withColumns({"layout": name, "turns": turns})


# ---------------------------------------------------------------- template

def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def formatted(rows: DataFrame, turns: str = "turns") -> DataFrame:
    """``rows`` with ``formatted``, the text of the turns, and ``loss_spans``,
    the code-point spans [start, end) of assistant texts in it."""
    safe = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n")).alias("head"),
        escaped(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")))
    tail = F.lit(END + "\n")
    rows = rows.withColumn("parts", safe)
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], tail)), "")
    long = lambda x: F.char_length(x).cast("long")
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + long(p["head"])
        end = start + long(p["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END) + 1).alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("parts", begin, step, lambda acc: acc["spans"])
    return rows.withColumns({"formatted": text, "loss_spans": spans}).drop("parts")


def read_back(rows: DataFrame, text: str = "formatted", spans: str = "loss_spans") -> DataFrame:
    """``rows`` with ``read_turns``, the turns parsed from the formatted text,
    and ``loss_text``, what is under the mask, unescaped and joined."""
    blocks = F.split(text, START.replace("|", r"\|"), -1)
    blocks = F.slice(blocks, F.lit(2), F.size(blocks))

    def turn(block: Column) -> Column:
        head = F.locate("\n", block)
        return F.struct(
            unescaped_role(F.substring(block, F.lit(1), head - 1)).alias("role"),
            unescaped(F.substring(block, head + 1, F.char_length(block) - head - len(END) - 1)).alias("text"))

    under = F.transform(spans, lambda s: unescaped(
        F.substring(F.col(text), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return rows.withColumns({"read_turns": F.transform(blocks, turn), "loss_text": F.array_join(under, "")})


# ------------------------------------------------------------ turn rows

RECORD = ("struct<prompt:string,response:string,system:string,instruction:string,output:string,"
          "conversations:array<struct<from:string,value:string>>,messages:array<struct<role:string,content:string>>>")


def records(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn gathered into one record a conversation, each in the
    layout that its roles fit: a question and its answer as a prompt, the same
    after a system text as an instruction, other talks of user and assistant
    as share records, the rest as messages."""
    row = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                   F.coalesce(text, F.lit("")).alias("text"))
    # rows of a null conversation are no group
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    got = rows.select(F.col(key), alone.alias("alone"), row.alias("row")) \
        .groupBy(key, "alone").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    said = F.transform("rows", lambda r: r["role"])
    is_ = lambda *names: said == F.array(*map(F.lit, names))
    talk = F.forall(said, lambda r: r.isin("user", "assistant"))
    at = lambda i: F.col("rows")[i]["text"]
    layout = F.when(is_("user", "assistant"), "prompt").when(is_("system", "user", "assistant"), "instruction") \
        .when(talk, "share").otherwise("messages")
    got = got.withColumn("as", layout)
    want = lambda name, value: F.when(F.col("as") == name, value)
    share = F.transform("rows", lambda r: F.struct(
        F.when(r["role"] == "user", "human").otherwise("gpt").alias("from"), r["text"].alias("value")))
    messages = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("content")))
    record = F.struct(
        want("prompt", at(0)).alias("prompt"), want("prompt", at(1)).alias("response"),
        want("instruction", at(0)).alias("system"), want("instruction", at(1)).alias("instruction"),
        want("instruction", at(2)).alias("output"), want("share", share).alias("conversations"),
        want("messages", messages).alias("messages")).cast(RECORD)
    return got.select(key, record.alias("record"))


def chat_digests(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per conversation what can be read back from its formatted text."""
    out = read_back(formatted(canonical_turns(records(rows, key)).select(key, "layout", "turns")).drop("turns"))
    lines = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    long = lambda c: F.char_length(c).cast("long")
    return out.select(key, F.size("read_turns").cast("long").alias("n_turns"), sha(lines).alias("turns_sha256"),
                      long(F.col("loss_text")).alias("loss_chars"), sha(F.col("loss_text")).alias("loss_sha256"),
                      long(F.col("formatted")).alias("formatted_chars"), "layout")
