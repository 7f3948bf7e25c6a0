"""Chat formatting: records of many layouts become canonical turns by the fingerprint of their field paths, and turns become marked-up text with a loss mask."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varicube.llm.common import sliced

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """How a record of some layout maps to turns.

    many: the field that lists the turns, whose elements have `role` and `text` fields; `parts` is the text field of the pieces if a text is a list of them.
    Without `many`, `fixed` lists (role, fields): a turn each, the fields' texts joined by a blank line; a turn whose fields are all null or missing is left
    out if none of them is required. Without either, the record is a turn itself. `roles` renames roles.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    many: str | None = None
    role: str = "role"
    text: str = "text"
    parts: str | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
LAYOUTS = (
    Layout("turn", ("role", "text")),
    Layout("messages", ("messages[].role", "messages[].content"), ("prompt",), many="messages", text="content", roles=SPEAKERS),
    Layout("message parts", ("messages[].role", "messages[].content[].text"), ("messages[].content[].type", "prompt"), many="messages", text="content", parts="text", roles=SPEAKERS),
    Layout("conversations", ("conversations[].from", "conversations[].value"), ("system",), many="conversations", role="from", text="value", roles=SPEAKERS),
    Layout("instruction", ("instruction", "output"), ("input", "system"), fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("prompt and response", ("prompt", "response"), ("system",), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt and completion", ("prompt", "completion"), ("system",), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("question and answer", ("question", "answer"), ("context",), fixed=(("user", ("context", "question")), ("assistant", ("answer",)))),
)


def fingerprint(paths, known: frozenset[str]) -> str:
    """A hash of those field paths that some layout knows; a record's other fields have no bearing on its layout."""
    return hashlib.sha256("\n".join(sorted(set(paths) & known)).encode()).hexdigest()[:16]


def known_paths(layouts=LAYOUTS) -> frozenset[str]:
    return frozenset(p for x in layouts for p in x.required + x.optional)


def by_fingerprint(layouts=LAYOUTS) -> dict[str, str]:
    """Name of the layout for the fingerprint of each set of paths that it takes: the required ones and any of the optional ones. The first layout wins."""
    known, out = known_paths(layouts), {}
    for x in layouts:
        for n in range(len(x.optional) + 1):
            for some in combinations(x.optional, n):
                out.setdefault(fingerprint(x.required + some, known), x.name)
    return out


def paths_of_type(kind: T.DataType, at: str = "") -> list[str]:
    """Field paths of a column type: a.b for fields, [] for elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in paths_of_type(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return paths_of_type(kind.elementType, at + "[]")
    return [at]


TOKEN = re.compile(r"OBJECT<|ARRAY<|>|`(?:[^`]|``)*`|, |: |[^<>,:`( ][^<>,:`(]*(?:\([^)]*\))?")


def paths_of_schema(text: str | None) -> list[str]:
    """Field paths in the words of Spark's schema_of_variant, e.g. OBJECT<messages: ARRAY<OBJECT<role: STRING>>>."""
    tokens, out = TOKEN.findall(text or ""), []

    def kind(i: int, at: str) -> int:
        if i < len(tokens) and tokens[i] == "OBJECT<":
            i += 1
            while tokens[i] != ">":
                name = tokens[i][1:-1].replace("``", "`") if tokens[i].startswith("`") else tokens[i]
                i = kind(i + 2, f"{at}.{name}" if at else name)
                i += tokens[i] == ", "
            return i + 1
        if i < len(tokens) and tokens[i] == "ARRAY<":
            return kind(i + 1, at + "[]") + 1
        out.append(at)
        return i + 1

    if tokens:
        kind(0, "")
    return out


def turns_by(layout: Layout, field) -> Column:
    """The turns of a record as array<struct<role,text>>; field(path, type) gives the column of a top-level field."""
    names = F.create_map(*[F.lit(x) for pair in layout.roles for x in pair]) if layout.roles else None

    def turn(role: Column, text: Column) -> Column:
        role = F.coalesce(role, F.lit(""))
        return F.struct((F.coalesce(F.try_element_at(names, role), role) if names is not None else role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    if layout.many:
        content = f"array<struct<{layout.parts}:string>>" if layout.parts else "string"
        whole = field(layout.many, f"array<struct<`{layout.role}`:string,`{layout.text}`:{content}>>")
        text = lambda m: F.array_join(F.transform(m[layout.text], lambda p: p[layout.parts]), "") if layout.parts else m[layout.text]
        return F.coalesce(F.transform(whole, lambda m: turn(m[layout.role], text(m))), F.array().cast(TURNS))
    if layout.fixed:
        each = []
        for role, fields in layout.fixed:
            texts = [field(f, "string") for f in fields]
            one = turn(F.lit(role), F.concat_ws("\n\n", *texts))
            each.append(one if set(fields) & set(layout.required) else F.when(F.coalesce(*texts).isNotNull(), one))
        return F.array_compact(F.array(*each)).cast(TURNS)
    return F.array(turn(field(layout.role, "string"), field(layout.text, "string"))).cast(TURNS)


def canonical(records: DataFrame, ids: list[str], json: str | None = None, layouts=LAYOUTS) -> DataFrame:
    """`ids` of each record with its fingerprint, layout and turns (array of role and text).

    With `json`, that column holds a JSON object a row: the field paths that Spark's schema_of_variant finds in it are hashed row by row, and the hash
    selects the row's mapping. Without, the records' own columns (but `ids`) are the fields; their paths are the same for all rows. A record of no known
    layout, one that is not a JSON object and a null one have a null layout and no turns; none is dropped. Null roles and texts are empty. A text that is a
    number or, among texts, a list is taken as its JSON text. Columns that no layout knows are ignored.
    """
    chosen, known = by_fingerprint(layouts), known_paths(layouts)
    if json is None:
        typed = records.schema
        paths = [p for f in typed.fields if f.name not in ids for p in paths_of_type(f.dataType, f.name)]
        mark = fingerprint(paths, known)
        layout = next((x for x in layouts if x.name == chosen.get(mark)), None)
        turns = turns_by(layout, lambda name, kind: F.col(f"`{name}`").cast(kind) if not layout.many else F.col(f"`{name}`")) if layout else F.array().cast(TURNS)
        return records.select(*ids, F.lit(mark).alias("fingerprint"), F.lit(layout.name if layout else None).cast("string").alias("layout"), turns.alias("turns"))

    def marks(schemas: pd.Series) -> pd.Series:
        seen = {s: fingerprint(paths_of_schema(s), known) for s in schemas.dropna().unique()}  # a few for many rows
        return schemas.map(lambda s: seen.get(s))

    hashed = F.pandas_udf(marks, "string")
    record = F.try_parse_json(F.col(json))
    read = records.select(*ids, record.alias("record_")).withColumn("fingerprint", hashed(F.schema_of_variant("record_")))
    names = F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair])
    read = read.withColumn("layout", F.try_element_at(names, F.col("fingerprint")))
    turns = F.array().cast(TURNS)
    for x in layouts:
        own = turns_by(x, lambda name, kind: F.try_variant_get("record_", f"$.{name}", kind))
        turns = F.when(F.col("layout") == x.name, own).otherwise(turns)
    return read.select(*ids, "fingerprint", "layout", turns.alias("turns"))


@dataclass(frozen=True)
class Template:
    """Marks around a turn's role and text. `control` are strings that may not stand in a role or text as they are, the marks among them."""

    begin: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    # Control strings of common chat templates.
    control: tuple[str, ...] = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    learned: tuple[str, ...] = ("assistant",)

    def odd(self) -> re.Pattern:
        return re.compile("|".join(re.escape(x) for x in ("\\", *self.control)))

    def turns(self) -> re.Pattern:
        return re.compile(f"{re.escape(self.begin)}(.*?){re.escape(self.middle)}(.*?){re.escape(self.end)}", re.DOTALL)


def escaped(text: str, odd: re.Pattern) -> str:
    """Backslashes are doubled and a control string has one behind its first character, so that no control string is left and the text can be had back."""
    return odd.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


FORMATTED = "conv_id long, part int, formatted string, loss array<struct<start:long,end:long>>"


def format_turns(turns: DataFrame, template: Template = Template(), most: int = 1 << 20) -> DataFrame:
    """(conv_id, part, formatted, loss): each conversation's text with its marks, and the spans of it that are learned (code points within the part).

    turns: conv_id, turn, place (within a record of several turns), role, text. They stand in order of turn and place, nulls first, then role and text; null
    roles and texts are empty, repeated rows are turns of their own, and those of a null conv_id are one conversation. A conversation comes in
    parts of whole turns, a new one once `most` characters are passed, so a task holds one part, whatever a conversation's length; most have one. A part
    can be read without the others. One shuffle by conversation brings the texts together; rows come out in order of conv_id and part.
    """

    def run(batches):
        odd = template.odd()
        now, part, out, size, loss = None, 0, [], 0, []

        def row():
            return (now, part, "".join(out), loss)

        rows, held = [], 0
        for pdf in sliced(batches):
            for conv, role, text in zip(pdf["conv_id"].astype("Int64"), pdf["role"], pdf["text"]):
                conv = None if conv is pd.NA else int(conv)
                if out and (conv != now or size >= most):
                    rows.append(row())
                    held += size
                    part, out, size, loss = (0 if conv != now else part + 1), [], 0, []
                now = conv
                head = f"{template.begin}{escaped(role, odd)}{template.middle}"
                body = escaped(text, odd)
                if role in template.learned:
                    loss.append({"start": size + len(head), "end": size + len(head) + len(body)})
                out += [head, body, template.end]
                size += len(head) + len(body) + len(template.end)
                if held >= most:
                    yield frame(rows)
                    rows, held = [], 0
        if out:
            rows.append(row())
        if rows:
            yield frame(rows)

    def frame(rows) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["conv_id", "part", "formatted", "loss"])
        return out.assign(conv_id=out["conv_id"].astype("Int64"))

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    source = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "place", text("role"), text("text"))
    ordered = source.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "place", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInPandas(run, FORMATTED)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame, template: Template = Template(), in_order: bool = False) -> DataFrame:
    """One row a conversation from format_turns()' rows alone: its turns and learned texts as they were before the escapes, as numbers and digests.

    turns_sha256 is over role, line feed, text, line feed of each turn, loss_sha256 over the learned texts. Digests take a part at a time, so a
    conversation of any length needs one part's memory. in_order: the rows still stand as format_turns() gives them and need no other shuffle.
    """

    def run(batches):
        whole, now, state = template.turns(), None, None

        def told():
            return (now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for pdf in sliced(batches):
            rows = []
            for conv, text, loss in zip(pdf["conv_id"].astype("Int64"), pdf["formatted"], pdf["loss"]):
                conv = None if conv is pd.NA else int(conv)
                if state is not None and conv != now:
                    rows.append(told())
                if state is None or conv != now:
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for m in whole.finditer(text):
                    state[0] += 1
                    state[1].update(f"{unescaped(m[1])}\n{unescaped(m[2])}\n".encode("utf-8"))
                for span in loss:
                    learned = unescaped(text[span["start"] : span["end"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode("utf-8"))
                state[4] += len(text)
            if rows:
                yield frame(rows)
        if state is not None:
            yield frame([told()])

    def frame(rows) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")])
        return out.assign(conv_id=out["conv_id"].astype("Int64"))

    rows = formatted if in_order else formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return rows.mapInPandas(run, READ)


def turns_of(canonical_records: DataFrame, turn: str | None = None) -> DataFrame:
    """Rows of turns for format_turns() from canonical()'s records, one or more a conversation, in the order of the column `turn` if they have one."""
    order = F.col(turn).cast("long") if turn else F.lit(None).cast("long")
    return canonical_records.select("conv_id", order.alias("turn"), F.posexplode("turns").alias("place", "t")).select("conv_id", "turn", "place", "t.role", "t.text")
