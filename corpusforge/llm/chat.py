"""Chat records of any layout as canonical turns, formatted by a template that can be read back.

The field paths of a record (``messages[].role``) name its schema; their hash is the fingerprint. Each fingerprint picks the
``Layout`` whose needed paths it has, and a layout only declares where texts, roles and numbers stand. The choice depends on paths
alone, so each task makes it once per fingerprint. Records that no layout fits are not dropped: ``unmapped`` returns them.

A template writes one piece of text per turn, marks turns with control strings and escapes these inside texts: a backslash
goes behind the first character of each, and backslashes are doubled. Pieces are independent rows, so a conversation of
any length is formatted, read back and masked without ever standing in one value; only its digest follows its turns in order,
streamed by one task, because SHA-256 can be had in no other way.

Odd input: null texts and roles are empty, a null conversation id is a conversation of its own, turns of one number go by
part, role and text, so repeated rows all stay. An empty table gives an empty result. Records that are no JSON object are unmapped.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.llm.wordarrays import tidy

# --- layouts ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Take:
    """One turn, or one per element of the array ``each``: where its text is, and its role."""

    text: str | tuple[str, ...]  # paths, joined by an empty line where there are several; "" is the element itself
    role: str | tuple[str, ...]  # a path that starts with ".", a fixed role, or fixed roles that take turns
    each: str | None = None
    names: tuple[tuple[str, str], ...] = ()  # roles by other names
    optional: bool = False  # no turn where the text is empty


@dataclass(frozen=True)
class Layout:
    name: str
    needs: tuple[str, ...]
    turns: tuple[Take, ...]


SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"), ("chatbot", "assistant"))

#: The first layout with the most needed paths wins.
LAYOUTS = (
    Layout("turn_row", ("role", "text", "turn"), (Take("text", ".role"),)),
    Layout("messages", ("messages[].role", "messages[].content"), (Take("content", ".role", "messages", SPEAKERS),)),
    Layout("speakers", ("conversations[].from", "conversations[].value"), (Take("value", ".from", "conversations", SPEAKERS),)),
    Layout(
        "instruction", ("instruction", "output"),
        (Take("system", "system", optional=True), Take(("instruction", "input"), "user"), Take("output", "assistant")),
    ),
    Layout("prompt_response", ("prompt", "response"), (Take("system", "system", optional=True), Take("prompt", "user"), Take("response", "assistant"))),
    Layout("prompt_completion", ("prompt", "completion"), (Take("prompt", "user"), Take("completion", "assistant"))),
    Layout("question_answer", ("question", "answer"), (Take("context", "system", optional=True), Take("question", "user"), Take("answer", "assistant"))),
    Layout("preference_messages", ("chosen[].role", "chosen[].content", "rejected[].content"), (Take("content", ".role", "chosen", SPEAKERS),)),
    Layout("preference", ("prompt", "chosen", "rejected"), (Take("prompt", "user"), Take("chosen", "assistant"))),
    Layout("dialog", ("dialog[]",), (Take("", ("user", "assistant"), "dialog"),)),
)


def paths_of(value, prefix: str = "") -> Iterator[str]:
    """Nested field paths; array elements share ``[]``. Objects and arrays count as well as what they hold."""
    if isinstance(value, dict):
        for name, inner in value.items():
            path = f"{prefix}.{name}" if prefix else name
            yield path
            yield from paths_of(inner, path)
    elif isinstance(value, list):
        if value:
            yield f"{prefix}[]"
        for inner in value:
            yield from paths_of(inner, f"{prefix}[]")


def fingerprint(paths: frozenset[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(errors="surrogatepass"), digest_size=8).hexdigest()


def layout_for(paths: frozenset[str], layouts: tuple[Layout, ...] = LAYOUTS) -> Layout | None:
    fitting = [layout for layout in layouts if paths.issuperset(layout.needs)]
    return max(fitting, key=lambda layout: len(layout.needs), default=None)


def _text(value) -> str:
    """Text of a field: strings as they are, parts of a message joined, other values as JSON."""
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, list):
        return "".join(_text(v.get("text")) if isinstance(v, dict) else _text(v) for v in value)
    return json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, layout: Layout) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn."""
    for take in layout.turns:
        elements = record.get(take.each) if take.each else [record]
        for i, element in enumerate(elements or []):
            fields = element if isinstance(element, dict) else {"": element}
            paths = (take.text,) if isinstance(take.text, str) else take.text
            found = [_text(fields.get(path)) for path in paths]
            text = found[0] if len(found) == 1 else "\n\n".join(f for f in found if f)
            if isinstance(take.role, tuple):
                role = take.role[i % len(take.role)]
            else:
                role = _text(fields.get(take.role[1:])) if take.role.startswith(".") else take.role
            if text or not take.optional:
                yield dict(take.names).get(role, role), text


class _Reader:
    """Records of one task; the layout of each schema is looked up once."""

    KNOWN = 10_000  # schemas remembered; beyond, they are looked up again

    def __init__(self, layouts: tuple[Layout, ...]):
        self.layouts, self.known = layouts, {}

    def read(self, text: str | None) -> tuple[dict | None, str | None, Layout | None]:
        try:
            record = json.loads(text or "")
        except ValueError:
            record = None
        if not isinstance(record, dict):
            return None, None, None
        paths = frozenset(paths_of(record))
        mark = fingerprint(paths)
        if mark not in self.known:
            if len(self.known) >= self.KNOWN:
                self.known.clear()
            self.known[mark] = layout_for(paths, self.layouts)
        return record, mark, self.known[mark]


def _carried(records: DataFrame, *names: str) -> list[T.StructField]:
    return [T.StructField(alias, records.schema[name].dataType) for alias, name in zip(("conv_id", "turn"), names, strict=False)]


def canonical_turns(
    records: DataFrame, id: str = "conv_id", position: str = "turn", record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """``(conv_id, turn, part, role, text, layout, fingerprint)``: one row per turn of each JSON ``record`` that a layout fits.

    ``turn`` is the record's own position in its conversation, ``part`` that of the turn in its record.
    """
    schema = T.StructType(
        [*_carried(records, id, position), T.StructField("part", T.LongType())]
        + [T.StructField(name, T.StringType()) for name in ("role", "text", "layout", "fingerprint")]
    )

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(layouts)
        for batch in batches:
            rows, origin = [], []
            for i, text in enumerate(batch.column("record").to_pylist()):
                found, mark, layout = reader.read(text)
                if layout:
                    for part, (role, said) in enumerate(turns_of(found, layout)):
                        rows.append((part, role, said, layout.name, mark))
                        origin.append(i)
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64()] + [pa.string()] * 4
            carried = [batch.column(c).take(pa.array(origin, pa.int64())) for c in ("conv_id", "turn")]
            yield pa.RecordBatch.from_arrays(
                [*carried, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=schema.names
            )

    wanted = records.select(F.col(id).alias("conv_id"), F.col(position).alias("turn"), F.col(record).alias("record"))
    return wanted.mapInArrow(read, schema)


def schema_report(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``(fingerprint, paths, layout, n)``: every schema among the records, with the layout it gets (null: none)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(layouts)
        for batch in batches:
            rows = []
            for text in batch.column("record").to_pylist():
                found, mark, layout = reader.read(text)
                rows.append((mark, sorted(set(paths_of(found))) if found is not None else None, layout.name if layout else None))
            marks, paths, names = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [pa.array(marks, pa.string()), pa.array(paths, pa.list_(pa.string())), pa.array(names, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["fingerprint", "paths", "layout"])

    read_schema = "fingerprint string, paths array<string>, layout string"
    seen = records.select(F.col(record).alias("record")).mapInArrow(read, read_schema)
    return seen.groupBy("fingerprint", "paths", "layout").agg(F.count("*").alias("n"))


def unmapped(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The records, with all their columns, that no layout fits."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(layouts)
        for batch in batches:
            yield batch.filter(pa.array([reader.read(t)[2] is None for t in batch.column(record).to_pylist()], pa.bool_()))

    return records.mapInArrow(read, records.schema)


# --- template -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Template:
    """``begin`` role ``\\n`` text ``end``; ``controls`` are all strings that a text must not hold unescaped."""

    begin: str
    end: str
    controls: tuple[str, ...]

    def __post_init__(self):
        if not {self.begin, self.end.rstrip("\n")} <= set(self.controls):
            raise ValueError("the marks of turns belong to the control strings")
        for a in self.controls:
            if "\\" in a or "\n" in a or "%" in a or len(a) < 2:
                raise ValueError(f"no control string: {a!r}")
            if any(a[-n:] == b[:n] for b in self.controls for n in range(1, min(len(a), len(b)))):
                raise ValueError("a control string begins as another ends: a mark could be read inside a text")


# The marks of a usual chat template, and those of another that texts are known to hold.
CHATML = Template(
    "<|im_start|>", "<|im_end|>\n",
    ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"),
)


def escaped(text: Column, template: Template) -> Column:
    marks = "|".join(re.escape(c) for c in template.controls)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"(?s)(?={marks})(.)", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame, template: Template = CHATML, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``(conv_id, turn, part, piece, mask)``: each turn as text; ``mask`` (start, length in code points) covers what is learnt.

    A conversation's text is its pieces in the order of turn and part. Roles are percent-encoded, which leaves usual ones as they are.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(template.begin), F.url_encode(role), F.lit("\n"))
    made = turns.select("conv_id", "turn", "part", role.isin(*learn).alias("learnt"), head.alias("head"), escaped(text, template).alias("body"))
    span = F.struct(F.char_length("head").alias("start"), F.char_length("body").alias("length"))
    return made.select(
        "conv_id", "turn", "part", F.concat("head", "body", F.lit(template.end)).alias("piece"),
        F.when(F.col("learnt"), F.array(span)).otherwise(F.array().cast("array<struct<start:int,length:int>>")).alias("mask"),
    )


def read_back(pieces: DataFrame, template: Template = CHATML) -> DataFrame:
    """``(conv_id, turn, part, spot, role, text, learnt, n_chars)``: turns read from the formatted pieces alone.

    A piece may hold any number of whole turns: ``spot`` counts them. ``learnt`` is the text under the mask inside the turn, ``n_chars``
    the length of the turn as formatted.
    """
    ends = F.split("piece", re.escape(template.end), -1)
    whole = F.slice(ends, 1, F.size(ends) - 1)
    turns = pieces.select("conv_id", "turn", "part", "mask", whole.alias("whole")).select("*", F.posexplode("whole").alias("spot", "said"))
    before = F.aggregate(F.slice("whole", 1, F.col("spot")), F.lit(0), lambda n, one: n + F.char_length(one) + len(template.end))
    body = F.substring("said", len(template.begin) + 1, F.char_length("said"))
    role = F.substring_index(body, "\n", 1)
    turns = turns.select("conv_id", "turn", "part", "spot", "said", "mask", before.alias("before"), body.alias("body"), role.alias("role"))
    inside = F.filter("mask", lambda m: (m["start"] >= F.col("before")) & (m["start"] <= F.col("before") + F.char_length("said")))
    learnt = F.transform(inside, lambda m: F.substring("said", m["start"] - F.col("before") + 1, m["length"]))
    return turns.select(
        "conv_id", "turn", "part", "spot", F.url_decode("role").alias("role"),
        unescaped(F.substring("body", F.char_length("role") + 2, F.char_length("body"))).alias("text"),
        unescaped(F.array_join(learnt, "")).alias("learnt"),
        (F.char_length("said") + len(template.end)).cast("long").alias("n_chars"),
    )


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation of ``read_back``: number of turns, digests of all turns and of what is learnt, lengths in code points.

    Turns come sorted and are streamed: memory does not depend on the length of a conversation.
    """
    schema = T.StructType([turns.schema["conv_id"], *T.StructType.fromDDL(DIGESTS).fields])
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Conversation | None = None
        for batch in batches:
            done = []
            for id, *turn in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "learnt", "n_chars")), strict=True):
                if open_ is None or open_.id != id:
                    done += [open_] if open_ else []
                    open_ = _Conversation(id)
                open_.add(*turn)
            yield rows(done, batch.schema.field("conv_id").type)
        if open_:
            yield rows([open_], batch.schema.field("conv_id").type)

    def rows(done: list[_Conversation], id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*(c.row() for c in done), strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [id_type, *types], strict=True)], names=schema.names)

    order = ["conv_id", "turn", "part", "spot", "role", "text"]
    return turns.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(read, schema)


class _Conversation:
    def __init__(self, id):
        self.id, self.n, self.loss_chars, self.chars = id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, learnt: str, n_chars: int) -> None:
        self.n += 1
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(learnt.encode())
        self.loss_chars += len(learnt)
        self.chars += n_chars

    def row(self) -> tuple:
        return self.id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
