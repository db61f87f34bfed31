"""Document fingerprints from Lempel-Ziv phrases: texts that compress well together share phrases.

A text is parsed from left to right into phrases, each the shortest run of characters that is not yet in the text's own
dictionary. The set of phrases is hashed and described by minimum hashes; the share of equal minimum hashes of two texts
estimates the likeness of their phrase sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm import wordarrays as wa
from corpusforge.llm.neardup import min_hashes
from corpusforge.llm.storage import stored

HASHES = 128
EMPTY = "-" * (4 * HASHES)
RESULT = (
    "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)

Batches = Iterator[pa.RecordBatch]


class Parse:
    """A parse that may be forked: dictionary, ends of the phrases so far, and the start of the open phrase."""

    def __init__(self, known: set[str] | None = None, ends: list[int] | None = None, start: int = 0, upto: int = 0):
        self.known, self.ends, self.start, self.upto = known or set(), ends or [], start, upto

    def fork(self) -> Parse:
        return Parse(set(self.known), list(self.ends), self.start, self.upto)

    def run(self, text: str, upto: int) -> Parse:
        known, ends, start = self.known, self.ends, self.start
        add, note = known.add, ends.append
        for end in range(self.upto + 1, upto + 1):
            phrase = text[start:end]
            if phrase not in known:
                add(phrase)
                note(end)
                start = end
        self.start, self.upto = start, upto
        return self

    def fingerprint(self, text: str) -> str:
        """Minimum hashes as hexadecimal digits; a text without phrases has digits that no other has."""
        return self.minima(text).hex() or EMPTY

    def minima(self, text: str) -> bytes:
        """Minimum hashes, two bytes each; none for a text without phrases."""
        if not self.ends:
            return b""
        ends = np.array(self.ends, np.int64)
        starts = np.r_[0, ends[:-1]]
        codes = np.frombuffer(text[: int(ends[-1])].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        up, down = wa.powers(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(wa.mix(codes + np.uint64(1)) * up[: len(codes)], out=sums[1:])
        hashes = wa.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        return min_hashes(hashes, HASHES, 31).astype(">u2").tobytes()


def likeness(a: str, b: str) -> float:
    """Share of equal minimum hashes; nothing is like a text without phrases but another one."""
    return alike(*(b"" if x == EMPTY else bytes.fromhex(x) for x in (a, b)))


def alike(a: bytes, b: bytes) -> float:
    if not a or not b:
        return float(a == b)
    left, right = (np.frombuffer(x, np.uint16) for x in (a, b))
    return float((left == right).mean())


@dataclass
class Document:
    doc_id: object
    text: str

    def __post_init__(self) -> None:
        self.cut = len(self.text) - len(self.text) // 4
        self.head = Parse().run(self.text, self.cut)
        self.own = self.head.fork().run(self.text, len(self.text)).minima(self.text)

    def against(self, follower: Document) -> tuple:
        edited = self.text[: self.cut] + follower.text[: len(self.text) - self.cut]
        other = self.head.run(edited, len(edited)).minima(edited)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return (
            self.doc_id, len(self.text), digest, self.own, other, alike(self.own, other),
            alike(self.own, follower.own),
        )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


_RESULT_TYPES = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_EDGE_TYPES = [
    ("part", pa.int32()), ("first_id", None), ("first_text", pa.string()), ("last_text", pa.string()),
]


def within_parts(batches: Batches) -> Batches:
    """Fingerprints of sorted documents; the last of a task waits for the first of the next one in an edge row."""
    before = first = schema = None
    part = TaskContext.get().partitionId()
    for batch in batches:
        if schema is None:
            key = batch.schema.field(0).type
            schema = pa.schema([("doc_id", key), *_RESULT_TYPES, *[(n, t or key) for n, t in _EDGE_TYPES]])
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            now = Document(doc_id, text or "")
            if before is None:
                first = (doc_id, now.text)
            else:
                rows.append((*before.against(now), None, None, None, None))
            before = now
            if len(rows) == 500:
                yield _batch(rows, schema)
                rows = []
        yield _batch(rows, schema)
    if before is not None:
        yield _batch([(before.doc_id, *[None] * 6, part, *first, before.text)], schema)


def across(batches: Batches) -> Batches:
    for batch in batches:
        ids, texts, followers = (batch.column(k).to_pylist() for k in range(3))
        rows = [Document(i, t).against(Document(None, f)) for i, t, f in zip(ids, texts, followers, strict=True)]
        yield _batch(rows, pa.schema([("doc_id", batch.schema.field(0).type), *_RESULT_TYPES]))


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter replaced by the beginning of the next document by id, the last document's by
    that of the first. Fingerprints are hexadecimal digits, those of texts without phrases are dashes. Null texts count as empty. Rows of one id follow each other in the order of their texts, rows without id
    come first. A single row follows itself. No rows give no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_column].dataType.simpleString()
    named = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = named.repartitionByRange(parts, "doc_id", F.length("text"), F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.length("text"), F.xxhash64("text")
    )
    done = stored(
        ordered.mapInArrow(
            within_parts,
            f"doc_id {id_type}, {RESULT}, part int, first_id {id_type}, first_text string, last_text string",
        ),
        "fingerprints",
    )
    edges = done.filter("part is not null")
    order = Window.orderBy("part")
    ring = edges.select("part", F.lead("part").over(order).alias("next")).withColumn(
        "next", F.coalesce("next", F.min("part").over(Window.partitionBy()))
    )
    followers = edges.select(F.col("part").alias("next"), F.col("first_text").alias("follower"))
    last = edges.join(ring, "part").join(followers, "next").select("doc_id", "last_text", "follower")
    columns = ["doc_id", *[n for n, _ in _RESULT_TYPES]]
    rows = done.filter("part is null").select(columns).union(last.mapInArrow(across, f"doc_id {id_type}, {RESULT}"))
    for name in ("fingerprint", "edited_fingerprint"):
        digits = F.when(F.length(name) == 0, F.lit(EMPTY)).otherwise(F.lower(F.hex(name)))
        rows = rows.withColumn(name, digits)
    return rows
