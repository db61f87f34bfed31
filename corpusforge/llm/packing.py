"""Packing documents into training sequences whose windows all hold the sources in target proportions.

Each source is a queue of tokens: its documents in storage order, each closed by an end token. A window is a run of
``window_sequences`` sequences. By deficit round-robin every window owes each queue its proportion of the window; what
a whole number of tokens can't serve is carried as the queue's deficit into the next window, so after ``w`` windows
queue ``s`` has been served ``floor(w * quota[s])`` tokens. That sum is known for every window without running through
the windows before it, so tasks place their documents independently, and deficits carry across tasks like across
windows. With the proportions of the corpus as targets, all queues run dry together.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm import wordarrays as wa
from corpusforge.llm.storage import stored

LENGTH = 1024
WINDOW_SEQUENCES = 64
MAX_QUEUES = 65_536
CACHED_CHUNKS = 500_000
END = 0

Batches = Iterator[pa.RecordBatch]

# lead bytes of characters behind which a white space byte surely begins a new piece; other leads include blanks
_CLEAR = np.zeros(256, bool)
_CLEAR[0x21:0x7F] = True
_TWO, _THREE = np.zeros(256, bool), np.zeros(256, bool)
_TWO[0xC3:0xE0] = True
_THREE[0xE4:0xF0] = True


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer surely splits: before white space that follows a visible character."""
    white = wa.WHITE[data]
    behind = np.zeros(len(data), bool)
    behind[1:] = _CLEAR[data[:-1]]
    behind[2:] |= _TWO[data[:-2]] & (data[1:-1] >= 0x80)
    behind[3:] |= _THREE[data[:-3]] & (data[2:-1] >= 0x80) & (data[1:-2] >= 0x80)
    start = white & behind
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(start)


class Encoder:
    """Token ids of many texts. Each distinct chunk goes through the tokenizer; up to ``CACHED_CHUNKS`` are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keys, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.uint32)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes, ids = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        for low in range(0, len(texts), 8192):
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts[low : low + 8192], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(sizes), np.concatenate(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, first id of each text and one more), without end tokens."""
        starts = chunk_starts(data, offsets)
        ends = np.r_[starts[1:], len(data)].astype(np.int64)
        keys, where, inverse = np.unique(wa.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        raw = data.tobytes()
        fresh = ~known
        new_sizes, new_ids = self._encoded([raw[starts[k] : ends[k]].decode("utf-8") for k in where[fresh]])
        ids = np.concatenate([self.ids, new_ids])
        sizes, at = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        sizes[known], at[known] = self.sizes[place[known]], self.at[place[known]]
        new_at = len(self.ids) + np.cumsum(new_sizes) - new_sizes
        sizes[fresh], at[fresh] = new_sizes, new_at
        if len(self.keys) + len(new_at) <= CACHED_CHUNKS:
            spot = place[fresh]
            self.keys, self.ids = np.insert(self.keys, spot, keys[fresh]), ids
            self.at, self.sizes = np.insert(self.at, spot, new_at), np.insert(self.sizes, spot, new_sizes)
        at, sizes = at[inverse], sizes[inverse]
        sums = np.r_[0, np.cumsum(sizes)]
        flat = ids[np.repeat(at - sums[:-1], sizes) + np.arange(sums[-1])]
        return flat, sums[np.searchsorted(starts, offsets)]


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process, so that tasks share what was learnt."""
    return Encoder(path)


def tokenize(path: str) -> Callable[[Batches], Batches]:
    """(part, doc_id, source, at, n, ids): ``at`` counts the tokens of the source before it in this task."""

    def run(batches: Batches) -> Batches:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            for low, high, data, offsets in wa.slices(batch.column(2)):
                flat, first = encoder(path).encode(data, offsets)
                rows, sources = [], batch.column(1).slice(low, high - low)
                sizes, at = np.diff(first) + 1, []
                for k, source in enumerate(sources.to_pylist()):
                    own = np.append(flat[first[k] : first[k + 1]], np.uint32(END))
                    rows.append(own.astype("<u2" if own.max() < 65536 else "<u4").tobytes())
                    at.append(seen.get(source, 0))
                    seen[source] = at[-1] + int(sizes[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(high - low, part, np.int32)), batch.column(0).slice(low, high - low), sources,
                     pa.array(at, pa.int64()), pa.array(sizes.astype(np.int64)), pa.array(rows, pa.binary())],
                    ["part", "doc_id", "source", "at", "n", "ids"],
                )

    return run


class Schedule:
    """How many tokens of each queue lie before each window."""

    def __init__(self, totals: np.ndarray, window: int):
        self.totals = totals.astype(np.int64)
        self.windows = max(1, -(-int(self.totals.sum()) // window))
        self.quota = self.totals * (window / max(1, int(self.totals.sum())))

    def served(self, w: np.ndarray, s: np.ndarray | slice) -> np.ndarray:
        out = np.minimum(np.floor(w * self.quota[s]).astype(np.int64), self.totals[s])
        return np.where(np.asarray(w) >= self.windows, self.totals[s], out)

    def window_of(self, position: np.ndarray, s: np.ndarray) -> np.ndarray:
        w = np.minimum((position / np.maximum(self.quota[s], 1e-12)).astype(np.int64), self.windows - 1)
        for _ in range(2):  # rounding is off by one at most
            w -= self.served(w, s) > position
            w += self.served(w + 1, s) <= position
        return w

    def place(self, w: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Position in the whole stream of the first token that window ``w`` takes from queue ``s``."""
        kinds, inverse = np.unique(w, return_inverse=True)
        out = np.empty(len(w), np.int64)
        every = slice(None)
        step = max(1, (1 << 20) // max(1, len(self.totals)))
        for at in range(0, len(kinds), step):
            some = kinds[at : at + step, None]
            low = self.served(some, every)
            share = self.served(some + 1, every) - low
            before = low.sum(axis=1, keepdims=True) + np.cumsum(share, axis=1) - share
            mine = (inverse >= at) & (inverse < at + step)
            out[mine] = before[inverse[mine] - at, s[mine]]
        return out


def cut_pieces(schedule: Schedule, length: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids, rows = batch.column(0), batch.column(4)
            queue, begin, n = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2, 3))
            if len(n) == 0:
                continue
            # by windows
            low, high = schedule.window_of(begin, queue), schedule.window_of(begin + n - 1, queue)
            count = high - low + 1
            doc = np.repeat(np.arange(len(n)), count)
            w = low[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            opened, closed = schedule.served(w, queue[doc]), schedule.served(w + 1, queue[doc])
            first = np.maximum(begin[doc], opened)
            last = np.minimum(begin[doc] + n[doc], closed)
            some = last > first
            doc, w, first, last, opened = (x[some] for x in (doc, w, first, last, opened))
            spot = schedule.place(w, queue[doc]) + first - opened
            # by sequences
            size = last - first
            count = (spot + size - 1) // length - spot // length + 1
            piece = np.repeat(np.arange(len(doc)), count)
            nth = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
            sequence = spot[piece] // length + nth
            left = np.maximum(spot[piece], sequence * length)
            right = np.minimum(spot[piece] + size[piece], (sequence + 1) * length)
            doc_of = doc[piece]
            start = first[piece] - begin[doc_of] + left - spot[piece]
            held, crcs = -1, []
            for d, a, b in zip(doc_of.tolist(), start.tolist(), (start + right - left).tolist(), strict=True):
                if d != held:
                    raw, held = rows[d].as_py(), d
                    wide = np.frombuffer(raw, "<u2" if len(raw) == 2 * n[d] else "<u4").astype("<u4")
                crcs.append(zlib.crc32(wide[a:b]))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(doc_of)), pa.array(start), pa.array(right - left), pa.array(crcs, pa.int64()),
                 pa.array(n[doc_of]), pa.array(sequence), pa.array(left - sequence * length)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, window_sequences: int = WINDOW_SEQUENCES,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file. Every document is its ids and the end token 0; null and empty texts
    are the end token alone. Every id lies in one piece, and all sequences but the last are full, so the last alone
    is padded to ``length``, unless it holds a power of two. Null is a source of its own, as is each value. Rows that
    repeat an id, or have none, are documents of their own. No rows give no pieces. More than ``MAX_QUEUES`` sources
    must be grouped by the caller, as their totals go to the driver and to all tasks.
    """
    id_type, source_type = (docs.schema[c].dataType.simpleString() for c in (id_column, source_column))
    named = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), F.col(text_column).alias("text")
    )
    tokens = stored(
        named.mapInArrow(
            wa.tidy(tokenize(tokenizer)), f"part int, doc_id {id_type}, source {source_type}, at long, n long, ids binary"
        ),
        "tokens",
    )
    parts = tokens.groupBy("part", "source").agg(F.sum("n").alias("n"))
    by_source = parts.groupBy("source").agg(F.sum("n").alias("n"))
    totals = by_source.orderBy(F.col("source").asc_nulls_last()).take(MAX_QUEUES + 1)
    if len(totals) > MAX_QUEUES:
        raise ValueError(f"more than {MAX_QUEUES} sources: group them into fewer queues")
    spark = docs.sparkSession
    schedule = Schedule(np.array([n for _, n in totals], np.int64), length * window_sequences)
    queues = spark.createDataFrame(
        [(s, k) for k, (s, _) in enumerate(totals)], f"source {source_type}, queue int"
    )
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    bases = stored(
        bases.alias("p").join(queues.alias("q"), F.col("p.source").eqNullSafe(F.col("q.source")))
        .select("p.part", "p.source", "p.base", "q.queue").coalesce(8), "bases"
    )
    same = (F.col("t.part") == F.col("b.part")) & F.col("t.source").eqNullSafe(F.col("b.source"))
    placed = tokens.alias("t").join(bases.alias("b"), same).select(
        "t.doc_id", "b.queue", (F.col("b.base") + F.col("t.at")).alias("begin"), "t.n", "t.ids"
    )
    return placed.mapInArrow(
        wa.tidy(cut_pieces(schedule, length)),
        f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
