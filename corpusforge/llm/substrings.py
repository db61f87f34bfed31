"""Repeated passages by relative Lempel-Ziv parsing over whole corpora.

The reference is everything that starts earlier: all blocks of all documents in the order of ids. Its index holds every
phrase of ``window`` words once, with the place where it first starts. A document is factored greedily: a factor begins
at the first word whose phrase starts earlier in the reference and is extended word by word as long as the phrase at the
next word does too. A factor is thus at least ``window`` words long; phrases that lie across the boundary of two
factors are looked up like all others, so nothing is lost where the source of the copy changes.

Only phrases that may recur are indexed. Each phrase has an anchor, the smallest hash of the ten-word grams in it, and
equal phrases have equal anchors. Anchors that occur twice or more go into a Bloom filter of bounded size; a phrase
whose anchor is not in it is new. False alarms of the filter cost work only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import wordarrays as wa
from corpusforge.llm.storage import stored

GRAM = 10
FILTER_BITS = 28  # at most 2**28 bits, 32 MB, are sent to tasks

Batches = Iterator[pa.RecordBatch]


def phrases(words: wa.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number where a whole phrase starts, phrase hash, word number of its anchor), anchors leftmost."""
    gram = min(GRAM, window)
    hashes, whole = wa.grams(words, window)
    grams, _ = wa.grams(words, gram)
    span, n = window - gram + 1, len(hashes)
    at = np.arange(n)
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        later = at[np.minimum(np.arange(n) + step, n - 1)]
        at = np.where(grams[later] < grams[at], later, at)
        reach += step
    starts = np.flatnonzero(whole)
    return starts, hashes[starts], at[starts]


def anchors_of(window: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for _, _, data, offsets in wa.slices(batch.column(0)):
                words = wa.words_of(data, offsets)
                _, _, at = phrases(words, window)
                grams, _ = wa.grams(words, min(GRAM, window))
                keys, counts = np.unique(grams[np.unique(at)], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.minimum(counts, 2))], ["anchor", "n"]
                )

    return run


class Filter:
    """Bloom filter with two bits per key, addressed by slices of the key's hash."""

    def __init__(self, bits: int, blocks: np.ndarray):
        self.bits, self.blocks = bits, blocks

    def seen(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for shift in (0, 32):
            bit = (keys >> np.uint64(shift)) & np.uint64((1 << self.bits) - 1)
            found &= (self.blocks[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return found


def build_filter(keys: DataFrame, n: int) -> Filter:
    """Filter of the ``anchor`` column; blocks are merged in Spark, at most 2**(FILTER_BITS - 6) reach the driver."""
    bits = min(max(int(16 * max(n, 1)).bit_length(), 10), FILTER_BITS)
    places = F.array(*[F.shiftrightunsigned("anchor", s).bitwiseAND((1 << bits) - 1) for s in (0, 32)])
    rows = (
        keys.select(F.explode(places).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("block"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word"))
        .toArrow()
    )
    blocks = np.zeros(1 << (bits - 6), np.uint64)
    blocks[rows["block"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return Filter(bits, blocks)


def candidates_of(window: int, shared) -> Callable[[Batches], Batches]:
    """Phrases that may recur: (phrase, doc_id, start)."""

    def run(batches: Batches) -> Batches:
        known = shared.value
        for batch in batches:
            ids = batch.column(0)
            for low, high, data, offsets in wa.slices(batch.column(1)):
                words = wa.words_of(data, offsets)
                doc, starts, hashes = _candidates(words, window, known)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), ids.slice(low, high - low).take(pa.array(doc)),
                     pa.array(starts.astype(np.int32))],
                    ["phrase", "doc_id", "start"],
                )

    return run


def _candidates(words: wa.Words, window: int, known: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start within the text, phrase hash)."""
    starts, hashes, at = phrases(words, window)
    grams, _ = wa.grams(words, min(GRAM, window))
    open_ = known.seen(grams[at]) if len(at) else np.zeros(0, bool)
    starts, hashes = starts[open_], hashes[open_]
    doc = np.searchsorted(words.first, starts, side="right") - 1
    return doc, starts - words.first[doc], hashes


def factors(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy factors [start, end) in words from the sorted starts of phrases known from the reference."""
    if len(starts) == 0:
        return starts, starts
    breaks = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.r_[0, breaks + 1]], starts[np.r_[breaks, len(starts) - 1]] + window


def parse(window: int, shared, texts: bool) -> Callable[[Batches], Batches]:
    """Factor each document; ``firsts`` holds the starts of its phrases that are the first of their kind."""

    def run(batches: Batches) -> Batches:
        known = shared.value
        for batch in batches:
            first_starts = batch.column(2)
            for low, high, data, offsets in wa.slices(batch.column(1)):
                words = wa.words_of(data, offsets)
                doc, starts, _ = _candidates(words, window, known)
                bounds = np.searchsorted(doc, np.arange(high - low + 1))
                out: list[list] = [[], [], [], []]
                raw = data.tobytes()
                for k in range(high - low):
                    own = starts[bounds[k] : bounds[k + 1]]
                    new = first_starts[low + k].as_py()
                    if new is None:  # no id: compared with nothing
                        own = own[:0]
                    elif len(own):
                        own = own[~np.isin(own, np.frombuffer(new, ">i4"))]
                    begin, end = factors(own, window)
                    spoken = raw[offsets[k] : offsets[k + 1]].split()
                    n = len(spoken)
                    if len(begin):
                        gone = np.zeros(n + 1, np.int32)
                        np.add.at(gone, begin, 1)
                        np.add.at(gone, end, -1)
                        stay = np.flatnonzero(np.cumsum(gone[:n]) == 0)
                        spoken = [spoken[i] for i in stay]
                    left = b" ".join(spoken)
                    out[0].append(n)
                    out[1].append(n - len(spoken))
                    out[2].append(hashlib.sha256(left).hexdigest())
                    out[3].append([{"start": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
                    if texts:
                        untouched = raw[offsets[k] : offsets[k + 1]]
                        out.append((left if len(begin) else untouched).decode("utf-8", "replace"))
                columns = [
                    pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
                    pa.array(out[3], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ]
                names = ["n_words", "n_removed", "kept_sha256", "factors"]
                if texts:
                    columns.append(pa.array(out[4:], pa.string()))
                    names.append("kept_text")
                rest = [batch.column(c).slice(low, high - low) for c in (0, *range(3, batch.num_columns))]
                rest_names = [batch.schema.names[c] for c in (0, *range(3, batch.num_columns))]
                yield pa.RecordBatch.from_arrays(rest + columns, rest_names + names)

    return run


def remove_repeats(
    docs: DataFrame, window: int = 20, id_column: str = "doc_id", text_column: str = "text",
    texts: bool = False, carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the columns ``carry``, n_words, n_removed, kept_sha256, factors and, with
    ``texts``, kept_text (as it is written where nothing went).

    A word goes when a phrase of ``window`` words that covers it also starts earlier: in a document of smaller id, or
    earlier in the same document. All phrases are judged on the texts as given. Kept words are joined by one
    space. Null and empty texts have no words. Rows without id keep all words and are no reference for others.
    Rows that repeat an id count as one document read twice. No rows give no rows.
    """
    spark = docs.sparkSession
    extra = [F.col(c).alias(f"_carried_{c}") for c in carry]
    texts_only = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), *extra)
    named = texts_only.filter("doc_id is not null")
    id_type = texts_only.schema["doc_id"].dataType.simpleString()
    anchors = named.select("text").mapInArrow(wa.tidy(anchors_of(window)), "anchor long, n long")
    again = stored(anchors.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "anchors")
    shared = spark.sparkContext.broadcast(build_filter(again, again.count()))
    open_ = named.select("doc_id", "text").mapInArrow(
        wa.tidy(candidates_of(window, shared)), f"phrase long, doc_id {id_type}, start int"
    )
    index = open_.groupBy("phrase").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    # the starts of a document's first phrases as one run of bytes, as long as the document at most
    firsts = index.groupBy("first.doc_id").agg(F.collect_list("first.start").alias("starts"))
    firsts = firsts.select("doc_id", F.unhex(F.array_join(F.transform("starts", lambda s: F.lpad(F.hex(s), 8, "0")), "")).alias("firsts"))
    joined = texts_only.join(firsts, "doc_id", "left").select(
        "doc_id", "text",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("firsts", F.lit(b""))).alias("firsts"),
        *[f"_carried_{c}" for c in carry],
    )
    kept = "".join(f"`_carried_{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    done = joined.mapInArrow(
        wa.tidy(parse(window, shared, texts)),
        f"doc_id {id_type}, {kept}n_words long, n_removed long, kept_sha256 string, "
        "factors array<struct<start:int,end:int>>" + (", kept_text string" if texts else ""),
    )
    return done.withColumnsRenamed({f"_carried_{c}": c for c in carry})
