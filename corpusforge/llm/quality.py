"""Quality by importance resampling: how much likelier a text is under a model of target text than of raw text.

Both models are bags of hashed n-grams: runs of three bytes, words, and pairs of words, each kind hashed into ``BUCKETS``
cells (pairs of the same word twice share one cell). The raw model counts all documents, the target model the
documents labelled good. Adding Gumbel noise to the log weights of documents and keeping the largest keys samples
without replacement in proportion to the weights.

The log ratio of a cell is ``log((target + PRIOR) / (expected + PRIOR))``, expected by the raw model, and moves towards 0 by
``DEAD``: labelled texts are few and long ones weigh much in them, so ratios up to a factor of two say as much about
the draw of languages and topics as about quality. The log weight of a document is its mean log ratio per n-gram,
summed over kinds, as if it had ``NGRAMS`` n-grams: long documents are not judged by their length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import wordarrays as wa
from corpusforge.llm.storage import stored

BUCKETS = 1 << 16
KINDS = 3
PRIOR = 8.0
DEAD = 0.7
NGRAMS = 256
MARGIN = -40.0
SHORT = 24  # n-grams without weight that each kind is given, so that one odd n-gram does not condemn a short text
TARGET_ROWS = 20_000  # labelled rows from which the target model is fitted, the smallest by a seeded hash

Batches = Iterator[pa.RecordBatch]


def ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(cell of each n-gram, first n-gram of each text and one more) for byte runs, then for words."""
    wide = data.astype(np.uint32)
    n = len(data)
    cells = np.zeros(n, np.uint32)
    if n > 2:
        cells[:-2] = ((wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(2654435761)) >> 16
    cells[n - 2 if n > 2 else 0 :] = 0
    yield cells, offsets
    words = wa.words_of(data, offsets)
    yield (words.hashes >> np.uint64(48)).astype(np.uint32), words.first
    pairs, inside = wa.grams(words, 2)
    cells = (pairs >> np.uint64(48)).astype(np.uint32) | np.uint32(1)
    cells[:-1][words.hashes[1:] == words.hashes[:-1]] = 0
    counts = np.maximum(words.counts - 1, 0)
    yield cells[inside], np.r_[0, np.cumsum(counts)]


def count_ngrams(batches: Batches) -> Batches:
    """Counts per cell over all texts of a task: (kind, cell, n)."""
    totals = np.zeros((KINDS, BUCKETS), np.int64)
    for batch in batches:
        for _, _, data, offsets in wa.slices(batch.column(0)):
            for kind, (cells, _) in enumerate(ngrams(data, offsets)):
                totals[kind] += np.bincount(cells, minlength=BUCKETS)
    kind, cell = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(kind.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(totals[kind, cell])],
        ["kind", "cell", "n"],
    )


def counts_of(texts: DataFrame) -> np.ndarray:
    """Counts by kind and cell: ``KINDS * BUCKETS`` numbers whatever the size of the input."""
    counted = texts.mapInArrow(wa.tidy(count_ngrams), "kind int, cell int, n long")
    summed = counted.groupBy("kind", "cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((KINDS, BUCKETS))
    out[summed["kind"].to_numpy(), summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    size = np.maximum(raw.sum(axis=1, keepdims=True), 1)
    expected = raw / size * target.sum(axis=1, keepdims=True)
    ratio = np.log((target + PRIOR) / (expected + PRIOR))
    return np.sign(ratio) * np.maximum(np.abs(ratio) - DEAD, 0)


def weigh(shared, noise_seed: int, noise: float) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        ratio = shared.value
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(2)
            for low, high, data, offsets in wa.slices(batch.column(1)):
                weight = np.zeros(high - low)
                for kind, (cells, first) in enumerate(ngrams(data, offsets)):
                    sums = np.r_[0.0, np.cumsum(ratio[kind][cells])]
                    weight += NGRAMS * (sums[first[1:]] - sums[first[:-1]]) / (np.diff(first) + SHORT)
                weight = np.round(weight, 6)
                drawn = hashes.slice(low, high - low).to_numpy(zero_copy_only=False).view(np.uint64)
                uniform = (wa.mix(drawn + np.uint64(noise_seed)) >> np.uint64(11)).astype(float) / 2.0**53
                key = weight - noise * np.log(-np.log(np.clip(uniform, 1e-300, 1 - 1e-16)))
                # the bits of a double, made to sort like the double
                bits = key.view(np.int64)
                rank = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, high - low), pa.array(weight), pa.array(key), pa.array(rank)],
                    ["doc_id", "log_weight", "gumbel_key", "rank"],
                )

    return run


def threshold(ranked: DataFrame, k: int) -> int:
    """The ``k``-th largest ``rank``, by counting 16 bits at a time; at most 65,536 counts reach the driver at once."""
    prefix: int | None = None
    for shift in (48, 32, 16, 0):
        inside = ranked if prefix is None else ranked.filter(F.shiftright("rank", shift + 16) == prefix)
        counts = inside.groupBy(F.shiftright("rank", shift).alias("top")).count().collect()
        for top, n in sorted(counts, reverse=True):
            if k <= n:
                prefix = top
                break
            k -= n
    return prefix


def resample(
    docs: DataFrame, labels: DataFrame, margin: float = MARGIN, noise: float = 1.0, seed: int = 3,
    id_column: str = "doc_id", text_column: str = "text", good: str = "quality", share: float | None = None, count: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, log_weight, gumbel_key, kept.

    ``labels`` (id, ``good`` 0 or 1) names target documents. The sample holds ``count`` documents, or the ``share`` of all, or else
    as many as there are rows whose weight is at least ``margin``; the largest keys, weight plus ``noise`` times Gumbel noise, fill it. So a
    document is drawn in proportion to ``exp(weight / noise)``. Log weights spread over hundreds: with a noise of 1 the draw is nearly their order,
    and a noise of their own spread samples among good and middling documents.
    Rows with equal keys at the limit are all kept. Null and empty texts weigh 0. Rows without id get the noise of
    id null. Without any labelled row all weights are 0. No rows give no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_column].dataType.simpleString()
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    wanted = labels.filter(F.col(good) == 1).select(F.col(id_column).alias("doc_id")).distinct()
    sample = wanted.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(TARGET_ROWS)
    target_texts = named.join(F.broadcast(sample), "doc_id", "left_semi").select("text")
    ratios = log_ratios(counts_of(target_texts), counts_of(named.select("text")))
    shared = spark.sparkContext.broadcast(ratios)
    ranked = stored(
        named.select("doc_id", "text", F.xxhash64(F.lit(seed), "doc_id").alias("h")).mapInArrow(
            wa.tidy(weigh(shared, seed, noise)), f"doc_id {id_type}, log_weight double, gumbel_key double, rank long"
        ),
        "weights",
    )
    if count is None and share is None:
        k = ranked.filter(F.col("log_weight") >= margin).count()
    else:
        n = ranked.count()
        k = min(n, count if count is not None else int(n * share))
    limit = threshold(ranked, k) if k else None
    kept = F.col("rank") >= limit if k else F.lit(False)
    return ranked.select("doc_id", "log_weight", "gumbel_key", kept.alias("kept"))
