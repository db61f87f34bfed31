"""Near-duplicate documents by MinHash bands with sequential Bayesian verification.

1. Every document becomes the set of its distinct shingles. Documents with equal sets form a class, and only one
   member of a class goes on.
2. 128 minimum hashes per class, 32 bands of four: classes that agree in a band share a bucket. A pair at the threshold
   of 0.8 meets in no bucket with a probability of 5e-8.
3. Pairs are compared on a finer signature, 64 hashes at a time. After each batch the posterior probability (uniform
   prior) that the pair reaches the threshold is known from the matches so far; a pair below ``miss`` is dropped.
4. Survivors are verified on their full shingle sets.

A bucket is never expanded into its pairs. First every member meets the smallest member of its bucket only. The links
found give provisional components; only buckets that still hold several components are compared further, members of one
component never with each other. The members outside the main component are few in a large bucket as a rule: from the
largest buckets on, as far as they fit in ``SCAN_BYTES``, they are sent to all tasks, and every row of such buckets is read once and meets those
that share a band with it. The smaller buckets are compared block by block, a pair only in the first band it shares. Both ways find the same components.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import wordarrays as wa
from corpusforge.llm.storage import components, stored

BANDS, ROWS = 32, 4
COARSE = BANDS * ROWS
FINE, BATCH = 1024, 64
BLOCK = 512
SCAN_BYTES = 32 << 20  # members that are sent to all tasks, with signatures and sets
FEW = 16  # buckets of so few members are compared pair by pair, larger ones block by block

Batches = Iterator[pa.RecordBatch]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words than ``width`` is one shingle."""
    words = wa.words_of(data, offsets, fold=True)
    hashes, room = wa.grams(words, width)
    up, _ = wa.powers(width + 1)
    for low, high in zip(words.first[:-1], words.first[1:], strict=True):
        n = high - low
        if n >= width:
            yield np.unique(hashes[low:high][room[low:high]])
        elif n:
            whole = (words.hashes[low:high] * up[:n]).sum(dtype=np.uint64) + np.uint64(n)
            yield wa.mix(np.array([whole], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def min_hashes(shingles: np.ndarray, n: int, seed: int) -> np.ndarray:
    """``n`` 32-bit minimum hashes of a set that is not empty."""
    factors = (wa.seeded(n, seed) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shifts = (wa.seeded(n, seed + 1) >> np.uint64(32)).astype(np.uint32)
    keys = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    step = max(1, (1 << 19) // n)
    for at in range(0, len(keys), step):
        part = factors[:, None] * keys[None, at : at + step]
        part += shifts[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def coarse_signature(shingles: np.ndarray) -> bytes:
    return min_hashes(shingles, COARSE, 11).astype(np.uint16).tobytes()


def fine_signature(shingles: np.ndarray) -> bytes:
    return min_hashes(shingles, FINE, 21).astype(np.uint8).tobytes()


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def prune_table(percent: int, miss: float) -> np.ndarray:
    """For each number of compared batches, the most matches at which a pair is dropped.

    With a uniform prior on the match rate, ``P(rate >= t | m of n match) = P(Binomial(n + 1, t) <= m)``. Equal bytes
    by chance raise the rate of a pair at the threshold by 1/256 of the rest.
    """
    t = percent / 100 + (1 - percent / 100) / 256
    cut = np.full(FINE // BATCH + 1, -1)
    if t >= 1:
        t = 1 - 1e-9
    for k in range(1, FINE // BATCH + 1):
        n, below = k * BATCH + 1, 0.0
        for m in range(n):
            log = math.lgamma(n + 1) - math.lgamma(m + 1) - math.lgamma(n - m + 1)
            below += math.exp(log + m * math.log(t) + (n - m) * math.log1p(-t))
            if below >= miss:
                break
            cut[k] = m
    return cut


def survivors(
    left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, cut: np.ndarray
) -> np.ndarray:
    """Which of the pairs (``left[i]``, ``right[j]``) stand after all batches; a pair leaves as soon as it may."""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int32)
    for k in range(FINE // BATCH):
        part = slice(k * BATCH, (k + 1) * BATCH)
        for at in range(0, len(alive), 16384):
            some = alive[at : at + 16384]
            matches[some] += (left[i[some], part] == right[j[some], part]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] > cut[k + 1]]
    return alive


def bytes_matrix(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    if len(column) == 0:
        return np.empty((0, width), dtype)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def sketch(width: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids = batch.column(0)
            for low, high, data, offsets in wa.slices(batch.column(1)):
                sizes, keys, signatures = [], [], []
                for shingles in shingle_sets(data, offsets, width):
                    sizes.append(len(shingles))
                    keys.append(set_key(shingles))
                    signatures.append(coarse_signature(shingles) if len(shingles) else b"")
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, high - low), pa.array(sizes, pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                    ["doc_id", "n_shingles", "key", "signature"],
                )

    return run


def full_sets(width: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for _, _, data, offsets in wa.slices(batch.column(0)):
                sets = [x for x in shingle_sets(data, offsets, width) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f(x) for x in sets], pa.binary())
                     for f in (set_key, np.ndarray.tobytes, coarse_signature, fine_signature)],
                    ["key", "shingles", "signature", "fine"],
                )

    return run


def likely(cut: np.ndarray) -> Callable[[Batches], Batches]:
    """Of pairs (a, b, fine_a, fine_b) those that the posterior does not rule out."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            left, right = (bytes_matrix(batch.column(k), np.uint8, FINE) for k in (2, 3))
            all_rows = np.arange(len(left))
            alive = survivors(left, right, all_rows, all_rows, cut)
            yield batch.select([0, 1]).take(pa.array(alive))

    return run


def linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


def verified(percent: int) -> Callable[[Batches], Batches]:
    """Of pairs (a, b, shingles_a, shingles_b) those whose sets reach the threshold."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            good = []
            for k in range(batch.num_rows):
                left, right = (np.frombuffer(batch.column(c)[k].as_py(), np.uint64) for c in (2, 3))
                if linked(left, right, percent):
                    good.append(k)
            yield batch.select([0, 1]).take(pa.array(good, pa.int64()))

    return run


def block_links(cut: np.ndarray, percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links between the two sides of one block of a bucket, across components only, as many as connect them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = np.array(table["right"].to_pylist(), bool)
        band = table["band"][0].as_py()
        inner = table["inner"][0].as_py()  # a block against itself: both sides are the same rows
        keys = np.array(table["key"].to_pylist(), object)
        labels = np.unique(np.array([x for x in table["label"].to_pylist()], object), return_inverse=True)[1]
        coarse = bytes_matrix(table["signature"].combine_chunks(), np.uint64, BANDS)
        fine = bytes_matrix(table["fine"].combine_chunks(), np.uint8, FINE)
        sets = table["shingles"].combine_chunks()
        rows = np.flatnonzero(~side)
        cols = rows if inner else np.flatnonzero(side)
        found: tuple[list, list] = ([], [])
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            open_ = labels[some][:, None] != labels[cols][None, :]
            if inner:
                open_ &= some[:, None] < cols[None, :]
            for b in range(band):
                open_ &= coarse[some, b][:, None] != coarse[cols, b][None, :]
            i, j = np.nonzero(open_)
            i, j = some[i], cols[j]
            alive = survivors(fine, fine, i, j, cut)
            for x, y in zip(i[alive].tolist(), j[alive].tolist(), strict=True):
                if labels[x] != labels[y] and linked(*(np.frombuffer(sets[k].as_py(), np.uint64) for k in (x, y)), percent):
                    labels[labels == labels[y]] = labels[x]
                    found[0].append(keys[x])
                    found[1].append(keys[y])
        return pa.table({"a": pa.array(found[0], pa.binary()), "b": pa.array(found[1], pa.binary())})

    return run


class _Others:
    """The members outside the main components of their buckets, found by the value of any band."""

    def __init__(self, table: pa.Table):
        self.keys = table["key"].to_pylist()
        self.labels = table["label"].to_pylist()
        self.fine = bytes_matrix(table["fine"].combine_chunks(), np.uint8, FINE)
        self.sets = table["shingles"].combine_chunks()
        bands = bytes_matrix(table["signature"].combine_chunks(), np.uint64, BANDS)
        self.order = np.argsort(bands, axis=0, kind="stable")
        self.values = np.take_along_axis(bands, self.order, axis=0)

    def sharing(self, bands: np.ndarray) -> np.ndarray:
        """Numbers of those that share a band with one row, each once."""
        found = []
        for b in range(BANDS):
            low, high = np.searchsorted(self.values[:, b], bands[b], "left"), np.searchsorted(self.values[:, b], bands[b], "right")
            if low < high:
                found.append(self.order[low:high, b])
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def scan_links(shared, cut: np.ndarray, percent: int) -> Callable[[Batches], Batches]:
    """Links of rows (key, label, signature, fine, shingles) to the others, across components only, as many as connect them."""

    def run(batches: Batches) -> Batches:
        others = _Others(shared.value)
        number = {label: n for n, label in enumerate(dict.fromkeys(others.labels))}
        component = np.array([number[label] for label in others.labels])
        merged: dict[int, int] = {}

        def root(n: int) -> int:
            while n in merged:
                n = merged[n]
            return n

        for batch in batches:
            bands = bytes_matrix(batch.column("signature"), np.uint64, BANDS)
            fine = bytes_matrix(batch.column("fine"), np.uint8, FINE)
            labels = batch.column("label").to_pylist()
            found: tuple[list, list] = ([], [])
            for y in range(batch.num_rows):
                near = others.sharing(bands[y])
                if not len(near):
                    continue
                own = root(number.setdefault(labels[y], len(number)))
                near = near[component[near] != own]
                alive = survivors(others.fine, fine, near, np.full(len(near), y), cut)
                words = np.frombuffer(batch.column("shingles")[y].as_py(), np.uint64)
                for x in near[alive].tolist():
                    if component[x] != own and linked(np.frombuffer(others.sets[x].as_py(), np.uint64), words, percent):
                        joined = component[x]
                        merged[int(joined)] = own
                        component[component == joined] = own
                        found[0].append(others.keys[x])
                        found[1].append(batch.column("key")[y].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.binary()) for f in found], ["a", "b"])

    return run


def _pairs_with(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    for side in ("a", "b"):
        own = sets.select(F.col("key").alias(side), F.col(column).alias(f"{column}_{side}"))
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", f"{column}_a", f"{column}_b")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, miss: float = 1e-6,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when ``100 * intersection >= percent * union`` of their shingle sets; ``component_id`` is
    the smallest id reachable by links. Texts that are null, empty or blank have no shingles and link with nothing.
    Rows without id are returned with a null component and kept, and link with nothing. Rows that repeat an id
    are all returned and share what the id's texts link to. Other columns are not looked at. No rows give no rows.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = stored(
        texts.mapInArrow(wa.tidy(sketch(width)), f"doc_id {id_type}, n_shingles long, key binary, signature binary"),
        "sketches",
    )
    usable = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(
        usable.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("signature").alias("signature")),
        "classes",
    )
    links = class_links(texts.filter("doc_id is not null"), classes, width, percent, miss)
    # rows that repeat an id with another text join what the texts link to
    ids = usable.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a <> b")
    several = usable.join(ids.select("doc_id", "a"), "doc_id").select("a", F.col("key").alias("b"))
    labels = components(links.union(several.filter("a <> b")))
    of_class = classes.join(labels.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "first_id", F.coalesce("label", "key").alias("label")
    )
    least = of_class.groupBy("label").agg(F.min("first_id").alias("component_id"))
    known = of_class.join(least, "label").select("key", "component_id")
    own = rows.join(known, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), F.col("doc_id"))
        .otherwise(F.coalesce("component_id", "doc_id"))
        .alias("component_id"),
    )
    return own.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def class_links(
    texts: DataFrame, classes: DataFrame, width: int, percent: int, miss: float
) -> DataFrame:
    """Links (a, b) between class keys, enough of them to connect all classes that verified links connect."""
    cut = prune_table(percent, miss)
    pair_schema = "a binary, b binary"
    banded = classes.select(
        "key", "first_id",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.substring("signature", b * 8 + 1, F.lit(8)))).alias("band", "part"),
    ).select("key", "band", F.xxhash64("band", "part").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("key").alias("center"), F.count("*").alias("n"))
    members = stored(
        banded.join(shared.filter("n > 1"), "bucket").select("bucket", "band", "key", "center", "n"), "members"
    )
    wanted = members.select("key").distinct().join(classes.select("key", F.col("first_id").alias("doc_id")), "key")
    found = texts.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = stored(
        found.select("text")
        .mapInArrow(wa.tidy(full_sets(width)), "key binary, shingles binary, signature binary, fine binary")
        .join(wanted.select("key"), "key", "left_semi")
        .dropDuplicates(["key"]),
        "sets",
    )

    def links_of(pairs: DataFrame) -> DataFrame:
        """Exact check of likely pairs."""
        return _pairs_with(pairs, sets, "shingles").mapInArrow(wa.tidy(verified(percent)), pair_schema)

    star = members.filter("key <> center").select(F.col("center").alias("a"), F.col("key").alias("b")).distinct()
    near = stored(_pairs_with(star, sets, "fine").mapInArrow(wa.tidy(likely(cut)), pair_schema), "likely")
    first = stored(links_of(near), "verified")

    labels = components(first).withColumnRenamed("node", "key")
    labelled = members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    centers = labelled.filter("key = center").select("bucket", F.col("label").alias("main")).dropDuplicates(["bucket"])
    # every pair with the center is done, so a bucket of two is done
    small = labelled.filter((F.col("n") > 2) & (F.col("n") <= FEW) & (F.col("key") != F.col("center")))
    left, right = (small.select("bucket", F.col("key").alias(k), F.col("label").alias(f"label_{k}")) for k in "ab")
    crossing = left.join(right, "bucket").filter("a < b and label_a <> label_b").select("a", "b").distinct()
    crossing = _pairs_with(crossing, sets, "fine").mapInArrow(wa.tidy(likely(cut)), pair_schema)

    large = labelled.filter(F.col("n") > FEW)
    sides = large.join(centers, "bucket").withColumn("right", F.col("label") == F.col("main"))
    # the largest buckets are read as a scan, as many sizes of bucket as their outside members fit in what may be sent to all tasks
    sides = sides.withColumn("level", F.floor(F.log2("n")).cast("int"))
    outside = sides.filter(~F.col("right"))
    others = stored(outside.groupBy("key", "label").agg(F.max("level").alias("level")).join(sets, "key"), "others")
    weight = F.octet_length("shingles") + FINE + COARSE * 2 + 64
    lowest, total = None, 0
    for level, size in others.groupBy("level").agg(F.sum(weight)).orderBy(F.desc("level")).collect():
        total += size
        if total > SCAN_BYTES:
            break
        lowest = level
    found = links_of(crossing)
    if lowest is not None:
        shared = texts.sparkSession.sparkContext.broadcast(others.filter(F.col("level") >= lowest).drop("level").toArrow())
        split = outside.filter(F.col("level") >= lowest).select("bucket").distinct()
        touched = sides.join(split, "bucket", "left_semi").select("key", "label").distinct().join(sets, "key")
        found = found.union(touched.mapInArrow(wa.tidy(scan_links(shared, cut, percent)), pair_schema))
    if total <= SCAN_BYTES:
        return first.union(stored(found, "verified"))
    sides = sides.filter(F.col("level") < (lowest if lowest is not None else 64)).drop("level")
    sizes = sides.groupBy("bucket").agg(
        F.ceil(F.sum((~F.col("right")).cast("long")) / BLOCK).alias("n_left"),
        F.ceil(F.sum(F.col("right").cast("long")) / BLOCK).alias("n_right"),
    )
    sides = sides.join(sizes.filter("n_left > 0"), "bucket").withColumn(
        "own", F.pmod(F.xxhash64("key", F.lit(5)), F.when(F.col("right"), F.col("n_right")).otherwise(F.col("n_left")))
    )
    seq = lambda low, high: F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    zero, own, n_left, n_right = F.lit(0).cast("long"), F.col("own"), F.col("n_left"), F.col("n_right")
    block = lambda i, j, inner, right: F.struct(i.alias("i"), j.alias("j"), F.lit(inner).alias("inner"), F.lit(right).alias("right"))
    # rows of the main component meet every block of the others; the others meet those, and each other once
    as_main = F.transform(seq(zero, n_left - 1), lambda i: block(i, own, False, True))
    as_left = F.concat(
        F.transform(seq(zero, n_right - 1), lambda j: block(own, j, False, False)),
        F.array(block(own, -own - 1, True, False)),
        F.transform(seq(own + 1, n_left - 1), lambda j: block(own, -j - 1, False, False)),
        F.transform(seq(zero, own - 1), lambda i: block(i, -own - 1, False, True)),
    )
    tasks = sides.withColumn("t", F.explode(F.when(F.col("right"), as_main).otherwise(as_left))).select(
        "bucket", "band", "key", "label", "t.i", "t.j", "t.inner", "t.right"
    )
    rows = tasks.join(sets, "key")
    more = rows.groupBy("bucket", "i", "j").applyInArrow(block_links(cut, percent), pair_schema)
    return first.union(stored(found.union(more), "verified"))
