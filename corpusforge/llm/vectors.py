"""Near-duplicate vectors by product quantisation over inverted lists, confirmed by exact cosines.

A coarse quantiser, fitted on a bounded sample, puts each vector into one inverted list; what is left of it behind the
list's centroid is stored as one byte code per subspace. A vector also asks the lists it is likely to have neighbours in; in
a list its inner products with all codes are read from one lookup table per subspace. The length of a stored vector's
quantisation error bounds how far that value may be off, so a pair is dropped only when the bound proves it below the
threshold. All others get their exact cosine in double precision.

How many lists a vector asks is measured on the sample: as many as let one of two vectors exactly at the threshold find
the list of the other with a chance of ``reach``. Equal vectors form a class and only one of them is compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.storage import components, stored

SAMPLE = 32_768
LIST_ROWS = 256
MOST_LISTS = 2048
SUBSPACES = 8
CODES = 256
BLOCK = 2048
REACH = 0.995

Batches = Iterator[pa.RecordBatch]


@dataclass
class Quantiser:
    centroids: np.ndarray  # lists x dim
    books: list[np.ndarray]  # one per subspace, codes x its width
    cuts: np.ndarray  # where subspaces begin, and the end
    probes: int

    def lists(self, unit: np.ndarray) -> np.ndarray:
        """The lists each vector asks, nearest first; the first is its own."""
        sims = unit @ self.centroids.T
        k = min(self.probes, sims.shape[1])
        some = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(sims, some, axis=1), axis=1, kind="stable")
        return np.take_along_axis(some, order, axis=1).astype(np.int32)

    def encode(self, unit: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, length of the error) of vectors in their own lists."""
        rest = unit - self.centroids[own]
        codes = np.empty((len(unit), len(self.books)), np.uint8)
        error = np.zeros(len(unit))
        for m, book in enumerate(self.books):
            part = rest[:, self.cuts[m] : self.cuts[m + 1]]
            codes[:, m] = nearest(part, book)
            error += ((part - book[codes[:, m]]) ** 2).sum(axis=1)
        return codes, np.sqrt(error)


def nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1)[None, :] - 2 * rows @ centers.T, axis=1)


def k_means(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centers = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        own = nearest(rows, centers)
        counts = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, rows)
        full = counts > 0
        centers[full] = sums[full] / counts[full, None]
    return centers


def fit(sample: np.ndarray, n: int, threshold: float, reach: float, seed: int = 5) -> Quantiser:
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    k = int(np.clip(n // LIST_ROWS, 1, min(MOST_LISTS, max(1, len(sample) // 4))))
    centroids = k_means(sample, k, rng)
    cuts = np.linspace(0, dim, min(SUBSPACES, dim) + 1).astype(int)
    own = np.argmax(sample @ centroids.T, axis=1)
    rest = sample - centroids[own]
    books = [k_means(rest[:, a:b], min(CODES, len(rest)), rng) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    # neighbours exactly at the threshold, in random directions: how deep lies the list of the one for the other, and the other
    # way round, because a pair is found from either side
    some = sample[rng.permutation(len(sample))[:4096]]
    noise = rng.standard_normal(some.shape)
    noise -= (noise * some).sum(axis=1, keepdims=True) * some
    length = np.linalg.norm(noise, axis=1, keepdims=True)
    noise /= np.where(length > 0, length, 1)
    other = threshold * some + np.sqrt(max(0.0, 1 - threshold**2)) * noise
    sims = some @ centroids.T, other @ centroids.T
    depth = [
        (a > a[np.arange(len(some)), np.argmax(b, axis=1)][:, None]).sum(axis=1) + 1 for a, b in (sims, sims[::-1])
    ]
    return Quantiser(centroids, books, cuts, int(np.quantile(np.minimum(*depth), reach, method="higher")))


def units(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors stored as bytes of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def vector_keys(batches: Batches) -> Batches:
    """(vec_id, dim, key, vector): null where a vector can't be compared."""
    for batch in batches:
        ids, keys, dims, vectors = batch.column(0), [], [], []
        for values in batch.column(1):
            row = None if not values.is_valid else np.array(values.as_py(), dtype=object)
            usable = row is not None and len(row) > 0 and not any(x is None for x in row)
            row = row.astype(np.float64) + 0.0 if usable else None
            if row is not None and np.isfinite(row).all() and (scale := np.abs(row).max()) > 0:
                row = row / scale  # no overflow in squares; cosines stay what they are
                dims.append(len(row))
                vectors.append(row.tobytes())
                keys.append(xxhash.xxh3_128_digest(vectors[-1]))
            else:
                dims.append(None)
                vectors.append(None)
                keys.append(None)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())],
            ["vec_id", "dim", "key", "vector"],
        )


_ROW = "list int, asks boolean, home int, key binary, n long, vector binary, codes binary, error double, lists binary"


def into_lists(shared) -> Callable[[Batches], Batches]:
    """For each class a stored row in its list and an asking row in every list it asks."""

    def run(batches: Batches) -> Batches:
        model: Quantiser = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                unit = units(matrix(part.column(2)))
                lists = model.lists(unit)
                codes, error = model.encode(unit, lists[:, 0])
                depth = lists.shape[1]
                row = np.repeat(np.arange(len(unit)), depth + 1)
                asks = np.ones((len(unit), depth + 1), bool)
                asks[:, 0] = False
                target = np.concatenate([lists[:, :1], lists], axis=1)
                index = pa.array(row)
                nothing = pa.array(asks.ravel())
                packed = pa.array([x.tobytes() for x in codes], pa.binary()).take(index)
                asked = pa.array([x.tobytes() for x in lists], pa.binary()).take(index)
                null = pa.nulls(len(row), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(target.ravel()), nothing, pa.array(lists[row, 0]), part.column(0).take(index),
                     part.column(1).take(index), part.column(2).take(index),
                     pc.if_else(nothing, null, packed), pa.array(error[row]),
                     pc.if_else(nothing, null, asked)],
                    ["list", "asks", "home", "key", "n", "vector", "codes", "error", "lists"],
                )

    return run


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the pairs (a, b) over ``n`` nodes, as (center, member)."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        np.minimum.at(label, label[a], least)
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(n))
    return label[member], member


def compare(shared, threshold: float) -> Callable[[pa.Table], pa.Table]:
    """Links between the asking and the stored rows of one block of a list.

    Gives counted links per class (a, null, n) and enough links (a, b, null) to connect what is connected. A pair found
    in the lists of both is taken in the list of smaller number only.
    """

    def run(table: pa.Table) -> pa.Table:
        model: Quantiser = shared.value
        table = table.combine_chunks()
        asks = np.array(table["asks"].to_pylist(), bool)
        q, x = np.flatnonzero(asks), np.flatnonzero(~asks)
        out = {"a": [], "b": [], "n": []}
        types = [pa.binary(), pa.binary(), pa.int64()]
        if len(q) and len(x):
            here = table["list"][0].as_py()
            keys = np.array(table["key"].to_pylist(), object)
            rank = np.unique(keys, return_inverse=True)[1]
            weight, home = table["n"].to_numpy(), table["home"].to_numpy()
            raw = matrix(table["vector"].combine_chunks())
            unit = units(raw)
            codes = np.frombuffer(b"".join(table["codes"].take(pa.array(x)).to_pylist()), np.uint8).reshape(len(x), -1)
            error = table["error"].to_numpy()[x]
            # lists that the stored rows ask themselves
            asked = np.zeros((len(x), len(model.centroids)), bool)
            lists = np.frombuffer(b"".join(table["lists"].take(pa.array(x)).to_pylist()), np.int32).reshape(len(x), -1)
            np.put_along_axis(asked, lists.astype(np.int64), True, axis=1)
            # the tables are read in single precision, so the bound gives way by more than that can be off
            floor = (threshold - 1e-4 - error).astype(np.float32)[:, None]
            links = ([], [])
            for low in range(0, len(q), 256):
                some = q[low : low + 256]
                # a row of the table holds one code's products with all askers, so a stored vector reads whole rows
                value = np.repeat((unit[some] @ model.centroids[here]).astype(np.float32)[None, :], len(x), axis=0)
                for m, book in enumerate(model.books):
                    lookup = (book @ unit[some, model.cuts[m] : model.cuts[m + 1]].T).astype(np.float32)
                    value += lookup.take(codes[:, m], axis=0)
                j, i = np.nonzero(value >= floor)
                asker, found = some[i], x[j]
                elsewhere = home[asker] != here
                # of two lists that both show the pair, the one of the smaller number counts
                wanted = ~asked[j, home[asker]] | (here < home[asker])
                # pairs at home in one list are asked by both sides
                wanted = np.where(elsewhere, wanted, rank[asker] < rank[found])
                asker, found = asker[wanted], found[wanted]
                for at in range(0, len(asker), 16384):
                    a, b = asker[at : at + 16384], found[at : at + 16384]
                    good = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                    links[0].append(a[good])
                    links[1].append(b[good])
            a, b = (np.concatenate([np.empty(0, np.int64), *side]) for side in links)
            counts = np.bincount(a, weight[b], len(keys)) + np.bincount(b, weight[a], len(keys))
            some = np.flatnonzero(counts)
            center, member = spanning(a, b, len(keys))
            out["a"] = [*keys[some], *keys[center]]
            out["b"] = [*[None] * len(some), *keys[member]]
            out["n"] = [*counts[some].astype(int).tolist(), *[None] * len(member)]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types, strict=True)})

    return run


def near_vectors(
    embeddings: DataFrame, threshold: float = 0.9, reach: float = REACH,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without id, link with nothing
    and stand for themselves. Vectors of different lengths are never compared. Each row is a vector of its own, also where ids
    repeat. Other columns are not looked at. No rows give no rows.
    """
    spark = embeddings.sparkSession
    id_type = embeddings.schema[id_column].dataType.simpleString()
    named = embeddings.select(
        F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    rows = stored(
        named.mapInArrow(vector_keys, f"vec_id {id_type}, dim int, key binary, vector binary"), "vectors"
    )
    usable = rows.filter("key is not null and vec_id is not null")
    classes = stored(
        usable.groupBy("key").agg(
            F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.first("dim").alias("dim"),
            F.first("vector").alias("vector"),
        ),
        "vector-classes",
    )
    counted = links = None
    for dim, n in sorted(classes.groupBy("dim").count().collect()):
        found = stored(list_links(classes.filter(F.col("dim") == dim), n, threshold, reach), "vector-links")
        own = found.filter("b is null").select("a", "n")
        pairs = found.filter("b is not null").select("a", "b")
        counted, links = (own, pairs) if counted is None else (counted.union(own), links.union(pairs))
    if counted is None:
        nothing = F.lit(0).cast("long")
        return rows.select("vec_id", nothing.alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sums = counted.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("others"))
    labels = components(links).withColumnRenamed("node", "key")
    of_class = classes.select("key", "first_id", "n").join(sums, "key", "left").join(labels, "key", "left").select(
        "key", "first_id", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("label", "key").alias("label"),
    )
    least = of_class.groupBy("label").agg(F.min("first_id").alias("component_id"))
    known = of_class.join(least, "label").select("key", "n_links", "component_id")
    joined = rows.select("vec_id", "key").join(known, "key", "left")
    linked = F.col("vec_id").isNotNull()
    return joined.select(
        "vec_id",
        F.when(linked, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(linked, F.coalesce("component_id", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def list_links(classes: DataFrame, n: int, threshold: float, reach: float) -> DataFrame:
    spark = classes.sparkSession
    sample = classes.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("vector").toArrow()
    model = fit(units(matrix(sample["vector"].combine_chunks())), n, threshold, reach)
    shared = spark.sparkContext.broadcast(model)
    placed = stored(classes.select("key", "n", "vector").mapInArrow(into_lists(shared), _ROW), "lists")
    # one row per list, and there are MOST_LISTS at most
    sizes = placed.groupBy("list").agg(
        F.ceil(F.sum(F.col("asks").cast("long")) / BLOCK).alias("q_blocks"),
        F.ceil(F.sum((~F.col("asks")).cast("long")) / BLOCK).alias("x_blocks"),
    )
    blocks = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    own = F.pmod(F.xxhash64("key", F.lit(3)), F.when(F.col("asks"), F.col("q_blocks")).otherwise(F.col("x_blocks")))
    dealt = (
        placed.join(F.broadcast(sizes), "list")
        .withColumn("own", own)
        .withColumn("other", F.explode(blocks(F.when(F.col("asks"), F.col("x_blocks")).otherwise(F.col("q_blocks")))))
        .withColumn("q", F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")))
        .withColumn("x", F.when(F.col("asks"), F.col("other")).otherwise(F.col("own")))
        .drop("own", "other", "q_blocks", "x_blocks")
    )
    return dealt.groupBy("list", "q", "x").applyInArrow(compare(shared, threshold), "a binary, b binary, n long")
