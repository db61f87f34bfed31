"""An inverted-list vector index on storage: trained cells, vectors in a folder per cell, searches that read few cells.

Cells are trained by k-means in Spark: a task sums up its own vectors per cell, only these sums are shuffled, and
the driver holds the centres. Sums are whole numbers (entries in steps of ``STEP``), so centres do not depend on the order of tasks. Vectors are stored partitioned by
cell; a search names the cells it probes, and Spark reads the folders of these alone.

A search looks into the nearest cells of each query, as many as ``calibrate`` has found to give the recall
asked for when the index was built. ``exact`` goes on from there: no vector of a cell scores above the
query's product with the centre plus its norm times the cell's radius, so cells whose bound is below the k-th score found
so far cannot change the result and are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.operators import search as S
from corpusforge.scaling import cut_lineage

STEP = 2.0**-24  # entries are summed up in steps of this
ROUNDS = 8
RECALL = 0.95
SAMPLE = 256  # vectors that the number of probes is measured with
PLANNED = 1 << 24  # (query, cell) pairs that the driver plans at once
SLACK = 10.0**-S.SCORE_DIGITS  # scores are rounded, so a bound has to miss by more than a step

CELLS = "cell int, n long, radius double, centre array<double>"


def _cell_count(n: int) -> int:
    """About the root of the number of vectors, so that centres and the vectors of a cell grow alike, as far as tasks can hold centres."""
    return min(max(1, round(n**0.5)), S.MAX_CELLS)


def _nearest(matrix: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row and its squared distance, in blocks of rows."""
    half = (centres**2).sum(axis=1) / 2
    at = np.empty(len(matrix), np.int64)
    rows = max(1, (1 << 22) // max(len(centres), 1))
    for low in range(0, len(matrix), rows):
        part = matrix[low : low + rows]
        at[low : low + rows] = np.argmax(part @ centres.T - half, axis=1)
    return at, ((matrix - centres[at]) ** 2).sum(axis=1)


def _sound(df: DataFrame, vector: str, dim: int | None = None) -> DataFrame:
    """Vectors that can be compared: there, without null or non-finite entries, and of the length asked for."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    df = df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    return df if dim is None else df.filter(F.size(vector) == dim)


def dimension(df: DataFrame, vector: str) -> int | None:
    """The most frequent length of the vectors, the smaller one at a tie; None if there are none."""
    lengths = _sound(df, vector).groupBy(F.size(vector).alias("dim")).agg(F.count("*").alias("n"))
    first = lengths.orderBy(F.desc("n"), "dim").first()
    return first["dim"] if first else None


def train_cells(df: DataFrame, n_cells: int | None = None, rounds: int = ROUNDS, vector: str = "embedding") -> np.ndarray:
    """Centres of a k-means over all vectors of the table, one per row.

    The first centres are the vectors with the smallest hashes: the same ones in every run, and spread like the data.
    A cell that loses all its vectors keeps its centre. Each round is one pass that sends sums per cell and task.
    """
    dim = dimension(df, vector)
    if dim is None:
        return np.empty((0, 0))
    rows = _sound(df, vector, dim).select(F.col(vector).cast("array<double>").alias("vector"))
    n_cells = n_cells or _cell_count(rows.count())
    first = rows.distinct().orderBy(F.xxhash64("vector"), "vector").limit(n_cells)
    centres = S.matrix_of(first.toArrow().column("vector"))
    wire = pa.schema([("cell", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))])

    def sums_around(centres: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(len(centres), np.int64)
            totals = np.zeros(centres.shape, np.int64)
            for batch in batches:
                if batch.num_rows:
                    matrix = S.matrix_of(batch.column("vector"))
                    at, _ = _nearest(matrix, centres)
                    np.add.at(totals, at, np.rint(matrix / STEP).astype(np.int64))
                    counts += np.bincount(at, minlength=len(centres))
            for cells in np.array_split(np.flatnonzero(counts), max(1, np.count_nonzero(counts) // 1000)):
                if len(cells):
                    columns = [cells, counts[cells], totals[cells].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, wire, strict=True)], schema=wire)

        return run

    for _ in range(rounds):
        sums = rows.mapInArrow(sums_around(centres), "cell int, n long, total array<long>")
        # position by position: a cell that many tasks have met is added up in part before the shuffle
        means = (
            sums.select("cell", "n", F.posexplode("total").alias("pos", "x"))
            .groupBy("cell", "pos").agg((F.sum("x") * STEP / F.sum("n")).alias("x"))
        ).toArrow()
        moved = centres.copy()
        moved[means.column("cell").to_numpy(), means.column("pos").to_numpy()] = means.column("x").to_numpy()
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


@dataclass
class VectorIndex:
    """Where an index stands; ``cells`` holds centre, radius and size of each cell, ``vectors`` a folder per cell."""

    spark: SparkSession
    folder: str

    @property
    def cells(self) -> DataFrame:
        return self.spark.read.schema(CELLS).parquet(f"{self.folder}/cells")

    @property
    def probes(self) -> int:
        """Cells to look into for the recall that was asked for."""
        return self.spark.read.parquet(f"{self.folder}/settings").first()["probes"]

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/vectors")


def build(
    df: DataFrame, folder: str, n_cells: int | None = None, rounds: int = ROUNDS, id: str = "id", vector: str = "embedding",
    keep: list[str] | None = None, recall: float = RECALL,
) -> VectorIndex:
    """Train cells and store every vector of the usual length under its cell, with the columns ``keep`` for filters.

    Rows without a comparable vector are not indexed: no search could find them. A frequent cell is split into
    files of even size. ``recall``: what searches shall reach, see ``calibrate``.
    """
    spark = df.sparkSession
    centres = train_cells(df, n_cells, rounds, vector)
    kept = keep or []
    columns = [F.col(id).alias("id"), F.col(vector).alias("vector"), *kept]
    rows = _sound(df, vector, centres.shape[1] if len(centres) else None).select(*columns)
    out = T.StructType([*rows.schema.fields, T.StructField("distance", T.DoubleType()), T.StructField("cell", T.IntegerType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, squares = _nearest(S.matrix_of(batch.column("vector")), centres)
                added = [pa.array(np.sqrt(squares)), pa.array(at.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=out.names)

    placed = rows.mapInArrow(place, out)
    index = VectorIndex(spark, folder)
    if not len(centres):
        placed.write.parquet(f"{folder}/vectors")  # keeps the columns
        spark.createDataFrame([], CELLS).write.parquet(f"{folder}/cells")
        spark.range(1).select(F.lit(1).alias("probes")).write.parquet(f"{folder}/settings")
        return index
    placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{folder}/vectors")
    sizes = index.vectors.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius"))
    wide = pa.table({"cell": pa.array(np.arange(len(centres), dtype=np.int32)), "centre": pa.array(centres.tolist(), pa.list_(pa.float64()))})
    joined = spark.createDataFrame(wide).join(sizes, "cell").select("cell", "n", "radius", "centre")
    joined.coalesce(1).write.parquet(f"{folder}/cells")
    probes = calibrate(index, recall)
    spark.range(1).select(F.lit(probes).alias("probes")).write.parquet(f"{folder}/settings")
    return index


def calibrate(index: VectorIndex, recall: float = RECALL, k: int = 10, sample: int = SAMPLE) -> int:
    """Smallest number of probes with which ``sample`` vectors of the index find the share ``recall`` of their ``k`` nearest others.

    One exact search shows how far down each query's list of cells its true neighbours lie, which gives the recall
    of every number of probes at once. The sample is those with the smallest hashes.
    """
    picked = index.vectors.select("id", "vector").orderBy(F.xxhash64("vector"), "id").limit(sample)
    rows = cut_lineage(picked.withColumn("qid", F.monotonically_increasing_id()))
    asked = rows.select("qid", "vector")
    plan = _Plan(asked.toArrow(), index.cells.orderBy("cell").toArrow())
    true = query_index(asked, index, k + 1, probes=1, exact=True, vector="vector")
    others = true.join(rows.select(F.col("qid").alias("_q"), F.col("id").alias("_self")), F.col("qid") == F.col("_q"))
    others = cut_lineage(others.filter(~F.col("id").eqNullSafe(F.col("_self"))).select("qid", F.col("id").alias("_id")))
    where = index.vectors.select("id", "cell").join(F.broadcast(others), F.col("id").eqNullSafe(F.col("_id")))
    found = where.select("qid", "cell").toArrow()
    if not found.num_rows:
        return 1
    ranks = np.argsort(np.argsort(-plan.products, axis=1, kind="stable"), axis=1)
    row = {q: i for i, q in enumerate(plan.qids.to_pylist())}
    column = {int(c): i for i, c in enumerate(plan.cells)}
    depth = [ranks[row[q], column[c]] for q, c in zip(found.column("qid").to_pylist(), found.column("cell").to_pylist(), strict=True)]
    return int(np.quantile(depth, recall, method="inverted_cdf")) + 1


class _Plan:
    """Queries and cells on the driver: which query looks into which cell."""

    def __init__(self, queries: pa.Table, cells: pa.Table):
        self.qids = queries.column("qid").combine_chunks()
        self.vectors = S.matrix_of(queries.column("vector"))
        self.cells = cells.column("cell").to_numpy()
        self.sizes = cells.column("n").to_numpy()
        self.radius = cells.column("radius").to_numpy()
        self.products = self.vectors @ S.matrix_of(cells.column("centre")).T
        norms = np.linalg.norm(self.vectors, axis=1)
        # what rounding can add to a product of these sizes
        self.bounds = self.products + norms[:, None] * self.radius[None, :] * (1 + 1e-9) + 1e-9 * (1 + norms[:, None])

    def nearest(self, probes: int, k: int) -> np.ndarray:
        """(query, cell): the ``probes`` cells with the best centres, and more until these hold ``k`` vectors."""
        order = np.argsort(-self.products, axis=1, kind="stable")
        before = np.cumsum(self.sizes[order], axis=1) - self.sizes[order]
        chosen = (np.arange(order.shape[1])[None, :] < probes) | (before < k)
        out = np.zeros_like(self.products, dtype=bool)
        np.put_along_axis(out, order, chosen, axis=1)
        return out

    def open(self, scores: dict, k: int) -> np.ndarray:
        """(query, cell): whether the cell may hold a vector that belongs among the best ``k``."""
        floor = np.array([scores.get(q, -np.inf) for q in self.qids.to_pylist()])
        return self.bounds >= floor[:, None] - SLACK


def _scan(index: VectorIndex, plan: _Plan, looks: np.ndarray, k: int, filters: dict | None, qid_type: T.DataType) -> DataFrame:
    """The best ``k`` rows of each query in the cells that it looks into; other cells' folders are not read."""
    wanted = plan.cells[looks.any(axis=0)]
    rows = S.with_filters(index.vectors, filters).filter(F.col("cell").isin([int(c) for c in wanted]))
    rows = rows.select("id", "vector", "cell")
    askers = {int(c): np.flatnonzero(looks[:, i]) for i, c in enumerate(plan.cells) if looks[:, i].any()}
    qids, vectors = plan.qids, plan.vectors
    out = T.StructType(
        [T.StructField("qid", qid_type), T.StructField("id", rows.schema["id"].dataType), T.StructField("score", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, id_type = S.BestRows(k), None
        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.schema.field("id").type
            ids, cells = batch.column("id"), batch.column("cell").to_numpy()
            for cell in np.unique(cells):
                at = np.flatnonzero(cells == cell)
                part = batch.take(pa.array(at)) if len(at) < len(cells) else batch
                asking = askers[int(cell)]
                scores = np.round(S.matrix_of(part.column("vector")) @ vectors[asking].T, S.SCORE_DIGITS)
                names = S.sortable(ids.take(pa.array(at)))
                for column, q in enumerate(asking):
                    best.add(int(q), names, scores[:, column])
        if id_type is not None:
            yield from best.batches(qids, id_type)

    return S.top_k(rows.mapInArrow(run, out), k)


def query_index(
    queries: DataFrame, index: VectorIndex, k: int = 5, probes: int | None = None, exact: bool = False, filters: dict | None = None,
    qid: str = "qid", vector: str = "embedding", block: int | None = None,
) -> DataFrame:
    """``(qid, id, score, rank)`` of the ``k`` best vectors in the probed cells, or with ``exact`` in all of them.

    Queries of another length than the index have no row. A query set beyond ``block`` (by default what the driver can plan
    at once) is searched in blocks by the hash of its ids.
    """
    cells = index.cells.orderBy("cell").toArrow()
    if not cells.num_rows:
        return _nothing(queries, index, qid)
    dim = len(cells.column("centre")[0])
    asked = _sound(queries, vector, dim).select(F.col(qid).alias("qid"), F.col(vector).cast("array<double>").alias("vector"))
    probes = probes or (1 if exact else index.probes)
    block = block or max(1, min(S.MAX_BROADCAST_QUERIES, PLANNED // cells.num_rows))
    parts = -(-asked.count() // block)
    found: DataFrame | None = None
    for part in range(parts):
        rows = asked if parts == 1 else asked.filter(F.pmod(F.xxhash64("qid"), F.lit(parts)) == part)
        one = _query_block(rows, index, cells, k, probes, exact, filters)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else _nothing(queries, index, qid)


def _query_block(
    asked: DataFrame, index: VectorIndex, cells: pa.Table, k: int, probes: int, exact: bool, filters: dict | None
) -> DataFrame:
    plan = _Plan(asked.toArrow(), cells)
    qid_type = asked.schema["qid"].dataType
    near = plan.nearest(probes, k)
    found = _scan(index, plan, near, k, filters, qid_type)
    if not exact:
        return found
    found = cut_lineage(found)  # read twice: for the k-th scores, and as a part of the result
    floors = {r["qid"]: r["score"] for r in found.filter(F.col("rank") == k).select("qid", "score").toLocalIterator()}
    rest = plan.open(floors, k) & ~near
    if not rest.any():
        return found
    more = _scan(index, plan, rest, k, filters, qid_type)
    return S.top_k(found.unionByName(more).drop("rank"), k)


def _nothing(queries: DataFrame, index: VectorIndex, qid: str) -> DataFrame:
    id_type = index.vectors.schema["id"].dataType
    empty = T.StructType([T.StructField("qid", queries.schema[qid].dataType), T.StructField("id", id_type), T.StructField("score", T.DoubleType())])
    return S.top_k(queries.sparkSession.createDataFrame([], empty), 1)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``(qid, n_true, n_found)``: how many of the exact hits a search has found, per query."""
    hits = found.select(F.col("qid").alias("f_qid"), F.col("id").alias("f_id"))
    both = exact.join(hits, F.col("qid").eqNullSafe(F.col("f_qid")) & (F.col("id") == F.col("f_id")), "left")
    return both.groupBy("qid").agg(F.count("*").alias("n_true"), F.count("f_id").alias("n_found"))
