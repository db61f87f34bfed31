"""Vector, keyword and hybrid search: many queries against a corpus table in one Spark job.

Queries are the small side. Its size is checked before it is broadcast, and each function has an exact
way for query sets beyond the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from corpusforge.functions.text import token_count, tokens, word_counts
from corpusforge.operators.upsert import without_keys
from corpusforge.scaling import cut_lineage, fits, join_lookup, sized

# The usual BM25 parameters and the rank-fusion constant of the published formulas.
BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60

SCORE_DIGITS = 6
MAX_BROADCAST_QUERIES = 4096
MAX_CELLS = 65_536
WORD_BUCKETS = 64
LISTED_WORDS = 20_000  # query words that a scan looks for in its texts; of more, the words of a text are joined with them
#: What one task holds: so many pairs of a query and a text are scored together, or so many texts have their words counted.
TASK_PAIRS = 200_000
TASK_TEXTS = 4_000
QUERY_BLOCK = 1024
SCORE_CELLS = 1 << 22  # scores held at once when rows look for their cells
CORPUS_BLOCK = 50_000


def top_k(scored: DataFrame, k: int, qid: str = "qid", id: str = "id") -> DataFrame:
    """Best ``k`` rows per query, ties by id; the limit is applied before the shuffle as well."""
    order = Window.partitionBy(qid).orderBy(F.desc("score"), F.asc(id))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def with_filters(corpus: DataFrame, filters: dict | None) -> DataFrame:
    """AND of equalities, applied before any scoring so that it reaches the scan."""
    for column, value in (filters or {}).items():
        corpus = corpus.filter(F.col(column) == value)
    return corpus


# --- vectors ------------------------------------------------------------------------------------


def matrix_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def by_length(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray]]:
    """Lengths of the vectors, each with the positions of its rows."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


def sortable(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids as an array that keeps them exact: numbers, or objects where there are nulls or no numbers."""
    if column.null_count or not pa.types.is_integer(column.type):
        out = np.empty(len(column), object)
        out[:] = column.to_pylist()
        return out
    return column.to_numpy()


def _ranks(ids: np.ndarray) -> np.ndarray:
    """Places of ids in ascending order, null first."""
    if ids.dtype != object:
        return np.unique(ids, return_inverse=True)[1]
    there = np.array([i is not None for i in ids], bool)
    out = np.full(len(ids), -1)
    out[there] = np.unique(ids[there], return_inverse=True)[1]
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best scores, ties by id."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        candidates = np.flatnonzero(scores >= kth)
    else:
        candidates = np.arange(len(scores))
    order = np.lexsort((_ranks(ids[candidates]), -scores[candidates]))
    return candidates[order[:k]]


class BestRows:
    """The ``k`` best rows of each query seen so far in one task."""

    def __init__(self, k: int):
        self.k, self.kept = k, {}

    def add(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        seen = np.flatnonzero(np.isfinite(scores))
        ids, scores = ids[seen], scores[seen]
        best = _best(ids, scores, self.k)
        ids, scores = ids[best], scores[best]
        if query in self.kept:
            ids = np.concatenate([self.kept[query][0], ids])
            scores = np.concatenate([self.kept[query][1], scores])
            best = _best(ids, scores, self.k)
            ids, scores = ids[best], scores[best]
        self.kept[query] = ids, scores

    def batches(self, qids: pa.Array | pa.ChunkedArray, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        for query, (ids, scores) in self.kept.items():
            if len(ids):
                columns = [pa.array([qids[query].as_py()] * len(ids), qids.type), pa.array(ids.tolist(), id_type), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["qid", "id", "score"])


class _Queries:
    """Query vectors by length, and by the cells they probe when the search is approximate."""

    def __init__(self, rows: pa.Table, probing: bool):
        self.qids = rows.column("qid").combine_chunks()
        vectors = rows.column("vector")
        self.groups = {length: (at, matrix_of(vectors.take(pa.array(at)))) for length, at in by_length(vectors)}
        self.probes = [set(p or ()) for p in rows.column("probe").to_pylist()] if probing else None

    def asking(self, length: int, cell: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and vectors of the queries of this length that look into the cell."""
        at, matrix = self.groups.get(length, (np.empty(0, int), np.empty((0, length))))
        if cell is None:
            return at, matrix
        those = np.array([cell in self.probes[q] for q in at], bool)
        return at[those], matrix[those]


def _local_top_k(batches: Iterator[pa.RecordBatch], queries: _Queries, k: int) -> Iterator[pa.RecordBatch]:
    """Score the batches of one task and keep ``k`` rows per query, whatever the task's size.

    Vectors are compared with queries of their own length; rows of a cell only with the queries that probe it.
    """
    best, id_type = BestRows(k), None
    for batch in batches:
        id_type = batch.schema.field("id").type
        for length, at in by_length(batch.column("vector")):
            cells = batch.column("cell").to_numpy()[at] if queries.probes is not None else None
            for cell in [None] if cells is None else np.unique(cells):
                asking, vectors = queries.asking(length, cell)
                if len(asking):
                    rows = pa.array(at if cell is None else at[cells == cell])
                    ids = sortable(batch.column("id").take(rows))
                    scores = np.round(matrix_of(batch.column("vector").take(rows)) @ vectors.T, SCORE_DIGITS)
                    for column, q in enumerate(asking):
                        best.add(int(q), ids, scores[:, column])
    if id_type is not None:
        yield from best.batches(queries.qids, id_type)


def vector_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    filters: dict | None = None,
    qid: str = "qid",
    id: str = "id",
    vector: str = "embedding",
    max_broadcast: int = MAX_BROADCAST_QUERIES,
) -> DataFrame:
    """The ``k`` rows with the largest dot product for every query: ``(qid, id, score, rank)``.

    Up to ``max_broadcast`` queries travel to the tasks, the corpus is scanned once, and only ``k`` rows per
    query leave a task. Larger query sets are cut into blocks that meet corpus blocks in a shuffle.
    ``queries`` may carry an array column ``probe`` and the corpus a column ``cell`` (see ``assign_cells``):
    then a query sees the rows of its probed cells only.
    """
    probing = "probe" in queries.columns
    q = queries.filter(F.col(vector).isNotNull()).select(
        F.col(qid).alias("qid"), F.col(vector).alias("vector"), *(["probe"] if probing else [])
    )
    c = with_filters(corpus, filters).filter(F.col(vector).isNotNull())
    c = c.select(
        F.col(id).alias("id"), F.col(vector).alias("vector"), *(["cell"] if probing else [])
    )
    types = q.schema["qid"].dataType, c.schema["id"].dataType
    out = T.StructType(
        [
            T.StructField("qid", types[0]),
            T.StructField("id", types[1]),
            T.StructField("score", T.DoubleType()),
        ]
    )
    rows = q.limit(max_broadcast + 1).toArrow()
    if rows.num_rows == 0:
        return top_k(c.sparkSession.createDataFrame([], out), k)
    if rows.num_rows <= max_broadcast:
        block = _Queries(rows, probing)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _local_top_k(batches, block, k)

        scored = c.mapInArrow(scan, out)
    else:
        scored = _blocked(q, c, k, out, probing)
    return top_k(scored, k)


def _blocked(
    q: DataFrame, c: DataFrame, k: int, out: T.StructType, probing: bool,
    query_block: int = QUERY_BLOCK, corpus_block: int = CORPUS_BLOCK,
) -> DataFrame:
    """Fragment and replicate: every query block meets every corpus block in exactly one task."""
    q_blocks = -(-q.count() // query_block)
    c_blocks = max(1, -(-c.count() // corpus_block))
    every_q = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    every_c = F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))
    left = q.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(q_blocks)).cast("int"))
    left = left.withColumn("cb", every_c)
    right = c.withColumn("cb", F.pmod(F.xxhash64("id"), F.lit(c_blocks)).cast("int"))
    right = right.withColumn("qb", every_q)

    wire = to_arrow_schema(out)

    def meet(queries: pa.Table, corpus: pa.Table) -> pa.Table:
        if queries.num_rows == 0 or corpus.num_rows == 0:
            return wire.empty_table()
        found = [pa.Table.from_batches([b]).cast(wire) for b in _local_top_k(iter(corpus.combine_chunks().to_batches()), _Queries(queries, probing), k)]
        return pa.concat_tables(found) if found else wire.empty_table()

    return left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(meet, out)


def mean_vectors(df: DataFrame, by: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per group, summed per position so that a hot group is combined on the map side."""
    positions = df.select(by, F.posexplode(vector).alias("pos", "x"))
    means = positions.groupBy(by, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(by).agg(F.transform(ordered, lambda s: s["x"]).alias(vector))


def assign_cells(
    df: DataFrame, cells: DataFrame, n: int = 1, cell: str = "cell", vector: str = "embedding"
) -> DataFrame:
    """Add the nearest cell (``cell``), or for ``n`` > 1 the ``n`` nearest ones (``probe``), to every row.

    ``cells`` is a coarse quantizer: one centre per row, by dot product. A corpus stored partitioned by
    ``cell`` lets a search read the probed cells only.
    """
    rows = cells.select(F.col(cell).cast("int").alias("cell"), vector).limit(MAX_CELLS + 1)
    table = rows.toArrow()
    field = T.StructField("cell", T.IntegerType()) if n == 1 else T.StructField(
        "probe", T.ArrayType(T.IntegerType())
    )
    df = df.filter(F.col(vector).isNotNull())
    if table.num_rows > MAX_CELLS:
        return _assigned_by_join(df, cells, n, cell, vector, field.name)
    names = table.column("cell").to_numpy()
    order = np.argsort(names)
    names, centres = names[order].astype(np.int32), matrix_of(table.column(vector))[order]
    out = T.StructType([*df.schema.fields, field])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ranked = _nearest_cells(matrix_of(batch.column(vector)), centres, n)
            found = names[ranked]
            added = pa.array(found[:, 0]) if n == 1 else pa.array(found.tolist(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, added], names=[*batch.schema.names, field.name]
            )

    return df.mapInArrow(nearest, out)


def _nearest_cells(matrix: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` best centres of each row, the first one at a tie; memory is that of a block of rows."""
    n = min(n, len(centres))
    out = np.empty((len(matrix), n), np.int64)
    rows = max(1, SCORE_CELLS // max(len(centres), 1))
    for low in range(0, len(matrix), rows):
        scores = np.round(matrix[low : low + rows] @ centres.T, SCORE_DIGITS)
        every = np.arange(len(scores))
        for rank in range(n):
            at = np.argmax(scores, axis=1)
            out[low : low + rows, rank] = at
            scores[every, at] = -np.inf
    return out


def _assigned_by_join(df: DataFrame, cells: DataFrame, n: int, cell: str, vector: str, name: str) -> DataFrame:
    """As ``assign_cells`` for more cells than a task should hold: blocks of rows meet blocks of cells in a shuffle."""
    marked = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    rows = marked.select(F.col("_row").alias("qid"), F.col(vector).alias("vector"))
    centres = cells.select(F.col(cell).cast("int").alias("id"), F.col(vector).alias("vector"))
    out = T.StructType([T.StructField("qid", T.LongType()), T.StructField("id", T.IntegerType()), T.StructField("score", T.DoubleType())])
    best = top_k(_blocked(rows, centres, n, out, False), n).groupBy(F.col("qid").alias("_row"))
    found = best.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda s: s["id"]).alias(name))
    joined = marked.join(found, "_row").drop("_row")
    return joined.withColumn(name, F.element_at(name, 1)) if n == 1 else joined


# --- keywords -----------------------------------------------------------------------------------


def query_terms(queries: DataFrame, qid: str = "qid", text: str = "text") -> DataFrame:
    words = queries.select(F.col(qid).alias("qid"), F.explode_outer(tokens(text)).alias("term"))
    return words.filter(F.col("term") != "").distinct()


def _words(corpus: DataFrame, id: str, text: str) -> DataFrame:
    """``(id, n_words, term)``, one row per word of every text."""
    return (
        corpus.select(F.col(id).alias("id"), tokens(text).alias("_tokens"))
        .select("id", token_count("_tokens").alias("n_words"), F.explode_outer("_tokens").alias("term"))
        .filter(F.col("term") != "")
    )


def _counted(words: DataFrame) -> DataFrame:
    return words.groupBy("id", "n_words", "term").agg(F.count("*").alias("tf"))


def corpus_totals(corpus: DataFrame, text: str = "text") -> DataFrame:
    """One row: number of texts and their average length in words."""
    counted = corpus.select(token_count(tokens(text)).alias("n_words"))
    return counted.agg(F.count("n_words").alias("n"), F.avg("n_words").alias("avg_words"))


def keyword_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    filters: dict | None = None,
    qid: str = "qid",
    id: str = "id",
    text: str = "text",
) -> DataFrame:
    """BM25 over the whole texts of the corpus: ``(qid, id, score, rank)``.

    Only words that occur in a query leave the scan, already counted per text. For a corpus that is searched again and
    again see ``word_index``.
    """
    return top_k(keyword_scores(queries, corpus, filters, qid, id, text), k)


def keyword_scores(
    queries: DataFrame, corpus: DataFrame, filters: dict | None = None, qid: str = "qid", id: str = "id", text: str = "text"
) -> DataFrame:
    """``(qid, id, score)`` of every text that holds a word of a query: what ``keyword_topk`` ranks."""
    wanted = cut_lineage(query_terms(queries, qid, text))
    small = fits(wanted)
    hits, totals = _query_words(with_filters(corpus, filters), wanted, small, id, text)
    return _score_hits(wanted, hits, totals, small, together=True)


def _query_words(corpus: DataFrame, wanted: DataFrame, small: bool, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Counted query words per text, and the totals of all texts, from one pass over the texts."""
    terms = wanted.select("term").distinct()
    listed = [row["term"] for row in terms.limit(LISTED_WORDS + 1).collect()]
    few = len(listed) <= LISTED_WORDS
    asked = wanted.select("qid").distinct().count()
    texts = _texts(corpus, id, text, max(1, TASK_PAIRS // max(asked, TASK_PAIRS // TASK_TEXTS)), listed if few else None)
    found = _text_words(texts)
    # reads all columns, or its exchange would be another than that of the words
    kept = texts.groupBy("id", "n_words").agg(F.max(F.size("words")).alias("_size"))
    totals = kept.agg(F.count_if(F.col("_size") >= 0).alias("n"), F.avg("n_words").alias("avg_words"))
    return (found if few else join_lookup(found, terms, "term", F.col("id"), small)), totals


def _texts(corpus: DataFrame, id: str, text: str, task_texts: int, listed: list[str] | None = None) -> DataFrame:
    """``(id, n_words, words)``, a row per text with its words as a map to their numbers; of the ``listed`` words only, if given.

    A text is counted in its row, so no task of the scan holds more than that. Rows of one id then come together, in partitions of
    about ``task_texts`` rows however large the corpus is: what is done per id needs no other exchange, and all readers share this one.
    """
    wanted = (lambda t: t.isin(listed)) if listed else (lambda t: F.lit(False)) if listed is not None else (lambda t: t != "")
    # step by step: what is used twice is a column first
    cut = corpus.filter(F.col(text).isNotNull()).select(F.col(id).alias("id"), tokens(text).alias("_tokens"))
    cut = cut.select("id", token_count("_tokens").alias("n_words"), F.filter("_tokens", wanted).alias("_tokens"))
    partitions = max(corpus.sparkSession.sparkContext.defaultParallelism, -(-corpus.count() // task_texts))
    return cut.select("id", "n_words", word_counts(F.col("_tokens")).alias("words")).repartition(partitions, "id")


def _text_words(texts: DataFrame) -> DataFrame:
    """``(id, n_words, term, tf)`` of ``_texts``, a row per word of an id; needs no further exchange."""
    # the outer form leaves out the filter that would make another exchange of this one
    words = texts.select("id", "n_words", F.explode_outer("words").alias("term", "_n")).filter(F.col("term").isNotNull())
    return words.groupBy("id", "n_words", "term").agg(F.sum("_n").alias("tf"))


def word_index(corpus: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """Words counted per text, for storage partitioned by ``bucket`` next to ``corpus_totals``."""
    return _counted(_words(corpus, id, text)).withColumn("bucket", word_bucket())


def word_bucket() -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(WORD_BUCKETS)).cast("int")


def indexed_topk(
    queries: DataFrame, index: DataFrame, totals: DataFrame, k: int = 5, qid: str = "qid", text: str = "text"
) -> DataFrame:
    """As ``keyword_topk`` on a stored ``word_index``: reads the buckets of the query words, no text."""
    wanted = query_terms(queries, qid, text)
    small = fits(wanted)
    terms = wanted.select("term").distinct()
    if small:
        # joining on the bucket as well lets Spark skip the partitions that no query word falls into
        keyed = F.broadcast(terms.withColumn("bucket", word_bucket()))
        hits = index.join(keyed, ["bucket", "term"]).drop("bucket")
    else:
        hits = join_lookup(index.drop("bucket"), terms, "term", F.col("id"), small)
    return _rank_hits(wanted, hits, totals, k, small)


def _rank_hits(
    wanted: DataFrame, hits: DataFrame, totals: DataFrame, k: int, small: bool
) -> DataFrame:
    """Score counted words and keep the best texts per query."""
    return top_k(_score_hits(wanted, hits, totals, small), k)


def _score_hits(wanted: DataFrame, hits: DataFrame, totals: DataFrame, small: bool, together: bool = False) -> DataFrame:
    """Scores of all texts with counted words. ``together``: the words of a text lie in one partition already.

    What is shuffled grows with the matching words and not with queries times texts: the queries are
    multiplied in after the words of a text have come together, and the top-k cut precedes the last exchange.
    """
    total = totals.select(F.struct("n", "avg_words")).scalar()
    # counting through tf keeps this branch equal to the one below, so its exchange is reused
    frequencies = hits.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    weight = bm25(F.col("tf"), F.col("df"), F.col("n_words"), total["n"], total["avg_words"])
    weighted = join_lookup(hits, frequencies, "term", F.col("id"), small).select(
        "id", "term", weight.alias("weight")
    )
    # one exchange brings the words of a text together, the per-query sums reuse it
    return (
        join_lookup(weighted if together else weighted.repartition("id"), wanted, "term", F.col("id"), small)
        .groupBy("qid", "id")
        .agg(F.round(F.sum("weight"), SCORE_DIGITS).alias("score"))
    )


def bm25(tf: Column, df: Column, n_words: Column, n_texts: Column, avg_words: Column) -> Column:
    idf = F.log(1 + (n_texts - df + 0.5) / (df + 0.5))
    norm = BM25_K1 * (1 - BM25_B + BM25_B * n_words / avg_words)
    return idf * tf * (BM25_K1 + 1) / (tf + norm)


# --- both ---------------------------------------------------------------------------------------


def fuse(rankings: list[DataFrame], k: int = 5) -> DataFrame:
    """Reciprocal-rank fusion of several rankings of the same queries and ids."""
    votes = rankings[0].select("qid", "id", "rank")
    for other in rankings[1:]:
        votes = votes.unionByName(other.select("qid", "id", "rank"))
    fused = votes.groupBy("qid", "id").agg(
        F.round(F.sum(1 / (F.lit(float(RRF_K)) + F.col("rank"))), 9).alias("score")
    )
    return top_k(fused, k)


def hybrid_exact(
    queries: DataFrame, corpus: DataFrame, k: int = 5, filters: dict | None = None,
    id: str = "id", text: str = "text", vector: str = "embedding",
) -> DataFrame:
    """Fusion of the two whole rankings, without a depth: ``(qid, id, score, rank)``.

    A text among the first ``k`` of either ranking scores at least ``1 / (RRF_K + k)``. One that is behind place
    ``2 k + RRF_K`` in both scores less, so the candidates are those before it. A candidate's place in the other ranking, however far
    down, is counted: how many texts come ahead of it.
    """
    depth = 2 * k + RRF_K
    corpus = with_filters(corpus, filters)
    near = vector_topk(queries, corpus, depth, None, "qid", id, vector).select("qid", "id", F.lit("v").alias("kind"), "rank")
    hits = cut_lineage(keyword_scores(queries, corpus, None, "qid", id, text))
    said = top_k(hits, depth).select("qid", "id", F.lit("w").alias("kind"), "rank")
    known = cut_lineage(near.unionByName(said))
    pairs = known.groupBy("qid", "id").agg(F.collect_set("kind").alias("kinds")).filter(F.size("kinds") == 1)
    lacking = lambda kind: pairs.filter(~F.array_contains("kinds", kind)).select("qid", "id")
    by_vector = _vector_places(lacking("v"), queries, corpus, id, vector)
    by_word = _places(sized(lacking("w")).join(hits, ["qid", "id"]), hits)
    votes = known.select("qid", "id", "rank").unionByName(by_vector).unionByName(by_word)
    return fuse([votes], k)


def _places(candidates: DataFrame, scored: DataFrame) -> DataFrame:
    """``(qid, id, rank)`` of candidates ``(qid, id, score)`` among all ``scored`` rows of their query.

    The candidates travel to the tasks, in order of their scores; a batch of scored rows is looked up among them, and only the counts
    are shuffled.
    """
    table = candidates.toArrow()  # at most the depth for each query
    if not table.num_rows:
        return candidates.select("qid", "id", F.lit(1).alias("rank"))
    groups, scores, ids = _grouped(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(scores), np.int64)
        for batch in batches:
            coded = batch.column("qid").dictionary_encode(null_encoding="encode")
            codes, names, found = coded.indices.to_numpy(), sortable(batch.column("id")), batch.column("score").to_numpy()
            order = np.argsort(codes, kind="stable")
            ends = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
            for code, q in enumerate(coded.dictionary.to_pylist()):
                if q in groups:
                    own = order[ends[code] : ends[code + 1]]
                    _add_ahead(totals, groups[q], scores, ids, found[own], names[own])
        yield _counts(totals)

    return _ranked(candidates.sparkSession, table, scored.select("qid", "id", "score").mapInArrow(count, "at long, n long"))


def _grouped(candidates: pa.Table) -> tuple[dict, np.ndarray, np.ndarray]:
    """Rows of the candidates by query, their scores, their ids."""
    groups: dict = {}
    for at, q in enumerate(candidates.column("qid").to_pylist()):
        groups.setdefault(q, []).append(at)
    ids = sortable(candidates.column("id").combine_chunks())
    return {q: np.array(of) for q, of in groups.items()}, candidates.column("score").to_numpy(), ids


def _counts(totals: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(totals)
    return pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], names=["at", "n"])


def _ranked(spark: SparkSession, candidates: pa.Table, counts: DataFrame) -> DataFrame:
    """``(qid, id, rank)`` of the candidates from what each task counted ahead of them."""
    ranks = spark.createDataFrame(candidates.select(["qid", "id"]).append_column("_at", pa.array(range(candidates.num_rows))))
    summed = counts.groupBy("at").agg(F.sum("n").alias("n"))
    joined = ranks.join(F.broadcast(summed), F.col("_at") == F.col("at"), "left")
    return joined.select("qid", "id", (F.coalesce("n", F.lit(0)) + 1).cast("int").alias("rank"))


def _add_ahead(
    totals: np.ndarray, members: np.ndarray, scores: np.ndarray, ids: np.ndarray, found: np.ndarray, known: np.ndarray
) -> None:
    """Add to the totals of the members how many of the rows ``(known, found)``, ids and scores of one query, come ahead of each."""
    order = np.argsort(found, kind="stable")
    sorted_scores, mine = found[order], scores[members]
    low, high = np.searchsorted(sorted_scores, mine, "left"), np.searchsorted(sorted_scores, mine, "right")
    totals[members] += len(found) - high
    for k in np.flatnonzero(high > low):
        totals[members[k]] += _before(known[order[low[k] : high[k]]], ids[members[k]])


def _vector_places(pairs: DataFrame, queries: DataFrame, corpus: DataFrame, id: str, vector: str) -> DataFrame:
    """``(qid, id, rank)`` of the pairs in the whole vector rankings of their queries; pairs without comparable vectors have none."""
    asked = queries.filter(F.col(vector).isNotNull()).select("qid", F.col(vector).cast("array<double>").alias("_q"))
    rows = corpus.filter(F.col(vector).isNotNull()).select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    met = rows.join(sized(pairs), "id").join(asked, "qid").filter(F.size("_q") == F.size("vector"))
    product = F.aggregate(F.zip_with("_q", "vector", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    candidates = cut_lineage(met.select("qid", "id", F.round(product, SCORE_DIGITS).alias("score")).filter("not isnan(score)"))
    table = candidates.join(asked, "qid").toArrow()  # at most twice the depth for each query
    counts = _ahead(rows, table) if table.num_rows else None
    if counts is None:
        return candidates.select("qid", "id", F.lit(1).alias("rank"))
    return _ranked(candidates.sparkSession, table, counts)


def _ahead(rows: DataFrame, candidates: pa.Table) -> DataFrame:
    """``(at, n)``: for the candidate in each row of the table, how many vectors of a task come ahead of it."""
    groups, scores, ids = _grouped(candidates)
    members = list(groups.values())
    vectors = [np.array(candidates.column("_q")[int(of[0])].as_py(), float) for of in members]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(scores), np.int64)
        for batch in batches:
            for length, at in by_length(batch.column("vector")):
                asking = [n for n, v in enumerate(vectors) if len(v) == length]
                if not asking:
                    continue
                taken = pa.array(at)
                own = np.round(matrix_of(batch.column("vector").take(taken)) @ np.array([vectors[n] for n in asking]).T, SCORE_DIGITS)
                names = sortable(batch.column("id").take(taken))
                for column, n in enumerate(asking):
                    found = own[:, column]
                    there = np.isfinite(found)
                    _add_ahead(totals, members[n], scores, ids, found[there], names[there])
        yield _counts(totals)

    return rows.mapInArrow(count, "at long, n long")


def _before(ids: np.ndarray, one) -> int:
    """How many ids sort before ``one``, null first."""
    if one is None:
        return 0
    if ids.dtype != object:
        return int(np.count_nonzero(ids < one))
    return sum(i is None or i < one for i in ids.tolist())


def search(
    queries: DataFrame,
    corpus: DataFrame,
    columns: list[str] | None = None,
    num_results: int = 5,
    filters: dict | None = None,
    query_type: str = "hybrid",
    depth: int | None = 50,
    id: str = "id",
    text: str = "text",
    vector: str = "embedding",
) -> DataFrame:
    """Search a corpus with ``(qid, text, embedding)`` queries, hybrid or semantic only (``ann``).

    Returns the asked-for corpus columns next to query, score and rank. A hybrid search fuses two rankings of
    ``depth`` hits, or of ``num_results`` where more are asked for; ``depth=None`` fuses the whole rankings.
    """
    if query_type == "hybrid" and depth is None:
        found = hybrid_exact(queries, corpus, num_results, filters, id, text, vector)
    elif query_type == "ann":
        found = vector_topk(queries, corpus, num_results, filters, "qid", id, vector)
    elif query_type == "hybrid":
        depth = max(depth, num_results)
        by_vector = vector_topk(queries, corpus, depth, filters, "qid", id, vector)
        by_word = keyword_topk(queries, corpus, depth, filters, "qid", id, text)
        found = fuse([by_vector, by_word], num_results)
    else:
        raise ValueError(f"unknown query type: {query_type}")
    wanted = columns or [id, text]
    # hits are few, but Spark cannot know that before it has started to shuffle the corpus
    found = sized(found.select("qid", F.col("id").alias("_id"), "score", "rank"))
    return found.join(corpus, F.col("_id") == F.col(id)).select("qid", *wanted, "score", "rank")


def tfidf_vectors(
    df: DataFrame, dims: int = 256, text: str = "text", vector: str = "embedding", id: str = "id"
) -> DataFrame:
    """A vector per text without a model service: signed hashed word counts, weighted by rarity, unit length.

    The md5 of a word names its position and its sign, so words that share a position cancel out rather than add up.
    Texts without words get the zero vector.
    """
    values = tfidf_entries(df, dims, text, id)
    rows = values.groupBy(F.col("id").alias("_id")).agg(F.map_from_entries(F.collect_list(F.struct("position", "value"))).alias("_at"))
    at = F.coalesce("_at", F.create_map().cast("map<int,double>"))
    whole = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda p: F.coalesce(F.try_element_at(at, p), F.lit(0.0)).cast("float"))
    return df.join(rows, F.col(id) == F.col("_id"), "left").select(*df.columns, whole.alias(vector))


def tfidf_entries(df: DataFrame, dims: int = 256, text: str = "text", id: str = "id") -> DataFrame:
    """``(id, position, value)``: the entries other than zero of ``tfidf_vectors``, rounded to ``SCORE_DIGITS``."""
    counted = _text_words(_texts(df, id, text, TASK_TEXTS))
    total = df.select(F.count("*").alias("n")).scalar()
    rarity = lambda df: F.log((total + 1) / (df + 1)) + 1
    hashed = F.md5("term")
    position = (F.conv(F.left(hashed, F.lit(8)), 16, 10).cast("long") % dims).cast("int")
    sign = F.when(F.conv(F.substring(hashed, 9, 1), 16, 10).cast("int") % 2 == 0, 1.0).otherwise(-1.0)
    # words of one text only, most of a large vocabulary, need no join; the others are hashed once and not once per text
    frequencies = counted.groupBy("term").agg(F.count("*").alias("df")).filter(F.col("df") > 1)
    shared = cut_lineage(frequencies.select("term", position.alias("_position"), (sign * rarity(F.col("df"))).alias("_weight")))
    met = counted.join(F.broadcast(shared) if fits(shared) else shared, "term", "left")
    x = F.col("tf") * F.coalesce("_weight", sign * rarity(F.lit(1)))
    words = met.select("id", F.coalesce("_position", position).alias("position"), x.alias("x"))
    summed = words.groupBy("id", "position").agg(F.sum("x").alias("x"))
    length = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("id")))
    unit = summed.select("id", "position", F.round(F.col("x") / length, SCORE_DIGITS).alias("value"))
    return unit.filter("value <> 0")


def sync_index(index: DataFrame, feed: DataFrame, embed, key: str = "id") -> DataFrame:
    """The vector index after a change feed of its text table: only changed rows are embedded anew."""
    feed = cut_lineage(feed)
    changed = feed.filter(F.col("_change_type").isin("insert", "update_postimage"))
    entering = embed(changed.drop("_change_type"))
    kept = without_keys(index, feed, key)
    return kept.unionByName(entering.select(*index.columns))
