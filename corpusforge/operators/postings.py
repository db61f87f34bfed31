"""Keyword search on stored postings, cut into blocks of texts that carry an upper score per word.

A block holds the postings of a group of texts. For each of its words the table ``peaks`` has the number of texts and the largest
score that a text of the block can draw from it. A search adds up these peaks per query and block, reads the
most promising blocks, and then only those blocks whose sum reaches the k-th score found: no other can hold a better text. The
result is that of a scan over all texts.

Texts that share their smallest word hash stand together, so texts of one language or about one thing
tend to meet in a block and whole blocks lack the words of a query. Hashes alone decide, so each run builds the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusforge.functions.text import tokens
from corpusforge.operators import search as S
from corpusforge.scaling import cut_lineage, fits, join_lookup

BLOCK_POSTINGS = 32_768
#: Postings are stored in folders of about this many, of which a search reads those with blocks it needs.
SLICE_POSTINGS = 1 << 22
MOST_SLICES = 1024
FIRST_BLOCKS = 4
MOST_FLAGS = 1024  # queries whose blocks are told to the tasks as flags
SLACK = 2 * 10.0**-S.SCORE_DIGITS  # scores are rounded


@dataclass
class PostingIndex:
    """Where an index stands: ``postings`` by slice, ``peaks`` by bucket of words, ``totals`` in one row, with the number of slices."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")


def _share(n_words: Column, tf: Column, avg_words: Column) -> Column:
    """What a word brings to the score of a text, without the weight of its rarity."""
    norm = S.BM25_K1 * (1 - S.BM25_B + S.BM25_B * n_words / avg_words)
    return tf * (S.BM25_K1 + 1) / (tf + norm)


def _rarity(df: Column, n_texts: Column) -> Column:
    return F.log(1 + (n_texts - df + 0.5) / (df + 0.5))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (slice, block, id, n_words, words) as a row per distinct word. A text is one row, so nothing has to be shuffled for it."""
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            words = pa.table({"text": pc.list_parent_indices(part["words"]), "term": pc.list_flatten(part["words"])})
            counts = words.group_by(["text", "term"]).aggregate([([], "count_all")])
            kept = [part[c].take(counts["text"]) for c in ("slice", "block", "id", "n_words")]
            columns = [*kept[:2], counts["term"], *kept[2:], counts["count_all"]]
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield from pa.table(columns, names=["slice", "block", "term", "id", "n_words", "tf"]).to_batches(max_chunksize=50_000)


def build(
    corpus: DataFrame, folder: str, id: str = "id", text: str = "text", block_postings: int = BLOCK_POSTINGS, slices: int | None = None
) -> PostingIndex:
    """Store the postings of all texts. ``block_postings``: about how many postings a block holds.

    A group of texts with one smallest hash that is larger than a block is split by the hash of the id; smaller groups
    share blocks. Texts without words count in the totals and have no postings.
    """
    spark = corpus.sparkSession
    index = PostingIndex(spark, folder)
    cut = corpus.select(F.col(id).alias("id"), F.filter(tokens(text), lambda t: t != "").alias("words"))
    least = F.array_min(F.transform("words", lambda t: F.xxhash64(t)))
    # one select ahead of what follows, which would otherwise work this out again
    texts = cut.select("id", "words", F.size("words").alias("n_words"), least.alias("least")).filter("words is not null")

    # how many postings a hash has, from the texts alone
    sized = texts.select("least", "n_words", F.size(F.array_distinct("words")).alias("n"))
    groups = cut_lineage(sized.groupBy("least").agg(F.count("*").alias("texts"), F.sum("n_words").alias("words"), F.sum("n").alias("n")))
    sums = groups.agg(F.sum("n"), F.sum(F.when(F.col("n") < block_postings, F.col("n"))), F.sum("texts"), F.sum("words")).first()
    slices = slices or max(1, min(MOST_SLICES, (sums[0] or 0) // SLICE_POSTINGS))
    average = sums[3] / sums[2] if sums[2] else None
    totals = "n long, avg_words double, slices int"
    spark.createDataFrame([(sums[2] or 0, average, slices)], totals).write.parquet(f"{folder}/totals")
    shared = max(1, -(-(sums[1] or 0) // block_postings))
    large = groups.filter(F.col("n") >= block_postings).select("least", F.ceil(F.col("n") / block_postings).alias("parts"))

    # texts are told their block before their words are taken apart; large groups are as many as blocks, at most
    split = texts.join(F.broadcast(large) if fits(large) else large, "least", "left")
    own = F.xxhash64(F.lit("group"), "least", F.pmod(F.xxhash64("id"), F.col("parts")))
    common = F.xxhash64(F.lit("shared"), F.pmod(F.xxhash64("least"), F.lit(shared)))
    placed = split.withColumn("block", F.when(F.col("parts").isNull(), common).otherwise(own))
    placed = placed.withColumn("slice", F.pmod("block", F.lit(slices)).cast("int")).select("slice", "block", "id", "n_words", "words")
    schema = T.StructType([placed.schema[c] for c in ("slice", "block")] + [T.StructField("term", T.StringType())])
    schema = T.StructType([*schema.fields, placed.schema["id"], placed.schema["n_words"], T.StructField("tf", T.LongType())])
    postings = placed.filter("n_words > 0").mapInArrow(_counted, schema)
    ordered = postings.hint("rebalance", "slice").sortWithinPartitions("slice", "term", "block")
    ordered.write.partitionBy("slice").parquet(f"{folder}/postings")

    average = index.table("totals").select("avg_words").scalar()
    peak = F.max(_share(F.col("n_words"), F.col("tf"), average))
    peaks = index.table("postings").groupBy("term", "block").agg(F.count("*").alias("n"), peak.alias("peak"))
    peaks = peaks.withColumn("bucket", S.word_bucket())
    peaks.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{folder}/peaks")
    return index


def reading_plan(queries: DataFrame, index: PostingIndex, qid: str = "qid", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(qid, block, slice, bound)`` for every block with a word of the query, and ``(qid, term, weight)``."""
    wanted = S.query_terms(queries, qid, text)
    keyed = wanted.select("term").distinct().withColumn("bucket", S.word_bucket())
    small = fits(keyed)
    stored = index.table("peaks")
    # the bucket in the key lets Spark skip the folders that no query word falls into
    peaks = stored.join(F.broadcast(keyed), ["bucket", "term"]) if small else stored.join(keyed, ["bucket", "term"])
    total = index.table("totals").select("n").scalar()
    rare = peaks.groupBy("term").agg(_rarity(F.sum("n"), total).alias("weight"))
    weights = cut_lineage(wanted.join(rare, "term"))
    weights_fit = fits(weights)
    bounds = join_lookup(peaks.select("term", "block", "peak"), weights, "term", F.col("block"), weights_fit)
    bounds = bounds.groupBy("qid", "block").agg(F.sum(F.col("peak") * F.col("weight")).alias("bound"))
    slices = index.table("totals").select("slices").scalar()
    return cut_lineage(bounds.withColumn("slice", F.pmod("block", slices).cast("int"))), weights


def _numbers(pairs: DataFrame) -> DataFrame:
    """``(qid, _n)``: the queries numbered from 0."""
    return pairs.select("qid").distinct().withColumn("_n", F.row_number().over(Window.orderBy("qid")) - 1)


def _asked_blocks(pairs: DataFrame) -> DataFrame | None:
    """``(slice, block, _asked)``: for every block a flag per query that looks into it; none for very many queries."""
    numbers = cut_lineage(_numbers(pairs).limit(MOST_FLAGS + 1))
    n = numbers.count()
    if not 0 < n <= MOST_FLAGS:
        return None
    those = pairs.join(F.broadcast(numbers), "qid").groupBy("slice", "block").agg(F.collect_set("_n").alias("_set"))
    flags = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.array_contains("_set", i))
    return cut_lineage(those.select("slice", "block", flags.alias("_asked")))


def score_blocks(pairs: DataFrame, weights: DataFrame, index: PostingIndex) -> DataFrame:
    """``(qid, id, score)``: whole scores of the texts in the blocks ``(qid, block, slice)``."""
    needed = pairs.select("qid", "block", "slice").join(weights, "qid")
    needed = needed.select("slice", "block", "term", "qid", "weight")
    few = fits(needed)
    average = index.table("totals").select("avg_words").scalar()
    postings = index.table("postings")
    asked = None if few else _asked_blocks(pairs)
    if asked is not None and fits(asked) and fits(weights):
        # blocks, words and queries are too many together; apart they are not, and no posting is shuffled for them
        numbered = F.broadcast(weights.join(F.broadcast(_numbers(pairs)), "qid"))
        hits = postings.join(F.broadcast(asked), ["slice", "block"]).join(numbered, "term").filter(F.get("_asked", F.col("_n")))
    else:
        hits = postings.join(F.broadcast(needed) if few else needed, ["slice", "block", "term"])
    drawn = F.col("weight") * _share(F.col("n_words"), F.col("tf"), average)
    return hits.groupBy("qid", "id").agg(F.round(F.sum(drawn), S.SCORE_DIGITS).alias("score"))


def blocked_topk(
    queries: DataFrame, index: PostingIndex, k: int = 5, qid: str = "qid", text: str = "text", first: int = FIRST_BLOCKS
) -> DataFrame:
    """As ``keyword_topk`` over the indexed texts, reading only blocks that can change the result."""
    found, _, _ = _search(queries, index, k, qid, text, first)
    return found


def _search(
    queries: DataFrame, index: PostingIndex, k: int, qid: str, text: str, first: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The result, all (query, block) pairs, and the pairs that were read."""
    bounds, weights = reading_plan(queries, index, qid, text)
    order = Window.partitionBy("qid").orderBy(F.desc("bound"), "block")
    ranked = bounds.withColumn("place", F.row_number().over(order))
    head = ranked.filter(F.col("place") <= first)
    best = cut_lineage(S.top_k(score_blocks(head, weights, index), k))
    floors = best.filter(F.col("rank") == k).select("qid", F.col("score").alias("floor"))
    floors = F.broadcast(floors) if fits(floors) else floors
    more = bounds.join(floors, "qid", "left").filter(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - SLACK))
    more = more.join(head.select("qid", "block"), ["qid", "block"], "left_anti").select(*bounds.columns)
    more = cut_lineage(more)
    read = head.select(*bounds.columns).unionByName(more)
    rest = score_blocks(more, weights, index)
    return S.top_k(best.drop("rank").unionByName(rest), k), bounds, read
