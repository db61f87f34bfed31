"""The operators as queries over the given tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import (
    chat,
    extraction,
    fingerprints,
    mixing,
    neardup,
    packing,
    quality,
    spelling,
    substrings,
    toxicity,
    vectors,
    warc,
    whitening,
)
from corpusforge.llm.storage import stored

_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    """The public vocabulary file of the contract; it stays where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), width=4)


@query
def op2_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return quality.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_subset_sum_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op9_relative_lz_substrings(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op10_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query
def op3_lz_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, folder, "documents"))


@query
def op6_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query
def op4_pq_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query
def op5_crf_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_max_subsequence(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.main_texts(table(spark, folder, "pages"))


@query
def op11_spectrum_whitening(spark: SparkSession, folder: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, folder, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").cast("long"))


def misprint(doc_id: Column, run: Column) -> Column:
    """The run as the contract has it counted: in one of 199, told by a checksum, a code point is missing."""
    seed = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (seed % F.char_length(run)).cast("int")
    shorter = F.concat(F.left(run, at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(seed % 199 == 0, shorter).otherwise(run)


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.count_words(table(spark, folder, "documents"), misprint))


@query
def op13_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by turn, and one conversation that comes as a prompt with its response."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    record = F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"})
    said = "</s>[INST] ok [/INST]"
    added = F.to_json(F.struct(F.lit(said).alias("prompt"), F.lit(said).alias("response")))
    other = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), added.alias("record"))
    records = rows.select("conv_id", "turn", record.alias("record")).unionByName(other)
    pieces = stored(chat.format_turns(chat.canonical_turns(records)), "chat-pieces")
    return chat.digests(chat.read_back(pieces))
