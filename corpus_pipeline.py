"""From raw documents to packed training sequences in five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import mixing, neardup, packing, quality, substrings
from corpusforge.llm.queries import tokenizer_path
from corpusforge.llm.storage import stored
from corpusforge.scaling import folders_named, release

# None: sampling by noise, near-duplicate links, subset sums and token ids are nothing that SQL can state
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling against the labelled good texts keeps.

    Null and empty texts have weight 0 and stay; rows without id are judged by their texts alike, rows that repeat an id go together.
    Other columns are not looked at. No rows give no rows.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = quality.resample(docs, labels).filter("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more.

    The one with the smallest id stays, one row of it where rows repeat the id. Texts without words are no copies of anything; rows without id all
    stay. Other columns are not looked at. No rows give no rows.
    """
    kept = neardup.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id")
    named = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(docs.columns).union(docs.filter("doc_id is null"))


def _set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but the used ones under names that no operator has, and these names."""
    names = {c: c if c in used else f"aside_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def _as_before(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that start earlier; a text that has nothing else goes. Others stay as they are written.

    Null and empty texts and rows without id stay; rows that repeat an id lose the same words. Any other column is carried along,
    whatever its name; ``n_chars`` follows the text. No rows give no rows.
    """
    own, names = _set_aside(docs, "doc_id", "text")
    cut = substrings.remove_repeats(own, texts=True, carry=tuple(n for c, n in names.items() if c not in ("doc_id", "text")))
    cut = cut.filter("n_removed = 0 or n_removed < n_words").withColumnRenamed("kept_text", "text")
    if "n_chars" in names:
        cut = cut.withColumn(names["n_chars"], F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return _as_before(cut, names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix holds it. Rows that share an id share the smaller number.

    Null and empty texts have no words, and are held as often as whole copies of their source are. A null source is one more source, a null
    id one more id. Ties go by a seeded hash, any other column is carried along, whatever its name. No rows give no rows.
    """
    own, names = _set_aside(docs, "doc_id", "text", "source")
    mixed = mixing.mix(own).groupBy(F.col("doc_id").alias("mixed_id")).agg(F.min("copies").alias("copies"))
    held = own.join(mixed.filter("copies > 0"), own["doc_id"].eqNullSafe(mixed["mixed_id"]))
    return _as_before(held.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), names)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences whose windows hold all sources in proportion.

    Null and empty texts are one end mark; repeated rows are packed each. Other columns are not looked at. No rows give no rows.
    """
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read by the next; returns the packed pieces.

    What a stage has stored on its way goes as soon as its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        since = len(folders_named())
        docs = stored(stage(spark, docs, sf_dir), name)
        release(spark, folders_named()[-1:], since)
    return STAGES[-1][1](spark, docs, sf_dir)
