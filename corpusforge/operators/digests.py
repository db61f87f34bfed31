"""Change feeds between stored versions: digests of each version are kept bucketed by key, so only they are compared.

A version's digests are written once, when the version is. A later run reads the digests of two versions, bucket by
bucket and without a shuffle, and then fetches the payload of the changed keys in one scan per version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.operators.upsert import row_hash
from corpusforge.scaling import cut_lineage, fits

BUCKETS = 64


def store_digests(df: DataFrame, key: str, name: str, buckets: int = BUCKETS) -> DataFrame:
    """Digests ``(_key, _hash)`` of all rows of ``df`` as the catalog table ``name``, one row per version of a key."""
    rows = df.select(F.col(key).alias("_key"), row_hash(df, key).alias("_hash"))
    rows.write.bucketBy(buckets, "_key").sortBy("_key").saveAsTable(name)
    return df.sparkSession.table(name)


def touched_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(_key)`` of all keys whose versions differ between two tables of digests.

    A side has one row of fixed size per key: how many versions, and sums over their digests in which no two sets of
    versions will agree by chance (128 bits). Both aggregates and the join run on the buckets as they are stored. A null key is always reported.
    """

    def side(df: DataFrame, suffix: str) -> DataFrame:
        versions = df.groupBy("_key", "_hash").agg(F.lit(1).alias("_one"))
        lane = lambda at: F.conv(F.substring(F.hex("_hash"), at, 15), 16, 10).cast("decimal(38,0)")
        return versions.groupBy("_key").agg(F.count("*").alias(f"n_{suffix}"), F.sum(lane(1)).alias(f"x_{suffix}"), F.sum(lane(17)).alias(f"y_{suffix}"))

    both = side(old, "then").join(side(new, "now"), "_key", "full_outer")
    same = [F.col(f"{c}_then").eqNullSafe(F.col(f"{c}_now")) for c in "nxy"]
    return both.filter(~(same[0] & same[1] & same[2])).select("_key")


def compare_digests(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(_key, _hash, _change_type)`` of all versions of the keys whose versions differ. Only these keys' digests are shuffled."""
    touched = cut_lineage(touched_keys(old, new)).select(F.col("_key").alias("_touched"))
    touched = F.broadcast(touched) if fits(touched) else touched
    of_touched = lambda df: df.join(touched, F.col("_key").eqNullSafe(F.col("_touched")), "left_semi")
    sides = of_touched(old).withColumn("_new", F.lit(False)).unionByName(of_touched(new).withColumn("_new", F.lit(True)))
    versions = sides.groupBy("_key", "_hash").agg(F.bool_or("_new").alias("_now"), F.bool_or(~F.col("_new")).alias("_then"))
    same_key = Window.partitionBy("_key")
    judged = versions.select(
        "_key", "_hash", "_now", F.bool_or("_now").over(same_key).alias("_in_new"), F.bool_or("_then").over(same_key).alias("_in_old"),
        F.bool_or(F.col("_now") != F.col("_then")).over(same_key).alias("_differs"),
    )
    both = F.col("_in_new") & F.col("_in_old")
    kind = F.when(both & F.col("_now"), "update_postimage").when(both, "update_preimage").when(F.col("_now"), "insert").otherwise("delete")
    return judged.filter("_differs").select("_key", "_hash", kind.alias("_change_type"))


def feed_between(old: DataFrame, new: DataFrame, key: str, old_digests: DataFrame, new_digests: DataFrame) -> DataFrame:
    """As ``upsert.change_feed``, from stored digests: rows that turn ``old`` into ``new`` with their ``_change_type``."""
    changes = cut_lineage(compare_digests(old_digests, new_digests))
    few = fits(changes)

    def rows(df: DataFrame, kinds: list[str]) -> DataFrame:
        picked = changes.filter(F.col("_change_type").isin(kinds))
        keys = picked.select("_key").distinct()
        if few:
            picked, keys = F.broadcast(picked), F.broadcast(keys)
        # the key alone decides which rows are digested at all
        touched = df.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        own = touched.select("*", row_hash(df, key).alias("_own"))
        found = own.join(picked, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_hash")))
        return found.dropDuplicates([key, "_own"]).select(*df.columns, "_change_type")

    gone = rows(old, ["delete", "update_preimage"])
    return rows(new, ["insert", "update_postimage"]).unionByName(gone)
