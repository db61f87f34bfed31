"""Keyed changes between tables: new keys, insert-only merge, change feed and its application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.scaling import cut_lineage, fits


def new_keys_only(source: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is not there yet. A null key is never there and stays."""
    return source.join(existing.select(key), key, "left_anti")


def merge_insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The target after inserting the source rows whose key it lacks; columns are aligned by name."""
    return target.unionByName(new_keys_only(source, target, key), allowMissingColumns=True)


def row_hash(df: DataFrame, key: str) -> Column:
    """Digest of all columns but the key. Going through JSON keeps null and empty apart."""
    fields = F.struct(*[F.col(c) for c in sorted(df.columns) if c != key])
    return F.unhex(F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256))


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``(key, _hash, _change_type)`` for the row versions of every key whose versions differ between the sides.

    A version is present or absent, however many copies it has. A key that is on both sides gives its vanished
    versions as preimages and all versions it has now as postimages, so that applying the feed loses none of them.
    Only keys and digests are shuffled, never the payload, and versions are aggregated rather than joined.
    """

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(key, row_hash(df, key).alias("_hash"), F.lit(sign).alias("_side"))

    versions = (
        side(old, -1)
        .unionByName(side(new, 1))
        .groupBy(key, "_hash")
        .agg(F.bool_or(F.col("_side") > 0).alias("_now"), F.bool_or(F.col("_side") < 0).alias("_then"))
    )
    sides = versions.groupBy(F.col(key).alias("_key")).agg(
        F.bool_or("_now").alias("_in_new"),
        F.bool_or("_then").alias("_in_old"),
        F.bool_or(F.col("_now") != F.col("_then")).alias("_touched"),
    )
    both = F.col("_in_new") & F.col("_in_old")
    return versions.join(sides.filter("_touched"), F.col(key).eqNullSafe(F.col("_key"))).select(
        key,
        "_hash",
        F.when(both & F.col("_now"), "update_postimage")
        .when(both, "update_preimage")
        .when(F.col("_now"), "insert")
        .otherwise("delete")
        .alias("_change_type"),
    )


def change_feed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows that turn ``old`` into ``new``: insert, update_preimage, update_postimage and delete.

    Copies of one row count as one row. The changed keys are worked out first; while they are few they are
    broadcast to both snapshots, so that no payload is shuffled to find them.
    """
    changes = cut_lineage(changed_keys(old, new, key))
    few = fits(changes)

    def rows(df: DataFrame, kinds: list[str]) -> DataFrame:
        picked = changes.filter(F.col("_change_type").isin(kinds)).select(
            F.col(key).alias("_key"), F.col("_hash").alias("_changed_hash"), "_change_type"
        )
        picked = F.broadcast(picked) if few else picked
        hashed = df.withColumn("_hash", row_hash(df, key))
        same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_changed_hash"))
        return (
            hashed.join(picked, same)
            .dropDuplicates([key, "_hash"])
            .select(*df.columns, "_change_type")
        )

    gone = rows(old, ["delete", "update_preimage"])
    return rows(new, ["insert", "update_postimage"]).unionByName(gone)


def without_keys(df: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """Rows whose key a (computed) change feed does not touch; a null key can be touched as well."""
    keys = feed.select(F.col(key).alias("_key")).distinct()
    keys = F.broadcast(keys) if fits(keys) else keys
    return df.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")


def apply_changes(target: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """The target after a change feed: touched keys leave, inserts and postimages enter."""
    feed = cut_lineage(feed)
    kept = without_keys(target, feed, key)
    entering = feed.filter(F.col("_change_type").isin("insert", "update_postimage"))
    return kept.unionByName(entering.select(*target.columns))
