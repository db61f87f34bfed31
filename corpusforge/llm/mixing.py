"""Mixing sources to target weights by fitting word budgets with subset sums over document lengths.

Targets are filled like water: each source gets its share by weight but at most ``max_repeats`` times its size, and what
is over goes to the others by weight. A source then takes every document as many whole times as fits, and fits the rest
of its budget exactly: documents are counted by length, each length gives its proportional part, and what is left is
closed by bounded-knapsack dynamic programming over lengths. Which documents of a length are taken is decided by a
seeded hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm import wordarrays as wa
from corpusforge.llm.storage import stored

WEIGHTS = (5.0, 2.0, 1.0)
TRAIL_BITS = 1 << 30  # of all bit sets that a source keeps for the way back
CELLS = 65536


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, a text, by its number of words."""
    for batch in batches:
        sizes = [np.empty(0, np.int64)]
        for _, _, data, offsets in wa.slices(batch.column(batch.num_columns - 1)):
            sizes.append(np.diff(wa.word_spans(data, offsets)[2]))
        columns = [*batch.columns[:-1], pa.array(np.concatenate(sizes))]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "size"])


def fit_budget(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take, none more than there are, so that lengths sum up to ``budget`` or
    as near below it as subsets reach.

    Each length gives its proportional part, and the rest is a subset sum over what is free. Where that misses the budget, one, two,
    four ... documents of each length are given back and it is tried again, up to all of them.
    """
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if total == 0 or budget <= 0:
        return [0] * len(lengths)
    whole = [c * min(budget, total) // total for c in counts]
    best, nearest, back = whole, -1, 0
    while True:
        part = [max(0, w - back) for w in whole]
        found = _close_gap(lengths, counts, part, budget)
        reached = sum(n * t for n, t in zip(lengths, found, strict=True))
        if reached > nearest:
            best, nearest = found, reached
        if nearest == min(budget, total) or not any(part):
            return best
        back = 2 * back or 1


def _close_gap(lengths: list[int], counts: list[int], taken: list[int], budget: int) -> list[int]:
    """``taken`` with more documents, by subset sums over the whole gap as long as their bit sets fit in ``TRAIL_BITS``; of
    a wider gap (over 100,000 words with as many as 10,000 lengths) the longest documents take the excess."""
    taken = list(taken)
    rest = budget - sum(n * t for n, t in zip(lengths, taken, strict=True))
    exact = TRAIL_BITS // max(1, sum((c - t).bit_length() for n, c, t in zip(lengths, counts, taken, strict=True) if n))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        if rest <= exact:
            break
        more = min(counts[i] - taken[i], rest // lengths[i]) if lengths[i] else 0
        taken[i] += more
        rest -= more * lengths[i]
    # reachable sums as bits; items are powers of two of one length, so each bit set is one shift
    reach, mask = 1, (1 << (min(rest, exact) + 1)) - 1
    trail: list[tuple[int, int, int]] = []
    for i in order:
        free = min(counts[i] - taken[i], rest // lengths[i]) if 0 < lengths[i] <= rest else 0
        part = 1
        while free > 0 and not (reach >> rest) & 1:
            now = min(part, free)
            trail.append((i, now, reach))
            reach |= (reach << (lengths[i] * now)) & mask
            free -= now
            part *= 2
    at = reach.bit_length() - 1
    for i, n, before in reversed(trail):
        if not (before >> at) & 1:
            at -= lengths[i] * n
            taken[i] += n
    return taken


def plan_source(frame: pd.DataFrame) -> pd.DataFrame:
    """(source, size, copies, extra) from the length counts of one source; a row for each length."""
    frame = frame.sort_values("size")
    lengths, counts = frame["size"].astype(int).tolist(), frame["n"].astype(int).tolist()
    total, target = int(frame["source_size"].iloc[0]), float(frame["target"].iloc[0])
    limit = int(frame["max_repeats"].iloc[0])
    copies = min(int(target // total), limit) if total else 0
    budget = round(target) - copies * total if copies < limit else 0
    extra = fit_budget(lengths, counts, min(budget, total))
    return pd.DataFrame(
        {"source": frame["source"], "size": frame["size"], "copies": copies, "extra": extra}
    )


def source_targets(sizes: DataFrame, share: float, max_repeats: int, weights: tuple[float, ...]) -> DataFrame:
    """(source, source_size, target): ``target = min(max_repeats * size, level * weight)`` with one level for all."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    which = (F.row_number().over(order) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), which + 1))
    cap = (F.col("source_size") * max_repeats).cast("double")
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    leveled = weighted.withColumn("cap", cap).withColumn("level", level)
    # sources in the order of cap / weight are full until the level of those left stays below their cap; the level
    # rises up to there and falls behind it
    fits = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything)
    return leveled.select(
        "source", "source_size", F.least(F.col("cap"), F.coalesce(fits, F.lit(float("inf"))) * F.col("weight")).alias("target")
    )


def mix(
    docs: DataFrame, share: float = 1.5, max_repeats: int = 2, weights: tuple[float, ...] = WEIGHTS, seed: int = 17,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    ``size`` counts words; null and empty texts have none. Sources in code point order, null last, weigh ``weights`` in
    turn and share ``share`` of all words. ``copies`` is how often the mix holds the document, ``max_repeats`` at most,
    and ``taken`` the words that makes. The same rows and seed give the same mix; rows that repeat an id are mixed as
    rows of their own. No rows give no rows.
    """
    id_type, source_type = (docs.schema[c].dataType.simpleString() for c in (id_column, source_column))
    named = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), F.col(text_column).alias("text")
    )
    sizes = stored(
        named.mapInArrow(wa.tidy(count_words), f"doc_id {id_type}, source {source_type}, size long"), "sizes"
    )
    targets = stored(source_targets(sizes, share, max_repeats, weights), "targets")
    lengths = sizes.groupBy("source", "size").agg(F.count("*").alias("n"))
    same: Column = F.col("l.source").eqNullSafe(F.col("t.source"))
    planned = (
        lengths.alias("l").join(targets.alias("t"), same)
        .select("l.source", "l.size", "l.n", "t.source_size", "t.target", F.lit(max_repeats).alias("max_repeats"))
        .groupBy("source")
        .applyInPandas(plan_source, f"source {source_type}, size long, copies long, extra long")
    )
    # a third of all rows may share source and length: cells of the hash are counted first, and only the rows of
    # the one cell in which the number runs out are ranked
    hashed = sizes.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")).withColumn("cell", F.pmod("h", F.lit(CELLS)))
    keys = ["source", "size", "cell"]
    cells = hashed.groupBy(*keys).agg(F.count("*").alias("n"))
    running = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0)))
    match = lambda a, b, names: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in names]
    cells = stored(
        cells.alias("c").join(planned.alias("p"), match("c", "p", keys[:2]))
        .select("c.*", "p.copies", "p.extra"), "cells"
    )
    joined = hashed.alias("d").join(cells.alias("c"), match("d", "c", keys)).select(
        "d.*", "c.n", "c.before", "c.copies", "c.extra"
    )
    whole = F.col("before") + F.col("n") <= F.col("extra")
    cut = (F.col("before") < F.col("extra")) & ~whole
    plain = joined.filter(~cut).withColumn("more", whole.cast("long"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))
    ranked = joined.filter(cut).withColumn("more", (F.col("before") + rank <= F.col("extra")).cast("long"))
    chosen = plain.unionByName(ranked)
    copies = F.col("d.copies") + F.col("d.more")
    return chosen.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "d.doc_id", "d.source", "d.size", "t.source_size", "t.target",
        copies.alias("copies"), (copies * F.col("d.size")).alias("taken"),
    )
