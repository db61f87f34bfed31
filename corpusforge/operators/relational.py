"""Star join of contests, countries and entries, and the per-entity profiles built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.functions.text import slug

# Fixed value: the name of the contest as it stands in the summary text.
EVENT = "Eurovision"
WINNERS_PER_PART = 10_000

WINNER_FIELDS = ("year", "song_name", "artist_name", "language", "style")


def star_join(
    contest: DataFrame, country: DataFrame, song: DataFrame, key: str = "year"
) -> DataFrame:
    """Contest and entries, each with the region of its country, joined on ``key``.

    Inner joins throughout: rows whose country is not in the dimension drop out, see
    ``dropped_dimension_keys``. Join strategies are left to Catalyst: a dimension is broadcast only while
    its size stays below the session threshold, beyond it adaptive execution splits hot keys.
    """
    hosts = contest.join(
        country.select(F.col("country").alias("host"), F.col("region").alias("host_region")), "host"
    )
    participants = song.join(
        country.select("country", F.col("region").alias("participant_region")), "country"
    )
    return hosts.join(participants, key)


def dropped_dimension_keys(contest: DataFrame, country: DataFrame, song: DataFrame) -> DataFrame:
    """Country keys that the star join loses, with the number of rows behind each."""

    def lost(df: DataFrame, key: str, side: str) -> DataFrame:
        # counting first leaves one row per key for the anti join
        counted = df.groupBy(F.col(key).alias("country")).agg(F.count("*").alias("n"))
        return counted.join(country, "country", "left_anti").select(
            F.lit(side).alias("side"), F.col("country").alias("key"), "n"
        )

    return lost(contest, "host", "host").unionByName(lost(song, "country", "participant"))


def scoreboard(entries: DataFrame, min_participations: int = 5) -> DataFrame:
    """Ranked finishes per country, most participations and fewest wins first."""
    return (
        entries.filter(F.col("final_place").isNotNull())
        .groupBy("country")
        .agg(
            F.count("*").alias("participations"),
            F.sum(F.when(F.col("final_place") == 1, 1).otherwise(0)).alias("wins"),
            F.avg("final_place").alias("avg_place"),
        )
        .filter(F.col("participations") >= min_participations)
        .orderBy(F.desc("participations"), "wins", "country")
    )


def _yearly(entries: DataFrame, entity: str) -> DataFrame:
    """Entries pre-aggregated to one row per entity and year.

    The map side combines a hot entity to a few rows before the shuffle: sums, and sets as long as the code lists.
    """
    place = F.col("final_place")
    return entries.groupBy(F.col(entity).alias("entity"), "year").agg(
        F.count("*").alias("n"),
        F.count_if(place == 1).alias("n_won"),
        F.count(place).alias("n_placed"),
        F.sum(place).alias("place_sum"),
        F.min(place).alias("place_min"),
        # inside a struct a missing region counts, as the first one
        F.min(F.struct(F.col("participant_region").alias("region"))).alias("region"),
        F.collect_set("language").alias("languages"),
        F.collect_set("style").alias("styles"),
    )


def entity_profile(entries: DataFrame, entity: str = "country") -> DataFrame:
    """Participations, results, years, region, languages and styles per entity.

    ``years`` is the sorted list of years with its multiplicities, ``array<struct<year, n>>``: lossless,
    and as long as the calendar is, not as the entity. Languages and styles are bounded by their code
    lists in the same way. The winning entries, which have no such bound, come from ``winner_parts``.
    """
    return _profile(_yearly(entries, entity))


def _profile(yearly: DataFrame) -> DataFrame:
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return yearly.groupBy("entity").agg(
        F.sum("n").alias("participations"),
        F.sum("n_won").alias("wins"),
        F.bround(F.sum("place_sum") / F.sum("n_placed"), 1).alias("avg_place"),
        F.min("place_min").alias("best_place"),
        F.min(F.struct("year", "region"))["region"]["region"].alias("region"),
        every("languages").alias("languages"),
        every("styles").alias("styles"),
        F.array_sort(F.collect_list(F.struct("year", "n"))).alias("years"),
    )


def _combined(entries: DataFrame, entity: str) -> DataFrame:
    """Entries grouped once for both the profile and the winners: winning ones by all they show, the others by their codes.

    Every sum has a fixed width, so the map side combines a hot entity to few rows but for its winning entries. The first year
    of a group is null if any of its years is: missing years come first.
    """
    place, year = F.col("final_place"), F.col("year")
    won = F.coalesce(place == 1, F.lit(False))
    shown = [F.when(won, F.col(c)).alias(c) for c in ("year", "song_name", "artist_name")]
    grouped = entries.groupBy(
        F.col(entity).alias("entity"), F.col("participant_region").alias("region"), "language", "style", won.alias("_won"), *shown
    ).agg(
        F.count("*").alias("n"), F.count(place).alias("n_placed"), F.sum(place).alias("place_sum"), F.min(place).alias("place_min"),
        F.count_if(year.isNull()).alias("_unknown"), F.min(year).alias("_from"), F.max(year).alias("_to"),
    )
    first = F.when(F.col("_unknown") == 0, F.col("_from"))
    return grouped.withColumn("_first", first)


def _grouped(combined: DataFrame, per_part: int) -> DataFrame:
    """Rows of ``_combined`` dealt out once by entity, to one row of sums, codes and winners per entity.

    An entity with more than ``per_part`` wins has a row per year and hash of its winners, as ``winner_parts`` cuts them, and one of its
    other entries. Windows keep the rows of an entity on disk where memory ends. Equal winners of two regions are packed by region.
    """
    # very many copies are dealt out as well, in packs of per_part; a winning entry has placement 1
    packs = F.when(F.col("_won"), F.call_function("div", F.col("n") - 1, F.lit(per_part))).otherwise(0)
    of_pack = lambda c: F.when(
        F.col("_won"), F.least(F.lit(per_part), F.col("n") - F.col("_pack") * per_part)
    ).otherwise(F.col(c))
    packed = (
        combined.repartition("entity")
        .withColumn("_pack", F.explode(F.sequence(F.lit(0).cast("long"), packs)))
        .withColumns({c: of_pack(c) for c in ("n", "n_placed", "place_sum")})
        .withColumn("n_won", F.when(F.col("_won"), F.col("n")).otherwise(0))
    )
    # the order of the first window serves the second one as well
    counted = packed.withColumn("_in_year", F.sum("n_won").over(Window.partitionBy("entity", "year"))).withColumn(
        "_total", F.sum("n_won").over(Window.partitionBy("entity"))
    )
    apart = F.col("_won") & (F.col("_total") > per_part)
    parts = F.ceil(F.col("_in_year") / per_part).cast("long")
    cut = counted.withColumns(
        {
            "_year": F.when(apart, F.col("year")),
            "_parts": F.when(apart, parts),
            "_bucket": F.when(apart, F.pmod(F.xxhash64(*WINNER_FIELDS, "_pack"), parts)),
        }
    )
    codes = lambda c: F.sort_array(F.collect_set(c)).alias(f"{c}s")
    winners = F.collect_list(F.when(F.col("_won"), F.struct(*WINNER_FIELDS, F.col("n").cast("int").alias("copies"))))
    return cut.groupBy("entity", "_year", "_parts", "_bucket").agg(
        *[F.sum(c).alias(c) for c in ("n", "n_won", "n_placed", "place_sum")],
        F.min("place_min").alias("place_min"), F.min("_from").alias("_from"), F.max("_to").alias("_to"),
        F.min(F.struct("_first", "region")).alias("_region"), codes("language"), codes("style"),
        F.sort_array(winners).alias("_winners"),
    )


def _profiled(grouped: DataFrame) -> DataFrame:
    """Rows of ``_grouped`` with the whole profile of their entity and the number of their part; ``_leads`` on one row per entity."""
    in_order = Window.partitionBy("entity").orderBy("_year", "_bucket")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opens = F.col("_bucket").isNotNull() & ~(
        F.lag("_year").over(in_order).eqNullSafe(F.col("_year")) & F.lag("_bucket").over(in_order).isNotNull()
    )
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c).over(whole))))
    total = lambda c: F.sum(c).over(whole)
    profiled = grouped.withColumns(
        {
            "_leads": F.row_number().over(in_order) == 1,
            "_new": F.when(opens, F.col("_parts")).otherwise(0),
            "participations": total("n"),
            "wins": total("n_won"),
            "avg_place": F.bround(total("place_sum") / total("n_placed"), 1),
            "best_place": F.min("place_min").over(whole),
            "first_year": F.min("_from").over(whole),
            "last_year": F.max("_to").over(whole),
            "region": F.min("_region").over(whole)["region"],
            "languages": every("languages"),
            "styles": every("styles"),
        }
    )
    before = F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_parts")
    return profiled.withColumn("part", 1 + before + F.col("_bucket"))


def expand_years(years: Column) -> Column:
    """Plain sorted list with repeats, for entities known to be small."""
    return F.flatten(F.transform(years, lambda y: F.array_repeat(y["year"], y["n"].cast("int"))))


def winner_parts(
    entries: DataFrame, entity: str = "country", per_part: int = WINNERS_PER_PART
) -> DataFrame:
    """Winning entries per entity in year order, in parts of about ``per_part`` entries.

    Most entities have one part, number 0. An entity with more than ``per_part`` wins is split by year and,
    inside a year, by a hash of the entry, into parts 1, 2, ...: reading them in order gives every entry
    once and in year order, and no task ever holds all entries of a hot entity.
    """
    # copies of one entry are counted and not shuffled one by one
    won = (
        entries.filter(F.col("final_place") == 1)
        .groupBy(F.col(entity).alias("entity"), *WINNER_FIELDS)
        .agg(F.count("*").alias("copies"))
    )
    return _parts(won, per_part)


def _parts(won: DataFrame, per_part: int) -> DataFrame:
    by_year = won.groupBy("entity", "year").agg(F.sum("copies").alias("n"))
    per_entity = Window.partitionBy("entity")
    earlier = per_entity.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    layout = (
        by_year.withColumn("_total", F.sum("n").over(per_entity))
        .withColumn("_parts", F.ceil(F.col("n") / per_part).cast("long"))
        .select(
            F.col("entity").alias("_entity"),
            F.col("year").alias("_year"),
            "_total",
            "_parts",
            F.coalesce(F.sum("_parts").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    placed = won.join(
        layout,
        F.col("entity").eqNullSafe(F.col("_entity")) & F.col("year").eqNullSafe(F.col("_year")),
    )
    # very many copies are dealt out as well, in packs of per_part
    packs = F.call_function("div", F.col("copies") - 1, F.lit(per_part))
    packed = placed.withColumn("_pack", F.explode(F.sequence(F.lit(0).cast("long"), packs))).withColumn(
        "copies", F.least(F.lit(per_part), F.col("copies") - F.col("_pack") * per_part)
    )
    bucket = F.pmod(F.xxhash64(*WINNER_FIELDS, "_pack"), F.col("_parts"))
    part = F.when(F.col("_total") <= per_part, F.lit(0).cast("long")).otherwise(
        1 + F.col("_offset") + bucket
    )
    entry = F.struct(*WINNER_FIELDS)
    packs_in_order = F.array_sort(
        F.collect_list(F.struct(entry.alias("entry"), F.col("copies").cast("int").alias("copies")))
    )
    return (
        packed.groupBy("entity", part.alias("part"))
        .agg(F.sum("copies").alias("n_winners"), packs_in_order.alias("_packs"))
        .select(
            "entity",
            "part",
            "n_winners",
            F.flatten(
                F.transform("_packs", lambda p: F.array_repeat(p["entry"], p["copies"]))
            ).alias("winning_entries"),
        )
    )


def _shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def winner_list(winning_entries: Column) -> Column:
    return F.array_join(
        F.transform(
            winning_entries,
            lambda e: F.concat(
                F.lit("'"), _shown(e["song_name"]), F.lit("' by "), _shown(e["artist_name"]),
                F.lit(" ("), _shown(e["year"]), F.lit(", "), _shown(e["language"]), F.lit(", "),
                _shown(e["style"]), F.lit(")"),
            ),
        ),
        ", ",
    )


def _opening(event: str, tidy: bool) -> Column:
    return F.concat(
        F.col("entity"), F.lit(f" has participated in {event}{' ' if tidy else ''}"),
        F.col("participations"), F.lit(" times ("), _shown(F.col("first_year")), F.lit("–"),
        _shown(F.col("last_year")), F.lit("), representing "), _shown(F.col("region")), F.lit("."),
    )


def _closing(tidy: bool) -> Column:
    average = F.concat(F.lit(" Their average placement is "), F.col("avg_place"), F.lit(","))
    best = F.concat(F.lit(" with a best placement of "), F.col("best_place"), F.lit("."))
    blank = F.lit("" if tidy else " ")
    return F.concat(
        blank, F.coalesce(average, F.lit("")), blank, F.coalesce(best, F.lit("")),
        F.lit(" They have performed in: "), F.array_join("languages", ", "), F.lit("."),
        F.lit(" Their musical styles include: "), F.array_join("styles", ", "), F.lit("."),
    )


def entity_summary(
    entries: DataFrame,
    entity: str = "country",
    event: str = EVENT,
    per_part: int = WINNERS_PER_PART,
    tidy: bool = False,
) -> DataFrame:
    """One prose summary per entity as ``(chunk_id, part, text)``. Takes its entries once.

    An entity with at most ``per_part`` wins is one row, part 0. A larger one is an opening (part 0), its
    winner lists (parts 1, 2, ..., to be joined by a comma and a blank) and a closing (the last part).
    The default text keeps the blanks of the original wording; ``tidy`` puts them right.
    """
    opening, closing = _opening(event, tidy), _closing(tidy)
    won = F.concat(F.lit(" They have won "), F.col("wins"), F.lit(" time(s): "))
    entries_won = F.transform("_winners", lambda w: F.array_repeat(w, w["copies"]))
    lists = winner_list(F.flatten(entries_won))
    result = F.when(F.col("wins") > 0, F.concat(won, lists, F.lit("."))).otherwise(
        F.lit(" They have never won.")
    )

    def piece(part: Column, text: Column) -> Column:
        return F.struct(part.cast("long").alias("part"), text.alias("text"))

    zero, none = F.lit(0), F.array().cast("array<struct<part: bigint, text: string>>")
    ends = F.array(
        piece(zero, F.concat(opening, won)),
        # one part per started per_part wins of a year, so this number lies behind every winner list
        piece(F.col("wins") + 1, F.concat(F.lit("."), closing)),
    )
    pieces = F.when(
        F.col("wins") <= per_part, F.array(piece(zero, F.concat(opening, result, closing)))
    ).otherwise(
        F.concat(
            F.when(F.col("_leads"), ends).otherwise(none),
            F.when(F.col("_bucket").isNotNull(), F.array(piece(F.col("part"), lists))).otherwise(none),
        )
    )
    rows = _profiled(_grouped(_combined(entries, entity), per_part))
    # the outer form keeps Catalyst from working the texts out again in an inferred filter
    pieced = rows.select(slug("entity").alias("chunk_id"), F.inline_outer(pieces))
    return pieced.filter(F.col("part").isNotNull())
