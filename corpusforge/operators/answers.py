"""Scoring of answers in bulk: every scorer is a boolean column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import contains_any, word_count

# Word limit and terms of the two built-in checks.
MAX_WORDS = 400
COUNTRY_TERMS = [
    "norway", "sweden", "france", "uk", "united kingdom", "germany", "italy", "spain",
    "ireland", "finland", "ukraine", "portugal", "australia", "denmark", "greece", "switzerland",
]


def output_text(output: Column) -> Column:
    """Text of an answer given as JSON of any form.

    A string is its own text. Of a list, the first item counts: the ``text`` of an object, empty if it has none, any other item as it is
    written. Everything else, an empty list as well, counts as it is written; what is no JSON is plain text.
    """
    value = F.try_parse_json(output)
    kind = F.schema_of_variant(value)
    first = F.try_variant_get(value, "$[0]", "variant")
    of_first = F.schema_of_variant(first)
    item = F.when(F.startswith(of_first, F.lit("OBJECT")), F.coalesce(F.try_variant_get(value, "$[0].text", "string"), F.lit("")))
    written = F.to_json(value)
    return (
        F.when(value.isNull(), output)
        .when(kind == "STRING", F.variant_get(value, "$", "string"))
        .when(F.startswith(kind, F.lit("ARRAY")) & first.isNotNull(), F.coalesce(item, F.try_variant_get(value, "$[0]", "string"), F.to_json(first)))
        .otherwise(written)
    )


def word_count_check(text: Column) -> Column:
    return word_count(text) < MAX_WORDS


def mentions_countries(
    text: Column, terms: list[str] = COUNTRY_TERMS, whole_word: bool = False
) -> Column:
    return contains_any(text, terms, whole_word)


SCORERS: dict[str, Callable[[Column], Column]] = {
    "word_count_check": word_count_check,
    "mentions_countries": mentions_countries,
}


def score_answers(
    answers: DataFrame, text: str = "text", scorers: dict[str, Callable] | None = None, mixed: bool = False
) -> DataFrame:
    """The answers with one flag per scorer. ``mixed``: the column holds JSON of any form, see ``output_text``."""
    if mixed:
        answers = answers.withColumn("_said", output_text(F.col(text)))
    flags = {name: fn(F.col("_said" if mixed else text)) for name, fn in (scorers or SCORERS).items()}
    return answers.withColumns(flags).drop("_said")


def report(scored: DataFrame, scorers: list[str] | None = None) -> DataFrame:
    """``(scorer, n, mean)``: all scorers in one aggregate, then one row each."""
    names = scorers or list(SCORERS)
    means = scored.agg(
        F.count("*").alias("n"), *[F.avg(F.col(s).cast("double")).alias(s) for s in names]
    )
    return means.unpivot(["n"], names, "scorer", "mean").select("scorer", "n", "mean")
