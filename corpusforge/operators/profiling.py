"""Table profiles and plain-text rendering of small results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame) -> DataFrame:
    """``(column, type, n, nulls)`` per column, counted in one pass."""
    types = dict(df.dtypes)
    counted = df.agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = counted.unpivot(["_n"], df.columns, "column", "nulls")
    type_of = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    return long.select("column", type_of[F.col("column")].alias("type"), F.col("_n").alias("n"), "nulls")


def head(df: DataFrame, order_by: str, n: int = 5) -> DataFrame:
    return df.orderBy(order_by).limit(n)


def markdown_rows(df: DataFrame) -> DataFrame:
    """One markdown table line per row."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def markdown_header(columns: list[str]) -> str:
    return "| " + " | ".join(columns) + " |\n|" + "|".join(" --- " for _ in columns) + "|"
