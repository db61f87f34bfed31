"""Minute stamps of the form yyyyMMddHHmm held in a long, and ages in whole days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.functions.text import col

# A source is due again after six months of thirty days.
DAYS_PER_MONTH = 30
MONTHS_BETWEEN_SYNCS = 6


def minute_stamp(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyyMMddHHmm").cast("long")


def stamp_year(stamp: Column | str) -> Column:
    return F.call_function("div", col(stamp), F.lit(100_000_000)).cast("int")


def stamp_month(stamp: Column | str) -> Column:
    return F.call_function("div", col(stamp) % 100_000_000, F.lit(1_000_000)).cast("int")


def stamp_day(stamp: Column | str) -> Column:
    return F.call_function("div", col(stamp) % 1_000_000, F.lit(10_000)).cast("int")


def whole_days(start: Column | str, end: Column) -> Column:
    """Complete periods of 24 hours between two timestamps."""
    seconds = F.unix_micros(end) - F.unix_micros(col(start))
    return F.floor(seconds / F.lit(86_400_000_000)).cast("long")


def is_due(last_synced: Column | str, as_of: Column) -> Column:
    last = col(last_synced)
    return last.isNull() | (whole_days(last, as_of) >= DAYS_PER_MONTH * MONTHS_BETWEEN_SYNCS)
