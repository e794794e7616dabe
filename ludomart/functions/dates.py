"""Lenient timestamp parsing and calendar parts. Bad text gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three text formats the raw dumps use.
DMY_FORMAT = "dd/MM/yyyy HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"
RFC822_FORMAT = "d MMM yyyy HH:mm:ss xx"


def parse_dmy(text: Column) -> Column:
    """``31/12/2022 23:59:59``, taken as UTC (the session zone)."""
    return F.try_to_timestamp(text, F.lit(DMY_FORMAT))


def parse_iso(text: Column) -> Column:
    """``2022-12-31T23:59:59.123Z``; the zone is read, not skipped as a literal."""
    return F.try_to_timestamp(text, F.lit(ISO_FORMAT))


def parse_rfc822(text: Column) -> Column:
    """``Sat, 31 Dec 2022 23:59:59 -0500``.

    Spark 3+ refuses to parse a weekday name, so it is cut off; the date alone
    fixes it. The offset is applied as an offset.
    """
    return F.try_to_timestamp(F.regexp_replace(text, r"^\w{3}, ", ""), F.lit(RFC822_FORMAT))


def calendar(ts: Column) -> list[Column]:
    """Minute to weekday; weeks are ISO, Sunday is weekday 1."""
    return [
        F.minute(ts).alias("minute"),
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        F.dayofweek(ts).alias("weekday"),
    ]
