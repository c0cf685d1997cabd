"""Publication times and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def post_time(value: Column, strict: bool = False) -> Column:
    """Text as a timestamp without zone; bad text is null, or an error if strict."""
    return value.cast("timestamp_ntz") if strict else value.try_cast("timestamp_ntz")


def month_of(time: Column) -> Column:
    """``yyyy-MM`` of a timestamp, read off the date so no time zone is involved."""
    return F.substring(time.cast("date").cast("string"), 1, 7)


def month_column(month: str, prefix: str) -> str:
    """Export column of a month: ``2022-01`` -> ``<prefix>2022_1``."""
    year, number = month.split("-")
    return f"{prefix}{year}_{int(number)}"
