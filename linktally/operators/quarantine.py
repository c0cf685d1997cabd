"""Raw rows that cannot be used, kept with the reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.functions.times import post_time
from linktally.schemas import POST_COLUMNS, QUARANTINE_SCHEMA

MALFORMED = "malformed row"
BAD_TIME = "unreadable time"


def with_reason(posts: DataFrame) -> DataFrame:
    """Posts read with ``keep_bad``, with ``reason``, null for a usable one, and ``raw_row`` of the others.

    The text of usable rows is not worked out.
    """
    reason = F.when(F.col("malformed"), MALFORMED).when(post_time(F.col("local_time")).isNull(), BAD_TIME)
    judged = posts.withColumn("reason", reason)
    return judged.select(
        *POST_COLUMNS, "reason", "source_file", F.when(F.col("reason").isNotNull(), F.col("raw_row")).alias("raw_row")
    )


def quarantine_rows(judged: DataFrame) -> DataFrame:
    """``reason, source_file, raw_row, month`` of the rows with a reason.

    The month, with which a refresh replaces a row, is that of the first date in the
    row's text; null where there is none.
    """
    found = F.nullif(F.regexp_extract("raw_row", r"(?<!\d)(\d{4}-(?:0[1-9]|1[0-2]))-\d\d", 1), F.lit(""))
    return judged.where(F.col("reason").isNotNull()).withColumn("month", found).select(*QUARANTINE_SCHEMA.names)
