"""Data checks; each is one aggregate, run where it is asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.functions.platforms import CHANNEL


class DuplicateKeys(ValueError):
    """A table that must have one row per key has more."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("nb_rows")).where(F.col("nb_rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df``; raise :class:`DuplicateKeys` if a key repeats."""
    repeated = duplicate_keys(df, keys).first()
    if repeated is not None:
        raise DuplicateKeys(f"repeated key: {repeated.asDict()}")
    return df


def rejected_rows(shares: DataFrame) -> DataFrame:
    """One row: how many shares there are, and how many the reports leave out."""

    def count(condition, name):
        return F.count_if(condition).alias(name)

    return shares.agg(
        F.count("*").alias("nb_shares"),
        count(F.col("month").isNull(), "nb_without_time"),
        count(F.col("normalized_url").isNull(), "nb_without_url"),
        count(F.col("domain_name").isNull(), "nb_without_domain"),
    )


def nameless_channels(classified: DataFrame) -> DataFrame:
    """One row: channel links that give a name but no id, and so are dropped."""
    nameless = (F.col("link_kind") == CHANNEL) & F.col("channel_id").isNull()
    return classified.agg(F.count_if(nameless).alias("nb_channel_links_without_id"))
