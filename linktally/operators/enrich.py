"""Joins that attach platform metadata, and the channel rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linktally.functions.platforms import CHANNEL, VIDEO, YOUTUBE, Platform, link_channel_id, link_kind, video_id
from linktally.functions.settle import settle
from linktally.schemas import METADATA_FIELDS, MONTH_COLUMN_PREFIX, metadata_type

# Columns that classify_links adds.
LINK_KEYS = ("video_id", "channel_id", "link_kind")


def classify_links(links: DataFrame, platform: Platform = YOUTUBE, url: str = "normalized_url") -> DataFrame:
    """Add ``video_id``, ``channel_id`` (of channel links) and ``link_kind``."""
    kind = link_kind(F.col(url), F.col("video_id"), platform)
    return (
        links.withColumn("video_id", video_id(F.col(url), platform))
        .withColumn("link_kind", kind)
        .withColumn(
            "channel_id",
            F.when(F.col("link_kind") == CHANNEL, link_channel_id(F.col(url), platform)),
        )
    )


def video_links(classified: DataFrame) -> DataFrame:
    """Links to videos, without the classification columns."""
    return classified.where(F.col("link_kind") == VIDEO).drop(*LINK_KEYS)


def channel_links(classified: DataFrame) -> DataFrame:
    """Links to channels known by id; channels known by name only are left out."""
    keep = F.col("channel_id").isNotNull() & (F.col("link_kind") == CHANNEL)
    return classified.where(keep).drop("video_id", "link_kind")


def _shuffled_for_join(unique: DataFrame, *keys: str) -> DataFrame:
    """Let the join that follows shuffle a table that is already placed by key.

    Adaptive execution splits a hot key's rows on the other side only where both
    sides of the join come straight from a shuffle, which an aggregate does not.
    Settling the keys hides their placement; the table has one row per key.
    """
    return settle(unique, *keys)


def video_channels(metadata: DataFrame) -> DataFrame:
    """``(video_id, channel_id)``, one row per video, so a join adds no rows."""
    unique = (
        metadata.where(F.col("video_id").isNotNull())
        .groupBy("video_id")
        .agg(F.min("channel_id").alias("channel_id"))
    )
    return _shuffled_for_join(unique, "video_id")


def attach_channels(classified: DataFrame, metadata: DataFrame) -> DataFrame:
    """Video links with their channel from the metadata, null where unknown.

    Spark broadcasts the metadata only if it measures it as small, and splits
    skewed partitions of the links otherwise.
    """
    videos = classified.where(F.col("link_kind") == VIDEO).drop("channel_id", "link_kind")
    return videos.join(video_channels(metadata), "video_id", "left").drop("video_id")


def links_with_channel(classified: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Video links and channel links together, with ``channel_id``.

    Both kinds go through one join, so the links are computed once. Channel
    links have no video id; a null key would send all of them to one task, so
    they get a key of their own that is never used. Without metadata no video
    has a known channel.
    """
    is_video = F.col("link_kind") == VIDEO
    known = classified.where(is_video | F.col("channel_id").isNotNull())
    if metadata is None:
        return known.drop("video_id", "link_kind")
    found = video_channels(metadata).select(
        F.col("video_id").alias("_key"), F.col("channel_id").alias("_found")
    )
    keyed = known.withColumn("_key", F.coalesce("video_id", F.concat(F.lit("/"), "normalized_url")))
    channel = F.when(is_video, F.col("_found")).otherwise(F.col("channel_id"))
    joined = keyed.join(found, "_key", "left").withColumn("channel_id", channel)
    return joined.drop("_key", "_found", "video_id", "link_kind")


def unify_records(videos: DataFrame, channels: DataFrame) -> DataFrame:
    """Video and channel records in one schema: channels have null video fields."""
    both = videos.unionByName(channels, allowMissingColumns=True)

    def typed(name: str) -> Column:
        column = F.col(name) if name in both.columns else F.lit(None)
        return column.cast(metadata_type(name)).alias(name)

    return both.select(*[typed(name) for name in METADATA_FIELDS])


def _keyed_records(records: DataFrame) -> DataFrame:
    """One whole record per kind and id: the largest, so a known value beats a null."""
    kind = F.when(F.col("video_id").isNotNull(), VIDEO).otherwise(CHANNEL)
    unique = (
        records.select(
            kind.alias("link_kind"),
            F.coalesce("video_id", "channel_id").alias("_key"),
            F.struct(*METADATA_FIELDS).alias("_record"),
        )
        .where(F.col("_key").isNotNull())
        .groupBy("link_kind", "_key")
        .agg(F.max("_record").alias("_record"))
    )
    return _shuffled_for_join(unique, "link_kind", "_key")


def attach_metadata(classified: DataFrame, records: DataFrame) -> DataFrame:
    """Links with the whole metadata record; links without a record are dropped.

    Video links match on ``video_id``. Channel links match channel records,
    those with no ``video_id``, on ``channel_id``.
    """
    base = [name for name in classified.columns if name not in LINK_KEYS]
    key = F.when(F.col("link_kind") == VIDEO, F.col("video_id")).otherwise(F.col("channel_id"))
    links = classified.select(*base, "link_kind", key.alias("_key")).where(F.col("_key").isNotNull())
    return links.join(_keyed_records(records), ["link_kind", "_key"]).select(*base, "_record.*")


# Measures of the link reports, beside those of single months.
LINK_MEASURES = (
    "nb_collected_retweets_with_links",
    "sum_all_tweets_with_link",
    "nb_accounts_that_shared_link",
    "nb_collected_original_tweets",
)


def channel_rollup(links: DataFrame) -> DataFrame:
    """Sum every measure over a channel's links and count the links.

    A post with two links of one channel counts twice: totals are sums over
    links. Measures are the columns of the link reports and any number column; further
    columns are left out. Sums and texts are read apart: give a stored table.
    """
    texts = ("normalized_url", "link_for_scraping")
    measures = [
        field.name
        for field in links.schema
        if field.name in LINK_MEASURES
        or field.name.startswith(MONTH_COLUMN_PREFIX)
        or isinstance(field.dataType, T.NumericType)
    ]
    rows = links.where(F.col("channel_id").isNotNull())
    sums = rows.groupBy("channel_id").agg(
        *[F.expr(f"sum(CAST(`{name}` AS BIGINT)) AS `{name}`") for name in measures], F.count("channel_id").alias("nb_links")
    )
    # Apart from the sums, which a text minimum beside them would have Spark sort.
    named = rows.groupBy("channel_id").agg(*[F.min(name).alias(name) for name in texts])
    return sums.join(named, "channel_id").select(*texts, *measures, "channel_id", "nb_links")
