"""Column names and schemas shared by every step."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns a raw post file must have.
POST_COLUMNS = ("id", "local_time", "user_id", "retweeted_id", "links")

# What a read that keeps bad rows adds to the columns it was asked for.
BAD_ROW_COLUMNS = ("malformed", "raw_row", "source_file")

# The columns of a parsed-link file written by an earlier tool.
PARSED_LINK_COLUMNS = (
    "id",
    "local_time",
    "user_id",
    "retweeted_id",
    "link",
    "normalized_url",
    "domain",
)

# The columns of the stored shares.
SHARES_SCHEMA = T.StructType(
    [
        T.StructField("domain_id", T.StringType()),
        T.StructField("domain_name", T.StringType()),
        T.StructField("normalized_url", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("retweeted_id", T.StringType()),
        T.StructField("tweet_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("local_time", T.TimestampNTZType()),
        T.StructField("month", T.StringType()),
    ]
)

# Rows that did not become shares, and why.
QUARANTINE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("reason", "source_file", "raw_row", "month")]
)


def _monthly(texts, counts) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in (*texts, "month")]
    return T.StructType([*fields, *[T.StructField(name, T.LongType()) for name in counts]])


DOMAIN_MONTH_SCHEMA = _monthly(
    ("domain_id", "domain_name"), ("n_links", "n_retweeted", "n_tweets", "n_users")
)
LINK_MONTH_SCHEMA = _monthly(
    ("normalized_url", "link_for_scraping"), ("n_retweeted", "n_tweets", "n_users")
)

# Prefix of the per-month columns in exported tables.
MONTH_COLUMN_PREFIX = "nb_tweets_in_"

# The fields of an extended platform metadata record, in name order.
METADATA_FIELDS = (
    "channel_country",
    "channel_description",
    "channel_id",
    "channel_keywords",
    "channel_publishedAt",
    "channel_subscriberCount",
    "channel_title",
    "channel_videoCount",
    "channel_viewCount",
    "video_commentCount",
    "video_description",
    "video_duration",
    "video_favoriteCount",
    "video_id",
    "video_likeCount",
    "video_publishedAt",
    "video_tags",
    "video_title",
    "video_viewCount",
)


def metadata_type(field: str) -> T.DataType:
    """Counts are bigint, publication dates timestamps, the rest strings."""
    if field.endswith("Count"):
        return T.LongType()
    if field.endswith("_publishedAt"):
        return T.TimestampType()
    return T.StringType()


def strings(names) -> T.StructType:
    """An all-string schema."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def require_columns(present, required, what: str) -> None:
    """Raise ``ValueError`` naming every required column that is absent."""
    missing = [name for name in required if name not in present]
    if missing:
        raise ValueError(f"{what} lacks the column(s) {', '.join(missing)}")
