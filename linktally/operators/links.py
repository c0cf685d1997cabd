"""From posts to one row per shared link."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.functions.times import month_of, post_time
from linktally.schemas import POST_COLUMNS


def clean_posts(posts: DataFrame, null_zero_ids: bool = True, strict_time: bool = False) -> DataFrame:
    """Typed posts that can hold a link.

    ``0`` and ``''`` stand for "no retweet". With ``null_zero_ids`` a ``0`` in
    the post or account id is read as missing too. A time that cannot be read
    gives a null ``local_time`` and ``month``, or an error with ``strict_time``.
    The length filter comes first: Spark derives none from the split.
    """

    def identifier(name):
        return F.nullif(F.col(name), F.lit("0")) if null_zero_ids else F.col(name)

    retweeted = F.col("retweeted_id")
    time = post_time(F.col("local_time"), strict_time)
    return (
        posts.select(*POST_COLUMNS)
        .where(F.length("links") > 1)
        .select(
            identifier("id").alias("tweet_id"),
            time.alias("local_time"),
            identifier("user_id").alias("user_id"),
            F.when(~retweeted.isin("0", ""), retweeted).alias("retweeted_id"),
            "links",
        )
        .withColumn("month", month_of(F.col("local_time")))
    )


def spread_scan(scan: DataFrame, *keys: str) -> DataFrame:
    """Shuffle a scan by key, for a badly split table that feeds costly row work."""
    return scan.repartition(*[F.col(key) for key in keys])


def cluster_by_month(posts: DataFrame, slices: int | None = None) -> DataFrame:
    """Shuffle posts by month and slice, before the costly link work.

    Gzip files and files with line breaks inside values are read by one task
    each, so this is where the work becomes parallel; it also gathers the rows
    of a month for the partitioned write that follows. Slices are dealt out row
    by row, so neither a month nor a group of copies can fill one task.

    Use it directly on a file scan (with projections and filters between): there
    a retried task deals the same rows to the same slices.
    """
    if slices is None:
        slices = max(1, int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    sliced = posts.withColumn("_slice", F.pmod(F.monotonically_increasing_id(), F.lit(slices)))
    if posts.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        shuffled = sliced.hint("rebalance", "month", "_slice")
    else:  # the hint is then without effect
        shuffled = sliced.repartition("month", "_slice")
    return shuffled.drop("_slice")


def explode_links(posts: DataFrame) -> DataFrame:
    """One row per non-empty link; a link repeated in a post stays repeated."""
    keep = [name for name in posts.columns if name != "links"]
    return posts.select(*keep, F.explode(F.split("links", "[|]")).alias("link")).where(F.col("link") != "")
