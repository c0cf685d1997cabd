"""Posts, platform links and metadata that Spark derives from the supplied tables.

The tables hold no posts, no joined links and no platform URLs. Every order
becomes a post, every page a link, and the mapping is plain arithmetic, so the
data grows with the tables and the same text can be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktally.operators.links import spread_scan


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _digest(number) -> F.Column:
    return F.md5(number.cast("string"))


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, link)``: the page's URL, or a platform link made from its id."""
    page = F.col("page_id")
    video = F.substring(_digest(page), 1, 11)
    channel = F.substring(_digest(page), 1, 22)
    kind = page % 10
    link = (
        F.when(kind == 0, F.concat(F.lit("https://www.youtube.com/watch?v="), video, F.lit("&feature=share")))
        .when(kind == 3, F.concat(F.lit("https://youtu.be/"), video))
        .when(kind == 5, F.concat(F.lit("https://www.youtube.com/channel/UC"), channel))
        .when(kind == 7, F.concat(F.lit("https://m.youtube.com/@name"), page.cast("string")))
        .otherwise(F.col("url"))
    )
    return table(spark, folder, "pages").select("page_id", link.alias("link"))


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    """One post per order, with the links of two pages; some cells hold no link."""
    links = page_links(spark, folder)
    order = F.col("o_orderkey")
    size = links.agg(F.count("*")).scalar()
    columns = ("o_orderkey", "o_custkey", "o_orderdate")
    orders = spread_scan(table(spark, folder, "orders").select(*columns), "o_orderkey")
    posts = orders.select(
        order,
        order.cast("string").alias("id"),
        F.when(order % 97 == 1, "no time").otherwise(F.col("o_orderdate").cast("string")).alias("local_time"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(order % 3 == 0, (order % 500 + 1).cast("string")).otherwise("0").alias("retweeted_id"),
        (order % size).alias("first_page"),
        ((order * 7 + 3) % size).alias("second_page"),
    )
    first = links.select(F.col("page_id").alias("first_page"), F.col("link").alias("first_link"))
    second = links.select(F.col("page_id").alias("second_page"), F.col("link").alias("second_link"))
    cell = F.concat("first_link", F.lit("|"), "second_link", F.when(order % 5 == 0, "|").otherwise(""))
    return (
        posts.join(first, "first_page")
        .join(second, "second_page")
        .select(
            "id",
            "local_time",
            "user_id",
            "retweeted_id",
            F.when(order % 11 == 0, "").when(order % 13 == 0, "x").otherwise(cell).alias("links"),
        )
    )


def video_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """A metadata row per page; some give no channel, some no video id."""
    page = F.col("page_id")
    return table(spark, folder, "pages").select(
        F.when(page % 7 != 1, F.substring(_digest(page), 1, 11)).alias("video_id"),
        F.when(
            page % 7 != 0, F.concat(F.lit("UC"), F.substring(_digest(page % 4 * 10 + 5), 1, 22))
        ).alias("channel_id"),
    )


def video_records(spark: SparkSession, folder: str) -> DataFrame:
    """Extended records of videos: some of the fields, the rest is left out."""
    page = F.col("page_id")
    meta = video_metadata(spark, folder).where(F.col("video_id").isNotNull())
    pages = table(spark, folder, "pages").select(
        F.substring(_digest(page), 1, 11).alias("video_id"),
        F.concat(F.lit("Video "), page.cast("string")).alias("video_title"),
        F.length("html").cast("string").alias("video_viewCount"),
    )
    return pages.join(meta, "video_id")


def channel_records(spark: SparkSession, folder: str) -> DataFrame:
    """Extended records of channels, which have no video fields."""
    page = F.col("page_id")
    return table(spark, folder, "pages").select(
        F.concat(F.lit("UC"), F.substring(_digest(page), 1, 22)).alias("channel_id"),
        F.concat(F.lit("Channel "), page.cast("string")).alias("channel_title"),
        (page * 3).cast("string").alias("channel_videoCount"),
    )
