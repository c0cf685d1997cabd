"""The whole job: raw posts to exported reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktally.functions.platforms import YOUTUBE, Platform
from linktally.functions.suffixes import SuffixRules
from linktally.operators.checks import require_unique
from linktally.operators.enrich import (
    LINK_KEYS,
    channel_links,
    channel_rollup,
    classify_links,
    links_with_channel,
    video_links,
)
from linktally.operators.quarantine import quarantine_rows, with_reason
from linktally.plans.reports import domain_month, domains_table, platform_link_month, platform_links_table
from linktally.plans.shares import shares_from_posts
from linktally.schemas import DOMAIN_MONTH_SCHEMA, LINK_MONTH_SCHEMA, POST_COLUMNS, require_columns
from linktally.sources.exports import ranked, write_csv
from linktally.sources.posts import DEFAULT_PATTERN, read_posts
from linktally.sources.tables import (
    SHARES_ORDER,
    read_by_month,
    read_parsed_links,
    read_shares,
    refresh_by_month,
    stored_months,
    write_by_month,
)


@dataclass(frozen=True)
class Outputs:
    """Where a run puts its tables (Parquet by month) and its exports (CSV).

    With ``run`` these are the run's own folders below those of all runs.
    """

    root: str
    run: str = ""

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}" + (f"/run={self.run}" if self.run else "")

    @property
    def posts(self) -> str:
        return self._at("posts")

    @property
    def quarantine(self) -> str:
        return self._at("quarantine")

    @property
    def shares(self) -> str:
        return self._at("shares")

    @property
    def domain_month(self) -> str:
        return self._at("domain_month")

    @property
    def link_month(self) -> str:
        return self._at("platform_link_month")

    @property
    def links_by_kind(self) -> str:
        return self._at("platform_links_by_kind")

    @property
    def domains(self) -> str:
        return self._at("domains")

    @property
    def platform_links(self) -> str:
        return self._at("platform_links")

    @property
    def video_links(self) -> str:
        return self._at("video_links")

    @property
    def channel_links(self) -> str:
        return self._at("channel_links")

    @property
    def channels(self) -> str:
        return self._at("channels")


def store_posts(
    posts: DataFrame, out: Outputs, months: Sequence[str] | None = None, codec: str = "zstd"
) -> DataFrame:
    """Store posts read with ``keep_bad`` once, quarantine the bad ones, and give back the others.

    The raw files are parsed a single time: the rows go to a table with a folder of
    usable and one of bad rows, and what follows reads the folder it needs. With
    ``months`` the quarantine keeps the rows of other months; rows without one are added, once.
    """
    judged = with_reason(posts)
    judged.withColumn("usable", F.col("reason").isNull()).write.mode("overwrite").option("compression", codec).partitionBy(
        "usable"
    ).parquet(out.posts)
    stored = posts.sparkSession.read.schema(judged.schema.add("usable", "boolean")).parquet(out.posts)
    bad = quarantine_rows(stored.where("NOT usable"))
    if months is None:
        write_by_month(bad, out.quarantine, codec)
    else:
        kept = bad.where(F.col("month").isin(*months) | F.col("month").isNull())
        refresh_by_month(kept, out.quarantine, months, codec, undated=True)
    return stored.where("usable").select(*POST_COLUMNS)


def write_rollups(
    shares: DataFrame, out: Outputs, platform: Platform = YOUTUBE, months: Sequence[str] | None = None
) -> None:
    """Write the two monthly rollups. With ``months`` only those are redone.

    A month's counts depend on that month alone, so adding a month to the data
    costs one month of work. The filter is on the partition column, and reads
    no other month's files.
    """
    if months is not None:
        shares = shares.where(F.col("month").isin(*months))
    for rollup, path in (
        (domain_month(shares), out.domain_month),
        (platform_link_month(shares, platform), out.link_month),
    ):
        if months is None:
            write_by_month(rollup, path)
        else:
            refresh_by_month(rollup, path, months)


def write_links_by_kind(links: DataFrame, path: str, platform: Platform = YOUTUBE) -> DataFrame:
    """Store classified platform links, a folder per kind, and read them back."""
    classified = classify_links(links, platform)
    classified.write.mode("overwrite").partitionBy("link_kind").parquet(path)
    return links.sparkSession.read.schema(classified.schema).parquet(path)


def write_reports(
    spark: SparkSession,
    out: Outputs,
    months: Sequence[str],
    video_metadata: DataFrame | None = None,
    platform: Platform = YOUTUBE,
    rollups: tuple[DataFrame, DataFrame] | None = None,
) -> None:
    """Export every report from the stored rollups, those of ``out`` unless others are given.

    Links are summed over months once and stored by kind; the link exports and
    the channel report each read the kinds they need.
    """
    if rollups is None:
        rollups = (
            read_by_month(spark, out.domain_month, DOMAIN_MONTH_SCHEMA),
            read_by_month(spark, out.link_month, LINK_MONTH_SCHEMA),
        )
    domains = domains_table(rollups[0], months)
    write_csv(ranked(domains, "sum_all_tweets_with_domain", "domain_id"), out.domains)

    links = platform_links_table(rollups[1], months)
    classified = write_links_by_kind(links, out.links_by_kind, platform)
    channels = channel_rollup(links_with_channel(classified, video_metadata))
    for report, key, path in (
        (classified.drop(*LINK_KEYS), "normalized_url", out.platform_links),
        (video_links(classified), "normalized_url", out.video_links),
        (channel_links(classified), "normalized_url", out.channel_links),
        (channels, "channel_id", out.channels),
    ):
        write_csv(ranked(report, "sum_all_tweets_with_link", key), path)


def run_pipeline(
    spark: SparkSession,
    inputs: str | None,
    out: str,
    pattern: str = DEFAULT_PATTERN,
    shares_path: str | None = None,
    parsed_links: str | None = None,
    parsed_pattern: str | None = None,
    video_metadata: DataFrame | None = None,
    platform: Platform = YOUTUBE,
    rules: SuffixRules | None = None,
    refresh_months: Sequence[str] | None = None,
    null_zero_ids: bool = True,
    strict_time: bool = False,
    quarantine: bool = False,
    codec: str = "zstd",
    **csv_options,
) -> Outputs:
    """Run everything and return where the results are.

    In place of ``inputs``, ``shares_path`` continues from stored shares, and
    ``parsed_links`` from a folder of parsed-link Parquet files of an earlier tool,
    those whose names match ``parsed_pattern`` if it is given.
    ``refresh_months`` takes only these months from the inputs and replaces
    them in the tables of an earlier run; the exports then cover all months.
    ``quarantine`` puts malformed rows and those whose time cannot be read into a
    table with reason, file and text; without it a malformed row raises, and a
    row without a time stays in the shares. ``codec`` compresses the shares
    table; ``csv_options`` go to ``read_posts``.
    Without ``video_metadata`` (``video_id``, ``channel_id``) the channel report
    holds direct channel links only. The stored tables are where lineage ends:
    a lost executor costs a stage, not the run.
    """
    outputs = Outputs(out)
    if [inputs, shares_path, parsed_links].count(None) != 2:
        raise ValueError("give either inputs, shares_path or parsed_links")
    if video_metadata is not None:
        require_columns(video_metadata.columns, ("video_id", "channel_id"), "video metadata")
    if shares_path is None:
        if parsed_links is None:
            posts = read_posts(spark, inputs, pattern, keep_bad=quarantine, **csv_options)
            if quarantine:
                posts = store_posts(posts, outputs, refresh_months, codec)
            shares = shares_from_posts(
                posts, rules, (platform,), null_zero_ids, strict_time, cluster=True, months=refresh_months
            )
        else:
            shares = read_parsed_links(spark, parsed_links, strict_time, parsed_pattern, null_zero_ids)
            if refresh_months is not None:
                shares = shares.where(F.col("month").isin(*refresh_months) | F.col("month").isNull())
        gather = parsed_links is not None  # posts were gathered ahead of the link work
        if refresh_months is None:
            write_by_month(shares, outputs.shares, codec, SHARES_ORDER, gather)
        else:
            refresh_by_month(
                shares, outputs.shares, refresh_months, codec, SHARES_ORDER, gather, undated=True
            )
        shares_path = outputs.shares
    shares = read_shares(spark, shares_path)
    write_rollups(shares, outputs, platform, refresh_months)
    write_reports(spark, outputs, stored_months(spark, shares_path), video_metadata, platform)
    return outputs


def check_outputs(spark: SparkSession, outputs: Outputs) -> None:
    """Raise if a monthly table has two rows for one key and month."""
    domains = read_by_month(spark, outputs.domain_month, DOMAIN_MONTH_SCHEMA)
    require_unique(domains, ("domain_id", "month"))
    links = read_by_month(spark, outputs.link_month, LINK_MONTH_SCHEMA)
    require_unique(links, ("normalized_url", "month"))
