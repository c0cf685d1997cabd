"""The reports: domains, platform links, channels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.functions.platforms import YOUTUBE, Platform
from linktally.functions.times import month_column
from linktally.operators.rollup import RollupSpec, merge_months, monthly_rollup
from linktally.schemas import MONTH_COLUMN_PREFIX

# Grouping by the name alone is enough: the id is a function of it, added at the end.
DOMAINS = RollupSpec(
    keys=("domain_name",),
    distinct={
        "n_links": "normalized_url",
        "n_retweeted": "retweeted_id",
        "n_tweets": "tweet_id",
        "n_users": "user_id",
    },
    where=lambda: F.col("domain_name") != "",
    skip_null_keys=True,
)

# The columns of the exported tables.
DOMAIN_LABELS = {
    "n_links": "nb_distinct_links_from_domain",
    "n_retweeted": "nb_collected_retweets_with_domain",
    "n_tweets": "sum_all_tweets_with_domain",
    "n_users": "nb_accounts_that_shared_domain_link",
}
LINK_LABELS = {
    "n_retweeted": "nb_collected_retweets_with_links",
    "n_tweets": "sum_all_tweets_with_link",
    "n_users": "nb_accounts_that_shared_link",
}
ORIGINALS = "nb_collected_original_tweets"


def platform_spec(platform: Platform = YOUTUBE) -> RollupSpec:
    """Links of one platform, with one original link kept for fetching."""
    return RollupSpec(
        keys=("normalized_url",),
        distinct={"n_retweeted": "retweeted_id", "n_tweets": "tweet_id", "n_users": "user_id"},
        carried={"link_for_scraping": "link"},
        where=lambda: F.col("domain_name") == platform.name,
        skip_null_keys=True,
    )


def domain_month(shares: DataFrame) -> DataFrame:
    """Domain by month: distinct links, retweeted posts, posts and accounts."""
    counts = monthly_rollup(shares, DOMAINS)
    return counts.select(F.md5("domain_name").alias("domain_id"), "domain_name", "month", *DOMAINS.distinct)


def platform_link_month(shares: DataFrame, platform: Platform = YOUTUBE) -> DataFrame:
    """Platform link by month: distinct retweeted posts, posts and accounts."""
    spec = platform_spec(platform)
    return monthly_rollup(shares, spec).select("normalized_url", "link_for_scraping", "month", *spec.distinct)


def _labelled(merged: DataFrame, labels: dict[str, str], leading, months: Sequence[str]) -> DataFrame:
    """Export columns. "Originals" are posts minus distinct retweeted ids."""
    return merged.select(
        *leading,
        *[F.col(name).alias(label) for name, label in labels.items()],
        *[month_column(month, MONTH_COLUMN_PREFIX) for month in months],
        (F.col("n_tweets") - F.col("n_retweeted")).alias(ORIGINALS),
    )


def domains_table(monthly: DataFrame, months: Sequence[str]) -> DataFrame:
    """Domains over all months, with one column of posts per month."""
    merged = merge_months(monthly, DOMAINS, months, by_month="n_tweets")
    leading = [F.md5("domain_name").alias("domain_id"), "domain_name"]
    return _labelled(merged, DOMAIN_LABELS, leading, months)


def platform_links_table(monthly: DataFrame, months: Sequence[str]) -> DataFrame:
    """Platform links over all months, with one column of posts per month."""
    merged = merge_months(monthly, platform_spec(), months, by_month="n_tweets")
    return _labelled(merged, LINK_LABELS, ["normalized_url", "link_for_scraping"], months)
