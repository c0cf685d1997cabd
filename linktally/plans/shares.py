"""The shares table: one row per post and link, with URL and domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.functions.platforms import YOUTUBE, Platform, fold_aliases
from linktally.functions.settle import settle
from linktally.functions.suffixes import SuffixRules, suffix_rules
from linktally.functions.urls import with_normalized_url
from linktally.operators.domains import attribute_domain
from linktally.operators.links import clean_posts, cluster_by_month, explode_links
from linktally.schemas import SHARES_SCHEMA


def with_url_and_domain(
    df: DataFrame,
    rules: SuffixRules | None = None,
    platforms: Sequence[Platform] = (YOUTUBE,),
    link: str = "link",
) -> DataFrame:
    """Add ``normalized_url`` and ``domain_name`` for a link column."""
    rules = rules or suffix_rules(df.sparkSession)
    urls = with_normalized_url(df, link, host="_url_host")
    named = attribute_domain(urls, rules, "_url_host", "domain_name")
    folded = named.withColumn("domain_name", fold_aliases(F.col("domain_name"), platforms))
    return settle(folded.drop("_url_host"), "domain_name")


def shares_from_posts(
    posts: DataFrame,
    rules: SuffixRules | None = None,
    platforms: Sequence[Platform] = (YOUTUBE,),
    null_zero_ids: bool = True,
    strict_time: bool = False,
    cluster: bool = False,
    slices: int | None = None,
    months: Sequence[str] | None = None,
) -> DataFrame:
    """Shares of raw posts, as one lazy plan; with ``months`` of these and of no month only.

    ``cluster`` shuffles the posts by month once, ahead of the link work: for
    files that do not split, and ahead of a write by month.
    """
    cleaned = clean_posts(posts, null_zero_ids, strict_time)
    if months is not None:
        cleaned = cleaned.where(F.col("month").isin(*months) | F.col("month").isNull())
    if cluster:
        cleaned = cluster_by_month(cleaned, slices)
    shares = with_url_and_domain(explode_links(cleaned), rules, platforms)
    return shares.withColumn("domain_id", F.md5("domain_name")).select(*SHARES_SCHEMA.names)
