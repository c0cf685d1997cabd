"""Every operator as a query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktally.functions.suffixes import read_suffix_rules, suffix_rules
from linktally.functions.times import month_of
from linktally.operators.checks import duplicate_keys, nameless_channels, rejected_rows
from linktally.operators.enrich import (
    attach_channels,
    attach_metadata,
    channel_links,
    channel_rollup,
    classify_links,
    links_with_channel,
    unify_records,
    video_links,
)
from linktally.operators.links import clean_posts, explode_links
from linktally.operators.rollup import RollupSpec, merge_months, monthly_rollup
from linktally.plans.append import append_rollup
from linktally.plans.pipeline import Outputs, run_pipeline, write_links_by_kind, write_rollups
from linktally.plans.reports import (
    domain_month,
    domains_table,
    platform_link_month,
    platform_links_table,
    platform_spec,
)
from linktally.plans.shares import shares_from_posts, with_url_and_domain
from linktally.plans.versions import read_version, run_version
from linktally.schemas import DOMAIN_MONTH_SCHEMA, LINK_MONTH_SCHEMA, PARSED_LINK_COLUMNS, POST_COLUMNS, QUARANTINE_SCHEMA
from linktally.session import scratch_path
from linktally.sources.exports import ranked, read_export, read_positions, write_csv
from linktally.sources.posts import read_bronze, read_posts, write_bronze
from linktally.sources.tables import (
    bad_record_values,
    read_by_month,
    read_metadata,
    read_metadata_records,
    read_parsed_links,
    read_shares,
    stored_months,
    write_by_month,
)
from suite.inputs import (
    channel_records,
    page_links,
    raw_posts,
    table,
    video_metadata,
    video_records,
)

# Rules of the private-suffix query: hosts below these count as suffixes.
PRIVATE_RULES = ("example.net", "*.example.org", "!spam-farm.example.org")

# Months of the supplied orders, for queries over one or two of them.
ONE_MONTH = "1996-02"
REFRESHED = ("1996-02", "1997-11")


def _shares(spark, folder) -> DataFrame:
    return shares_from_posts(raw_posts(spark, folder))


def _stored_link_months(spark, folder) -> tuple[DataFrame, list[str]]:
    """Links by month as the whole job stores them, and its months."""
    path = scratch_path(spark, "link-month")
    write_by_month(platform_link_month(_shares(spark, folder)), path)
    return read_by_month(spark, path, LINK_MONTH_SCHEMA), stored_months(spark, path)


def _platform_links(spark, folder) -> DataFrame:
    return platform_links_table(*_stored_link_months(spark, folder))


def _links_total(spark, folder) -> DataFrame:
    return platform_links_table(_stored_link_months(spark, folder)[0], [])


def _page_urls(spark, folder) -> DataFrame:
    return with_url_and_domain(page_links(spark, folder))


def _classified_pages(spark, folder) -> DataFrame:
    platform = _page_urls(spark, folder).where(F.col("domain_name") == "youtube.com")
    return classify_links(platform.drop("domain_name"))


def links_exploded(spark, folder):
    return explode_links(clean_posts(raw_posts(spark, folder))).select("tweet_id", "user_id", "link")


def zero_token_null(spark, folder):
    return clean_posts(raw_posts(spark, folder)).select("tweet_id", "user_id", "retweeted_id")


def shares_projected(spark, folder):
    return clean_posts(raw_posts(spark, folder)).drop("links")


def shares(spark, folder):
    return _shares(spark, folder)


def url_normalized(spark, folder):
    return _page_urls(spark, folder).select("page_id", "link", "normalized_url")


def url_domain(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return with_url_and_domain(pages, platforms=(), link="url").select("page_id", "domain_name")


def url_domain_private(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    rules = suffix_rules(spark, extra=PRIVATE_RULES)
    return with_url_and_domain(pages, rules, link="url").select("page_id", "domain_name")


def domain_alias(spark, folder):
    return _page_urls(spark, folder).select("page_id", "domain_name")


def domain_key(spark, folder):
    named = _page_urls(spark, folder)
    return named.select("page_id", F.md5("domain_name").alias("domain_id"))


def months_present(spark, folder):
    return _shares(spark, folder).select("month").where(F.col("month").isNotNull()).distinct()


def domains_total(spark, folder):
    return domains_table(domain_month(_shares(spark, folder)), [])


def domains_by_month_wide(spark, folder):
    path = scratch_path(spark, "domain-month")
    write_by_month(domain_month(_shares(spark, folder)), path)
    wide = domains_table(read_by_month(spark, path, DOMAIN_MONTH_SCHEMA), stored_months(spark, path))
    return ranked(wide, "sum_all_tweets_with_domain", "domain_id")


def domain_month_query(spark, folder):
    return domain_month(_shares(spark, folder))


def one_month(spark, folder):
    return domain_month(_shares(spark, folder).where(F.col("month") == ONE_MONTH))


def merged_halves(spark, folder):
    """Two tables of monthly counts, put together before the sum over months."""
    monthly = domain_month(_shares(spark, folder))
    early = monthly.where(F.col("month") < "1998-05")
    late = monthly.where(F.col("month") >= "1998-05")
    return domains_table(early.unionByName(late), [])


ORDERS_BY_PRIORITY = RollupSpec(
    keys=("o_orderpriority",),
    distinct={"n_customers": "o_custkey", "n_orders": "o_orderkey", "n_statuses": "o_orderstatus"},
    carried={"first_status": "o_orderstatus"},
)
EVENTS_BY_TYPE = RollupSpec(
    keys=("event_type",), distinct={"n_users": "user_id", "n_events": "event_id"}
)
LINES_BY_SUPPLIER = RollupSpec(
    keys=("l_suppkey",),
    distinct={"n_orders": "l_orderkey", "n_parts": "l_partkey"},
    where=lambda: F.col("l_returnflag") != "N",
)


def orders_monthly_rollup(spark, folder):
    orders = table(spark, folder, "orders").withColumn("month", month_of(F.col("o_orderdate")))
    return monthly_rollup(orders, ORDERS_BY_PRIORITY)


def orders_merged(spark, folder):
    return merge_months(orders_monthly_rollup(spark, folder), ORDERS_BY_PRIORITY)


def events_month_rollup(spark, folder):
    events = table(spark, folder, "events").withColumn("month", month_of(F.col("ts")))
    return monthly_rollup(events, EVENTS_BY_TYPE)


def lineitem_month_totals(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("month", month_of(F.col("l_shipdate")))
    return merge_months(monthly_rollup(lines, LINES_BY_SUPPLIER), LINES_BY_SUPPLIER)


def platform_link_month_query(spark, folder):
    return platform_link_month(_shares(spark, folder))


def platform_links_wide(spark, folder):
    return ranked(_platform_links(spark, folder), "sum_all_tweets_with_link", "normalized_url")


def link_kind(spark, folder):
    return _classified_pages(spark, folder)


def video_link_table(spark, folder):
    links = _links_total(spark, folder)
    return video_links(classify_links(links))


def channel_link_table(spark, folder):
    links = _links_total(spark, folder)
    return channel_links(classify_links(links))


def video_enriched(spark, folder):
    return attach_channels(_classified_pages(spark, folder), video_metadata(spark, folder))


def metadata_inner(spark, folder):
    records = unify_records(video_records(spark, folder), channel_records(spark, folder))
    return attach_metadata(_classified_pages(spark, folder), records)


def links_with_channel_query(spark, folder):
    links = _links_total(spark, folder)
    return links_with_channel(classify_links(links), video_metadata(spark, folder))


def channels(spark, folder):
    classified = write_links_by_kind(_platform_links(spark, folder), scratch_path(spark, "kinds"))
    rolled = channel_rollup(links_with_channel(classified, video_metadata(spark, folder)))
    return ranked(rolled, "sum_all_tweets_with_link", "channel_id")


def channels_without_metadata(spark, folder):
    links = _links_total(spark, folder)
    return channel_rollup(links_with_channel(classify_links(links)))


def duplicate_keys_query(spark, folder):
    """Posts with several links to one domain."""
    return duplicate_keys(_shares(spark, folder), ("tweet_id", "domain_name"))


def rejected_rows_query(spark, folder):
    return rejected_rows(_shares(spark, folder))


def nameless_channel_links(spark, folder):
    return nameless_channels(_classified_pages(spark, folder))


def csv_roundtrip(spark, folder):
    """Posts through gzipped CSV files with two column orders, then the totals."""
    path = scratch_path(spark, "posts")
    posts = raw_posts(spark, folder)
    late = F.coalesce(F.col("local_time") >= "1998", F.lit(False))
    write_csv(posts.where(~late), f"{path}/a", compression="gzip")
    write_csv(posts.where(late).select(*reversed(POST_COLUMNS)), f"{path}/b", compression="gzip")
    read = read_posts(spark, path)
    return domains_table(domain_month(shares_from_posts(read, cluster=True)), [])


def csv_split(spark, folder):
    """Posts through plain CSV files with line breaks in values, shared by many tasks; then the totals."""
    path = scratch_path(spark, "posts")
    note = F.repeat(F.concat(F.lit('said "'), F.col("id"), F.lit('",\n')), 40)
    broken = F.replace(F.col("links"), F.lit("|"), F.lit("|\n"))
    write_csv(raw_posts(spark, folder).select("id", note.alias("note"), broken.alias("links"), *POST_COLUMNS[1:4]), path)
    read = read_posts(spark, path, "*.csv", split=True)
    return domains_table(domain_month(shares_from_posts(read)), [])


def quarantine(spark, folder):
    """Raw rows that a job leaves out, with the reason; the others are counted."""
    path = scratch_path(spark, "job")
    order = F.col("o_orderkey")
    fields = [order.cast("string"), F.col("o_orderdate").cast("string"), F.col("o_custkey").cast("string"), F.lit("0")]
    link = F.concat(F.lit('"https://site'), order % 50, F.lit('.com/a,b"'))
    row = F.concat_ws(",", *fields, link)
    line = (
        F.when(order % 41 == 1, F.concat_ws(",", *fields[:3]))
        .when(order % 43 == 1, F.concat(row, F.lit(",more")))
        .when(order % 47 == 1, F.concat_ws(",", fields[0], F.lit("soon"), *fields[2:], link))
        .otherwise(row)
    )
    # raw lines under a header, by a writer that never finds anything to quote
    lines = table(spark, folder, "orders").select(line.alias(",".join(POST_COLUMNS)))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").csv(f"{path}/posts")
    out = run_pipeline(spark, f"{path}/posts", f"{path}/out", pattern="*.csv", quarantine=True, split=True)
    bad = read_by_month(spark, out.quarantine, QUARANTINE_SCHEMA)
    is_file = F.col("source_file").rlike(r"/posts/part-[^/]*[.]csv$").alias("has_file")
    good = read_shares(spark, out.shares).agg(F.count("*").alias("number"))
    counted = good.select(F.lit("shared").alias("reason"), F.col("number").cast("string").alias("raw_row"), F.lit(True).alias("has_file"))
    return bad.select("reason", "raw_row", is_file).unionByName(counted)


def bronze_roundtrip(spark, folder):
    """Posts through a Parquet copy of the needed columns."""
    path = scratch_path(spark, "bronze")
    write_bronze(raw_posts(spark, folder), path)
    return platform_link_month(shares_from_posts(read_bronze(spark, path)))


def parsed_links_read(spark, folder):
    """Shares from parsed-link files: gzip Parquet under an earlier tool's names."""
    path = scratch_path(spark, "parsed")
    renamed = _shares(spark, folder).withColumnsRenamed({"tweet_id": "id", "domain_name": "domain"})
    text_time = F.coalesce(F.col("local_time").cast("string"), F.lit("no time"))
    files = renamed.withColumn("local_time", text_time).select(*PARSED_LINK_COLUMNS)
    files.write.option("compression", "gzip").parquet(path)
    return read_parsed_links(spark, path)


def metadata_roundtrip(spark, folder):
    path = scratch_path(spark, "metadata")
    write_csv(video_metadata(spark, folder), path)
    return read_metadata(spark, path)


def _records_file(spark, folder) -> str:
    """Extended records as CSV; some counts are words, some have blanks around them."""
    path = scratch_path(spark, "records")
    number = F.regexp_extract("video_title", r"([0-9]+)", 1).cast("long")
    views = F.col("video_viewCount").cast("string")
    marked = F.when(number % 7 == 2, "many").when(number % 7 == 3, F.concat(F.lit(" "), views, F.lit(" "))).otherwise(views)
    records = unify_records(video_records(spark, folder), channel_records(spark, folder))
    write_csv(records.withColumn("video_viewCount", marked), path)
    return path


def records_roundtrip(spark, folder):
    return read_metadata_records(spark, _records_file(spark, folder))


def bad_records(spark, folder):
    return bad_record_values(spark, _records_file(spark, folder))


def shares_stored(spark, folder):
    """One month read back from the table partitioned by month."""
    path = scratch_path(spark, "shares")
    write_by_month(_shares(spark, folder), path)
    return read_shares(spark, path).where(F.col("month") == ONE_MONTH)


def month_refresh(spark, folder):
    """Monthly counts after two months were taken out and put back."""
    out = Outputs(scratch_path(spark, "refresh"))
    write_by_month(_shares(spark, folder), out.shares)
    stored = read_shares(spark, out.shares)
    write_rollups(stored.where(~F.col("month").isin(*REFRESHED)), out)
    write_rollups(stored, out, months=REFRESHED)
    return read_by_month(spark, out.domain_month, DOMAIN_MONTH_SCHEMA)


def versioned_refresh(spark, folder):
    """Monthly counts of the version that is read after two months were done again."""
    root = scratch_path(spark, "versions")
    stored = f"{root}/input"
    write_by_month(_shares(spark, folder), stored)
    every = read_shares(spark, stored)
    run_version(spark, every.where(~F.col("month").isin(*REFRESHED)), f"{root}/out")
    run_version(spark, every, f"{root}/out", refresh_months=REFRESHED)
    return read_version(spark, f"{root}/out", "domain_month")


def month_append(spark, folder):
    """Link counts of all months, with the posts of two of them added in two parts that overlap."""
    root = scratch_path(spark, "append")
    write_by_month(_shares(spark, folder), f"{root}/shares")
    every = read_shares(spark, f"{root}/shares")
    months, spec = stored_months(spark, f"{root}/shares"), platform_spec()
    late = F.col("month").isin(*REFRESHED)
    number = F.pmod(F.xxhash64("tweet_id"), F.lit(10))
    append_rollup(spark, every.where(~late | (number < 6)), spec, months, f"{root}/values", f"{root}/counts")
    append_rollup(spark, every.where(late & (number > 3)), spec, REFRESHED, f"{root}/values", f"{root}/counts")
    return read_by_month(spark, f"{root}/counts", LINK_MONTH_SCHEMA)


def _measures_as_numbers(df: DataFrame, texts) -> DataFrame:
    return df.select(*[F.col(c) if c in texts else F.col(c).cast("bigint").alias(c) for c in df.columns])


def pipeline_channels(spark, folder):
    """The whole job on CSV files, read back from its channel export."""
    path = scratch_path(spark, "job")
    write_csv(raw_posts(spark, folder), f"{path}/posts", compression="gzip")
    out = run_pipeline(
        spark, f"{path}/posts", f"{path}/out", video_metadata=video_metadata(spark, folder)
    )
    return _measures_as_numbers(
        read_export(spark, out.channels), ("normalized_url", "link_for_scraping", "channel_id")
    )


def resume(spark, folder):
    """The job continued from stored shares, read back from its domain export."""
    path = scratch_path(spark, "resume")
    write_by_month(_shares(spark, folder), f"{path}/shares")
    out = run_pipeline(spark, None, f"{path}/out", shares_path=f"{path}/shares")
    return _measures_as_numbers(read_export(spark, out.domains), ("domain_id", "domain_name"))


def _suffix_hosts(spark, folder) -> DataFrame:
    """Links under many kinds of suffixes, made from the page's id."""
    number = (F.col("page_id") % 40).cast("string")
    shapes = [
        ("www.site", ".com"), ("a.site", ".co.uk"), ("site", ".bar"), ("x.foo", ".google"), ("site", ".com.hk"),
        ("a.b", ".go.jp"), ("user", ".github.io"), ("a.example", ".bzh"), ("10.0.0.", ""), ("a.site", ".рф"),
        ("x.shop", ".foo.ck"), ("x", ".www.ck"), ("site", ".org."), ("a.site", ".XN--P1AI"), ("a.site", ".公司.cn"),
        ("A.Site", ".xn--55qx5d.cn"), ("a.ÉTÉ", "。com"),
    ]
    host = F.lit(None)
    for rest, (before, after) in enumerate(shapes):
        host = F.when(F.col("page_id") % len(shapes) == rest, F.concat(F.lit(before), number, F.lit(after))).otherwise(host)
    return table(spark, folder, "pages").select("page_id", F.concat(F.lit("https://"), host, F.lit("/p")).alias("link"))


def url_domain_suffixes(spark, folder):
    return with_url_and_domain(_suffix_hosts(spark, folder)).select("page_id", "domain_name")


def suffix_file(spark, folder):
    """Domains by the rules of a file."""
    path = scratch_path(spark, "suffixes")
    lines = ["// rules", "com", "bar", "hk", "*.hk", "ck", "!www.ck", "org // more", "公司.cn"]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    rules = read_suffix_rules(spark, path)
    return with_url_and_domain(_suffix_hosts(spark, folder), rules).select("page_id", "domain_name")


def pipeline_refresh(spark, folder):
    """The whole job, then two months done again, with posts of no time among them."""
    path = scratch_path(spark, "job")
    posts = raw_posts(spark, folder)
    again = F.substring("local_time", 1, 7).isin(*REFRESHED) | (F.col("local_time") == "no time")
    write_csv(posts, f"{path}/all", compression="gzip")
    write_csv(posts.where(again), f"{path}/again", compression="gzip")
    out = run_pipeline(spark, f"{path}/all", f"{path}/out")
    run_pipeline(spark, f"{path}/again", f"{path}/out", refresh_months=REFRESHED)
    return rejected_rows(read_shares(spark, out.shares))


def parsed_links_job(spark, folder):
    """The job continued from an earlier tool's folder, which holds its raw columns too."""
    path = scratch_path(spark, "parsed")
    renamed = _shares(spark, folder).withColumnsRenamed({"tweet_id": "id", "domain_name": "domain"})
    text_time = F.coalesce(F.col("local_time").cast("string"), F.lit("no time"))
    parsed = renamed.withColumn("local_time", text_time).select(*PARSED_LINK_COLUMNS)
    parsed.write.option("compression", "gzip").parquet(f"{path}/links")
    raw_posts(spark, folder).write.option("compression", "snappy").parquet(f"{path}/raw")
    out = run_pipeline(spark, None, f"{path}/out", parsed_links=path, parsed_pattern="*.gz.parquet")
    return _measures_as_numbers(read_export(spark, out.domains), ("domain_id", "domain_name"))


def stored_months_query(spark, folder):
    path = scratch_path(spark, "shares")
    write_by_month(_shares(spark, folder), path)
    return spark.createDataFrame([(month,) for month in stored_months(spark, path)], "month string")


def links_by_kind(spark, folder):
    """Classified links stored by kind and read back."""
    links = _links_total(spark, folder)
    return write_links_by_kind(links, scratch_path(spark, "kinds"))


def _export_order(report: DataFrame, measure: str, key: str) -> DataFrame:
    """Each key's place in the files of an export, read in order of their names."""
    path = scratch_path(report.sparkSession, "order")
    write_csv(ranked(report, measure, key), path)
    return read_positions(report.sparkSession, path, "place").select(key, "place")


def export_domains_order(spark, folder):
    return _export_order(domains_total(spark, folder), "sum_all_tweets_with_domain", "domain_id")


def export_links_order(spark, folder):
    links = _links_total(spark, folder)
    return _export_order(links, "sum_all_tweets_with_link", "normalized_url")


def export_channels_order(spark, folder):
    rolled = channel_rollup(links_with_channel_query(spark, folder))
    return _export_order(rolled, "sum_all_tweets_with_link", "channel_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "links_exploded": links_exploded,
    "zero_token_null": zero_token_null,
    "shares_projected": shares_projected,
    "shares": shares,
    "url_normalized": url_normalized,
    "url_domain": url_domain,
    "url_domain_private": url_domain_private,
    "domain_alias": domain_alias,
    "domain_key": domain_key,
    "domain_month": domain_month_query,
    "months_present": months_present,
    "domains_total": domains_total,
    "domains_by_month_wide": domains_by_month_wide,
    "merged_halves": merged_halves,
    "one_month": one_month,
    "orders_monthly_rollup": orders_monthly_rollup,
    "orders_merged": orders_merged,
    "events_month_rollup": events_month_rollup,
    "lineitem_month_totals": lineitem_month_totals,
    "platform_link_month": platform_link_month_query,
    "platform_links_wide": platform_links_wide,
    "link_kind": link_kind,
    "video_link_table": video_link_table,
    "channel_link_table": channel_link_table,
    "video_enriched": video_enriched,
    "metadata_inner": metadata_inner,
    "links_with_channel": links_with_channel_query,
    "channels": channels,
    "channels_without_metadata": channels_without_metadata,
    "duplicate_keys": duplicate_keys_query,
    "rejected_rows": rejected_rows_query,
    "nameless_channel_links": nameless_channel_links,
    "csv_roundtrip": csv_roundtrip,
    "csv_split": csv_split,
    "quarantine": quarantine,
    "bronze_roundtrip": bronze_roundtrip,
    "parsed_links_read": parsed_links_read,
    "metadata_roundtrip": metadata_roundtrip,
    "records_roundtrip": records_roundtrip,
    "bad_records": bad_records,
    "shares_stored": shares_stored,
    "month_refresh": month_refresh,
    "versioned_refresh": versioned_refresh,
    "month_append": month_append,
    "pipeline_channels": pipeline_channels,
    "resume": resume,
    "url_domain_suffixes": url_domain_suffixes,
    "suffix_file": suffix_file,
    "pipeline_refresh": pipeline_refresh,
    "parsed_links_job": parsed_links_job,
    "stored_months": stored_months_query,
    "links_by_kind": links_by_kind,
    "export_domains_order": export_domains_order,
    "export_links_order": export_links_order,
    "export_channels_order": export_channels_order,
}
