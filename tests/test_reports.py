import datetime
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from linktally.operators.checks import DuplicateKeys, duplicate_keys, nameless_channels, rejected_rows, require_unique
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
from linktally.operators.links import spread_scan
from linktally.operators.rollup import RollupSpec, monthly_rollup, present_months
from linktally.plans.reports import (
    DOMAIN_LABELS,
    domain_month,
    domains_table,
    platform_link_month,
    platform_links_table,
)
from linktally.plans.shares import shares_from_posts
from linktally.schemas import METADATA_FIELDS, POST_COLUMNS
from suite.inputs import raw_posts, video_metadata

SMALL = "/root/testdata/sf0.001"
VIDEO = "https://youtu.be/abcdefghijk"
CHANNEL = "https://youtube.com/channel/UCabcdefghijklmnopqrstuv"


def shares_of(spark, rows):
    schema = ", ".join(f"{name} string" for name in POST_COLUMNS)
    return shares_from_posts(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def shares(spark):
    """Shares of the small test tables, computed once."""
    return shares_from_posts(raw_posts(spark, SMALL)).cache()


def brute_force(rows, key, values):
    """Monthly distinct counts by key, one set per cell."""
    cells = {}
    for row in rows:
        if row["month"] is None or row[key] is None:
            continue
        sets = cells.setdefault((row[key], row["month"]), [set() for _ in values])
        for found, name in zip(sets, values):
            if row[name] is not None:
                found.add(row[name])
    return {cell: tuple(len(found) for found in sets) for cell, sets in cells.items()}


def test_total_is_the_sum_of_monthly_distinct_counts(spark):
    shares = shares_of(
        spark,
        [
            ("1", "2022-01-31 23:59:59", "7", "0", "https://a.com/x|https://a.com/x"),
            ("2", "2022-02-01", "7", "9", "https://www.a.com/x"),
            ("3", "2022-02-02", "7", "9", "http://a.com/y"),
        ],
    )
    months = present_months(shares)
    (row,) = domains_table(domain_month(shares), months).collect()
    assert months == ["2022-01", "2022-02"]
    assert row["nb_accounts_that_shared_domain_link"] == 2  # one account, two months
    assert row["nb_distinct_links_from_domain"] == 3
    assert row["sum_all_tweets_with_domain"] == 3
    assert row["nb_collected_retweets_with_domain"] == 1  # one retweeted post, twice
    assert row["nb_collected_original_tweets"] == 2
    assert (row["nb_tweets_in_2022_1"], row["nb_tweets_in_2022_2"]) == (1, 2)


def test_domain_month_against_brute_force(shares):
    values = ("normalized_url", "retweeted_id", "tweet_id", "user_id")
    expected = brute_force(shares.collect(), "domain_name", values)
    found = {
        (row["domain_name"], row["month"]): (row["n_links"], row["n_retweeted"], row["n_tweets"], row["n_users"])
        for row in domain_month(shares).collect()
    }
    assert found == expected


def test_link_month_against_brute_force(shares):
    rows = [row for row in shares.collect() if row["domain_name"] == "youtube.com"]
    expected = brute_force(rows, "normalized_url", ("retweeted_id", "tweet_id", "user_id"))
    found = {}
    for row in platform_link_month(shares).collect():
        found[row["normalized_url"], row["month"]] = (row["n_retweeted"], row["n_tweets"], row["n_users"])
        links = [r["link"] for r in rows if (r["normalized_url"], r["month"]) == (row["normalized_url"], row["month"])]
        assert row["link_for_scraping"] == min(links)
    assert found == expected


def test_invariants(shares):
    months = present_months(shares)
    domains = domains_table(domain_month(shares), months)
    links = platform_links_table(platform_link_month(shares), months)
    for table, key in ((domains, "domain_name"), (links, "normalized_url")):
        total = [name for name in table.columns if name.startswith("sum_all")][0]
        by_month = [F.col(name) for name in table.columns if name.startswith("nb_tweets_in_")]
        assert len(by_month) == len(months) == 80
        wrong = table.where(F.expr("+".join(table.select(*by_month).columns)) != F.col(total))
        assert wrong.count() == 0
        retweets = [name for name in table.columns if name.startswith("nb_collected_retweets")][0]
        accounts = [name for name in table.columns if name.startswith("nb_accounts")][0]
        assert table.where((F.col(retweets) > F.col(total)) | (F.col(accounts) > F.col(total))).count() == 0
        assert require_unique(table, [key]) is table


def test_row_order_and_repetition_change_nothing(shares):
    first = domain_month(shares)
    again = domain_month(shares.unionByName(shares).repartition(5, "link"))
    assert first.exceptAll(again).count() == 0 and first.count() == again.count()


def test_one_hot_domain(spark):
    """A domain with most of all rows is counted as exactly as any other."""
    rows = spark.range(30_000)
    shares = rows.select(
        F.when(F.col("id") % 10 < 8, "hot.com").otherwise(F.concat(F.lit("d"), F.col("id") % 10)).alias("domain_name"),
        F.concat(F.lit("u"), F.col("id") % 5000).alias("normalized_url"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).alias("retweeted_id"),
        F.col("id").cast("string").alias("tweet_id"),
        (F.col("id") % 700).cast("string").alias("user_id"),
        F.lit("2022-01").alias("month"),
    )
    hot = domain_month(shares).where("domain_name = 'hot.com'").first()
    assert (hot["n_links"], hot["n_retweeted"], hot["n_tweets"], hot["n_users"]) == (4000, 1, 24_000, 560)


def test_no_months(spark):
    shares = shares_of(spark, [])
    months = present_months(shares)
    table = domains_table(domain_month(shares), months)
    assert months == [] and table.count() == 0
    assert table.columns == ["domain_id", "domain_name", *DOMAIN_LABELS.values(), "nb_collected_original_tweets"]


def links_of(spark, urls):
    rows = [(url, "https://" + url, n + 1, 10 * (n + 1)) for n, url in enumerate(urls)]
    return classify_links(
        spark.createDataFrame(
            rows, "normalized_url string, link_for_scraping string, nb_a bigint, sum_all_tweets_with_link bigint"
        )
    )


URLS = [
    "youtu.be/abcdefghijk",
    "youtube.com/watch?v=abcdefghijk",
    "youtu.be/lmnopqrstuv",
    "youtube.com/channel/UCabcdefghijklmnopqrstuv",
    "youtube.com/@name",
    "youtube.com/playlist?list=1",
]
HERE = "UCabcdefghijklmnopqrstuv"


def metadata_of(spark):
    # The first video is listed twice, once without its channel.
    rows = [("abcdefghijk", None), ("abcdefghijk", HERE), (None, "UCnobody"), ("other", "UCother")]
    return spark.createDataFrame(rows, "video_id string, channel_id string")


def test_kinds_are_routed(spark):
    links = links_of(spark, URLS)
    assert {row["normalized_url"] for row in video_links(links).collect()} == set(URLS[:3])
    (channel,) = channel_links(links).collect()
    assert (channel["normalized_url"], channel["channel_id"]) == (URLS[3], HERE)
    assert video_links(links).columns == channel_links(links).columns[:-1]
    assert nameless_channels(links).first()[0] == 1


def test_metadata_join_adds_no_rows(spark):
    found = {row["normalized_url"]: row["channel_id"] for row in attach_channels(links_of(spark, URLS), metadata_of(spark)).collect()}
    assert found == {URLS[0]: HERE, URLS[1]: HERE, URLS[2]: None}


def test_links_with_channel_is_the_union_of_both_kinds(spark):
    links, metadata = links_of(spark, URLS), metadata_of(spark)
    union = attach_channels(links, metadata).unionByName(channel_links(links))
    both = links_with_channel(links, metadata)
    assert sorted(map(tuple, both.select(*union.columns).collect()), key=str) == sorted(
        map(tuple, union.collect()), key=str
    )
    alone = {row["normalized_url"]: row["channel_id"] for row in links_with_channel(links).collect()}
    assert alone == {URLS[0]: None, URLS[1]: None, URLS[2]: None, URLS[3]: HERE}


def test_channel_rollup(spark):
    rolled = channel_rollup(links_with_channel(links_of(spark, URLS), metadata_of(spark)))
    (row,) = rolled.collect()
    assert row.asDict() == {
        "normalized_url": URLS[0],
        "link_for_scraping": "https://" + URLS[0],
        "nb_a": 1 + 2 + 4,
        "sum_all_tweets_with_link": 70,
        "channel_id": HERE,
        "nb_links": 3,
    }


def test_links_of_channels_add_up(spark, shares):
    links = classify_links(platform_links_table(platform_link_month(shares), []))
    with_channel = links_with_channel(links, video_metadata(spark, SMALL))
    rolled = channel_rollup(with_channel)
    total = rolled.agg(F.sum("nb_links"), F.sum("sum_all_tweets_with_link")).first()
    expected = with_channel.where("channel_id IS NOT NULL").agg(F.count("*"), F.sum("sum_all_tweets_with_link")).first()
    assert tuple(total) == tuple(expected)


def test_metadata_records(spark):
    videos = spark.createDataFrame(
        [("abcdefghijk", HERE, "7", "2020-01-02 03:04:05")],
        "video_id string, channel_id string, video_viewCount string, video_publishedAt string",
    )
    channels = spark.createDataFrame([(HERE, "title")], "channel_id string, channel_title string")
    records = unify_records(videos, channels)
    assert tuple(records.columns) == METADATA_FIELDS == tuple(sorted(METADATA_FIELDS))
    rows = {row["normalized_url"]: row for row in attach_metadata(links_of(spark, URLS), records).collect()}
    assert set(rows) == {URLS[0], URLS[1], URLS[3]}
    assert rows[URLS[0]]["video_viewCount"] == 7 and rows[URLS[0]]["nb_a"] == 1
    assert rows[URLS[0]]["video_publishedAt"] == datetime.datetime(2020, 1, 2, 3, 4, 5)
    assert rows[URLS[3]]["channel_title"] == "title" and rows[URLS[3]]["video_id"] is None


def test_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert duplicate_keys(df, ["k"]).collect() == [("a", 2)]
    with pytest.raises(DuplicateKeys):
        require_unique(df, ["k"])
    shares = shares_of(
        spark,
        [
            ("1", "junk", "7", "0", "https://a.com/x"),
            ("2", "2022-02-01", "7", "9", "mailto:a@b.com|http://localhost/|https://a.com/x"),
        ],
    )
    assert rejected_rows(shares).first().asDict() == {
        "nb_shares": 4,
        "nb_without_time": 1,
        "nb_without_url": 1,
        "nb_without_domain": 2,
    }


def test_null_keys_are_a_group_unless_skipped(spark):
    rows = [(None, "2022-01", "x", "b"), (None, "2022-01", "y", "a"), ("k", "2022-01", "x", None), ("k", None, "z", "c")]
    df = spark.createDataFrame(rows, "key string, month string, value string, other string")
    spec = RollupSpec(keys=("key",), distinct={"n": "value"}, carried={"any": "other"})
    expected = {None: (2, "a"), "k": (1, None)}
    assert {row["key"]: (row["n"], row["any"]) for row in monthly_rollup(df, spec).collect()} == expected
    del expected[None]
    skipping = replace(spec, skip_null_keys=True)
    assert {row["key"]: (row["n"], row["any"]) for row in monthly_rollup(df, skipping).collect()} == expected


def test_counted_and_carried_columns_may_be_keys(spark):
    df = spark.createDataFrame([("k", "2022-01"), ("k", "2022-01")], "key string, month string")
    spec = RollupSpec(keys=("key",), distinct={"n": "key"}, carried={"any": "key"})
    assert [tuple(row) for row in monthly_rollup(df, spec).collect()] == [("k", "2022-01", 1, "k")]


def test_spread_scan(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    spread = spread_scan(orders, "o_orderkey")
    assert spread.exceptAll(orders).count() == 0
