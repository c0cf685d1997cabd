"""What the plans look like: pruning, pushdown, no Python, no repeated work."""

import re

import pytest
from pyspark.sql import functions as F

from linktally.operators.enrich import (
    attach_channels,
    channel_rollup,
    classify_links,
    links_with_channel,
)
from linktally.functions.suffixes import suffix_rules
from linktally.operators.links import clean_posts
from linktally.plans.reports import domain_month, domains_table, platform_link_month
from linktally.plans.shares import shares_from_posts, with_url_and_domain
from linktally.sources.exports import read_positions, write_csv
from linktally.sources.posts import read_posts
from linktally.sources.tables import read_shares, write_by_month
from suite.inputs import page_links, raw_posts, video_metadata
from suite.queries import QUERIES
from test_posts import HEADER, write

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    write_by_month(shares_from_posts(raw_posts(spark, SMALL)), path)
    return read_shares(spark, path)


def test_month_filter_prunes_partitions(stored):
    plan = plan_of(domain_month(stored.where(F.col("month") == "1996-02")))
    assert re.search(r"PartitionFilters: \[.*month.*1996-02", plan)


def test_only_needed_columns_are_read(stored):
    plan = plan_of(domain_month(stored))
    schema = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    names = {field.split(":")[0] for field in schema.split(",")}
    assert names == {"domain_name", "normalized_url", "retweeted_id", "tweet_id", "user_id"}
    assert "IsNotNull(domain_name)" in plan


def test_platform_filter_reaches_the_scan(stored):
    assert "EqualTo(domain_name,youtube.com)" in plan_of(platform_link_month(stored))


def test_csv_scan_skips_other_columns_when_asked(spark, tmp_path):
    write(tmp_path / "a.csv", f"{HEADER},text\n1,2022-01-01,7,0,https://a.com,long\n")
    plan = plan_of(clean_posts(read_posts(spark, str(tmp_path), "*.csv", check_width=False)))
    assert "text" not in re.search(r"ReadSchema: struct<(.*)>", plan).group(1)


def test_counted_value_is_in_the_shuffle_key(stored):
    """What keeps a hot domain from filling one task."""
    plan = plan_of(domain_month(stored))
    keys = re.findall(r"hashpartitioning\(([^)]*)", plan)
    assert any("domain_name" in key and "tweet_id" in key and "user_id" in key for key in keys)
    assert len(keys) == 2


def test_total_shuffles_only_counts(stored):
    plan = final_plan(domains_table(domain_month(stored), ["1996-01", "1996-02"]))
    assert plan.count("FileScan") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(", plan)) == 4  # the pivot adds up by key and month first
    assert "Join" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_url_work_is_one_generated_stage_without_shuffle(spark):
    plan = plan_of(with_url_and_domain(page_links(spark, SMALL)))
    assert "hashpartitioning" not in plan and "Python" not in plan
    # one lookup, however deep the rules are
    assert plan.count("BroadcastHashJoin LeftOuter") == 1
    deep = suffix_rules(spark, extra=["a.b.c.d.com", "*.e.b.c.d.com"])
    assert plan_of(with_url_and_domain(page_links(spark, SMALL), deep)).count("BroadcastHashJoin LeftOuter") == 1


def test_filters_do_not_repeat_the_url_rules(spark):
    """A filter on a result must not carry the rules with it to the scan."""
    links = classify_links(with_url_and_domain(page_links(spark, SMALL)).drop("domain_name"))
    plan = plan_of(attach_channels(links, video_metadata(spark, SMALL)))
    assert plan.count("utm_") <= 2  # once in the tree's details, once more if a stage is listed twice
    for condition in re.findall(r"Condition : .*", plan):
        assert "utm_" not in condition


@pytest.mark.parametrize("name", ["domains_total", "platform_link_month", "link_kind", "rejected_rows", "metadata_inner"])
def test_no_python_in_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def final_plan(df):
    """The plan as it ran, without the one it started from."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().partition("\n+- == Initial Plan ==")[0]


def test_counts_and_carried_link_share_one_scan_and_one_shuffle_of_rows(stored):
    plan = final_plan(platform_link_month(stored))
    assert plan.count("FileScan parquet") - plan.count("ReusedExchange") <= 1 and plan.count("ReusedExchange") == 1
    of_rows = [e for e in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "_value" in e]
    assert len({re.sub(r"#\d+", "", e) for e in of_rows}) == 1 and "_tag" in of_rows[0]


@pytest.mark.parametrize("name", ["channels", "platform_links_wide", "domains_by_month_wide"])
def test_no_sorting_above_sums_and_no_test_per_month(spark, name):
    plan = final_plan(QUERIES[name](spark, SMALL))
    assert all("sum(" not in line for line in plan.splitlines() if "SortAggregate" in line)
    assert "CASE WHEN (month" not in plan and ("pivotfirst" in plan) == (name != "channels")


def test_positions_bring_a_row_per_file_together(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id", "CAST(id % 9 AS STRING) || '\n' AS text").orderBy("id")
    write_csv(rows, str(tmp_path / "out"))
    placed = read_positions(spark, str(tmp_path / "out"))
    plan = final_plan(placed)
    single = plan.split("Exchange SinglePartition")
    assert len(single) == 2 and "HashAggregate" in single[1].splitlines()[1]
    assert placed.where("position <> CAST(id AS INT) + 1").isEmpty() and placed.count() == 5000


def test_large_plain_file_is_many_tasks(spark, tmp_path):
    rows = "".join(f'{i},2022-01-01,7,0,"https://a.com/{i}\n"\n' for i in range(3000))
    write(tmp_path / "a.csv", f"{HEADER}\n{rows}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        posts = read_posts(spark, str(tmp_path), "*.csv", split=True)
        assert posts.rdd.getNumPartitions() >= 10 and posts.count() == 3000
        assert read_posts(spark, str(tmp_path), "*.csv").rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_hot_video_is_split_in_the_metadata_join(spark):
    """A third of the links lead to one video; adaptive execution splits them."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    number = F.col("id")
    video = F.substring(F.md5(F.when(number % 3 == 0, 0).otherwise(number).cast("string")), 1, 11)
    links = spark.range(0, 300_000, 1, 8).select(
        F.concat(F.lit("youtu.be/"), video, F.lit("?t="), F.md5(number.cast("string"))).alias("normalized_url"),
        F.lit("l").alias("link_for_scraping"),
    )
    metadata = spark.range(0, 300_000, 1, 8).select(
        F.substring(F.md5(number.cast("string")), 1, 11).alias("video_id"),
        F.concat(F.lit("UC"), number % 100).alias("channel_id"),
    )
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rolled = channel_rollup(links_with_channel(classify_links(links), metadata))
        counts = [row["nb_links"] for row in rolled.collect()]
        plan = rolled._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(counts) == 300_000 and max(counts) > 100_000
    assert "SortMergeJoin(skew=true)" in plan
