import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from linktally.operators.checks import rejected_rows
from linktally.plans.pipeline import check_outputs, run_pipeline
from linktally.schemas import METADATA_FIELDS, MONTH_COLUMN_PREFIX
from linktally.sources.exports import write_csv
from linktally.sources.tables import (
    read_by_month,
    read_metadata,
    bad_record_values,
    read_metadata_records,
    read_parsed_links,
    read_shares,
    refresh_by_month,
    stored_months,
    write_by_month,
)
from test_posts import HEADER, write

A = "1,2022-01-05,7,0,https://www.a.com/x|https://youtu.be/abcdefghijk\n"
B = "2,2022-02-05,7,9,https://a.com/y|https://youtube.com/channel/UCabcdefghijklmnopqrstuv\n"
C = "3,2022-02-06,8,9,https://youtube.com/@name\n"
BAD = "4,junk,8,0,https://a.com/y\n"


def exported(spark, path):
    return spark.read.option("header", True).option("escape", '"').csv(path)


def rows_of(spark, path, key):
    return {row[key]: row.asDict() for row in exported(spark, path).collect()}


def files_below(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                found[os.path.join(folder, name)] = os.stat(os.path.join(folder, name)).st_mtime_ns
    return found


@pytest.fixture(scope="module")
def metadata(spark):
    rows = [("abcdefghijk", "UCabcdefghijklmnopqrstuv")]
    return spark.createDataFrame(rows, "video_id string, channel_id string")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory, metadata):
    root = tmp_path_factory.mktemp("job")
    write(root / "posts/a.csv.gz", f"{HEADER}\n{A}{BAD}")
    write(root / "posts/b.csv.gz", f"{HEADER}\n{B}{C}")
    return root, run_pipeline(spark, str(root / "posts"), str(root / "out"), video_metadata=metadata)


def test_exports(spark, run):
    _, out = run
    domains = exported(spark, out.domains)
    assert domains.columns == [
        "domain_id",
        "domain_name",
        "nb_distinct_links_from_domain",
        "nb_collected_retweets_with_domain",
        "sum_all_tweets_with_domain",
        "nb_accounts_that_shared_domain_link",
        "nb_tweets_in_2022_1",
        "nb_tweets_in_2022_2",
        "nb_collected_original_tweets",
    ]
    rows = rows_of(spark, out.domains, "domain_name")
    assert list(rows["a.com"].values())[2:] == ["2", "1", "2", "2", "1", "1", "1"]
    assert list(rows["youtube.com"].values())[2:] == ["3", "1", "3", "3", "1", "2", "2"]
    videos = rows_of(spark, out.video_links, "normalized_url")
    assert set(videos) == {"youtu.be/abcdefghijk"}
    links = exported(spark, out.channel_links)
    assert links.columns == [*exported(spark, out.video_links).columns, "channel_id"]
    assert [row["normalized_url"] for row in links.collect()] == ["youtube.com/channel/UCabcdefghijklmnopqrstuv"]
    (channel,) = exported(spark, out.channels).collect()
    assert channel["nb_links"] == "2" and channel["sum_all_tweets_with_link"] == "2"
    assert exported(spark, out.channels).columns[-2:] == ["channel_id", "nb_links"]
    check_outputs(spark, out)


def test_exports_are_in_order(spark, run):
    _, out = run
    totals = [int(row["sum_all_tweets_with_domain"]) for row in exported(spark, out.domains).collect()]
    assert totals == sorted(totals, reverse=True)


def test_rows_without_a_time_stay_in_the_table(spark, run):
    _, out = run
    shares = read_shares(spark, out.shares)
    assert shares.count() == 6
    assert shares.where("month IS NULL").count() == 1


def test_resume_gives_the_same(spark, run, metadata, tmp_path):
    _, out = run
    again = run_pipeline(spark, None, str(tmp_path), shares_path=out.shares, video_metadata=metadata)
    for name in ("domains", "platform_links", "video_links", "channel_links", "channels"):
        left, right = (exported(spark, getattr(o, name)).collect() for o in (out, again))
        assert left == right, name


def test_run_again_replaces(spark, run, metadata):
    root, out = run
    before = exported(spark, out.channels).collect()
    run_pipeline(spark, str(root / "posts"), str(root / "out"), video_metadata=metadata)
    assert exported(spark, out.channels).collect() == before


def test_without_metadata_direct_channel_links_remain(spark, run, tmp_path):
    _, out = run
    alone = run_pipeline(spark, None, str(tmp_path), shares_path=out.shares)
    (channel,) = exported(spark, alone.channels).collect()
    assert channel["nb_links"] == "1"


def test_month_refresh(spark, tmp_path):
    """Only the refreshed month's files change, also when it loses all its rows."""
    write(tmp_path / "posts/a.csv.gz", f"{HEADER}\n{A}{B}{C}")
    out = run_pipeline(spark, str(tmp_path / "posts"), str(tmp_path / "out"))
    before = files_below(out.root)
    write(tmp_path / "new/a.csv.gz", f"{HEADER}\n{A}5,2022-02-07,9,0,https://b.org\n")
    run_pipeline(spark, str(tmp_path / "new"), out.root, refresh_months=["2022-02"])
    after = files_below(out.root)
    for table in (out.shares, out.domain_month, out.link_month):
        kept = {name for name in before if name.startswith(f"{table}/month=2022-01")}
        assert kept and all(after.get(name) == before[name] for name in kept)
    rows = rows_of(spark, out.domains, "domain_name")
    assert set(rows) == {"a.com", "youtube.com", "b.org"}
    assert rows["b.org"]["nb_tweets_in_2022_2"] == "1" and rows["b.org"]["nb_tweets_in_2022_1"] == "0"
    assert rows["youtube.com"]["nb_tweets_in_2022_2"] == "0"
    assert set(rows_of(spark, out.platform_links, "normalized_url")) == {"youtu.be/abcdefghijk"}
    run_pipeline(spark, str(tmp_path / "new"), out.root, refresh_months=["2022-01"])
    assert set(rows_of(spark, out.domains, "domain_name")) == {"a.com", "youtube.com", "b.org"}


def test_refresh_keeps_rows_without_time(spark, tmp_path):
    write(tmp_path / "posts/a.csv.gz", f"{HEADER}\n{A}{BAD}")
    out = run_pipeline(spark, str(tmp_path / "posts"), str(tmp_path / "out"))
    write(tmp_path / "new/a.csv.gz", f"{HEADER}\n8,2022-02-07,9,0,https://b.org\n9,never,9,0,https://b.org\n")
    for _ in range(2):
        run_pipeline(spark, str(tmp_path / "new"), out.root, refresh_months=["2022-02"])
        found = rejected_rows(read_shares(spark, out.shares)).first()
        assert found["nb_without_time"] == 2 and stored_months(spark, out.shares) == ["2022-01", "2022-02"]


def test_failed_refresh_leaves_the_old_month(spark, tmp_path):
    path = str(tmp_path / "table")
    old = spark.createDataFrame([(1, "2022-01"), (2, "2022-02")], "v int, month string")
    write_by_month(old, path)
    broken = spark.range(5).select(
        F.when(F.col("id") == 4, F.raise_error("half way").cast("int")).otherwise(F.col("id").cast("int")).alias("v"),
        F.lit("2022-01").alias("month"),
    )
    with pytest.raises(Exception, match="half way"):
        refresh_by_month(broken, path, ["2022-01", "2022-02"])
    assert sorted(map(tuple, read_by_month(spark, path, old.schema).collect())) == [(1, "2022-01"), (2, "2022-02")]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_few_files_per_month(spark, tmp_path, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        rows = spark.range(0, 600, numPartitions=20).select("id", F.concat(F.lit("2022-0"), F.col("id") % 6 + 1).alias("month"))
        write_by_month(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    files = [name for name in files_below(str(tmp_path / "t")) if name.endswith(".parquet")]
    assert len(files) <= 12


def test_no_rows(spark, tmp_path):
    write(tmp_path / "posts/a.csv.gz", f"{HEADER}\n")
    out = run_pipeline(spark, str(tmp_path / "posts"), str(tmp_path / "out"))
    for path in (out.domains, out.platform_links, out.channels):
        table = exported(spark, path)
        assert table.count() == 0
        assert "nb_collected_original_tweets" in table.columns
        assert not [name for name in table.columns if name.startswith(MONTH_COLUMN_PREFIX)]


def test_strict_time(spark, tmp_path):
    write(tmp_path / "posts/a.csv.gz", f"{HEADER}\n{BAD}")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_pipeline(spark, str(tmp_path / "posts"), str(tmp_path / "out"), strict_time=True)


def test_bad_arguments(spark, tmp_path, metadata):
    with pytest.raises(ValueError, match="either"):
        run_pipeline(spark, None, str(tmp_path))
    with pytest.raises(ValueError, match="channel_id"):
        run_pipeline(spark, None, str(tmp_path), shares_path="x", video_metadata=metadata.drop("channel_id"))
    with pytest.raises(AnalysisException):
        run_pipeline(spark, None, str(tmp_path), shares_path=str(tmp_path / "absent"))
    spark.range(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="domain_id"):
        read_shares(spark, str(tmp_path / "other"))


def test_parsed_links_of_an_earlier_tool(spark, tmp_path):
    rows = [(1, "2022-01-05T10:00:00", 7, None, "https://a.com", "a.com", "a.com"), (2, "2022-01-06", 7, 9, "l", "l", None)]
    schema = "id long, local_time string, user_id long, retweeted_id long, link string, normalized_url string, domain string"
    spark.createDataFrame(rows, schema).write.option("compression", "gzip").parquet(str(tmp_path / "parsed"))
    shares = {row["tweet_id"]: row for row in read_parsed_links(spark, str(tmp_path / "parsed")).collect()}
    assert shares["1"]["month"] == "2022-01" and shares["1"]["user_id"] == "7" and shares["1"]["retweeted_id"] is None
    assert len(shares["1"]["domain_id"]) == 32 and shares["2"]["domain_id"] is None
    with pytest.raises(ValueError):
        spark.range(1).write.parquet(str(tmp_path / "other"))
        read_parsed_links(spark, str(tmp_path / "other"))


def test_metadata_files(spark, tmp_path):
    path = write(tmp_path / "m.csv", "x,channel_id,video_id\n1,UCa,-12345678901\n2,,0123\n")
    rows = [tuple(row) for row in read_metadata(spark, path).collect()]
    assert rows == [("-12345678901", "UCa"), ("0123", None)]
    from linktally.schemas import METADATA_FIELDS

    values = ["5" if name.endswith("Count") else "2020-01-01" if name.endswith("At") else "t" for name in METADATA_FIELDS]
    path = write(tmp_path / "r.csv", ",".join(METADATA_FIELDS) + "\n" + ",".join(values) + "\n")
    (row,) = read_metadata_records(spark, path).collect()
    assert row["video_viewCount"] == 5 and row["video_publishedAt"].year == 2020 and row["video_id"] == "t"


def test_csv_keeps_awkward_text(spark, tmp_path):
    rows = [(' a "q", b ',), ("line\nbreak",), (None,), ("\\",)]
    df = spark.createDataFrame(rows, "v string").withColumn("n", F.lit(1))
    write_csv(df, str(tmp_path / "out"))
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path / "out"))
    assert sorted((row["v"] for row in back.collect()), key=str) == sorted((row[0] for row in rows), key=str)


def test_shares_are_ordered_within_files(spark, run):
    _, out = run
    rows = spark.read.parquet(out.shares).where("month = '2022-02'").select(F.input_file_name(), "domain_name").collect()
    assert len(rows) == 3
    for file in {row[0] for row in rows}:
        domains = [row[1] for row in rows if row[0] == file]
        assert domains == sorted(domains)


def test_values_that_are_not_of_their_type(spark, tmp_path):
    rows = [("v1", " 12 ", "2022-01-03 10:00:00"), ("v2", "many", "soon"), ("v3", "", None)]
    names = ["video_id", "video_viewCount", "video_publishedAt"]
    others = [name for name in METADATA_FIELDS if name not in names]
    df = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in names))
    write_csv(df.select("*", *[F.lit(None).cast("string").alias(name) for name in others]), str(tmp_path))
    read = {row["video_id"]: row for row in read_metadata_records(spark, str(tmp_path)).collect()}
    assert read["v1"]["video_viewCount"] == 12 and read["v2"]["video_viewCount"] is None
    bad = {row["field"]: (row["nb_values"], row["nb_bad"]) for row in bad_record_values(spark, str(tmp_path)).collect()}
    assert bad["video_viewCount"] == (2, 1) and bad["video_publishedAt"] == (2, 1) and bad["channel_viewCount"] == (0, 0)
    with pytest.raises(Exception, match="many|soon"):
        read_metadata_records(spark, str(tmp_path), strict=True).collect()
