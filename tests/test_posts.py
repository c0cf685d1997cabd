import datetime
import gzip
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from linktally.operators.links import clean_posts, cluster_by_month, explode_links
from linktally.schemas import POST_COLUMNS
from linktally.sources.posts import list_files, read_bronze, read_posts, write_bronze

HEADER = "id,local_time,user_id,retweeted_id,links"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    data = text.encode("utf8")
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)
    return str(path)


def posts_of(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in POST_COLUMNS))


def names(files, root):
    return [name.split(str(root) + "/")[1] for name in files]


def test_list_files(spark, tmp_path, monkeypatch):
    for name in ("a.csv.gz", "b.csv", "deep/er/c.csv.gz", "deep/d[1].csv"):
        write(tmp_path / name, HEADER + "\n")
    assert names(list_files(spark, str(tmp_path)), tmp_path) == ["a.csv.gz", "deep/er/c.csv.gz"]
    assert names(list_files(spark, str(tmp_path), "*.csv"), tmp_path) == ["b.csv"]
    assert names(list_files(spark, str(tmp_path) + "/", "deep/*.csv"), tmp_path) == ["deep/d[1].csv"]
    assert len(list_files(spark, str(tmp_path / "b.csv"), "**/*.gz")) == 1
    assert len(list_files(spark, "file:" + str(tmp_path / "b.csv"))) == 1
    assert names(list_files(spark, "file://" + str(tmp_path), "*.csv"), tmp_path) == ["b.csv"]
    monkeypatch.chdir(tmp_path)
    assert names(list_files(spark, "deep"), tmp_path) == ["deep/er/c.csv.gz"]
    write(tmp_path / "one/two/one", HEADER + "\n")
    with pytest.raises(FileNotFoundError):
        list_files(spark, "one")
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path), "*.parquet")
    with pytest.raises(AnalysisException):
        list_files(spark, str(tmp_path / "absent"))


def test_read_by_header_name(spark, tmp_path):
    """Gzip and plain, swapped and extra columns, quotes and line breaks in values."""
    write(tmp_path / "a.csv.gz", f'{HEADER}\n1,2022-01-03T10:00:00,42,0,"https://a.com|https://b.com/\nz"\n')
    write(tmp_path / "in/b[x].csv", 'links,extra,id,user_id,local_time,retweeted_id\n"a ""q"" b",e,2,43,2022-02-01,9\n')
    rows = {row["id"]: row for row in read_posts(spark, str(tmp_path), "**/*.csv*").collect()}
    assert tuple(rows["1"]) == ("1", "2022-01-03T10:00:00", "42", "0", "https://a.com|https://b.com/\nz")
    assert tuple(rows["2"]) == ("2", "2022-02-01", "43", "9", 'a "q" b')


def test_same_header_is_checked(spark, tmp_path):
    write(tmp_path / "a.csv", f"{HEADER}\n1,t,u,0,l\n")
    write(tmp_path / "b.csv", f"{HEADER}\n2,t,u,0,l\n")
    assert read_posts(spark, str(tmp_path), "*.csv", same_header=True).count() == 2
    write(tmp_path / "c.csv", "links,retweeted_id,user_id,local_time,id\nl,0,u,t,3\n")
    assert read_posts(spark, str(tmp_path), "*.csv", each_header=True).where("links = 'l'").count() == 3
    with pytest.raises(Exception, match="header"):
        read_posts(spark, str(tmp_path), "*.csv").collect()
    with pytest.raises(Exception, match="header"):
        read_posts(spark, str(tmp_path), "*.csv", same_header=True).collect()


def test_missing_column_raises(spark, tmp_path):
    write(tmp_path / "a.csv", f"{HEADER}\n1,t,u,0,l\n")
    write(tmp_path / "b.csv", "id,local_time,user_id,retweeted_id\n1,t,u,0\n")
    with pytest.raises(ValueError, match="links"):
        read_posts(spark, str(tmp_path), "*.csv", each_header=True)


@pytest.mark.parametrize("row", ["2,t,u,0", "2,t,u,0,l,more"])
@pytest.mark.parametrize("multiline", [True, False])
def test_ragged_row_raises(spark, tmp_path, row, multiline):
    write(tmp_path / "a.csv", f"{HEADER}\n1,t,u,0,l\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_posts(spark, str(tmp_path), "*.csv", multiline=multiline).collect()


def test_plain_files_split_without_multiline(spark, tmp_path):
    lines = "".join(f"{n},2022-01-01,{n},0,https://a.com/{n}\n" for n in range(50_000))
    write(tmp_path / "a.csv", f"{HEADER}\n{lines}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400000")
    try:
        split = read_posts(spark, str(tmp_path), "*.csv", multiline=False)
        assert split.rdd.getNumPartitions() > 3
        assert split.count() == 50_000
        assert read_posts(spark, str(tmp_path), "*.csv").rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bronze(spark, tmp_path):
    posts = posts_of(spark, [("1", "2022-01-01", "u", "0", "https://a.com")])
    write_bronze(posts, str(tmp_path / "bronze"))
    assert read_bronze(spark, str(tmp_path / "bronze")).collect() == posts.collect()


def test_clean_posts(spark):
    posts = posts_of(
        spark,
        [
            ("1", "2022-01-31 23:59:59", "7", "0", "https://a.com"),
            ("2", "2022-02-01 00:00:00", "0", "", "https://a.com"),
            ("0", "junk", "7", "9", "https://a.com"),
            ("4", None, "7", None, "https://a.com"),
            ("5", "2022-02-01", "7", "9", "x"),
            ("6", "2022-02-01", "7", "9", ""),
            ("7", "2022-02-01", "7", "9", None),
        ],
    )
    rows = {row["tweet_id"]: row for row in clean_posts(posts).collect()}
    assert set(rows) == {"1", "2", None, "4"}
    assert rows["1"]["month"] == "2022-01" and rows["2"]["month"] == "2022-02"
    assert rows["1"]["local_time"] == datetime.datetime(2022, 1, 31, 23, 59, 59)
    assert [rows[key]["retweeted_id"] for key in ("1", "2", None, "4")] == [None, None, "9", None]
    assert rows["2"]["user_id"] is None and rows["1"]["user_id"] == "7"
    assert rows[None]["local_time"] is None and rows[None]["month"] is None
    kept = {row["tweet_id"]: row for row in clean_posts(posts, null_zero_ids=False).collect()}
    assert kept["0"]["retweeted_id"] == "9" and kept["2"]["user_id"] == "0"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean_posts(posts, strict_time=True).collect()


def test_month_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    posts = posts_of(spark, [("1", "2022-01-31T23:30:00", "u", "0", "https://a.com")])
    try:
        for other in ("UTC", "Asia/Tokyo", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert clean_posts(posts).first()["month"] == "2022-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_explode_links(spark):
    cell = "https://a.example.com||https://b.example.com|"
    posts = posts_of(spark, [("1", "2022-01-01", "u", "0", cell), ("2", "2022-01-01", "u", "0", "l1|l1")])
    rows = [(row["tweet_id"], row["link"]) for row in explode_links(clean_posts(posts)).collect()]
    assert sorted(rows) == [("1", "https://a.example.com"), ("1", "https://b.example.com"), ("2", "l1"), ("2", "l1")]


def test_cluster_keeps_rows_and_spreads_copies(spark, tmp_path):
    """A third of all rows being copies of one post still fills many slices."""
    copies = "".join("1,2022-01-01,1,0,https://a.com\n" for _ in range(1000))
    others = "".join(f"{n},2022-0{n % 3 + 1}-01,{n},0,https://b.com\n" for n in range(2, 2000))
    write(tmp_path / "a.csv.gz", f"{HEADER}\n{copies}{others}")
    posts = clean_posts(read_posts(spark, str(tmp_path)))
    clustered = cluster_by_month(posts, slices=16)
    assert clustered.exceptAll(posts).count() == 0 and clustered.count() == posts.count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        task = F.spark_partition_id().alias("task")
        rows = cluster_by_month(posts, slices=16).select(task, "tweet_id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    copies = Counter(row["task"] for row in rows if row["tweet_id"] == "1")
    assert len(copies) > 4 and max(copies.values()) < 500
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert cluster_by_month(posts, slices=16).exceptAll(posts).count() == 0
        assert cluster_by_month(posts, slices=16).rdd.getNumPartitions() == 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
