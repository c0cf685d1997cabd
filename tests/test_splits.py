"""Plain CSV files that many tasks share, and rows that go to the quarantine."""

import random

import pytest
from pyspark.sql import functions as F

from linktally.operators.quarantine import BAD_TIME, MALFORMED
from linktally.plans.pipeline import run_pipeline
from linktally.schemas import DOMAIN_MONTH_SCHEMA, POST_COLUMNS, QUARANTINE_SCHEMA
from linktally.sources.posts import read_csv_by_name, read_posts
from linktally.sources.splits import csv_records
from linktally.sources.tables import read_by_month, read_shares
from test_posts import HEADER, write


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes, so that most records cross a border."""
    settings = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def value(random):
    text = "".join(random.choice(["a", "é", ",", '"', "\n", "\r\n", "", " ", "long " * 9]) for _ in range(random.randrange(6)))
    return text if text.strip() else "x"


def cell(text, always):
    return '"' + text.replace('"', '""') + '"' if always or set(text) & set(',"\n\r') else text


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_split_files_equal_whole_ones(spark, tmp_path, small_splits, ending):
    dice = random.Random(7)
    for name in ("a.csv", "b.csv"):
        rows = [[value(dice) for _ in range(3)] for _ in range(60)]
        lines = [",".join(cell(v, dice.random() < 0.3) for v in row) for row in rows]
        write(tmp_path / name, "".join(line + ending for line in ["p,q,r", *lines]))
    files = [str(tmp_path / name) for name in ("a.csv", "b.csv")]
    whole = read_csv_by_name(spark, files, ("r", "p"), multiline=True)
    parts = read_csv_by_name(spark, files, ("r", "p"), split=True)
    assert parts.rdd.getNumPartitions() > 20 > whole.rdd.getNumPartitions()
    # inside a value the reader of whole files may change line ends; the split one keeps them
    def rows_of(df):
        return sorted(tuple(v.replace("\r\n", "\n") for v in row) for row in df.collect())

    assert rows_of(parts) == rows_of(whole) and parts.count() == 120


def test_borders_at_every_byte(spark, tmp_path):
    """One record of every kind under every split size."""
    text = 'p,q\n1,"a\nb"\n"2\n\n3","c""\n"""\n\n4,d\n5,"\n\n\n\n\n\n\n\n\n\n\n\n\n"\n6,e'
    file = write(tmp_path / "a.csv", text)
    expected = ['1,"a\nb"', '"2\n\n3","c""\n"""', "4,d", '5,"' + "\n" * 13 + '"', "6,e"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for size in (1, 2, 3, 5, 8, 13, 21, 40, 100):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            found = [row["record"] for row in csv_records(spark, [file], ("p", "q")).collect()]
            assert sorted(found) == sorted(expected), size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_lines_are_put_together_once(spark, tmp_path, small_splits):
    """Whole records and the pieces of crossing ones come from one pass over the lines."""
    text = "p,q\n" + "".join(f'{i},"a\nb {i}"\n' for i in range(40))
    found = csv_records(spark, [write(tmp_path / "a.csv", text)], ("p", "q"))
    leaves = found._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert [leaves.apply(i).nodeName() for i in range(leaves.size())] == ["InMemoryRelation"] * 2
    assert sorted(row["record"] for row in found.collect()) == sorted(f'{i},"a\nb {i}"' for i in range(40))


def test_gzip_files_stay_whole_and_mix_with_split_ones(spark, tmp_path, small_splits):
    write(tmp_path / "a.csv", f'{HEADER}\n1,2022-01-03,7,0,"https://a.com\n"\n')
    write(tmp_path / "b.csv.gz", f'{HEADER}\n2,2022-01-03,7,0,"https://b.com\n"\n')
    posts = read_posts(spark, str(tmp_path), "*", split=True)
    assert sorted(row["id"] for row in posts.collect()) == ["1", "2"]


def test_bad_quotes_and_other_headers_raise(spark, tmp_path, small_splits):
    write(tmp_path / "q.csv", 'p,q\n1,a"b\n2,c\n3,"d\n')
    with pytest.raises(Exception, match="malformed CSV record"):
        read_csv_by_name(spark, [str(tmp_path / "q.csv")], ("p",), split=True).collect()
    write(tmp_path / "w.csv", "p,q\n1,2,3\n")
    with pytest.raises(Exception, match="malformed CSV record"):
        read_csv_by_name(spark, [str(tmp_path / "w.csv")], ("p",), split=True).collect()
    assert read_csv_by_name(spark, [str(tmp_path / "w.csv")], ("q",), check_width=False, split=True).first()["q"] == "2"
    write(tmp_path / "z.csv", "q,p\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv_by_name(spark, [str(tmp_path / "w.csv"), str(tmp_path / "z.csv")], ("p",), split=True).collect()


def test_files_without_rows(spark, tmp_path, small_splits):
    files = [write(tmp_path / "a.csv", "p,q\n"), write(tmp_path / "b.csv", "p,q"), write(tmp_path / "c.csv", "﻿p,q\r\n1,2\r\n")]
    assert [tuple(row) for row in read_csv_by_name(spark, files, ("p", "q"), split=True, each_header=True).collect()] == [("1", "2")]


BAD = f'''{HEADER},note
1,2022-01-03,7,0,https://a.com,x
2,2022-01-04,7,0
3,never,7,0,https://b.com,"a ""b"", c"
4,2022-02-05,8,0,https://c.com,"two
lines"
5,2022-02-05,8,0,https://c.com,x,y,z
6,,8,0,https://c.com,x
'''


@pytest.mark.parametrize("name, split", [("p.csv", True), ("p.csv", False), ("p.csv.gz", True)])
def test_every_row_is_a_share_or_in_quarantine(spark, tmp_path, name, split):
    write(tmp_path / "in" / name, BAD)
    out = run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), pattern="*", quarantine=True, split=split)
    bad = read_by_month(spark, out.quarantine, QUARANTINE_SCHEMA).collect()
    found = {row["raw_row"].split(",")[0]: row for row in bad}
    assert {number: row["reason"] for number, row in found.items()} == {"2": MALFORMED, "5": MALFORMED, "3": BAD_TIME, "6": BAD_TIME}
    assert found["2"]["raw_row"] == "2,2022-01-04,7,0" and found["2"]["month"] == "2022-01"
    assert found["3"]["raw_row"] == '3,never,7,0,https://b.com,"a ""b"", c"' and found["3"]["month"] is None
    assert {row["source_file"].rsplit("/", 1)[1] for row in bad} == {name}
    assert sorted(row["tweet_id"] for row in read_shares(spark, out.shares).collect()) == ["1", "4"]
    assert {row["domain_name"] for row in read_by_month(spark, out.domain_month, DOMAIN_MONTH_SCHEMA).collect()} == {"a.com", "c.com"}
    with pytest.raises(Exception):
        run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "strict"), pattern="*", split=split)


def test_quarantine_is_refreshed_with_its_month(spark, tmp_path):
    write(tmp_path / "in/p.csv", BAD)
    out = run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), pattern="*", quarantine=True)

    def rows():
        return sorted((r["month"] or "", r["raw_row"][0]) for r in read_by_month(spark, out.quarantine, QUARANTINE_SCHEMA).collect())

    before = rows()
    assert before == [("", "3"), ("", "6"), ("2022-01", "2"), ("2022-02", "5")]
    # the same file again adds nothing; mended, its month has no bad row left
    run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), pattern="*", quarantine=True, refresh_months=["2022-02"])
    assert rows() == before
    write(tmp_path / "in/p.csv", BAD.replace("x,y,z", "x"))
    run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), pattern="*", quarantine=True, refresh_months=["2022-02"])
    assert rows() == before[:3]
    assert read_shares(spark, out.shares).where(F.col("month") == "2022-02").count() == 2
    assert set(POST_COLUMNS) <= set(spark.read.parquet(out.posts).columns)
