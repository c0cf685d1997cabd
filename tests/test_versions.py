"""Runs that are published whole."""

import os

import pytest
from pyspark.sql import functions as F

from linktally.plans import versions
from linktally.plans.reports import domain_month, platform_link_month
from linktally.plans.shares import shares_from_posts
from linktally.plans.versions import current_outputs, current_version, read_version, run_version
from linktally.sources.exports import read_export
from test_posts import posts_of

TABLES = ("shares", "domain_month", "platform_link_month")


def shares(spark, rows):
    return shares_from_posts(posts_of(spark, [(str(i), time, "u", "0", link) for i, time, link in rows]))


FIRST = [
    (1, "2022-01-03", "https://a.com/1"),
    (2, "2022-02-03", "https://b.com/1|https://youtu.be/abcdefghijk"),
    (3, "never", "https://c.com/1"),
]
SECOND = [(2, "2022-02-03", "https://b.com/1"), (4, "2022-02-09", "https://d.com/1"), (3, "never", "https://c.com/1")]


def state(spark, root):
    out = current_outputs(spark, root)
    tables = {name: sorted(map(str, read_version(spark, root, name).collect())) for name in TABLES}
    reports = {name: sorted(map(str, read_export(spark, getattr(out, name)).collect())) for name in ("domains", "platform_links")}
    return tables, reports


def agrees(spark, root):
    """Rollups and reports are those of the shares that are read."""
    stored = read_version(spark, root, "shares")
    assert sorted(map(str, domain_month(stored).collect())) == sorted(map(str, read_version(spark, root, "domain_month").collect()))
    links = platform_link_month(stored).collect()
    assert sorted(map(str, links)) == sorted(map(str, read_version(spark, root, "platform_link_month").collect()))
    named = {row["domain_name"] for row in read_export(spark, current_outputs(spark, root).domains).collect()}
    assert named == {row["domain_name"] for row in stored.where(F.col("month").isNotNull()).collect()}
    return named


def test_refresh_replaces_months_and_keeps_others(spark, tmp_path):
    root = str(tmp_path / "out")
    run_version(spark, shares(spark, FIRST), root)
    assert agrees(spark, root) == {"a.com", "b.com", "youtube.com"}
    version = run_version(spark, shares(spark, SECOND), root, refresh_months=["2022-02"])
    assert agrees(spark, root) == {"a.com", "b.com", "d.com"}
    assert version.number == 2 and version.months() == ["2022-01", "2022-02"]
    assert read_version(spark, root, "shares").where("month IS NULL").count() == 1
    # January's rows lie where the first run put them
    assert version.tables["shares"]["2022-01"] != version.tables["shares"]["2022-02"]
    # a month without rows goes
    run_version(spark, shares(spark, FIRST).where("month = '2022-01'"), root, refresh_months=["2022-02"])
    assert agrees(spark, root) == {"a.com"}


@pytest.mark.parametrize("step", ["domain_month", "platform_link_month", "write_reports", "_publish"])
def test_a_run_that_fails_on_the_way_changes_nothing(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "out")
    run_version(spark, shares(spark, FIRST), root)
    before = state(spark, root)

    def fails(*args, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, step, fails)
        with pytest.raises(RuntimeError, match="lost"):
            run_version(spark, shares(spark, SECOND), root, refresh_months=["2022-02"])
    assert state(spark, root) == before and agrees(spark, root) == {"a.com", "b.com", "youtube.com"}
    run_version(spark, shares(spark, SECOND), root, refresh_months=["2022-02"])
    assert agrees(spark, root) == {"a.com", "b.com", "d.com"}


def test_a_reader_of_the_version_before_is_not_disturbed(spark, tmp_path):
    root = str(tmp_path / "out")
    first = run_version(spark, shares(spark, FIRST), root)
    held = read_version(spark, root, "shares", first)
    run_version(spark, shares(spark, SECOND), root)
    assert held.count() == 4
    run_version(spark, shares(spark, SECOND), root)
    runs = set(os.listdir(f"{root}/shares")) | set(os.listdir(f"{root}/domains"))
    assert f"run={first.run}" not in runs and len(runs) == 2
    assert current_version(spark, root).number == 3


def test_reading_before_the_first_run_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_version(spark, str(tmp_path), "shares")
