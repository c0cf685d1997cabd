import re

import pytest
from pyspark.sql import functions as F

from linktally.functions.suffixes import default_rules, read_suffix_rules, rule_flags, suffix_rules
from linktally.operators.enrich import classify_links
from linktally.operators.domains import attribute_domain
from linktally.plans.shares import with_url_and_domain
from url_cases import CASES, SUFFIXES


def parsed(spark, links, rules=None):
    df = spark.createDataFrame([(link,) for link in links], "link string")
    rows = with_url_and_domain(df, rules).collect()
    return {row["link"]: (row["normalized_url"], row["domain_name"]) for row in rows}


@pytest.mark.parametrize("listed", [True, False])
def test_hand_cases(spark, listed):
    """The cases hold with their own suffix table, and with the built-in one."""
    rules = suffix_rules(spark, SUFFIXES) if listed else suffix_rules(spark, extra=["b"])
    result = parsed(spark, [case[0] for case in CASES], rules)
    assert result == {case[0]: (case[1], case[2]) for case in CASES}


def test_link_kinds(spark):
    platform_cases = [case for case in CASES if case[3]]
    df = spark.createDataFrame([(case[1],) for case in platform_cases], "normalized_url string")
    rows = {row["normalized_url"]: row for row in classify_links(df).collect()}
    for _, url, _, kind, video, channel in platform_cases:
        row = rows[url]
        assert (row["link_kind"], row["video_id"], row["channel_id"]) == (kind, video, channel), url


def test_null_link(spark):
    df = spark.createDataFrame([(None,)], "link string")
    row = with_url_and_domain(df).first()
    assert row["normalized_url"] is None and row["domain_name"] is None


def test_wildcards_and_exceptions(spark):
    rules = suffix_rules(spark, ["com", "ck", "*.ck", "!www.ck", "a.b.com", "*.deep.x.com"])
    hosts = {
        "shop.foo.ck": "shop.foo.ck",
        "x.shop.foo.ck": "shop.foo.ck",
        "foo.ck": None,
        "www.ck": "www.ck",
        "x.www.ck": "www.ck",
        "ck": None,
        "b.com": "b.com",
        "a.b.com": None,
        "z.a.b.com": "z.a.b.com",
        "y.deep.x.com": None,
        "w.y.deep.x.com": "w.y.deep.x.com",
        "deep.x.com": "x.com",
        "unknown.zzz": "unknown.zzz",
        "trailing.com.": "trailing.com",
        "a.trailing.com..": None,
        "10.0.0.1": None,
        "x.foo.google": "foo.google",
        "zzz": None,
        ".com": None,
    }
    df = spark.createDataFrame([(host,) for host in hosts], "host string")
    rows = attribute_domain(df, rules).collect()
    assert {row["host"]: row["domain_name"] for row in rows} == hosts


def test_suffix_file(spark, tmp_path):
    path = tmp_path / "suffixes.dat"
    path.write_text("// comment\n\ncom\nCO.uk trailing words\nuk\n*.ck\n!www.ck\nck\n", encoding="utf8")
    rules = read_suffix_rules(spark, str(path))
    listed = ["com", "co.uk", "uk", "*.ck", "!www.ck", "ck"]
    assert rule_flags(listed) == {"com": 1, "co.uk": 1, "uk": 1, "ck": 3, "www.ck": 4}
    found = {row["last"]: row.asDict() for row in rules.frame.collect()}
    assert found == {row["last"]: row.asDict() for row in suffix_rules(spark, listed).frame.collect()}
    assert found["ck"]["flags"] == 3 and found["ck"]["pairs"] == {"www.ck": "4"}
    assert rules.depth == 2
    assert parsed(spark, ["http://a.b.co.uk/"], rules)["http://a.b.co.uk/"] == ("a.b.co.uk", "b.co.uk")
    (tmp_path / "empty.dat").write_text("// nothing\n", encoding="utf8")
    with pytest.raises(ValueError):
        read_suffix_rules(spark, str(tmp_path / "empty.dat"))


def test_too_many_rules_raise(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("linktally.functions.suffixes.MOST_RULES", 1)
    (tmp_path / "two.dat").write_text("com\norg\n", encoding="utf8")
    for build in (lambda: suffix_rules(spark, ["com", "org"]), lambda: read_suffix_rules(spark, str(tmp_path / "two.dat"))):
        with pytest.raises(ValueError, match="2 suffix rules"):
            build()


@pytest.mark.parametrize(
    "host, domain",
    [
        ("a.site.公司.cn", "site.公司.cn"),
        ("a.site.xn--55qx5d.cn", "site.xn--55qx5d.cn"),
        ("a.site.рф", "site.рф"),
        ("a.site.xn--p1ai", "site.xn--p1ai"),
        ("a.site.個人.香港", "site.個人.香港"),
        ("a.site.xn--gmqw5a.香港", "site.xn--gmqw5a.香港"),
        ("a.site.xn--gmqw5a.xn--j6w193g", "site.xn--gmqw5a.xn--j6w193g"),
        ("a。site．com", "site.com"),
        ("a.site.xn--", "site.xn--"),
        ("a.b.c.deep.er.com", "b.c.deep.er.com"),
        ("deep.er.com", "er.com"),
    ],
)
def test_both_spellings_of_a_label(spark, host, domain):
    rules = suffix_rules(spark, ["com", "公司.cn", "xn--p1ai", "個人.香港", "香港", "xn--\u00e9", "c.deep.er.com"])
    df = spark.createDataFrame([(host,)], "host string")
    assert attribute_domain(df, rules).first()["domain_name"] == domain


@pytest.mark.parametrize("host, domain", [("example.bar", "example.bar"), ("a.x.com.hk", "x.com.hk"), ("a.b.go.jp", "b.go.jp")])
def test_default_rules(spark, host, domain):
    df = spark.createDataFrame([(host,)], "host string")
    assert attribute_domain(df, suffix_rules(spark)).first()["domain_name"] == domain


def test_default_rules_are_unique():
    rules = default_rules()
    assert len(rules) == len(set(rules))


def test_normalising_twice_changes_nothing(spark):
    first = parsed(spark, [case[0] for case in CASES])
    urls = sorted({url for url, _ in first.values() if url})
    assert {url: found[0] for url, found in parsed(spark, urls).items()} == {url: url for url in urls}


@pytest.mark.parametrize("table", ["/root/testdata/sf0.01/pages.parquet"])
def test_harmless_changes_on_all_pages(spark, table):
    """Scheme, tracking parameters, fragment and www. change no result."""
    pages = spark.read.parquet(table).select(F.col("url").alias("link"))
    bare = F.regexp_replace("link", "#.*$", "")
    marked = F.concat(bare, F.when(bare.contains("?"), "&").otherwise("?"), F.lit("utm_medium=a&fbclid=b#c"))
    changed = pages.select("link", F.regexp_replace(marked, "^https?://", "ftp://www.").alias("other"))
    left = with_url_and_domain(changed).withColumnsRenamed({"normalized_url": "u1", "domain_name": "d1"})
    both = with_url_and_domain(left, link="other")
    assert both.where(~(F.col("u1").eqNullSafe(F.col("normalized_url")))).count() == 0
    assert both.where(~(F.col("d1").eqNullSafe(F.col("domain_name")))).count() == 0
    assert both.where(F.col("d1").isNull()).count() == 0


def test_patterns_that_few_links_need_are_behind_a_test(spark):
    """A plain link meets no pattern for its scheme, ends and host, no trimming and no translation."""
    df = spark.createDataFrame([("https://a.com/x",)], "link string")
    text = with_url_and_domain(df)._jdf.queryExecution().optimizedPlan().toString()
    calls = re.findall(r"(.{5})\b(?:regexp_replace|translate|rtrim|trim|btrim)\(", text)
    assert calls and set(calls) <= {"THEN ", "ELSE "}, text
    odd = [
        ("https:////a.com/x", "a.com/x"),
        ("https://a.com/x\x00 ", "a.com/x"),
        ("HTTPS://a.com/x//", "a.com/x"),
        ("http://a。com./", "a。com."),
        ("http://mailto:x", "mailto:x"),
        ("https://a b.com", None),
        ("https://", None),
    ]
    found = with_url_and_domain(spark.createDataFrame([(link,) for link, _ in odd], "link string")).collect()
    assert {row["link"]: row["normalized_url"] for row in found} == dict(odd)
