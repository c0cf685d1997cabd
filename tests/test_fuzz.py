"""Random links through the URL rules and through their SQL twin."""

import random

import duckdb
import pytest

from linktally.functions.suffixes import suffix_rules
from linktally.plans.shares import with_url_and_domain
from suite.oracle import url_steps

RULES = "com org uk co.uk ck *.ck !www.ck io github.io jp *.kawasaki.jp !city.kawasaki.jp youtube be".split()
VALUES = (
    "('com', 1), ('org', 1), ('uk', 1), ('co.uk', 1), ('ck', 3), ('www.ck', 4), ('io', 1), ('github.io', 1), ('jp', 1), "
    "('kawasaki.jp', 2), ('city.kawasaki.jp', 4), ('youtube', 1), ('be', 1)"
)
SCHEMES = ["", "http://", "HTTPS://", "ftp://", "//", "http:////", "x+y.z://", "mailto:", "JavaScript:", "1http://", ":"]
USERS = ["", "", "", "u@", "u:p@", "a@b@", "@"]
LABELS = ["www", "m", "mobile", "a", "B-c", "youtube", "youtu", "co", "city", "www.www", "", "é", "192", "x y"]
SUFFIXES = ["com", "co.uk", "UK", "ck", "foo.ck", "www.ck", "github.io", "be", "zzz", "com.", "zzz..", "1.2", "kawasaki.jp", "x.kawasaki.jp", "city.kawasaki.jp", ""]
PORTS = ["", "", "", ":80", ":443", ":8080", ":"]
PATHS = ["", "/", "//", "/a", "/A/b/", "/index.html", "/a/index.php/", "/index.", "/index.HTML", "/a b", "/a\nb", "/index.html/index.html"]
QUERIES = ["", "?", "?&", "?a", "?b=2&a=1", "?utm_source=x", "?utm_Source=x", "?ref", "?ref=&refx=1", "?&&z=&feature=y&", "?a=1?b=2", "?fbclid=1&gclid", "?x=utm_a=1", "?é=1&É=2"]
FRAGMENTS = ["", "", "#", "#f", "#f?g#h", "#\n"]
EDGES = ["", "", "", " ", "\t", "\x00", " \r\n"]


def random_links(count, seed):
    chance = random.Random(seed)
    links = set()
    for _ in range(count):
        host = ".".join([*chance.choices(LABELS, k=chance.randint(0, 3)), chance.choice(SUFFIXES)])
        parts = [SCHEMES, USERS, [host], PORTS, PATHS, QUERIES, FRAGMENTS]
        links.add(chance.choice(EDGES) + "".join(chance.choice(part) for part in parts) + chance.choice(EDGES))
    return sorted(links)


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_equal_their_sql_twin(spark, seed):
    links = random_links(4000, seed)
    df = spark.createDataFrame([(link,) for link in links], "link string")
    found = with_url_and_domain(df, suffix_rules(spark, RULES)).collect()
    connection = duckdb.connect()
    connection.execute("CREATE TABLE links(link VARCHAR)")
    connection.executemany("INSERT INTO links VALUES (?)", [(link,) for link in links])
    sql = f"WITH {url_steps('links', VALUES)} SELECT link, normalized_url, domain_name FROM urls"
    expected = {row[0]: row[1:] for row in connection.execute(sql).fetchall()}
    ours = {row["link"]: (row["normalized_url"], row["domain_name"]) for row in found}
    wrong = {link: (ours[link], expected[link]) for link in links if ours[link] != expected[link]}
    assert not wrong, list(wrong.items())[:5]
    assert len({domain for _, domain in ours.values()}) > 20
