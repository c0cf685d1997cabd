"""Merkle audit: damage by hand, repeats, empty replicas, layout."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from linktally.llm.merkle import audit, lay_out, warc_record

SCHEMA = "archive long, offset long, digest string, status string"


def found(spark, left, right, **kw):
    a, b = (spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (left, right))
    return sorted(tuple(r) for r in audit(a, b, **kw).collect())


def test_finds_every_difference_and_nothing_else(spark):
    random.seed(3)
    left = [(archive, i * 700 + archive, f"{archive}:{i}", "x") for archive in range(4) for i in range(150)]
    right = [r for r in left if r[1] % 97 != 5 and r[0] != 3]
    changed = set(random.sample(range(len(right)), 9))
    right = [(a, o, d + "!", s) if i in changed else (a, o, d, s) for i, (a, o, d, s) in enumerate(right)]
    right += [(1, 699, "new", "x"), (9, 0, "new", "x")]
    l, r = {(a, o): d for a, o, d, _ in left}, {(a, o): d for a, o, d, _ in right}
    expected = sorted(
        (*k, "missing" if k not in r else "extra" if k not in l else "changed")
        for k in l.keys() | r.keys()
        if l.get(k) != r.get(k)
    )
    for bits in ((14, 3), (10, 2)):
        assert found(spark, left, right, leaf_bits=bits[0], fan_bits=bits[1]) == expected


def test_equal_and_empty_replicas_repeats_and_nulls(spark):
    rows = [(0, 0, "a", None), (0, 0, "a", None), (0, 5, None, None)]
    assert found(spark, rows, rows) == []
    assert found(spark, rows, rows[1:]) == [(0, 0, "changed")]
    assert found(spark, [], []) == []
    assert found(spark, rows[2:], []) == [(0, 5, "missing")]
    with pytest.raises(PySparkException):
        found(spark, [(None, 1, "a", None)], rows)


def test_every_digest_of_a_repeated_offset_counts(spark):
    rows = [(0, 0, d, None) for d in ("a", "c", "e", "e")] + [(0, 9, "x", None)]
    assert found(spark, rows, rows[::-1]) == []
    for other in ("acde", "abee", "acce"):
        assert found(spark, rows, [(0, 0, d, None) for d in other] + rows[4:]) == [(0, 0, "changed")]


def test_layout_of_records(spark):
    pages = [(i, f"http://e/{i}", "é" * (i % 50)) for i in range(300)] + [(None, None, None), (None, "u", "x"), (5, "http://e/5", "é" * 5)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = lay_out(df.select("page_id", "url", record.alias("record")), ["page_id", "url"], archive_records=50).collect()
    assert len(rows) == 303 and {r["archive"] for r in rows} <= set(range(7))
    by = {}
    for r in rows:
        by.setdefault(r["archive"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    text = df.select(record.alias("t")).where("page_id = 3").first()["t"]
    assert text.startswith("WARC/1.0\r\n") and "Content-Length: 6\r\n\r\néééé"[:24] in text and text.endswith("ééé\r\n\r\n")
