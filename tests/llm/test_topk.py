"""Top-k search: brute force with ties, nulls and odd vectors."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from linktally.llm.topk import SortedLists, top_k

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k):
    clean = []
    for vec_id, vector, _ in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        clean.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for at, (q, query) in enumerate(clean):
        if q % 3 == 0:
            scores = [(-sum(a * b for a, b in zip(query, v)), i) for other, (i, v) in enumerate(clean) if other != at]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_rows_that_repeat_an_id_are_candidates(spark):
    rows = [(50, [1.0], None), (1, [5.0], None), (1, [9.0], None), (2, [4.0], None), (50, [2.0], None), (50, [2.0], None)]
    out = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 50, k=4).collect()
    best = {tuple(r) for r in out if r["rank"] == 1}
    assert best == {(50, 1, 1, 9 * 256 * 256), (50, 1, 1, 2 * 9 * 256 * 256)}
    assert len(out) == 12
    assert [r["vec_id"] for r in sorted(out, key=lambda r: (r["score"], r["rank"]))].count(1) == 6


def test_matches_brute_force(spark):
    random.seed(4)
    rows = [(i, [random.choice([0.0, 0.5, -0.25, random.uniform(-1, 1)]) for _ in range(6)], "x") for i in range(200)]
    rows += [(i, rows[i - 200][1], "tie") for i in range(200, 240)]
    rows += [(None, [1.0] * 6, "x"), (300, None, "x"), (301, [1.0, None], "x"), (302, [math.nan] * 6, "x")]
    rows += [(303, [math.inf] * 6, "x"), (306, [], "x"), (309, [0.0] * 6, "x"), (312, [1.0], "x"), (3, [9.0] * 6, "again")]
    rows += [(12, rows[12][1], "same"), (12, rows[12][1], "same"), (13, [0.5] * 6, "again")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for block in (16, 1000):
        out = top_k(df, F.col("vec_id") % 3 == 0, k=4, block_rows=block, block_queries=32)
        assert sorted(tuple(r) for r in out.collect()) == brute(rows, 4)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0], None), (3, [2.0], None)], SCHEMA)
    assert sorted(tuple(r) for r in top_k(df, F.lit(True)).collect()) == [(0, 1, 3, 256 * 512), (3, 1, 0, 256 * 512)]
    assert top_k(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []


def test_large_components_stay_exact(spark):
    df = spark.createDataFrame([(0, [30000.0] * 4, None), (1, [30001.0, 30000.0, 30000.0, 29999.5], None)], SCHEMA)
    row = top_k(df, F.col("vec_id") == 0).first()
    assert row["score"] == 7_680_000 * (7_680_256 + 2 * 7_680_000 + 7_679_872)


def test_the_search_stops_early_where_the_bound_allows():
    rows = np.zeros((4096, 3))
    rows[:, 0] = np.arange(4096)
    met = []

    class Watched(SortedLists):
        def search(self, *args):
            self.rows = Counted(self.rows)
            return super().search(*args)

    class Counted:
        def __init__(self, inner):
            self.inner, self.dtype = inner, inner.dtype

        def __getitem__(self, key):
            if not isinstance(key, tuple):
                met.append(len(key))
            return self.inner[key]

    lists = Watched(np.arange(4096), rows)
    ids, scores = lists.search(np.array([1.0, 0.0, 0.0]), 4095, 5)
    assert sorted(ids) == [4090, 4091, 4092, 4093, 4094] and sum(met) < 100
