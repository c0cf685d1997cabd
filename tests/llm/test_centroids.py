"""Centroid clustering: brute force, ties, odd vectors, pruning."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from linktally.llm.centroids import OP12_SQL, VantageTree, cluster_vectors, op12_centroids
from suite.compare import difference, oracle_connection

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int"


def brute(rows, number, rounds, width, scale=1024, seed=3):
    whole = [
        (i, [math.floor(scale * x) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]

    def key(row):
        return hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest(), row[1]

    centroids = [v for _, v in sorted((r for r in whole if r[0] is not None), key=key)[:number]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in whole:
            groups[place(v)[1]].append(v)
        for k, members in groups.items():
            centroids[k] = [sum(c) // len(members) for c in zip(*members)]
    out = [(i, place(v)[1], place(v)[0]) for i, v in whole]
    inertia = defaultdict(int)
    for _, k, d in out:
        inertia[k] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), names[k]) for i, k, d in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("number, width", [(8, 4), (3, 2), (25, 3)])
def test_matches_brute_force(spark, number, width):
    random.seed(number)
    rows = [(i, [random.choice([-1.0, 0.5, random.gauss(0, 1)]) for _ in range(width)], "x", 1) for i in range(150)]
    rows += [(i % 7, rows[i % 11][1], "copy", 2) for i in range(80)]  # repeated rows and ids
    rows += [(None, [0.25] * width, "x", 1), (None, [-0.25] * width, "x", 1)]
    rows += [(900, None, "x", 1), (901, [], "x", 1), (902, [1.0] * (width + 1), "x", 1), (903, [None] * width, "x", 1)]
    rows += [(904, [math.nan] * width, "x", 1), (905, [math.inf] * width, "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(cluster_vectors(df, number, 6, width)) == brute(rows, number, 6, width)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(i % 3) * 500_000 + i, -1.0 * i]) for i in range(30)]
    df = spark.createDataFrame([(*row, None, None) for row in rows], SCHEMA)
    assert got(cluster_vectors(df, 4, 3, 2)) == brute(rows, 4, 3, 2)


def test_a_distance_beyond_a_long_raises(spark):
    df = spark.createDataFrame([(0, [1e18], None, None), (1, [-1e18], None, None), (2, [0.0], None, None)], SCHEMA)
    with pytest.raises(Exception, match="does not fit a long"):
        cluster_vectors(df, 1, 1, 1).collect()


def test_few_vectors_none_and_an_empty_table(spark):
    rows = [(4, [1.0, 2.0], "x", 1), (9, [1.0, 2.0], "x", 1), (5, [3.0, 2.0], "x", 1)]
    assert got(cluster_vectors(spark.createDataFrame(rows, SCHEMA), 8, 2, 2)) == brute(rows, 8, 2, 2)
    for none in ([], [(1, None, "x", 1)], [(None, [1.0, 2.0], "x", 1)]):
        out = cluster_vectors(spark.createDataFrame(none, SCHEMA), 8, 2, 2)
        assert out.collect() == []
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_the_tree_skips_distances_and_keeps_ties():
    random = np.random.default_rng(5)
    centers = random.integers(-10_000, 10_000, (64, 3))
    centers[40] = centers[7]
    vectors = np.concatenate([centers[random.integers(0, 64, 3000)] + random.integers(-40, 40, (3000, 3)), centers])
    chosen, best, taken = VantageTree(centers).nearest(vectors)
    squares = ((vectors[:, None] - centers[None]) ** 2).sum(axis=2)
    assert (best == squares.min(axis=1)).all() and (chosen == squares.argmin(axis=1)).all()
    assert 40 not in chosen and taken < squares.size / 3
    line = np.arange(0, 90, 10)[:, None]
    chosen, best, _ = VantageTree(line).nearest(np.arange(-5, 90, 5)[:, None])  # halfway between two
    assert (chosen == np.abs(np.arange(-5, 90, 5)[:, None] - line.T).argmin(axis=1)).all()


def test_equal_to_sql(spark):
    small = "/root/testdata/sf0.001"
    assert difference(op12_centroids(spark, small), oracle_connection(small), OP12_SQL) is None
