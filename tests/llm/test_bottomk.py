"""Bottom-k near duplicates: brute force, bounds, odd rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from linktally.llm import bottomk
from linktally.llm.bottomk import OP11_SQL, near_duplicates, op11_bottomk, parity, required, shared_at_least, union_estimate
from suite.compare import difference, oracle_connection

SCHEMA = "doc_id long, text string, kept string, n_shingles int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = [shingles(text, size) for _, text, *_ in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least = {}
    for i, row in enumerate(rows):
        ids = [row[0]] if row[0] is not None else []
        least[root(i)] = sorted([*least.get(root(i), []), *ids])[:1]
    out = []
    for i, row in enumerate(rows):
        name = (least[root(i)] or [None])[0] if sets[i] else row[0]
        out.append((row[0], len(sets[i]), name, row[0] == name))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=repr)


def corpus():
    random.seed(11)
    vocabulary = [f"word{i}" for i in range(900)]
    rows = []
    for i in range(60):
        words = random.choices(vocabulary, k=random.choice([3, 8, 40, 150, 400]))
        rows.append((len(rows), " ".join(words), "x", 1))
        for _ in range(random.randrange(0, 8)):
            near = list(words)
            for _ in range(random.randrange(0, max(len(words) // 25, 1) + 1)):
                near[random.randrange(len(near))] = random.choice(vocabulary)
            rows.append((len(rows), random.choice([" ", "\n"]).join(near).upper(), "x", 1))
    passage = " ".join(random.choices(vocabulary, k=120))
    for i in range(60):  # a passage most of whose readers say little else
        rows.append((2000 + i, passage + " " + " ".join(random.choices(vocabulary, k=random.choice([2, 12, 30]))), "x", 2))
    rows += [(None, rows[0][1], "x", 3), (None, "only here and there is this", "x", 3), (5, rows[9][1], "x", 4)]
    rows += [(3000, None, "x", 5), (3001, "", "x", 5), (3002, " \n", "x", 5), (3003, "Ab É", "x", 5), (3004, "aB É", "x", 5)]
    long = " ".join(random.choices(vocabulary, k=20_000))
    rows += [(4000, long, "x", 6), (4001, long + " end", "x", 6), (4002, long[: len(long) // 2], "x", 6)]
    return rows


@pytest.mark.parametrize("size, percent, retained, block", [(5, 85, 64, 8192), (5, 80, 64, 7), (3, 90, 128, 8192)])
def test_matches_brute_force(spark, monkeypatch, size, percent, retained, block):
    monkeypatch.setattr(bottomk, "LIST_BLOCK", block)
    monkeypatch.setattr(bottomk, "STAR", block)
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = near_duplicates(df, shingle_words=size, percent=percent, retained=retained).collect()
    assert sorted((tuple(r)[:4] for r in out), key=repr) == brute(rows, size, percent)
    by_component = {}
    for row in out:
        if row["n_shingles"] and row["component_id"] is not None:
            by_component.setdefault(row["component_id"], []).append(row)
    for name, members in by_component.items():
        staying = [r for r in members if r["stays"]]
        assert len(staying) == 1 and staying[0]["doc_id"] == name


def test_rows_without_ids_leave_one(spark):
    rows = [(None, "the same five words here", "x", 1)] * 30 + [(None, "x", "x", 1), (7, None, "x", 1), (None, "", "x", 1)]
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r["stays"] for r in out if r["n_shingles"]) == 2
    assert all(r["stays"] and r["component_id"] == r["doc_id"] for r in out if not r["n_shingles"])


def test_empty_table_and_bad_threshold(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = near_duplicates(df)
    assert out.collect() == [] and out.columns == ["doc_id", "n_shingles", "component_id", "kept", "stays"]
    with pytest.raises(ValueError):
        near_duplicates(df, percent=40)


def test_a_large_group_is_not_paired_out(spark):
    """Each member of a group with one center meets it, and few others."""
    random.seed(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        words = list(base)
        words[random.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(words), "x", 1))
    steps = bottomk.BottomK(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", 5, 85, 128)
    lists = steps.lists()
    assert lists.count() == 400
    partners = steps.partners(lists)
    assert 300 < partners.count() <= 400
    links = steps.linked(partners)
    labels = bottomk.connected(links)
    assert steps.pairs_between(lists, labels).count() < 4000
    assert {r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), percent=85).collect()} == {0}


@pytest.mark.parametrize("size", [40, 128, 129, 700, 5000])
def test_sketches_of_linked_sets_pass(size):
    random = np.random.default_rng(size)
    pool = random.permutation(np.unique(random.integers(-(1 << 62), 1 << 62, 2 * size)))
    for drop in (0, 1, size // 20, size // 14):
        x, y = np.sort(pool[:size]), np.sort(pool[drop : size + drop])
        both = len(np.intersect1d(x, y))
        union = 2 * size - both
        bits = [np.frombuffer(parity(s), np.uint64) for s in (x, y)]
        assert int(np.bitwise_count(bits[0] ^ bits[1]).sum()) <= union - both
        left, right = (pa.array([s[:128].tolist()], pa.list_(pa.int64())) for s in (x, y))
        common, number = union_estimate(left, right, 128)
        exact = np.sort(np.union1d(x, y))[:128]
        assert number[0] == len(exact) and common[0] == np.isin(exact, np.intersect1d(x, y)).sum()
        if 100 * both >= 85 * union:
            assert len(np.intersect1d(x[:128], y[:128])) >= required(np.array([size]), 128, 85)[0]


def test_the_bound_is_the_binomial_tail():
    random = np.random.default_rng(1)
    least = shared_at_least(128, 85)
    assert 65 < least < 85 and random.binomial(128, 0.85, 1_000_000).min() >= least
    assert shared_at_least(128, 100) == 128 and shared_at_least(64, 80) < 0.8 * 64


def test_equal_to_sql(spark):
    small = "/root/testdata/sf0.001"
    assert difference(op11_bottomk(spark, small), oracle_connection(small), OP11_SQL) is None
