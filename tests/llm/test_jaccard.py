"""Jaccard join: brute force over several settings, edge cases, components."""

import itertools
import random

import numpy as np
import pytest

import linktally.llm.jaccard as jaccard
from linktally.llm.common import distinct
from linktally.llm.components import connected
from linktally.llm.jaccard import jaccard_components

SCHEMA = "doc_id long, text string, component_id string, n int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, size, percent):
    sets = []
    for _, text, *_ in rows:
        w = lower(text).replace("\n", " ").replace("\t", " ").split(" ")
        w = [x for x in w if x]
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted(
        ((row[0], len(sets[i]), least.get(find(i)) if sets[i] else row[0]) for i, row in enumerate(rows)), key=repr
    )


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def corpus(seed):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    bases = [[random.choice(vocabulary) for _ in range(size)] for size in (12, 40, 40, 90)]
    rows = []
    for i in range(350):
        words = list(random.choice(bases))
        for _ in range(random.choice([0, 0, 1, 1, 2, 3, 5])):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        if random.random() < 0.15:
            words = [random.choice(vocabulary) for _ in range(random.randrange(0, 30))]
        rows.append((i, random.choice([" ", "\n", "  "]).join(words), "old", 1))
    shared = " ".join(random.choice(vocabulary) for _ in range(60))
    rows += [(1000 + i, shared + " " + " ".join(random.choice(vocabulary) for _ in range(40)), "x", 2) for i in range(40)]
    rows += [(None, rows[0][1], "x", 3), (None, "only here and there is this", "x", 3), (0, rows[0][1], "x", 4)]
    rows += [(2000, None, "x", 5), (2001, "", "x", 5), (2002, " \n", "x", 5), (2003, "Ab É", "x", 5), (2004, "aB É", "x", 5)]
    rows += [(3000, "long text " * 9000 + "end", "x", 6), (3001, "long text " * 9000 + "end", "x", 6)]
    return rows


@pytest.mark.parametrize("size, percent, frequent, block", [(3, 90, 8, 4096), (5, 80, 3, 12), (3, 60, 10_000, 10)])
def test_matches_brute_force(spark, monkeypatch, size, percent, frequent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus(percent)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = jaccard_components(df, shingle_words=size, percent=percent, frequent=frequent)
    assert got(out) == brute(rows, size, percent)


def test_sets_with_many_frequent_tokens(spark):
    """More frequent tokens in a prefix than are paired."""
    random.seed(9)
    base = [f"w{i}" for i in range(900)]
    rows = []
    for i in range(30):
        words = list(base)
        for _ in range(random.choice([1, 2, 20])):
            words[random.randrange(900)] = f"x{random.randrange(9)}"
        rows.append((i, " ".join(words), "x", 1))
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(jaccard_components(df, shingle_words=3, percent=90, frequent=2)) == brute(rows, 3, 90)


@pytest.mark.parametrize("percent", [60, 80, 90])
@pytest.mark.parametrize("size", [1, 40, 900, 1023, 1500, 3000, 10_000, 20_000])
def test_sketches_never_exceed_the_difference(size, percent):
    random = np.random.default_rng(size)
    pool = distinct(random.integers(0, 1 << 52, 3 * size, dtype=np.uint64))
    random.shuffle(pool)
    for other in (0, 1, size // 20, size // 4, size):
        sets = [pool[:size], pool[other : size + other + other // 9]]
        n = np.array([len(s) for s in sets])
        parities = jaccard.long_sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]))
        column = np.array(jaccard.list_sketches(parities, n, percent), dtype=object)
        apart = jaccard.Sketches(column).distance(np.zeros(1, int), np.ones(1, int))[0]
        assert apart <= len(np.setxor1d(*sets))
        if other == size and size > 20 and percent > 60:  # strangers are told apart
            assert apart * (100 + percent) > sum(n) * (100 - percent)


def test_large_sets_match_brute_force(spark):
    """Sets of 1,000 to 20,000 tokens: strangers, near copies on both sides of the threshold, shared tokens."""
    random.seed(5)
    rows, number = [], 0
    for size in (1000, 1100, 3000, 9000, 20_000):
        for _ in range(3):
            base = [random.randrange(4000) for _ in range(size)]
            for changes in (0, size // 100, size // 40, size // 20):
                words = list(base)
                for _ in range(changes):
                    words[random.randrange(size)] = random.randrange(4000)
                rows.append((number, " ".join(map(str, words)), "x", 1))
                number += 1
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(jaccard_components(df, shingle_words=3, percent=90)) == brute(rows, 3, 90)
    assert got(jaccard_components(df, shingle_words=3, percent=80, frequent=1)) == brute(rows, 3, 80)


def test_second_round_gives_a_pair_in_one_list_of_pairs(spark):
    """Members that share many frequent tokens meet in many lists."""
    random.seed(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(4):
            words[random.randrange(60)] = f"x{random.randrange(5)}"
        rows.append((i, " ".join(words), "x", 1))
    join = jaccard.JaccardJoin(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", 3, 60, 1)
    entries = join.entries()
    assert entries.where("kind = 1").count() > 1000
    labels = join.nodes.selectExpr("a AS node", "a AS label")
    pairs = [tuple(r) for r in join.listed(entries.where("kind > 0"), labels).collect()]
    assert len(pairs) == len(set(pairs)) > 0


def test_large_group_of_near_copies_is_joined_before_all_pairs_are_asked_for(spark, monkeypatch):
    """Copies on both sides of the threshold: few of their pairs are verified, and no link is lost."""
    random.seed(3)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(random.choice([3, 4, 5, 5, 6])):
            words[random.randrange(400)] = f"x{random.randrange(400)}"
        rows.append((i, " ".join(words), "x", 1))
    verified, numbers = jaccard.JaccardJoin.verified, []

    def counting(self, pairs, sets):
        numbers.append(pairs.count())
        return verified(self, pairs, sets)

    monkeypatch.setattr(jaccard.JaccardJoin, "verified", counting)
    out = jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(4), shingle_words=5, percent=80)
    assert got(out) == brute(rows, 5, 80)
    assert sum(numbers) < 4 * len(rows), numbers


def test_empty_table_and_bad_threshold(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert jaccard_components(df).collect() == []
    with pytest.raises(ValueError):
        jaccard_components(df, percent=50)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 100)] + [(500, i) for i in range(501, 600)] + [(7, 7)]
    labels = {r["node"]: r["label"] for r in connected(spark.createDataFrame(links, "x long, y long")).collect()}
    assert labels == {**{i: 0 for i in range(101)}, **{i: 500 for i in range(500, 600)}}
