"""Ranked lexical search: brute force, ties, odd rows, bounds."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from linktally.llm import pairmax
from linktally.llm.pairmax import OP13_SQL, PairIndex, op13_pairmax, ranked_search
from suite.compare import difference, oracle_connection

DOCS = "doc_id long, text string, rank string, score int"
ITEMS = "item_id long, text string, doc_id string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t, *_ in docs if terms(t)]
    many, length = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text, *_ in items:
        found = []
        for i, c, n in counted:
            m = 75 + 25 * n * many // length
            score = 0
            for t, times in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1)))
                    score += times * w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus():
    random.seed(13)
    vocabulary = [f"w{i}" for i in range(150)] + ["É", "straße", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(n):
        return random.choice([" ", ", ", "\n"]).join(random.choices(vocabulary, weights, k=n))

    docs = [(i, text(random.randrange(0, 60)), "x", 1) for i in range(500)]
    docs += [(1000 + i, docs[i % 5][1], "copy", 1) for i in range(60)]  # ties
    docs += [(7, docs[8][1], "again", 1), (7, docs[8][1], "again", 1), (None, docs[3][1], "x", 1), (None, None, "x", 1)]
    docs += [(2000, None, "x", 1), (2001, "", "x", 1), (2002, " .,! ", "x", 1), (2003, "w1 " * 30_000 + "W140 É é", "x", 1)]
    items = [(i, text(random.randrange(1, 25)), "y") for i in range(40)]
    items += [(0, "w5 W5 w5 w9", "again"), (50, None, "y"), (51, "", "y"), (52, "unknown words only", "y"), (None, "w3 w4", "y")]
    return docs, items


@pytest.mark.parametrize("rows, query_terms", [(1 << 14, 1 << 19), (64, 60)])
def test_matches_brute_force(spark, monkeypatch, rows, query_terms):
    monkeypatch.setattr(pairmax, "BLOCK_ROWS", rows)
    docs, items = corpus()
    out = ranked_search(
        spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), k=7, query_terms=query_terms
    )
    assert got(out) == brute(docs, items, 7)


def test_empty_tables(spark):
    docs, items = [(1, "a b", "x", 1)], [(1, "a", "y")]
    for left, right in (([], items), (docs, []), ([(1, "", "x", 1)], items), (docs, [(1, ".", "y")])):
        out = ranked_search(spark.createDataFrame(left, DOCS), spark.createDataFrame(right, ITEMS))
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def random_index(seed):
    random = np.random.default_rng(seed)
    rows, terms = np.nonzero(random.random((3000, 12)) < 0.9 ** np.arange(1, 13) * 0.6)
    impacts = random.integers(1, 1000, len(rows)) * (terms + 1)
    index = PairIndex(rows, terms, impacts, 3000, 12)
    dense = np.zeros((3000, 12), dtype=np.int64)
    dense[rows, terms] = impacts
    return index, dense


def test_pair_bounds_hold_and_are_tighter_than_two_maxima():
    index, dense = random_index(1)
    tighter = 0
    for left in range(12):
        for right in range(left + 1, 12):
            pair = ((left, 1), (right, 3))
            index.add_pair(pair)
            bound, both = index.pairs[pair]
            assert bound == (dense[:, left] + 3 * dense[:, right]).max()
            assert (both == np.flatnonzero((dense[:, left] > 0) & (dense[:, right] > 0))).all()
            tighter += bound < index.most(left, 1) + index.most(right, 3)
    assert tighter > 50


def spent_with_and_without_pairs(seed):
    random = np.random.default_rng(seed)
    # terms that are seldom together: rare ones with high impacts, common ones with low
    held = random.random((5000, 12)) < np.array([0.004] * 6 + [0.02] * 3 + [0.3] * 3)
    rows, terms = np.nonzero(held)
    impacts = np.maximum(random.integers(1, 1000, len(rows)) // np.array([1] * 6 + [2] * 3 + [20] * 3)[terms], 1)
    dense = np.zeros((5000, 13), dtype=np.int64)
    dense[rows, terms] = impacts
    query = [(t, 1 + t % 2) for t in range(13)]  # the last term is in no document
    exact = sum(times * dense[:, t] for t, times in query)
    least = int(np.sort(exact)[-20])
    spent = []
    for pairs in (False, True):
        index = PairIndex(rows, terms, impacts, 5000, 13)
        ordered = index.ordered(query)
        assert sorted(ordered) == query[:12]
        for pair in zip(ordered, ordered[1:]) if pairs else ():
            index.add_pair(pair)
        upto = index.bounds(ordered)
        for j in range(13):
            assert upto[j] >= sum(times * dense[:, t] for t, times in ordered[:j]).max() if j else upto[j] == 0
        for floor in (0, least, int(exact.max()) + 1):
            found, scores, touched = index.search(ordered, floor)
            assert (found == np.flatnonzero(exact >= max(floor, 1))).all() and (scores == exact[found]).all()
            if floor == least:
                spent.append(touched)
    assert spent[1] <= spent[0] < len(rows)
    return spent


def test_the_search_is_exact_and_skips_more_with_pairs():
    single, paired = np.sum([spent_with_and_without_pairs(seed) for seed in range(8)], axis=0)
    assert paired < single


def test_equal_to_sql(spark):
    small = "/root/testdata/sf0.001"
    assert difference(op13_pairmax(spark, small), oracle_connection(small), OP13_SQL) is None
