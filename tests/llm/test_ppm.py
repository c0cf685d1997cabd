"""PPM: the table model against a trie, the base model, edge cases."""

import glob
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from linktally.llm.ppm import (
    END,
    LEAST_LOTS,
    START,
    SYMBOLS,
    Levels,
    Prices,
    Tally,
    Trie,
    _dealt,
    _mark,
    _pack,
    gram_keys,
    score_adaptive,
    score_pretrained,
)

SCHEMA = "doc_id long, text string, bucket string"


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0d]+", lower) if w] + [None]


def rest(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def brute(rows, order):
    trie, counts = Trie(order), Counter()
    for doc_id, text, *_ in rows:
        if rest(doc_id) != 1:
            context = (START,) * order
            for symbol in (*(text or "").encode(), END):
                trie.add(context, symbol)
                context = (*context, symbol)[1:]
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text, *_ in rows:
        said = tokens(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in said)
        score = trie.run((text or "").encode(), learn=False)
        out.append((str(doc_id), rest(doc_id) == 1, len(said), sum(counts[w] > 0 for w in said), n, round(base, 6), round(score, 6)))
    return sorted(out)


def got(df):
    return sorted(
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
        for r in df.collect()
    )


@pytest.mark.parametrize("order", [2, 4])
def test_matches_a_trie(spark, order):
    random.seed(order)
    rows = [(i, "".join(random.choice("ab éA\n") for _ in range(random.randrange(40))), "x") for i in range(80)]
    rows += [(None, "hé there", "y"), (5, "xx yy", "z"), (6, None, None), (7, "", "w"), (2**60 + 1, "word " * 3000, "w")]
    assert got(score_pretrained(spark.createDataFrame(rows, SCHEMA), order=order)) == brute(rows, order)


def test_the_default_looks_five_bytes_back(spark):
    random.seed(5)
    rows = [(i, "".join(random.choice(["abcdex", "zbcdey", "é"]) for _ in range(20)), "x") for i in range(30)]
    assert got(score_pretrained(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 5) != brute(rows, 4)


def test_predictions_of_a_context_add_up_to_one():
    random.seed(2)
    trie, keys, order = Trie(2), Counter(), 2
    context = (START,) * order
    for symbol in (*random.choices(b"abc", k=200), END):
        trie.add(context, symbol)
        keys[(context[0] << 18) | (context[1] << 9) | symbol] += 1
        context = (*context, symbol)[1:]
    levels = Levels(np.array(list(keys)), np.array(list(keys.values())), order)
    for context in ((97, 98), (97, 200), (200, 201), (START, START)):
        wanted = np.array([(context[0] << 18) | (context[1] << 9) | s for s in range(SYMBOLS)])
        prices = levels.log10(wanted)
        assert abs((10**prices).sum() - 1) < 1e-9
        assert np.allclose(prices, [trie.log10(context, s) for s in range(SYMBOLS)])


def test_nothing_to_learn_from_and_empty_table(spark):
    held = next(i for i in range(100) if rest(i) == 1)
    row = score_pretrained(spark.createDataFrame([(held, "abc", None)], SCHEMA)).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0
    assert abs(row["score"] - 4 * -math.log10(SYMBOLS)) < 1e-9
    assert score_pretrained(spark.createDataFrame([], SCHEMA)).collect() == []


def test_adaptive_codes_each_text_alone(spark):
    rows = [(1, "abcabcabc", None), (2, None, None), (1, "abcabcabc", None)]
    out = score_adaptive(spark.createDataFrame(rows, SCHEMA), order=3).collect()
    assert [r["score"] for r in out] == [Trie(3).run((t or "").encode(), learn=True) for _, t, _ in rows]
    assert score_adaptive(spark.createDataFrame([], SCHEMA)).collect() == []


def test_keys_move_packed_not_one_by_one(spark):
    """What is kept between the passes is a row per bucket and lot, with the keys of one lot in it."""
    random.seed(9)
    rows = [(i, "".join(random.choice("abcdefgh ") for _ in range(2000)), "x") for i in range(20)]
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/ppm-docs")
    docs = spark.read.parquet(path)
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/ppm-tallied-*"))
    assert got(score_pretrained(docs)) == brute(rows, 5)
    (made,) = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/ppm-tallied-*")) - before
    tallied = spark.read.parquet(made)
    distinct = len({t[i : i + 6] for _, t, _ in rows for i in range(len(t))})
    assert tallied.count() <= docs.rdd.getNumPartitions() * 2 * LEAST_LOTS < distinct
    assert tallied.agg({"size": "sum"}).first()[0] > distinct


def test_other_texts_than_those_counted_raise():
    def tally(text):
        out = Tally()
        keys, _ = gram_keys(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 3)
        out.add(keys, np.ones(len(keys), dtype=bool))
        return out

    keys, counts = tally(b"abcabcab").table()
    place, present, ends = _dealt(keys, False, 8)
    back = {}
    for lot, start, end in zip(present.tolist(), [0, *ends[:-1]], ends):
        own = place[start:end]
        back[lot] = {"size": len(own), "mark": _mark(keys[own]), "prices": _pack(counts[own])}
    assert (Prices(tally(b"abcabcab"), False, 8, dict(back), np.int64).of(keys) == counts).all()
    with pytest.raises(RuntimeError, match="other partitions"):
        Prices(tally(b"abcabcax"), False, 8, dict(back), np.int64)
