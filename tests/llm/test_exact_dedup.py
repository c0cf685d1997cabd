"""Exact dedup: brute force, edge cases, the directory."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from linktally.llm.exact_dedup import build_directory, exact_dedup

SCHEMA = "doc_id long, text string, kept string, `a b` int"


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        norm = re.sub(r"[\x20\x09-\x0d]+", " ", text or "")
        groups.setdefault(norm, []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        norm = re.sub(r"[\x20\x09-\x0d]+", " ", text or "")
        ids = [i for i in groups[norm] if i is not None]
        keep = min(ids) if ids else None
        out.append((doc_id, keep, len(groups[norm]), doc_id == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    rows = df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted([tuple(r) for r in rows], key=repr)


def test_matches_brute_force_with_nulls_repeats_and_clashing_columns(spark):
    random.seed(5)
    texts = ["", None, " ", "\n\t", "a b", "a  b", "a b", "é", "long " * 40_000, "A b"]
    rows = [(i, random.choice(texts), "old", 1) for i in range(300)]
    rows += [(None, "a b", "old", 2), (None, "only null", "old", 3), (7, rows[7][1], "old", 4)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    out = exact_dedup(df, bucket_rows=2)
    assert got(out) == brute(rows)
    assert out.columns == ["doc_id", "text", "a b", "keep_id", "group_size", "kept", "text_sha256"]
    assert out.agg(F.sum("a b")).first()[0] == sum(r[3] for r in rows)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_directory_splits_overfull_buckets_only(spark):
    low = [(k,) for k in range(0, 4000, 40)]  # share their first 50 bits
    spread = [((k << 58) - (1 << 63),) for k in range(64)]
    keys = spark.createDataFrame(low + spread, "k long").distinct()
    starts = build_directory(keys, "k", 8)
    unsigned = np.array([k[0] for k in set(low + spread)], dtype=np.int64).view(np.uint64)
    held = np.bincount(np.searchsorted(starts, unsigned, side="right") - 1, minlength=len(starts))
    assert held.max() <= 8
    assert starts[0] == 0 and (np.diff(starts.astype(object)) > 0).all()
