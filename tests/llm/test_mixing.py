"""Pfair mixing: the lag bound, a simulation by hand, edge cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from linktally.llm.mixing import mix_sources


def by_hand(blocks, quotas):
    """Slots of (source, block) from an earliest-deadline-first loop over rounds."""
    done = dict.fromkeys(blocks, 0)
    slots, at = {}, 0
    while any(done[s] < blocks[s] for s in blocks):
        own = {s: min(quotas[s], blocks[s] - done[s]) for s in blocks if done[s] < blocks[s]}
        size, placed = sum(own.values()), dict.fromkeys(own, 0)
        for slot in range(size):
            ready = [
                (math.ceil((placed[s] + 1) * size / own[s]), place, s)
                for place, s in enumerate(own)
                if placed[s] < own[s] and math.floor(placed[s] * size / own[s]) <= slot
            ]
            source = min(ready)[2]
            slots[at + slot] = (source, done[source] + placed[source])
            placed[source] += 1
        for s in own:
            done[s] += own[s]
        at += size
    return slots


def documents(spark, counts):
    rows, number = [], 0
    for source, count in counts.items():
        for _ in range(count):
            rows.append((number, source, "t", 5))
            number += 1
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, source string, text string, mix_slot int").repartition(5)


def test_slots_are_those_of_the_loop_and_lag_stays_below_one(spark):
    counts = {None: 40, "a": 700, "b": 130, "c": 61, "d": 5}
    weights = {"a": 5.0, "b": 3.0, "c": 1.0, "d": 1.0}
    out = mix_sources(documents(spark, counts), weights, temper=0.0, block_rows=4, resolution=11).collect()
    assert len(out) == sum(counts.values()) and len({r["doc_id"] for r in out}) == len(out)
    total = sum(weights.values()) + 1.0
    quotas = {s: max(1, round(11 * (weights.get(s, 1.0)) / total)) for s in counts}
    expected = by_hand({s: math.ceil(c / 4) for s, c in counts.items()}, quotas)
    got = {r["mix_slot"]: (r["source"], r["mix_block"]) for r in out}
    assert got == expected
    per_slot = {}
    for r in out:
        per_slot.setdefault(r["mix_slot"], []).append(r["mix_place"])
    assert all(sorted(p) == list(range(len(p))) for p in per_slot.values())
    # deviation from the target while all sources last
    round_size = sum(quotas.values())
    lasting = min(math.ceil(counts[s] / 4) // quotas[s] for s in counts) * round_size
    seen = dict.fromkeys(counts, 0)
    for slot in range(lasting):
        seen[got[slot][0]] += 1
        for s in counts:
            assert abs(seen[s] - (slot + 1) * quotas[s] / round_size) < 1


def test_no_python_in_the_plan_and_no_row_lost(spark):
    docs = documents(spark, {"x": 30, "y": 3})
    out = mix_sources(docs)
    plan = out._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert out.columns == ["doc_id", "source", "text", "mix_block", "mix_slot", "mix_place"]
    assert out.count() == 33


def test_null_and_repeated_ids_and_empty_tables(spark):
    rows = [(None, "a")] * 5 + [(3, "a")] * 4 + [(4, None)]
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), block_rows=2)
    assert out.count() == 10
    assert out.groupBy("mix_slot", "mix_place").count().where("count > 1").count() == 0
    assert mix_sources(spark.createDataFrame([], "doc_id long, source string")).collect() == []


def test_bad_weight_raises(spark):
    with pytest.raises(ValueError):
        mix_sources(documents(spark, {"x": 3}), {"x": 0.0})
