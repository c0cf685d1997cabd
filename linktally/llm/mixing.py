"""Mixing sources to target weights by Pfair scheduling, in built-in functions only.

A source's documents, in a hashed order, are cut into blocks. Target weights are
brought to whole numbers: in a round of about ``resolution`` slots, source ``s``
owns ``e_s``. Block ``j`` of a round of ``P`` slots is released at slot
``floor(j * P / e_s)`` and due by slot ``ceil((j + 1) * P / e_s)``. Slots go, one
after the other, to the released block with the earliest deadline. At every slot
each source is then less than one block away from its share, and exactly on it at
the end of a round, so all rounds with the same sources are alike and only the
few kinds of round are scheduled, however many blocks there are.

When a source runs out, the rounds that follow hold the other sources only, with
their weights in proportion. Every document gets a slot: none is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linktally.llm.common import cut, quoted, without

#: Hashed ranges that a source's documents are counted in, for running totals
#: without a window over a whole source.
MIN_RANGES = 64
RANGE_ROWS = 65_536
#: With so many sources at most, the rounds have under 140,000 rows.
SMALL_SOURCES = 64

ADDED = ("mix_block", "mix_slot", "mix_place")


def _schedule(entries: Column, slots: Column) -> Column:
    """Source numbers by slot, for ``entries`` = array of (source number, blocks).

    A fold over the slots. Its state is how many blocks each source has placed
    and the slots dealt so far; its size is bounded by the round.
    """

    def step(state: Column, slot: Column) -> Column:
        due = F.transform(
            entries,
            lambda e, i: F.when(
                (state["placed"][i] < e["blocks"])
                & (F.floor(state["placed"][i] * slots / e["blocks"]) <= slot),
                F.struct(
                    F.ceil((state["placed"][i] + 1) * slots / e["blocks"]).alias("due"),
                    i.cast("int").alias("at"),
                ),
            ),
        )
        first = F.array_min(F.filter(due, lambda d: d.isNotNull()))["at"]
        return F.struct(
            F.transform(state["placed"], lambda p, i: F.when(i == first, p + 1).otherwise(p)).alias("placed"),
            F.array_append(state["dealt"], first).alias("dealt"),
        )

    start = F.struct(
        F.transform(entries, lambda e: F.lit(0).cast("long")).alias("placed"),
        F.array().cast("array<int>").alias("dealt"),
    )
    return F.aggregate(F.sequence(F.lit(0).cast("long"), slots - 1), start, step)["dealt"]


def _rounds(quotas: DataFrame) -> DataFrame:
    """``round_from, round_to, sid, nth, slot``: the schedule of each kind of round.

    ``quotas`` has ``sid, quota, blocks``. The kind of round changes only where a
    source comes to its last, partly filled round, or has run out.
    """
    q = quotas.select("sid", "quota", "blocks", F.floor(F.col("blocks") / F.col("quota")).alias("full"))
    turns = (
        q.select(F.explode(F.array("full", F.col("full") + 1)).alias("at"))
        .union(q.select(F.lit(0).cast("long")).limit(1))
        .distinct()
    )
    spans = turns.select(
        F.col("at").alias("round_from"), F.lead("at").over(Window.orderBy("at")).alias("round_to")
    ).where("round_to is not null")
    kinds = (
        spans.join(F.broadcast(q), F.col("blocks") > F.col("round_from") * F.col("quota"))
        .groupBy("round_from", "round_to")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("sid", F.least("quota", F.col("blocks") - F.col("round_from") * F.col("quota")).alias("blocks"))
                )
            ).alias("entries")
        )
        .withColumn("slots", F.aggregate("entries", F.lit(0).cast("long"), lambda n, e: n + e["blocks"]))
    )
    dealt = kinds.withColumn("dealt", _schedule(F.col("entries"), F.col("slots")))
    flat = dealt.select(
        "round_from", "round_to", "slots", "entries", F.posexplode("dealt").alias("slot", "entry")
    ).select(
        "round_from", "round_to", "slots", F.element_at("entries", F.col("entry") + 1)["sid"].alias("sid"), "slot"
    )
    nth = F.row_number().over(Window.partitionBy("round_from", "sid").orderBy("slot")) - 1
    return flat.withColumn("nth", nth)


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    temper: float = 0.5,
    block_rows: int = 64,
    resolution: int = 1000,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = 0,
) -> DataFrame:
    """The documents with ``mix_block, mix_slot, mix_place`` added.

    Sorted by ``(mix_slot, mix_place)`` they are the mixed stream: while all
    sources last, each source's blocks before any slot differ from its share by
    less than one. ``mix_block`` counts the blocks of a source. Each target is
    met to within ``1 / resolution``, and no source gets less than one slot a
    round. ``weights`` maps sources to relative weights; a source not in it, and
    every source where none is given, weighs ``rows ** temper``. Weights that are
    not positive and finite raise.

    Null is a source like any other. Rows with equal ids are told apart by no
    order, so they share a hashed place, and ties are broken by the running
    number alone; null ids likewise. The last block of a source may be short. An
    empty table gives an empty table. Columns named like an added one are
    replaced. The number of sources is taken to be small: their names, counts
    and one round per change of sources are kept together, documents never.
    """
    for name, weight in (weights or {}).items():
        if not (weight > 0 and math.isfinite(weight)):
            raise ValueError(f"weight of {name}: {weight}")
    kept = without(docs, ADDED)
    source, key = F.col(quoted(source_col)), F.xxhash64(F.lit(seed), F.col(quoted(id_col)))
    # 1. count by source
    counts = cut(docs.select(source.alias("source")).groupBy("source").count(), "mix-sources")
    totals = counts.agg(F.count("*").alias("sources"), F.coalesce(F.max("count"), F.lit(0)).alias("most")).first()
    # the tables of sources and rounds are broadcast where their size is bounded by this
    small = F.broadcast if totals["sources"] <= SMALL_SOURCES else lambda table: table
    # 2. whole-number quotas and the schedule of each kind of round
    given = F.lit(None).cast("double")
    for name, weight in (weights or {}).items():
        given = F.when(F.col("source") == F.lit(name), F.lit(float(weight))).otherwise(given)
    weighted = counts.select(
        "source", "count", F.coalesce(given, F.pow(F.col("count").cast("double"), F.lit(temper))).alias("weight")
    )
    together = Window.partitionBy()
    quotas = weighted.select(
        "source",
        (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_first())) - 1).alias("sid"),
        F.greatest(F.lit(1), F.round(F.lit(resolution) * F.col("weight") / F.sum("weight").over(together))).cast("long").alias("quota"),
        F.ceil(F.col("count") / block_rows).alias("blocks"),
    )
    quotas = cut(quotas, "mix-quotas")
    rounds = cut(_rounds(quotas), "mix-rounds")
    lengths = rounds.select("round_from", "round_to", "slots").distinct()
    offset = F.sum((F.col("round_to") - F.col("round_from")) * F.col("slots")).over(
        Window.orderBy("round_from").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = lengths.select("round_from", F.coalesce(offset, F.lit(0)).alias("span_start"))
    table = rounds.join(starts, "round_from").select(
        F.col("sid").alias("__mix_sid"),
        F.col("nth").alias("__mix_nth"),
        F.col("round_from").alias("__mix_from"),
        F.col("round_to").alias("__mix_to"),
        F.col("slots").alias("__mix_slots"),
        (F.col("span_start") + F.col("slot")).alias("__mix_start"),
    )
    # 3. count by source and hashed range, which gives each range its first row number
    by_source = quotas.select(F.col("source").alias("__mix_named"), F.col("sid").alias("__mix_sid"), "quota")
    ranges = 1 << max((MIN_RANGES - 1).bit_length(), (totals["most"] // RANGE_ROWS).bit_length())
    part = F.shiftrightunsigned(key, 64 - (ranges.bit_length() - 1))
    sized = docs.select(source.alias("source"), part.alias("__mix_part")).groupBy("source", "__mix_part").count()
    before = Window.partitionBy("__mix_sid").orderBy("__mix_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sized.join(small(by_source), F.col("source").eqNullSafe(F.col("__mix_named"))).select(
        "__mix_sid", "__mix_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__mix_first")
    )
    # 4. number the rows of each range, and look their block's slot up
    inside = Window.partitionBy("__mix_sid", "__mix_part").orderBy("__mix_key")
    named = kept.withColumns({"__mix_source": source, "__mix_key": key, "__mix_part": part})
    placed = (
        named.join(small(by_source), F.col("__mix_source").eqNullSafe(F.col("__mix_named")))
        .withColumn("__mix_row", F.row_number().over(inside) - 1)
        .join(firsts, ["__mix_sid", "__mix_part"])
        .withColumn("__mix_number", F.col("__mix_first") + F.col("__mix_row"))
        .withColumn("mix_block", F.floor(F.col("__mix_number") / block_rows))
        .withColumn("mix_place", (F.col("__mix_number") % block_rows).cast("int"))
        .withColumn("__mix_round", F.floor(F.col("mix_block") / F.col("quota")))
        .withColumn("__mix_nth", (F.col("mix_block") % F.col("quota")).cast("int"))
    )
    found = placed.join(
        small(table),
        (placed["__mix_sid"] == table["__mix_sid"])
        & (placed["__mix_nth"] == table["__mix_nth"])
        & (F.col("__mix_round") >= F.col("__mix_from"))
        & (F.col("__mix_round") < F.col("__mix_to")),
    )
    slot = F.col("__mix_start") + (F.col("__mix_round") - F.col("__mix_from")) * F.col("__mix_slots")
    return found.select(
        *[F.col(quoted(c)) for c in kept.columns], "mix_block", slot.cast("long").alias("mix_slot"), "mix_place"
    )


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "source", "mix_block", "mix_slot", "mix_place")
