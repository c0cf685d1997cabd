"""Distinct counts by month, and their sums over months.

A total is the **sum of monthly distinct counts**: an account active in three
months counts three times. That is the definition of the reports; an all-time
distinct count is a different number.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linktally.functions.settle import settle
from linktally.functions.times import month_column
from linktally.schemas import MONTH_COLUMN_PREFIX


@dataclass(frozen=True)
class RollupSpec:
    """What to count: keys, distinct measures, carried columns and a filter.

    ``distinct`` maps a measure to the column whose values it counts;
    ``carried`` maps an output to the column of which any value will do (the
    smallest is taken, so results repeat). ``where`` builds the row filter;
    ``skip_null_keys`` adds that every key has a value.
    """

    keys: tuple[str, ...]
    distinct: Mapping[str, str]
    carried: Mapping[str, str] = field(default_factory=dict)
    where: Callable[[], Column] | None = None
    skip_null_keys: bool = False


def monthly_rollup(df: DataFrame, spec: RollupSpec, month: str = "month") -> DataFrame:
    """One row per key and month. Rows without a month are left out.

    Spark shuffles on key, month *and* counted value, after removing repeats
    within each task, so a key holding a large share of all rows is spread over
    many tasks. The second step moves one row per key, month and task.

    Carried columns go through the same scan and shuffle, see ``_tagged_rollup``.
    """
    keys = [*spec.keys, "month"]
    others = {*spec.distinct.values(), *spec.carried.values()} - {*keys}
    rows = df.where(F.col(month).isNotNull())
    if spec.where is not None:
        rows = rows.where(spec.where())
    if spec.skip_null_keys:
        rows = rows.dropna(subset=list(spec.keys))
    rows = rows.select(*spec.keys, F.col(month).alias("month"), *sorted(others))
    if spec.carried:
        return _tagged_rollup(rows, spec, keys)
    return rows.groupBy(*keys).agg(*[F.count_distinct(column).alias(name) for name, column in spec.distinct.items()])


def _tagged_rollup(rows: DataFrame, spec: RollupSpec, keys: Sequence[str]) -> DataFrame:
    """Distinct counts and carried columns from one scan and one shuffle of the rows.

    Every row becomes one row per measure and carried column, tagged with its
    number; repeats go within each task, and the rest is shuffled by key, month,
    tag and value. Both aggregates that follow read this one shuffle: the counts
    by hashing, and the carried texts, for which Spark sorts, from their own few rows.
    """
    measures = len(spec.distinct)
    kinds = {name: rows.schema[column].dataType for name, column in spec.carried.items()}
    entries = [
        F.struct(
            F.lit(tag).alias("_tag"),
            F.col(column).cast("string").alias("_value"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()],
        )
        for tag, column in enumerate(spec.distinct.values())
    ]
    for tag, carried in enumerate(spec.carried, measures):
        values = [
            (F.col(spec.carried[name]) if name == carried else F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()
        ]
        entries.append(F.struct(F.lit(tag).alias("_tag"), F.lit(None).cast("string").alias("_value"), *values))
    names = {key: f"_key{place}" for place, key in enumerate(keys)}  # a carried column may be called like a key
    tagged = rows.select(*[F.col(key).alias(name) for key, name in names.items()], F.inline(F.array(*entries)))
    # a carried row stays where its value is null too: it stands for its key
    useful = tagged.where((F.col("_tag") >= measures) | F.col("_value").isNotNull()).distinct()
    shared = settle(useful, *useful.columns)
    own = list(names.values())
    counts = (
        shared.where(F.col("_tag") < measures)
        .groupBy(*own)
        .agg(*[F.count_if(F.col("_tag") == tag).alias(name) for tag, name in enumerate(spec.distinct)])
    )
    carried = shared.where(F.col("_tag") >= measures).groupBy(*own).agg(*[F.min(name).alias(name) for name in kinds])
    joined = _joined(carried, counts, own, spec.skip_null_keys, "left")
    return joined.select(
        *[F.col(name).alias(key) for key, name in names.items()],
        *[F.coalesce(name, F.lit(0)).alias(name) for name in spec.distinct],
        *kinds,
    )


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], never_null: bool, how: str = "inner") -> DataFrame:
    """Join two tables with the same unique keys, placed by them already."""
    return left.join(right, list(keys), how) if never_null else _join_null_safe(left, right, keys, how)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two tables with the same unique keys; a null key matches a null key."""
    renamed = right.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return left.join(renamed, same, how).drop(*[f"_{key}" for key in keys])


def present_months(df: DataFrame) -> list[str]:
    """The months in the data, in order. A driver list as long as the calendar."""
    rows = df.select("month").where(F.col("month").isNotNull()).distinct().collect()
    return sorted(row["month"] for row in rows)


def merge_months(
    monthly: DataFrame,
    spec: RollupSpec,
    months: Sequence[str] = (),
    by_month: str | None = None,
    prefix: str = MONTH_COLUMN_PREFIX,
) -> DataFrame:
    """Sum a monthly rollup over months: one row per key.

    ``by_month`` names the measure that also gets one column for each of
    ``months``, 0 where the key has no row. Input tables of several runs can be
    put together with ``unionByName`` first; the sums are the same. Carried
    columns are read apart, since Spark would sort the rows of an aggregate that
    keeps text beside sums: give a stored table where there are any.
    """
    sums = [F.sum(name).alias(name) for name in spec.distinct]
    if by_month and months:
        merged = _summed_by_slot(monthly, spec, months, by_month, prefix)
    else:
        merged = monthly.groupBy(*spec.keys).agg(*sums)
    if spec.carried:
        texts = monthly.groupBy(*spec.keys).agg(*[F.min(name).alias(name) for name in spec.carried])
        merged = _joined(merged, texts, spec.keys, spec.skip_null_keys)
    return merged


def _summed_by_slot(monthly: DataFrame, spec: RollupSpec, months: Sequence[str], by_month: str, prefix: str) -> DataFrame:
    """Sums of every measure, and of one measure for every month.

    A row gives a value to the slot of each measure, and one to that of its month.
    One pivot adds up all slots: a hash finds the slot of a value, so the work for
    a row does not grow with the months.
    """
    totals = {name: f"total of {name}" for name in spec.distinct}
    slots = [F.struct(F.lit(slot).alias("_slot"), F.col(name).cast("bigint").alias("_value")) for name, slot in totals.items()]
    slots.append(F.struct(F.col("month").alias("_slot"), F.col(by_month).cast("bigint").alias("_value")))
    values = monthly.select(*spec.keys, F.inline(F.array(*slots)))
    wide = values.groupBy(*spec.keys).pivot("_slot", [*totals.values(), *months]).agg(F.sum("_value"))
    return wide.select(
        *spec.keys,
        *[F.col(f"`{slot}`").alias(name) for name, slot in totals.items()],
        *[F.coalesce(F.col(f"`{month}`"), F.lit(0)).alias(month_column(month, prefix)) for month in months],
    )
