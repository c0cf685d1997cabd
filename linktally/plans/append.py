"""Months that grow: a file is added to a month without going through the month again.

What is stored are the distinct values that a rollup counts, by key and month. Of
new rows only the values not yet among them are written. The counts of the months
concerned are then taken over the stored values, in which nothing repeats, and not over the posts; so
a run that fails on the way, and is done again, counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linktally.operators.rollup import RollupSpec
from linktally.sources.tables import gather_by_month, refresh_by_month

#: Measure of the rows that say no more than that a key is there.
PRESENT = ""


def distinct_values(rows: DataFrame, spec: RollupSpec) -> DataFrame:
    """Keys, ``month``, ``measure`` and ``value``: the distinct values of every measure, and of carried columns, as text."""
    rows = rows.where(F.col("month").isNotNull())
    if spec.where is not None:
        rows = rows.where(spec.where())
    if spec.skip_null_keys:
        rows = rows.dropna(subset=list(spec.keys))
    pairs = [(name, F.col(column).cast("string")) for name, column in {**spec.distinct, **spec.carried}.items()]
    entries = [F.struct(F.lit(name).alias("measure"), value.alias("value")) for name, value in [(PRESENT, F.lit("")), *pairs]]
    listed = rows.select(*spec.keys, "month", F.inline(F.array(*entries)))
    return listed.where(F.col("value").isNotNull()).distinct()


def values_schema(rows: DataFrame, spec: RollupSpec) -> T.StructType:
    texts = [T.StructField(name, T.StringType()) for name in ("measure", "value", "month")]
    return T.StructType([*[rows.schema[key] for key in spec.keys], *texts])


def new_values(values: DataFrame, stored: DataFrame, spec: RollupSpec) -> DataFrame:
    """The values that are not among those stored. A null key equals a null key."""
    names = [*spec.keys, "month", "measure", "value"]
    renamed = stored.select(*[F.col(name).alias(f"_{name}") for name in names])
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in names]
    return values.join(renamed, same, "left_anti")


def count_values(values: DataFrame, spec: RollupSpec) -> DataFrame:
    """The rollup of stored values: one row per key and month. Carried columns are text."""
    keys = [*spec.keys, "month"]
    counts = values.groupBy(*keys).agg(*[F.count_if(F.col("measure") == name).alias(name) for name in spec.distinct])
    for name in spec.carried:
        least = values.where(F.col("measure").isin(name, PRESENT)).groupBy(*keys).agg(
            F.min(F.when(F.col("measure") == name, F.col("value"))).alias(name)
        )
        renamed = least.withColumnsRenamed({key: f"_{key}" for key in keys})
        same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
        counts = counts.join(renamed, same).drop(*[f"_{key}" for key in keys])
    return counts


def append_rollup(
    spark: SparkSession, rows: DataFrame, spec: RollupSpec, months: Sequence[str], values_path: str, counts_path: str
) -> None:
    """Add rows of the given months to a stored rollup; rows of other months are left out.

    Both tables are by month; they are made where they do not exist. Only values that are new are
    written, and only the counts of these months.
    """
    added = distinct_values(rows.where(F.col("month").isin(*months)), spec)
    schema = values_schema(rows, spec)
    try:
        stored = spark.read.schema(schema).parquet(values_path).where(F.col("month").isin(*months))
        added = new_values(added, stored, spec)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    written = gather_by_month(added.select(*schema.names)).write.mode("append").option("compression", "zstd")
    written.partitionBy("month").parquet(values_path)
    values = spark.read.schema(schema).parquet(values_path).where(F.col("month").isin(*months))
    refresh_by_month(count_values(values, spec), counts_path, months)
