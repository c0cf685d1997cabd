"""CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, total: str, key: str) -> DataFrame:
    """Largest total first, ties by key."""
    return df.orderBy(F.desc(total), F.asc(key))


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write a folder of CSV files with headers, in place of an earlier one.

    Read in name order, the files hold the rows in order: a sort is split into
    ranges, and no task has to hold the whole table.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", compression)
        .csv(path)
    )


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """An exported table, as text."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def read_positions(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """An exported table with each row's number from 1, over its files in order of their names.

    A file is read by one task, in order, so a row's place in it is how far its id is
    from the file's first. Only a row per file is put in one order.
    """
    rows = read_export(spark, path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_id")
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        rows.groupBy("_file")
        .agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
        .select("_file", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    place = F.col("_id") - F.col("_first") + F.col("_before") + 1
    return rows.join(firsts, "_file").withColumn(name, place).drop("_file", "_id", "_first", "_before")
