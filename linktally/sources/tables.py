"""Stored tables: shares and monthly rollups by month, and metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linktally.functions.times import month_of, post_time
from linktally.schemas import (
    METADATA_FIELDS,
    PARSED_LINK_COLUMNS,
    SHARES_SCHEMA,
    metadata_type,
    require_columns,
)
from linktally.sources.posts import list_files, read_csv_by_name


# Within a file, shares of one domain and URL lie together: the files are smaller,
# and a filter on the domain skips the row groups of others.
SHARES_ORDER = ("domain_name", "normalized_url")


def _by_month(df: DataFrame, codec: str, order: Sequence[str]) -> DataFrameWriter:
    rows = df.sortWithinPartitions("month", *order) if order else df
    return rows.write.mode("overwrite").option("compression", codec).partitionBy("month")


def gather_by_month(df: DataFrame) -> DataFrame:
    """Bring the rows of a month together, so that a month has few files.

    Adaptive execution splits a large month over tasks and puts small ones
    together. Without it the hint has no effect, and a plain shuffle takes its place.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", "month")
    return df.repartition("month")


def write_by_month(
    df: DataFrame, path: str, codec: str = "zstd", order: Sequence[str] = (), gather: bool = True
) -> None:
    """Write a table partitioned by month, in place of an earlier one.

    ``order`` sorts the rows within each file. ``gather=False`` is for rows that
    already lie together by month; others would leave a file per task and month.
    """
    _by_month(gather_by_month(df) if gather else df, codec, order).parquet(path)


def refresh_by_month(
    df: DataFrame,
    path: str,
    months: Sequence[str],
    codec: str = "zstd",
    order: Sequence[str] = (),
    gather: bool = True,
    undated: bool = False,
) -> None:
    """Replace the given months of a table; files of other months stay as they are.

    ``df`` holds these months and rows without one. The new rows are written
    first, each month in place of its old files, and only then are months dropped
    that got none, so a run that fails on the way loses nothing. With ``undated``,
    rows without a month are added to those stored, but for rows stored already:
    another run over the same input adds none.
    """
    spark = df.sparkSession
    before = {month: _month_files(spark, path, month) for month in months}
    dated = df.where(F.col("month").isNotNull())
    rows = gather_by_month(dated) if gather else dated
    _by_month(rows, codec, order).option("partitionOverwriteMode", "dynamic").parquet(path)
    if undated:
        new = df.where(F.col("month").isNull())
        stored = read_by_month(spark, path, df.schema).where(F.col("month").isNull()).select(*df.columns)
        _by_month(new.exceptAll(stored), codec, order).mode("append").parquet(path)
    for month, files in before.items():
        if files and _month_files(spark, path, month) == files:  # a month with new rows has new files
            _drop_month(spark, path, month)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _month_files(spark: SparkSession, path: str, month: str) -> set[str]:
    files, place = file_system(spark, f"{path}/month={month}")
    return {status.getPath().getName() for status in files.listStatus(place)} if files.exists(place) else set()


def _drop_month(spark: SparkSession, path: str, month: str) -> None:
    files, place = file_system(spark, f"{path}/month={month}")
    files.delete(place, True)


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """The months of a table, in order, from the names of its partitions: no row is read."""
    files, place = file_system(spark, path)
    names = [status.getPath().getName() for status in files.listStatus(place)]
    months = [name.removeprefix("month=") for name in names if name.startswith("month=")]
    return sorted(month for month in months if month != "__HIVE_DEFAULT_PARTITION__")


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table written by :func:`write_by_month`; ``month`` stays text."""
    return spark.read.schema(schema).parquet(path)


def read_shares(spark: SparkSession, path: str) -> DataFrame:
    """Stored shares. A missing path or column raises."""
    try:
        present = spark.read.parquet(path).columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        present = SHARES_SCHEMA.names  # a table without a single row
    require_columns(present, SHARES_SCHEMA.names, path)
    return read_by_month(spark, path, SHARES_SCHEMA)


def read_parsed_links(
    spark: SparkSession,
    path: str,
    strict_time: bool = False,
    pattern: str | None = None,
    null_zero_ids: bool = True,
) -> DataFrame:
    """Shares from parsed-link Parquet files of an earlier tool (any numbers as text).

    ``pattern`` picks the files by name where other files lie beside them, such as
    copies of the raw columns. ``null_zero_ids`` as for raw posts.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    links = (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)
    require_columns(links.columns, PARSED_LINK_COLUMNS, path)
    text = {name: F.col(name).cast("string") for name in PARSED_LINK_COLUMNS}
    time = post_time(text["local_time"], strict_time)

    def identifier(name):
        return F.nullif(text[name], F.lit("0")) if null_zero_ids else text[name]

    named = links.select(
        F.md5(F.col("domain")).alias("domain_id"),
        text["domain"].alias("domain_name"),
        text["normalized_url"].alias("normalized_url"),
        text["link"].alias("link"),
        F.when(~text["retweeted_id"].isin("0", ""), text["retweeted_id"]).alias("retweeted_id"),
        identifier("id").alias("tweet_id"),
        identifier("user_id").alias("user_id"),
        time.alias("local_time"),
    )
    return named.withColumn("month", month_of(F.col("local_time")))


def read_metadata(spark: SparkSession, path: str, pattern: str = "**/*.csv") -> DataFrame:
    """Video metadata from CSV: ``video_id`` and ``channel_id``, as text."""
    files = list_files(spark, path, pattern)
    return read_csv_by_name(spark, files, ("video_id", "channel_id"))


def _record_texts(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return read_csv_by_name(spark, list_files(spark, path, pattern), METADATA_FIELDS)


def _typed(name: str, strict: bool = False) -> Column:
    """A field of a record in its type; spaces around a number or a time do not matter."""
    kind = metadata_type(name)
    text = F.col(name)
    if isinstance(kind, T.StringType):
        return text
    return text.cast(kind) if strict else F.trim(text).try_cast(kind)


def read_metadata_records(
    spark: SparkSession, path: str, pattern: str = "**/*.csv", strict: bool = False
) -> DataFrame:
    """Extended metadata records from CSV, read as text and cast by name.

    A value that is not of its field's type becomes null, and :func:`bad_record_values`
    counts such values; with ``strict`` it raises.
    """
    rows = _record_texts(spark, path, pattern)
    return rows.select(*[_typed(name, strict).alias(name) for name in METADATA_FIELDS])


def bad_record_values(spark: SparkSession, path: str, pattern: str = "**/*.csv") -> DataFrame:
    """One row per field with a type: how many values there are, and how many are not of that type."""
    fields = [name for name in METADATA_FIELDS if not isinstance(metadata_type(name), T.StringType)]
    counts = []
    for name in fields:
        given = F.col(name).isNotNull() & (F.trim(name) != "")
        bad = F.count_if(given & _typed(name).isNull())
        counts.append(F.struct(F.lit(name).alias("field"), F.count_if(given).alias("nb_values"), bad.alias("nb_bad")))
    return _record_texts(spark, path, pattern).agg(F.array(*counts).alias("fields")).select(F.inline("fields"))
