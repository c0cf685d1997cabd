"""Raw post files: which ones, and how to read them."""

from __future__ import annotations

import os
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktally.functions.settle import settle
from linktally.schemas import BAD_ROW_COLUMNS, POST_COLUMNS, require_columns, strings
from linktally.sources.splits import csv_records, well_formed

DEFAULT_PATTERN = "**/*.gz"

# The endings of files that Spark unpacks, from their start only.
PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")

# Header reads running at once; each is a small job on one file.
HEADER_READS = 16


def _without_scheme(name: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", name)


def list_files(spark: SparkSession, path: str, pattern: str = DEFAULT_PATTERN) -> list[str]:
    """The file at ``path``, or the files below it that match ``pattern``.

    The pattern is relative to ``path`` and may use ``**``. Only names are read.
    A path that does not exist raises, as does a folder without a match.
    """
    root = path.rstrip("/")
    if os.path.exists(root):  # a local path may be relative
        root = os.path.abspath(root)
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path").collect()
    )
    base = _without_scheme(root)
    matching = []
    for name in sorted(row["path"] for row in listing):
        before, _, below = _without_scheme(name).partition(base)
        is_the_path_itself = not below and (not before or not base.startswith("/"))
        if is_the_path_itself or PurePosixPath(below.lstrip("/")).full_match(pattern):
            matching.append(name)
    if not matching:
        raise FileNotFoundError(f"no file below {path} matches {pattern}")
    return matching


def _literal_path(name: str) -> str:
    """A file name with glob characters escaped."""
    return "".join("\\" + char if char in "{}[]*?\\" else char for char in name)


def _csv_reader(spark: SparkSession, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("mode", "FAILFAST")
    )


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names: a job that reads one line. A name broken over lines fails later, by name."""
    return tuple(_csv_reader(spark, multiline=False).csv(_literal_path(file)).columns)


def _reads_in_parts(name: str) -> bool:
    """Is a file plain, so that it can be read from the middle?"""
    return not name.lower().endswith(PACKED)


def _named_types(names) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)


def _free_name(header) -> str:
    name = "_unparsed"
    while name in header:
        name += "_"
    return name


def _parse_whole(spark: SparkSession, files: list[str], header, multiline: bool, prune: bool, keep_bad: bool) -> DataFrame:
    """Rows by Spark's own reader; with ``keep_bad`` the bad row columns too."""
    reader = _csv_reader(spark, multiline).option("enforceSchema", False).option("columnPruning", prune)
    if not keep_bad:
        return reader.schema(strings(header)).csv(files)
    corrupt = _free_name(header)
    rows = (
        reader.schema(strings([*header, corrupt]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .csv(files)
    )
    malformed = F.col(f"`{corrupt}`").isNotNull()
    text = F.coalesce(F.col(f"`{corrupt}`"), F.to_csv(F.struct(*[F.col(f"`{name}`") for name in header]), {"escape": '"'}))
    return rows.select("*", malformed.alias("malformed"), text.alias("raw_row"), F.col("_metadata.file_path").alias("source_file"))


def _parse_split(spark: SparkSession, files: list[str], header, check_width: bool, keep_bad: bool) -> DataFrame:
    """Rows of plain files that many tasks share."""
    corrupt = _free_name(header)
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": corrupt}
    parsed = F.from_csv("record", _named_types([*header, corrupt]), options)
    records = settle(csv_records(spark, files, header).withColumn("row", parsed), "row")
    ragged = F.col(f"row.`{corrupt}`").isNotNull() if check_width or keep_bad else F.lit(False)
    malformed = ~well_formed(F.col("record")) | ragged
    values = [F.col(f"row.`{name}`").alias(name) for name in header]
    if not keep_bad:
        problem = F.concat(F.lit("malformed CSV record: "), F.substring("record", 1, 500))
        return records.where(F.when(malformed, F.raise_error(problem).cast("boolean")).otherwise(True)).select(*values)
    listed = spark.read.format("binaryFile").load(files).select(F.col("_metadata.file_path").alias("source_file"))
    paths = listed.select(F.xxhash64("source_file").alias("file"), "source_file")
    named = records.join(F.broadcast(paths), "file")  # a row per file; the driver holds their names anyway
    return named.select(*values, malformed.alias("malformed"), F.col("record").alias("raw_row"), "source_file")


def read_csv_by_name(
    spark: SparkSession,
    files: list[str],
    columns,
    multiline: bool = True,
    check_width: bool = True,
    same_header: bool = False,
    each_header: bool = False,
    split: bool = False,
    keep_bad: bool = False,
) -> DataFrame:
    """Columns of CSV files as strings, matched by name in every file.

    One read over files whose headers differ would take values by position, so
    files are grouped by header and read group by group. The files of a folder are
    taken to have the header of its first one, so there is a header to read per
    folder; Spark compares the names of every file and raises where they differ.
    ``each_header`` reads the header of every file instead, for folders of mixed
    files; ``same_header`` reads one for all files. ``check_width`` raises on
    a row with too few or too many values; without it the parser may skip the
    columns that are not needed. A file without a needed column raises.

    With line breaks in values a file is one task, unless ``split``: then many tasks
    share a plain file, and a first pass over it counts quotes. Quotes must
    enclose whole values there; a record where they do not raises. Packed files
    (gzip and the like) stay one task each.

    ``keep_bad`` raises on no row. It adds ``malformed`` (too few or too many
    values, or quotes that do not pair; the row's values are null), ``raw_row``, the row's text,
    and ``source_file``.
    """
    together: dict[str, list[str]] = {}
    for file in files:
        place = "" if same_header else file if each_header else file.rpartition("/")[0]
        together.setdefault(place, []).append(file)
    with ThreadPoolExecutor(HEADER_READS) as pool:
        headers = list(pool.map(lambda members: _header(spark, members[0]), together.values()))
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for header, members in zip(headers, together.values()):
        for member in members:
            groups.setdefault((header, split and multiline and _reads_in_parts(member)), []).append(_literal_path(member))
    frames = []
    for (header, in_parts), members in groups.items():
        require_columns(header, columns, members[0])
        if in_parts:
            rows = _parse_split(spark, members, header, check_width, keep_bad)
        else:
            rows = _parse_whole(spark, members, header, multiline, not check_width and not keep_bad, keep_bad)
        if not keep_bad:
            frames.append(rows.select(*columns))
        else:
            values = [F.when(~F.col("malformed"), F.col(name)).alias(name) for name in columns]
            frames.append(rows.select(*values, *BAD_ROW_COLUMNS))
    return reduce(DataFrame.unionByName, frames)


def read_posts(
    spark: SparkSession, path: str, pattern: str = DEFAULT_PATTERN, **csv_options
) -> DataFrame:
    """Raw posts from CSV files, packed or not, with line breaks in quoted values.

    Further options are those of :func:`read_csv_by_name`.
    """
    return read_csv_by_name(spark, list_files(spark, path, pattern), POST_COLUMNS, **csv_options)


def write_bronze(posts: DataFrame, path: str, codec: str = "zstd") -> None:
    """Keep the needed columns of raw posts as Parquet, which splits when read.

    Pays off when gzip files are to be read more than once.
    """
    posts.select(*POST_COLUMNS).write.mode("overwrite").option("compression", codec).parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    posts = spark.read.parquet(path)
    require_columns(posts.columns, POST_COLUMNS, path)
    return posts.select(*[F.col(name).cast("string").alias(name) for name in POST_COLUMNS])
