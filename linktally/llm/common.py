"""Helpers that the operators of this folder share."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linktally.session import scratch_path

#: White space of the text contracts, as a Java and Python pattern.
SPACES = r"[\x20\x09-\x0D]+"

#: Bytes of text worked on at once inside a task; bounds the arrays made from them.
SLICE_BYTES = 1 << 18


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Needed where it is neither installed nor in the workers' folder.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def text_of(name: str) -> Column:
    """A text column with null as empty."""
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The input without columns that an operator is about to add (names ignore case)."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in taken])


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends, the work is done once."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows with their number in the table's files added, files in order of their paths.

    The number follows from the files alone: it is the same whenever they are read.
    What does not come straight from Parquet files is written first. Only the row
    counts of files, not rows, are put in one order.
    """

    def placed(table: DataFrame) -> DataFrame:
        return table.select(
            *[F.col(quoted(c)) for c in table.columns],
            F.col("_metadata.file_path").alias("__file_path"),
            F.col("_metadata.row_index").alias("__file_row"),
        )

    try:
        rows = placed(df)
    except AnalysisException:
        rows = placed(cut(df, "numbered"))
    before = Window.orderBy("__file_path").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        rows.groupBy("__file_path")
        .count()
        .select("__file_path", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__file_first"))
    )
    return rows.join(F.broadcast(firsts), "__file_path").select(
        *[F.col(quoted(c)) for c in df.columns], (F.col("__file_first") + F.col("__file_row")).alias(name)
    )


def crc_rest(name: str, divisor: int = 5) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))) % divisor).cast("int")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow text column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES, most: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Ranges of ``most`` rows at most that hold about ``limit`` bytes each, one row at least."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), start + most, rows)
        yield start, end
        start = end


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes, those of UTF-8 sequences too, stay."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of non-space bytes, and how many each row has."""
    return runs(~_IS_SPACE[data], offsets)


def runs(full: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of marked bytes inside a row, and how many each row has."""
    before = np.zeros(len(full), dtype=bool)
    before[1:] = full[:-1]
    after = np.zeros(len(full), dtype=bool)
    after[:-1] = full[1:]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    before[firsts] = False
    after[lasts] = False
    opens = full & ~before
    counted = np.zeros(len(full) + 1, dtype=np.int64)
    np.cumsum(opens, out=counted[1:])
    return (
        np.flatnonzero(opens),
        np.flatnonzero(full & ~after) + 1,
        counted[offsets[1:]] - counted[offsets[:-1]],
    )


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending. Sorting is faster here than hashing."""
    values = np.sort(values)
    fresh = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values.copy()
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, size: int) -> Powers:
        if len(self.up) < size:
            size = max(size, 1 << 16)
            factors = np.full(size, self.BASE, dtype=np.uint64)
            factors[0] = 1
            self.up = np.cumprod(factors, dtype=np.uint64)
            factors[1:] = pow(self.BASE, -1, 1 << 64)
            self.down = np.cumprod(factors, dtype=np.uint64)
        return self


POWERS = Powers()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from running sums over all bytes."""
    table = POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * table.up[: len(data)], out=sums[1:], dtype=np.uint64)
    spans = (sums[ends] - sums[starts]) * table.down[starts]
    return mixed(spans + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
