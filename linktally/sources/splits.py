"""Records of large plain CSV files, read by many tasks.

Line breaks inside quoted values are why Spark gives such a file to one task. Here
Spark splits it by lines, and quotes tell the records: a line break ends a record
where an even number of quotes comes before it in the file.

1. A count of quotes for each split, in generated code, and their running parity
   over the file: does the split start inside a value?
2. A second pass puts lines together. Batches of lines are handled as Arrow arrays;
   the pieces of the few records that cross from one split into the next are
   put together apart. What the pass gives is kept on the executors' disks, since
   whole records and pieces are read from it for themselves.

A record whose quotes stand where CSV allows none (in the middle of an unquoted
value) would shift the parity of all that follows, so every record is tested for its form.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

#: A record whose quotes all enclose whole values; possessive, so long values do not nest calls.
WELL_FORMED = r'(?s)^(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)(?:,(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+))*+\z'

#: Splits that the driver keeps a parity of; at 128 MB each this many are 500 TB.
MOST_SPLITS = 4_000_000

# What a piece of text is: a whole record, or the part of one that a split starts
# with, ends with, or is nothing but.
_WHOLE, _START, _END, _INNER = 0, 1, 2, 3
_PIECES = "file long, split long, kind byte, record string"


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Lines in the order of each split, by file (a hash of its path) and start of the split."""
    lines = spark.read.option("lineSep", "\n").text(list(files))
    path = F.col("_metadata.file_path")
    return lines.select("value", F.xxhash64(path).alias("file"), F.col("_metadata.file_block_start").alias("split"))


def _quotes(text: str) -> Column:
    return F.length(text) - F.length(F.replace(F.col(text), F.lit('"'), F.lit("")))


def open_splits(lines: DataFrame) -> dict[tuple[int, int], bool]:
    """For each split that holds the start of a line: does it start inside a quoted value?"""
    counts = lines.groupBy("file", "split").agg((F.sum(_quotes("value")) % 2).cast("int").alias("odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.select("file", "split", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("open"))
    found = {(row["file"], row["split"]): row["open"] for row in rows.limit(MOST_SPLITS + 1).collect()}
    if len(found) > MOST_SPLITS:
        raise ValueError(f"over {MOST_SPLITS} splits: set spark.sql.files.maxPartitionBytes higher")
    return found


def _records(opened, header: tuple[str, ...]):
    """Pieces of text, whole records for the most part; a file's header record is left out.

    A file whose header differs raises, as does a split that was not counted.
    """

    def check_header(record: str) -> None:
        names = tuple(next(csv.reader([record.removeprefix("﻿").removesuffix("\r")]), ()))
        if names != header:
            raise ValueError(f"header {names} where {header} was expected")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = opened.value
        at: tuple[int, int] | None = None
        inside = carried_over = headed = False
        waiting: list[str] = []  # lines of a record not ended yet

        def finish() -> tuple[list, list]:
            if not waiting:
                return [], []
            kind = _INNER if carried_over else _END
            return ["\n".join(waiting)], [kind]

        def batch_of(key, records, kinds) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])), pa.array(kinds, pa.int8()), records],
                names=["file", "split", "kind", "record"],
            )

        for batch in batches:
            values = pc.fill_null(batch["value"], "")
            files, splits = batch["file"].to_numpy(), batch["split"].to_numpy()
            odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) & 1
            turns = np.flatnonzero((files[1:] != files[:-1]) | (splits[1:] != splits[:-1])) + 1
            for start, end in zip([0, *turns], [*turns, len(files)]):
                if start == end:
                    continue
                key = (int(files[start]), int(splits[start]))
                if key != at:
                    left, kinds = finish()
                    if left:
                        yield batch_of(at, pa.array(left, pa.string()), kinds)
                    if key not in states:
                        raise RuntimeError("files or split sizes changed while they were read; read again")
                    at, inside, waiting = key, states[key], []
                    carried_over, headed = inside, key[1] > 0
                after = (int(inside) + np.cumsum(odd[start:end])) & 1
                inside = bool(after[-1])
                ends = np.flatnonzero(after == 0) + 1
                lines = values.slice(start, end - start)
                if not len(ends):
                    waiting.extend(lines.to_pylist())
                    continue
                bounds = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                records = pc.binary_join(pa.ListArray.from_arrays(bounds, lines.slice(0, int(ends[-1]))), "\n")
                kinds = np.zeros(len(records), dtype=np.int8)
                if waiting:
                    first = "\n".join([*waiting, records[0].as_py()])
                    records = pa.concat_arrays([pa.array([first], pa.string()), records.slice(1)])
                if carried_over:
                    kinds[0], carried_over = _START, False
                if not headed:
                    check_header(records[0].as_py())
                    records, kinds, headed = records.slice(1), kinds[1:], True
                waiting = lines.slice(int(ends[-1])).to_pylist()
                yield batch_of(key, records, kinds)
        left, kinds = finish()
        if left:
            yield batch_of(at, pa.array(left, pa.string()), kinds)

    return run


def _crossing(pieces: DataFrame) -> DataFrame:
    """Records put together from their pieces in one split after the other."""
    in_order = Window.partitionBy("file").orderBy("split", (F.col("kind") == _END).cast("int"))
    number = F.sum((F.col("kind") == _END).cast("int")).over(in_order)
    listed = F.array_sort(F.collect_list(F.struct("split", (F.col("kind") == _END).alias("last"), "record")))
    return (
        pieces.withColumn("number", number)
        .groupBy("file", "number")
        .agg(listed.alias("parts"))
        .select("file", F.array_join(F.col("parts.record"), "\n").alias("record"))
    )


def csv_records(spark: SparkSession, files: Sequence[str], header: tuple[str, ...]) -> DataFrame:
    """``file, record``: the text of every record of plain files that have one header.

    Counting the quotes of all splits is a job of its own, run here. Where a record crosses
    from one split into the next, the text is kept on disk until ``spark.catalog.clearCache()``
    or the end of the session; what a lost executor kept is read again. Empty lines
    between records are left out. A value in quotes that never ends makes the rest of
    its file one record, which is not well formed.
    """
    lines = _lines(spark, files)
    opened = spark.sparkContext.broadcast(open_splits(lines))
    pieces = lines.mapInArrow(_records(opened, header), _PIECES)
    crossed = any(opened.value.values())
    if crossed:
        pieces = pieces.persist(StorageLevel.DISK_ONLY)
    whole = pieces.where(F.col("kind") == _WHOLE).select("file", "record")
    if crossed:
        whole = whole.unionByName(_crossing(pieces.where(F.col("kind") != _WHOLE)))
    else:  # only a value that never ends can be left over
        whole = whole.unionByName(pieces.where(F.col("kind") == _END).select("file", "record"))
    text = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return whole.select("file", text.alias("record")).where(F.col("record") != "")


def well_formed(record: Column) -> Column:
    """Do quotes enclose whole values? Records without any are not looked through."""
    return ~record.contains('"') | record.rlike(WELL_FORMED)
