"""Hashed linear scorers: features in numpy inside tasks, a small fit on a bounded sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linktally.llm.common import quoted, reachable, slices, text_of, utf8

#: Buckets of hashed features; a scorer's weights are this many floats.
BUCKETS = 1 << 18

#: Makes the features of some texts: bytes, row offsets -> row numbers (ascending), buckets, values.
Featurizer = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def bucketed(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


class Rows:
    """Sparse rows one after another."""

    def __init__(self, ends: np.ndarray, buckets: np.ndarray, values: np.ndarray) -> None:
        self.ends, self.buckets, self.values = ends, buckets, values

    def dot(self, weights: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(self.buckets) + 1)
        np.cumsum(weights[self.buckets] * self.values, out=sums[1:])
        return np.diff(sums[self.ends])

    def gradient(self, per_row: np.ndarray) -> np.ndarray:
        each = np.repeat(per_row, np.diff(self.ends)) * self.values
        return np.bincount(self.buckets, weights=each, minlength=BUCKETS)

    def only(self, used: np.ndarray) -> Rows:
        """The rows with the marked buckets alone."""
        kept = used[self.buckets]
        counted = np.zeros(len(kept) + 1, dtype=np.int64)
        np.cumsum(kept, out=counted[1:])
        return Rows(counted[self.ends], self.buckets[kept], self.values[kept])

    def take(self, rows: np.ndarray) -> Rows:
        starts, sizes = self.ends[rows], np.diff(self.ends)[rows]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])
        return Rows(ends, self.buckets[at], self.values[at])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Adam:
    """Adam steps with decay of the weights."""

    def __init__(self, size: int, rate: float, decay: float) -> None:
        self.first, self.second, self.steps = np.zeros(size), np.zeros(size), 0
        self.rate, self.decay = rate, decay

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> None:
        self.steps += 1
        self.first += 0.1 * (gradient - self.first)
        self.second += 0.001 * (gradient**2 - self.second)
        first = self.first / (1 - 0.9**self.steps)
        second = self.second / (1 - 0.999**self.steps)
        weights *= 1 - self.rate * self.decay
        weights -= self.rate * first / (np.sqrt(second) + 1e-8)


def features_of(texts: pa.Array, featurizer: Featurizer) -> Rows:
    """Features of a column of texts, a slice of bytes at a time."""
    data, offsets = utf8(texts)
    sizes, buckets, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for start, end in slices(offsets):
        part = data[offsets[start] : offsets[end]]
        row, bucket, value = featurizer(part, offsets[start : end + 1] - offsets[start])
        sizes.append(np.bincount(row, minlength=end - start).astype(np.int64))
        buckets.append(bucket)
        values.append(value)
    ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
    return Rows(ends, np.concatenate(buckets), np.concatenate(values))


def bounded_rows(rows: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` of the rows ``place, target, text``: the least by place, then by a hash of the text.

    Ids were chosen, and rows that share one are as many as they like. Places and
    hashes alone are put in order; rows equal in both count once.
    """
    keyed = rows.withColumn("row", F.xxhash64("text"))
    last = keyed.select("place", "row").orderBy("place", "row").limit(limit).agg(F.max(F.struct("place", "row")).alias("last"))
    most = last.first()["last"]
    if most is None:
        return rows
    below = (F.col("place") < most["place"]) | ((F.col("place") == most["place"]) & (F.col("row") <= most["row"]))
    return keyed.where(below).dropDuplicates(["place", "row"]).drop("row")


def sampled_features(sample: DataFrame, text_col: str, featurizer: Featurizer) -> tuple[np.ndarray, Rows]:
    """Targets and features of a sample of bounded size, for a fit on the driver.

    ``sample`` has ``target`` (double) and the text. Rows come in no fixed order,
    so they are put in order by the column ``place``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = features_of(batch["text"], featurizer)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["place"],
                    batch["target"],
                    pa.LargeListArray.from_arrays(rows.ends, pa.array(rows.buckets.astype(np.int32))).cast(pa.list_(pa.int32())),
                    pa.LargeListArray.from_arrays(rows.ends, pa.array(rows.values.astype(np.float32))).cast(pa.list_(pa.float32())),
                ],
                names=["place", "target", "buckets", "weights"],
            )

    reachable(sample.sparkSession)
    given = sample.select("place", F.col("target").cast("double").alias("target"), text_of(text_col).alias("text"))
    table = given.mapInArrow(run, "place long, target double, buckets array<int>, weights array<float>").toArrow()
    table = table.sort_by([("place", "ascending"), ("target", "ascending")])
    lists = table["buckets"].combine_chunks()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    values = table["weights"].combine_chunks().flatten().to_numpy().astype(np.float64)
    return table["target"].to_numpy(), Rows(ends, lists.flatten().to_numpy().astype(np.int64), values)


def scored(
    docs: DataFrame, text_col: str, featurizer: Featurizer, weights: np.ndarray, bias: float, name: str
) -> DataFrame:
    """The documents with a score between 0 and 1 added: the last column."""
    reachable(docs.sparkSession)
    broadcast = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), float(bias)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, shift = broadcast.value
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            scores = np.zeros(batch.num_rows)
            for start, end in slices(offsets):
                part = data[offsets[start] : offsets[end]]
                row, bucket, value = featurizer(part, offsets[start : end + 1] - offsets[start])
                total = np.bincount(row, weights=weight[bucket] * value, minlength=end - start)
                scores[start:end] = sigmoid(total + shift)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores)], names=[*batch.schema.names[:-1], name]
            )

    kept = docs.select(*[F.col(quoted(c)) for c in docs.columns], text_of(text_col).alias("__scored_text"))
    return kept.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
