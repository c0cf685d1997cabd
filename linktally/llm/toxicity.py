"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; every other document of the
training part, labelled or not, is unlabelled. With the class prior ``p`` the
risk of calling all unlabelled text clean counts the toxic share in it twice, so
``p`` times the positives' risk of being called clean is taken off, and where
that would make the estimate negative the step goes the other way. The model is
linear over hashed beginnings of words. Counts over the whole training part decide
which of them get a weight: all whose share differs surely between the two parts.
It is fitted in numpy on a bounded sample and applied to every text inside tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.llm.common import crc_rest, lowered, mixed, quoted, reachable, slices, span_hashes, text_of, utf8, without, words
from linktally.llm.hashed import BUCKETS, Adam, Rows, bounded_rows, bucketed, sampled_features, scored, sigmoid

#: Lengths in bytes of the word beginnings that are features, next to whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Words added to a text's length, and the largest density.
DAMPING, MOST_DENSE = 20, 4.0
#: Bounds of the sample that the classifier is fitted on.
POSITIVES, UNLABELLED = 1_500, 5_000
#: Bound of the likelihood ratio (chi-squared, one degree) that one in ``BUCKETS`` passes by chance.
SURE = 21.4
#: Words of 64 bits in the table of hashed ids, as a power of two.
WORD_BITS = 18

ADDED = ("held_out", "score", "predicted")


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How dense whole words and their beginnings are in each text, case of A-Z aside.

    A value is occurrences per hundred words, damped for texts of few words.
    """
    data = lowered(data)
    starts, ends, counts = words(data, offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    found = []
    for size in (*BEGINNINGS, 0):
        stop = np.minimum(starts + size, ends) if size else ends
        used = ends - starts > size if size else np.ones(len(starts), dtype=bool)
        hashes = mixed(span_hashes(data, starts[used], stop[used]) + np.uint64(size + 1))
        found.append((row[used].astype(np.int64) << 18) | bucketed(hashes))
    codes, occurrences = np.unique(np.concatenate(found), return_counts=True)
    row = codes >> 18
    return row, codes & (BUCKETS - 1), np.minimum(100.0 * occurrences / (counts[row] + DAMPING), MOST_DENSE)


def telling(p_count: np.ndarray, u_count: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """Marks every bucket whose share among positives surely differs from that among the other texts.

    The test is that of the likelihood ratio, which holds for rare buckets too. Its
    bound lets through about one of all buckets by chance; how many pass follows
    from the data alone.
    """

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-300)), 0.0)

    total, rows = p_count + u_count, max(n_p + n_u, 1)
    ratio = 2 * (
        part(p_count, total * (n_p / rows))
        + part(u_count, total * (n_u / rows))
        + part(n_p - p_count, (rows - total) * (n_p / rows))
        + part(n_u - u_count, (rows - total) * (n_u / rows))
    )
    return ratio > SURE


def bucket_counts(texts: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of the texts each bucket is, and how many texts there are.

    A task sends a row per bucket at most, and the driver gets no more than that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            data, offsets = utf8(batch["text"])
            rows += batch.num_rows
            for start, end in slices(offsets):
                part = data[offsets[start] : offsets[end]]
                _, buckets, _ = word_features(part, offsets[start : end + 1] - offsets[start])
                counts += np.bincount(buckets, minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(counts[seen], rows), pa.int64())],
            names=["bucket", "texts"],
        )

    reachable(texts.sparkSession)
    counted = texts.select(text_of(text_col).alias("text")).mapInArrow(run, "bucket int, texts long")
    table = counted.groupBy("bucket").agg(F.sum("texts").alias("texts")).toArrow()
    bucket, found = table["bucket"].to_numpy(), table["texts"].to_numpy()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[bucket[bucket >= 0]] = found[bucket >= 0]
    return counts, int(found[bucket < 0].sum())


def fit_nnpu(
    targets: np.ndarray,
    rows: Rows,
    prior: float,
    epochs: int = 30,
    batches: int = 20,
    rate: float = 0.05,
    decay: float = 0.0005,
    seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights and bias by the non-negative risk estimator with the logistic loss."""
    weights, bias = np.zeros(BUCKETS), np.array([np.log(prior / (1 - prior))])
    positive, unlabelled = np.flatnonzero(targets == 1), np.flatnonzero(targets != 1)
    if not len(positive) or not len(unlabelled):
        return weights, float(bias[0])
    of_weights, of_bias = Adam(BUCKETS, rate, decay), Adam(1, rate, 0.0)
    random = np.random.default_rng(seed)
    batches = max(1, min(batches, len(positive), len(unlabelled)))
    for _ in range(epochs):
        p_parts = np.array_split(random.permutation(positive), batches)
        u_parts = np.array_split(random.permutation(unlabelled), batches)
        for p_part, u_part in zip(p_parts, u_parts):
            p, u = rows.take(p_part), rows.take(u_part)
            p_out, u_out = p.dot(weights) + bias, u.dot(weights) + bias
            # losses log(1 + exp(-z)) and log(1 + exp(z)); their slopes are sigmoid(z) - 1 and sigmoid(z)
            clean_risk = np.logaddexp(0, u_out).mean() - prior * np.logaddexp(0, p_out).mean()
            p_slope = -prior * sigmoid(p_out) / len(p_part)
            u_slope = sigmoid(u_out) / len(u_part)
            if clean_risk < 0:  # step back from the part that went below zero, and nothing else
                p_slope, u_slope = -p_slope, -u_slope
            else:
                p_slope = p_slope + prior * (sigmoid(p_out) - 1) / len(p_part)
            of_weights.step(weights, p.gradient(p_slope) + u.gradient(u_slope))
            of_bias.step(bias, np.array([p_slope.sum() + u_slope.sum()]))
    return weights, float(bias[0])


def _of_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ``ids``, which are distinct.

    A bit per hashed id, in a table of bounded size, keeps most other texts out of
    the join, so that they are not shuffled. A semi join would be moved before it.
    """
    place = F.shiftrightunsigned(F.xxhash64("id"), 64 - WORD_BITS - 6)
    word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
    bits = ids.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    bits = bits.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    likely = texts.join(F.broadcast(bits), word == F.col("word")).where(F.getbit("bits", bit) == 1)
    return likely.select("id", "text").join(ids, "id").select("id", "text")


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prior: float | None = None,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> DataFrame:
    """The documents with ``held_out, score, predicted`` added.

    ``labels`` has the id and ``toxic``. Rows whose crc32 of the id as text leaves
    0 modulo 5 are held out of the fit. ``prior`` is the share of toxic texts;
    without it, the share among the labelled rows of the training part. At most
    ``positives`` confirmed and ``unlabelled`` other rows are fitted on, those
    with the least hashed ids and, of rows that share one, the least hashed texts; every text is scored whole. Which words may count is
    told by all rows of the training part: as many as pass the test of ``telling``.
    One that is in no text of the sample gets no weight.

    An id labelled more than once is toxic if any label says so; null labels and
    labels without a document count for nothing. Rows that repeat an id are each
    scored and share their label. Null and empty texts get the score of no evidence,
    about the prior; without a confirmed example every text does. A null id is
    hashed as empty text and has no label. Columns named like an added one are
    replaced; an empty table gives an empty table.
    """
    kept = without(docs, ADDED)
    ids = F.col(quoted(id_col))
    known = labels.where(F.col("toxic").isNotNull() & ids.isNotNull()).groupBy(ids.alias("id")).agg(F.max("toxic").alias("toxic"))
    train = docs.where(crc_rest(id_col) != 0).select(ids.alias("id")).distinct()
    marked = train.join(known, "id", "left")
    if prior is None:
        share = marked.agg(F.avg("toxic").alias("share")).first()["share"]
        prior = min(max(share or 0.0, 0.01), 0.9)
    place = F.xxhash64("id")
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    chosen = (
        marked.where(toxic).select("id", place.alias("place"), F.lit(1.0).alias("target")).orderBy("place").limit(positives)
    ).union(
        marked.where(~toxic).select("id", place.alias("place"), F.lit(0.0).alias("target")).orderBy("place").limit(unlabelled)
    )
    part = docs.where(crc_rest(id_col) != 0).select(ids.alias("id"), F.col(quoted(text_col)).alias("text"))
    confirmed = _of_ids(part, known.where("toxic = 1").select("id"))
    (p_count, n_p), (all_count, n_all) = bucket_counts(confirmed, "text"), bucket_counts(part, "text")
    used = telling(p_count, all_count - p_count, n_p, n_all - n_p)

    def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, bucket, value = word_features(data, offsets)
        kept = used[bucket]
        return row[kept], bucket[kept], value[kept]

    sample = docs.join(F.broadcast(chosen), ids.eqNullSafe(F.col("id")))
    if docs.schema[id_col].dataType.typeName() == "void":
        raise ValueError(f"{id_col} has no type")
    found = sample.select("place", "target", F.col(quoted(text_col)).alias("text"))
    bounded = bounded_rows(found.where("target = 1"), positives).union(bounded_rows(found.where("target = 0"), unlabelled))
    targets, rows = sampled_features(bounded, "text", features)
    weights, bias = fit_nnpu(targets, rows, prior)
    named = kept.withColumn("held_out", crc_rest(id_col) == 0)
    out = scored(named, text_col, word_features, weights, bias, "score")
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")
