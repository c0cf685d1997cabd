"""Exact dedup by an extendible-hash index on shared files.

1. Every text gets a 64-bit key. A directory is doubled, a bit of the key at a
   time, until no bucket holds more than ``bucket_rows`` distinct keys.
2. Equal texts of a batch are merged, then sent to the owner task of their
   bucket, which is a contiguous range of keys. Owners read their range in key
   order, chain different texts that share a key, and compare bytes.
3. The chains are the index: a table in the shared folder with one row per
   distinct text. Documents look themselves up in it by key and SHA-256.

Nothing grows with a group of copies: a batch sends one row per text, an owner
keeps one chain at a time, and the lookup is a plain equi-join, whose hot
partitions adaptive execution splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.llm.common import SPACES, cut, quoted, reachable, text_of, without

#: Directory bits that one pass over the keys counts.
BITS_PER_ROUND = 6
#: The directory is kept by the driver and sent to tasks (16 bytes an entry).
MAX_BUCKETS = 1 << 22

ADDED = ("keep_id", "group_size", "kept", "text_sha256")
_KEY, _NORM, _SHA = "__dedup_key", "__dedup_norm", "__dedup_sha"


def build_directory(keys: DataFrame, column: str, bucket_rows: int) -> np.ndarray:
    """First unsigned key of each bucket, ascending, for distinct 64-bit keys.

    A bucket is a key prefix. One that holds more than ``bucket_rows`` keys is
    split by its next bit; the directory doubles when its deepest bucket splits.
    """
    counts = {(0, 0): None}
    leaves: list[tuple[int, int]] = []
    depth = 0
    while counts and depth < 64:
        reach = min(depth + BITS_PER_ROUND, 64)
        prefix = F.shiftrightunsigned(F.col(column), 64 - reach) if reach < 64 else F.col(column)
        rows = keys
        if depth:
            parents = keys.sparkSession.createDataFrame([(p,) for p, _ in counts], "parent long")
            parent = F.shiftrightunsigned(F.col(column), 64 - depth)
            rows = keys.join(F.broadcast(parents), parent == F.col("parent"), "left_semi")
        below: dict[tuple[int, int], int] = {}
        for row in rows.groupBy(prefix.alias("prefix")).count().toLocalIterator():
            for d in range(depth, reach + 1):
                node = ((row["prefix"] & ((1 << 64) - 1 if reach == 64 else -1)) >> (reach - d), d)
                below[node] = below.get(node, 0) + row["count"]
        pending, counts = list(counts), {}
        while pending:
            prefix_value, d = pending.pop()
            if below.get((prefix_value, d), 0) <= bucket_rows or d == 64:
                leaves.append((prefix_value << (64 - d), d))
            elif d == reach:
                counts[(prefix_value, d)] = None
            else:
                pending += [(prefix_value * 2, d + 1), (prefix_value * 2 + 1, d + 1)]
        if len(leaves) + len(counts) > MAX_BUCKETS:
            raise ValueError(f"over {MAX_BUCKETS} buckets: raise bucket_rows above {bucket_rows}")
        depth = reach
    leaves += [(p << (64 - d), d) for p, d in counts]
    return np.array(sorted(start for start, _ in leaves), dtype=np.uint64)


def _gather(starts: np.ndarray):
    """Merge equal texts of a batch and address them to their bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            merged = (
                pa.Table.from_batches([batch])
                .group_by(["key", "text"])
                .aggregate([("id", "min"), ([], "count_all")])
            )
            key = merged["key"].to_numpy().astype(np.int64)
            bucket = np.searchsorted(starts, key.view(np.uint64), side="right") - 1
            yield from pa.table(
                {
                    "bucket": pa.array(bucket, pa.int64()),
                    "key": merged["key"],
                    "text": merged["text"],
                    "keep_id": merged["id_min"],
                    "rows": merged["count_all"],
                }
            ).to_batches()

    return run


def _own(id_type: pa.DataType):
    """Chains of the texts that share a key; rows come in key order."""
    schema = pa.schema(
        [
            ("bucket", pa.int64()),
            ("key", pa.int64()),
            ("chained", pa.int32()),
            ("sha", pa.string()),
            ("keep_id", id_type),
            ("group_size", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chain, out = None, [], []

        def flush():
            seen = set()
            for place, (text, keep, size) in enumerate(chain):
                sha = hashlib.sha256(text).hexdigest()
                if sha in seen:
                    raise ValueError(f"different texts share the SHA-256 {sha}")
                seen.add(sha)
                out.append((*at, place, sha, keep, size))
            chain.clear()

        def block():
            columns = list(zip(*out)) if out else [[] for _ in schema]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            texts = batch["text"].cast(pa.binary())
            for place, bucket, key, keep, size in zip(
                range(batch.num_rows),
                batch["bucket"].to_pylist(),
                batch["key"].to_pylist(),
                batch["keep_id"].to_pylist(),
                batch["rows"].to_pylist(),
            ):
                if (bucket, key) != at:
                    flush()
                    at = (bucket, key)
                text = texts[place].as_py()
                for link in chain:
                    if link[0] == text:
                        link[1] = keep if link[1] is None else link[1] if keep is None else min(link[1], keep)
                        link[2] += size
                        break
                else:
                    chain.append([text, keep, size])
            if len(out) >= 10_000:
                yield block()
                out.clear()
        flush()
        yield block()

    return run


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 16_384
) -> DataFrame:
    """The documents with ``keep_id, group_size, kept, text_sha256`` added.

    Texts are equal when identical after each run of ASCII white space became
    one space; null counts as empty. Of equal texts the row with the smallest id
    stays. A null id is larger than any other, and ``keep_id`` is null where a
    group has no other. Rows that repeat both id and text are one document: all
    carry the same flag. Other columns stay, but for any named like an added
    one, which is replaced. An empty table gives an empty table.
    """
    reachable(docs.sparkSession)
    norm = F.regexp_replace(text_of(text_col), SPACES, " ")
    keyed = without(docs, ADDED).withColumn(_NORM, norm).withColumn(_KEY, F.xxhash64(_NORM))
    keys = cut(keyed.select(_KEY).distinct(), "dedup-keys")
    starts = build_directory(keys, _KEY, bucket_rows)
    kind = docs.schema[id_col].dataType.simpleString()
    sent = keyed.select(
        F.col(quoted(id_col)).alias("id"), F.col(_KEY).alias("key"), F.col(_NORM).alias("text")
    ).mapInArrow(_gather(starts), f"bucket long, key long, text string, keep_id {kind}, rows long")
    owners = sent.repartition(max(len(starts), 1), "bucket").sortWithinPartitions("bucket", "key")
    from pyspark.sql.pandas.types import to_arrow_type

    index = cut(
        owners.mapInArrow(
            _own(to_arrow_type(docs.schema[id_col].dataType)),
            f"bucket long, key long, chained int, sha string, keep_id {kind}, group_size long",
        ),
        "dedup-index",
    )
    found = index.select(F.col("key").alias(_KEY), F.col("sha").alias(_SHA), "keep_id", "group_size")
    looked_up = keyed.withColumn(_SHA, F.sha2(F.col(_NORM), 256)).join(found, [_KEY, _SHA])
    return looked_up.select(
        *[F.col(quoted(c)) for c in without(docs, ADDED).columns],
        "keep_id",
        "group_size",
        F.col(quoted(id_col)).eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col(_SHA).alias("text_sha256"),
    )


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
