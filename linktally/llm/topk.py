"""Exact top-k by inner product with the threshold algorithm, block by block.

Vectors are dealt to row blocks and queries to query blocks; a task gets one of
each. Inside, every dimension of the row block has a sorted list. A query walks
its lists from the good end, scores the rows it meets in full, and stops once
the best score a row not met could still have is below its k-th score. The
blocks' results meet in a ranking per query that Spark limits before it
shuffles.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linktally.llm.common import cut, quoted, reachable

#: Rows of each list that a query walks before its bound is tested first; doubled from then on.
FIRST_DEPTH = 32


def quantised(column: str, scale: int) -> Column:
    """``floor(scale * x)`` of every component, in doubles."""
    return F.transform(F.col(quoted(column)), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _usable(column: str) -> Column:
    vector = F.col(quoted(column))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & finite


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    rows = np.zeros((len(vectors), width), dtype=np.int64)
    for place, vector in enumerate(vectors):
        rows[place, : len(vector)] = vector
    return rows


class SortedLists:
    """The sorted per-dimension lists of one block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, keys: np.ndarray | None = None) -> None:
        self.ids = ids
        self.rows = rows
        self.keys = ids if keys is None else keys  # tell rows apart that share an id
        self.order = np.argsort(rows, axis=0, kind="stable").T.copy()  # dimension x rank, ascending

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` rows but the one whose key is ``own``, ties to smaller ids."""
        size = len(self.ids)
        used = np.flatnonzero(query)
        seen = self.keys == own
        best_ids, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=self.rows.dtype)
        done, depth = 0, min(FIRST_DEPTH, size)
        if not len(used):
            depth = size
        up = query[used] > 0
        while True:
            if depth >= size:
                new = np.flatnonzero(~seen)
            else:
                from_top = self.order[used[up], size - depth : size - done]
                from_bottom = self.order[used[~up], done:depth]
                met = np.zeros(size, dtype=bool)
                met[from_top] = True
                met[from_bottom] = True
                new = np.flatnonzero(met & ~seen)
            seen[new] = True
            best_ids = np.concatenate([best_ids, self.ids[new]])
            best = np.concatenate([best, self.rows[new] @ query])
            if len(best) > k:
                keep = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[keep], best[keep]
            if depth >= size:
                return best_ids, best
            last = np.where(up, self.order[used, size - depth], self.order[used, depth - 1])
            bound = (self.rows[last, used] * query[used]).sum()
            if len(best) == k and best.min() > bound:
                return best_ids, best
            done, depth = depth, min(2 * depth, size)


def _searched(k: int):
    def run(_key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            width = max(rows["vector"].map(len).max(), queries["vector"].map(len).max())
            block, asked = _matrix(rows["vector"], width), _matrix(queries["vector"], width)
            most = max(width, 1) * float(np.abs(block).max(initial=0)) * float(np.abs(asked).max(initial=0))
            if most < 2**53:  # sums of products are exact in doubles, whose products are faster
                block, asked = block.astype(np.float64), asked.astype(np.float64)
            elif most >= 2**63:
                block, asked = block.astype(object), asked.astype(object)
            lists = SortedLists(rows["vec_id"].to_numpy(), block, rows["row"].to_numpy())
            for own, query_id, query in zip(queries["row"], queries["vec_id"], asked):
                ids, scores = lists.search(query, own, k)
                out.append(
                    pd.DataFrame({"query": own, "query_id": query_id, "vec_id": ids, "score": [int(s) for s in scores]})
                )
        if not out:
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        return pd.concat(out, ignore_index=True)

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    block_rows: int = 8192,
    block_queries: int = 8192,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query.

    Components become ``floor(scale * x)`` and scores are exact integers; ties go
    to the smaller id. A query's own row is no candidate. Rows without an id, with
    a null vector or with a null or non-finite component take no part. Vectors of
    unequal length count as filled up with zeros; an empty one scores 0. Rows that
    repeat an id are rows of their own: each is a candidate, for the others too, and
    each query row has its own ranking. With fewer than ``k``
    candidates all are given; an empty table gives no rows. A score that a long
    cannot hold raises. Extra columns are not read.
    """
    reachable(vectors.sparkSession)
    clean = cut(
        vectors.where(F.col(quoted(id_col)).isNotNull() & _usable(vector_col))
        .select(
            F.col(quoted(id_col)).cast("long").alias("vec_id"), is_query.alias("asked"), quantised(vector_col, scale).alias("vector")
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "topk-vectors",
    )
    counts = clean.agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).first()
    row_blocks = max(math.ceil(counts["n"] / block_rows), 1)
    query_blocks = max(math.ceil(counts["q"] / block_queries), 1)
    spread = F.xxhash64("row")
    rows = clean.select(
        "row",
        "vec_id",
        "vector",
        F.pmod(spread, F.lit(row_blocks)).alias("row_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1))).alias("query_block"),
    )
    queries = clean.where("asked").select(
        "row",
        "vec_id",
        "vector",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1))).alias("row_block"),
        F.pmod(spread, F.lit(query_blocks)).alias("query_block"),
    )
    keys = ("row_block", "query_block")
    found = (
        rows.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInPandas(_searched(k), "query long, query_id long, vec_id long, score long")
    )
    best_first = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP7_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.r <> q.r
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
