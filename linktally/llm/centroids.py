"""Centroid clustering of integer vectors with a vantage-point tree over the centroids.

Each round the driver builds a tree over the centroids, whose number is a
parameter, and broadcasts it. A task takes its vectors through the tree best
bound first: every vector has its own queue of open nodes, always opens the one
with the least lower bound, and is done when no open node can hold a centroid as
near as the best one found. All vectors of a batch take their steps together as
array operations. Bounds are whole numbers rounded towards zero and pruning leaves
equal ones open, so distances are exact and ties go to the smaller number.

New centroids are exact floors of sums: a task sends one sum per centroid, which
meet in a decimal aggregate by centroid and component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktally.llm.common import cut, quoted, reachable

#: Centroids in a leaf, compared one after the other.
LEAF = 2
#: Vectors that take their steps together; bounds the arrays made from them.
TOGETHER = 4096
#: Sums of squares stay exact in 64 bits below this component size and width.
SMALL, WIDE = 1 << 25, 1 << 10


def _floor_root(values: np.ndarray) -> np.ndarray:
    """The integer square root of every value."""
    if values.dtype == object:
        return np.array([math.isqrt(v) for v in values.ravel()], dtype=object).reshape(values.shape)
    root = np.sqrt(values.astype(np.float64)).astype(np.int64)
    root -= root * root > values
    root += (root + 1) * (root + 1) <= values
    return root


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return ((x - y) ** 2).sum(axis=-1)


@dataclass
class _Node:
    """A vantage centroid and two balls around it, or a leaf of a few centroids."""

    members: tuple[int, ...]  # of a leaf; the vantage centroid of an inner node
    inside: int = -1
    outside: int = -1
    # least and greatest distance from the vantage centroid to those of each side,
    # the least rounded down and the greatest rounded up
    near: tuple[int, int] = (0, 0)
    far: tuple[int, int] = (0, 0)


class VantageTree:
    """The tree over some centroids; small, made on the driver, sent to every task."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.nodes: list[_Node] = []
        if len(centroids):
            self._build(list(range(len(centroids))))

    def _build(self, members: list[int]) -> int:
        at = len(self.nodes)
        if len(members) <= LEAF:
            self.nodes.append(_Node(tuple(members)))
            return at
        vantage, rest = members[0], members[1:]
        squares = _squared(self.centroids[rest], self.centroids[vantage])
        order = np.argsort(squares, kind="stable")
        half = (len(rest) + 1) // 2
        sides = [[rest[i] for i in order[:half]], [rest[i] for i in order[half:]]]
        self.nodes.append(_Node((vantage,)))
        found = []
        for side, picked in zip(sides, (order[:half], order[half:])):
            roots = _floor_root(squares[picked])
            exact = roots[-1] * roots[-1] == squares[picked[-1]]
            found.append((self._build(side), (int(roots[0]), int(roots[-1]) + (not exact))))
        (inside, near), (outside, far) = found
        self.nodes[at] = _Node((vantage,), inside, outside, near, far)
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid, and how many distances were taken."""
        count = len(vectors)
        best = np.full(count, -1, dtype=vectors.dtype if vectors.dtype == object else np.int64)
        chosen = np.full(count, -1, dtype=np.int64)
        open_bound = np.full((count, len(self.nodes)), -1, dtype=best.dtype)  # -1: not open
        open_bound[:, 0] = 0
        taken = 0
        active = np.arange(count)
        while len(active):
            bounds = open_bound[active]
            keyed = np.where(bounds < 0, np.iinfo(np.int64).max, bounds)
            node_of = np.argmin(keyed, axis=1)
            least = bounds[np.arange(len(active)), node_of]
            # inclusive: a node whose bound equals the best distance may hold a smaller number
            alive = (least >= 0) & ((best[active] < 0) | (least * least <= best[active]))
            active, node_of, least = active[alive], node_of[alive], least[alive]
            open_bound[active, node_of] = -1
            for number in np.unique(node_of):
                node = self.nodes[number]
                at = node_of == number
                here, bound = active[at], least[at]
                for member in node.members:
                    squares = _squared(vectors[here], self.centroids[member])
                    taken += len(here)
                    better = (best[here] < 0) | (squares < best[here])
                    better |= (squares == best[here]) & (member < chosen[here])
                    best[here[better]], chosen[here[better]] = squares[better], member
                if node.inside < 0:
                    continue
                down = _floor_root(squares)
                up = down + (down * down != squares)
                for child, (low, high) in ((node.inside, node.near), (node.outside, node.far)):
                    apart = np.maximum(np.maximum(down - high, low - up), bound)
                    open_bound[here, child] = apart
        return chosen, best, taken


def _components(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows; Python integers where 64 bits could overflow."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return flat if _fits(flat, width) else flat.astype(object)


def _fits(values: np.ndarray, width: int) -> bool:
    return width <= WIDE and (not values.size or max(int(values.max()), -int(values.min())) < SMALL)


def _placed(column: pa.Array, tree: VantageTree, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for start in range(0, len(column), TOGETHER):
        rows = _components(column.slice(start, TOGETHER), width)
        centroids = tree.centroids
        if rows.dtype == object and centroids.dtype != object:
            wide = VantageTree(centroids.astype(object))
        elif centroids.dtype == object and rows.dtype != object:
            wide, rows = tree, rows.astype(object)
        else:
            wide = tree
        chosen, best, _ = wide.nearest(rows)
        yield start, rows, chosen, best


def _sums(tree, width: int):
    """Per task: rows and componentwise sums of the vectors of each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = len(tree.value.centroids)
        sums = np.zeros((number, width), dtype=object)
        counts = np.zeros(number, dtype=np.int64)
        for batch in batches:
            for _, rows, chosen, _ in _placed(batch["vector"], tree.value, width):
                counts += np.bincount(chosen, minlength=number)
                for centroid in np.unique(chosen):
                    sums[centroid] += rows[chosen == centroid].sum(axis=0).astype(object)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                pa.array(np.repeat(counts[used], width)),
                pa.array([str(v) for v in sums[used].ravel()], pa.string()),
            ],
            names=["cluster", "component", "rows", "total"],
        )

    return run


def _assigned(tree, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, _, chosen, best in _placed(batch["vector"], tree.value, width):
                if len(best) and int(best.max()) >= 1 << 63:
                    raise OverflowError("a squared distance does not fit a long")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"].slice(start, len(chosen)),
                        pa.array(chosen.astype(np.int32)),
                        pa.array(best.astype(np.int64)),
                    ],
                    names=["vec_id", "cluster", "distance"],
                )

    return run


def _array(rows: list[list[int]], width: int) -> np.ndarray:
    if any(abs(v) >= SMALL for row in rows for v in row) or width > WIDE:
        return np.array(rows, dtype=object).reshape(-1, width)
    return np.array(rows, dtype=np.int64).reshape(-1, width)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """``vec_id, vector`` of the rows with ``width`` finite components, as integers ``floor(scale * x)``."""
    given = F.col(quoted(vector_col))
    finite = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(given, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    kept = vectors.where((F.size(given) == width) & finite)
    return kept.select(F.col(quoted(id_col)).cast("long").alias("vec_id"), scaled.alias("vector"))


def _start(whole: DataFrame, number: int, seed: int) -> list[list[int]]:
    """The vectors whose ids hash lowest; ``number`` rows come to the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = whole.where("vec_id IS NOT NULL").orderBy(key, "vector").limit(number)
    return [list(row["vector"]) for row in first.select("vector").collect()]


def _moved(spark: SparkSession, whole: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """One round: every centroid with vectors becomes the floor of their mean."""
    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    parts = whole.select("vector").mapInArrow(_sums(tree, width), "cluster int, component int, rows long, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    means = parts.groupBy("cluster", "component").agg(F.sum("rows").alias("rows"), total.alias("total"))
    new = [[int(v) for v in row] for row in centroids]
    for row in means.collect():  # centroids x components, both parameters
        new[row["cluster"]][row["component"]] = int(row["total"]) // row["rows"]
    tree.unpersist()
    return _array(new, width)


def cluster_vectors(
    vectors: DataFrame,
    number: int = 8,
    rounds: int = 10,
    width: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Components become ``floor(scale * x)``. The centroids start as the ``number``
    vectors with the least sha256 of ``seed:vec_id`` (equal ids by vector), and move
    for ``rounds`` rounds to the floor of their vectors' mean; one without vectors
    stays. Distances are squared and exact, ties go to the smaller centroid.

    Vectors of another length, null ones and those with a null or non-finite component
    take no part. Every other row is given, rows that repeat an id each for itself;
    rows without an id are placed but are no start. With fewer vectors than
    ``number`` there are as many centroids as vectors with an id; without any the result is empty. A distance or
    sum that a long cannot hold raises. Further columns are not read.

    ``number`` and ``width`` bound what is broadcast and collected each round.
    """
    spark = vectors.sparkSession
    reachable(spark)
    whole = cut(whole_vectors(vectors, id_col, vector_col, width, scale), "centroid-vectors")
    centroids = _array(_start(whole, number, seed), width)
    if not len(centroids):
        whole = whole.where("false")
    else:
        for _ in range(rounds):
            centroids = _moved(spark, whole, centroids, width)
    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    placed = cut(whole.mapInArrow(_assigned(tree, width), "vec_id long, cluster int, distance long"), "centroid-placed")
    digests = [hashlib.sha256(",".join(str(int(v)) for v in row).encode()).hexdigest() for row in centroids]
    sums = [0] * max(len(centroids), 1)
    for row in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect():  # a row per centroid
        sums[row["cluster"]] = row["inertia"]

    def of_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster(sums, "long").alias("cluster_inertia"),
        F.lit(sum(sums)).cast("long").alias("inertia"),
        of_cluster(digests or [""], "string").alias("centroid_sha256"),
    )


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _op12_sql(number: int = 8, rounds: int = 10, width: int = 64) -> str:
    """Assignment and means spelled out round by round."""
    distance = f"list_sum([(e[i] - c[i]) * (e[i] - c[i]) FOR i IN range(1, {width + 1})])"
    floor = "(CAST(s AS BIGINT) - ((CAST(s AS BIGINT) % n) + n) % n) // n"
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE len(embedding) = {width} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e AS c
  FROM (SELECT sha256('3:' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT {number}))"""
    ]
    for step in range(rounds + 1):
        steps.append(
            f"""a{step} AS MATERIALIZED (
  SELECT r, min((d, k)) AS best FROM (SELECT r, k, CAST({distance} AS BIGINT) AS d FROM v, c{step}) GROUP BY r)"""
        )
        if step < rounds:
            steps.append(
                f"""m{step} AS (
  SELECT k, list({floor} ORDER BY i) AS c FROM (
    SELECT best[2] AS k, i, sum(e[i]) AS s, count(*) AS n FROM a{step} JOIN v USING (r), range(1, {width + 1}) t(i) GROUP BY ALL)
  GROUP BY k), c{step + 1} AS MATERIALIZED (
  SELECT c{step}.k, coalesce(m{step}.c, c{step}.c) AS c FROM c{step} LEFT JOIN m{step} ON m{step}.k = c{step}.k)"""
            )
    return f"""WITH {', '.join(steps)},
o AS (SELECT vec_id, best[2] AS k, best[1] AS d FROM a{rounds} JOIN v USING (r))
SELECT vec_id, CAST(o.k AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY o.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM o JOIN c{rounds} f ON f.k = o.k"""


OP12_SQL = _op12_sql()
