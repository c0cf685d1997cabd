"""Ranked lexical search with MaxScore and pair bounds.

One pass over the texts keeps the frequencies of the query terms; every task then
indexes its documents block by block: a posting list per term with the term's greatest impact,
and for each pair of terms that the queries need the list of documents that hold both,
with the greatest sum of their impacts. A pair's bound is the greatest of that joint
maximum and of what either term reaches without the other, never more than the two
maxima together. A query's terms are ordered by their maxima, and a few of the least
are bounded together by the best combination of pairs of neighbours. Terms that even together stay below the
query's k-th score are not searched for documents, only looked up for those that the
other terms found, and a document is given up as soon as its score and the bound of
the terms left stay below the k-th score. Scores are whole numbers; equal bounds are kept, so
ties come out exactly.

The k-th score carries on from block to block inside a task; the tasks' lists meet in a
ranking that Spark limits before it shuffles. Queries are taken in blocks of bounded
size, each against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linktally.llm.common import cut, lowered, quoted, reachable, runs, slices, span_hashes, text_of, utf8

#: Documents and postings of one block of the index; bounds what a task holds.
BLOCK_ROWS, BLOCK_POSTINGS = 1 << 14, 1 << 21
#: Distinct terms of the queries that are taken together, about; bounds what is broadcast.
QUERY_TERMS = 1 << 19

# The bytes of terms, ASCII letters and digits and every byte of longer UTF-8 sequences.
_IS_TERM = np.zeros(256, dtype=bool)
_IS_TERM[48:58] = _IS_TERM[65:91] = _IS_TERM[97:123] = _IS_TERM[128:] = True

_LAST = np.iinfo(np.int64).max
#: Sums below this are exact in doubles.
_EXACT = 1 << 53


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of every term, A-Z in lower case, and how many each row has."""
    starts, ends, counts = runs(_IS_TERM[data], offsets)
    return np.repeat(np.arange(len(counts)), counts), span_hashes(lowered(data), starts, ends), counts


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch["text"])
        for start, end in slices(offsets):
            part = slice(offsets[start], offsets[end])
            rows, hashes, _ = term_counts(data[part], offsets[start : end + 1] - offsets[start])
            terms, times = [], []
            for row in range(end - start):
                found, count = np.unique(hashes[rows == row], return_counts=True)
                terms.append(found.view(np.int64))
                times.append(count.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["item"].slice(start, end - start), pa.array(terms, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                names=["item", "terms", "times"],
            )


def _postings(vocabulary):
    """Per document: terms in all, and number and frequency of each query term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            data, offsets = utf8(batch["text"])
            for start, end in slices(offsets):
                part = slice(offsets[start], offsets[end])
                rows, hashes, counts = term_counts(data[part], offsets[start : end + 1] - offsets[start])
                at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                hit = known[at] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
                codes, times = np.unique((rows[hit] << 32) | at[hit], return_counts=True)
                ends = np.zeros(end - start + 1, dtype=np.int32)
                np.cumsum(np.bincount(codes >> 32, minlength=end - start), out=ends[1:])
                terms = pa.array((codes & 0xFFFFFFFF).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(start, end - start),
                        pa.array(counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), terms),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int64))),
                    ],
                    names=["id", "n", "terms", "times"],
                )

    return run


def _frequencies(size: int):
    """Documents of a task that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch["terms"].flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"])

    return run


#: Weighted terms: the number of a term and how often the query says it.
Query = list[tuple[int, int]]


class PairIndex:
    """Posting lists of one block, and the intersection lists of pairs of weighted terms.

    Impacts are those of one mention.
    """

    def __init__(self, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_rows: int, n_terms: int) -> None:
        order = np.argsort(terms, kind="stable")
        self.rows, self.impacts, self.n_rows = rows[order], impacts[order], n_rows
        self.starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.pairs: dict[tuple, tuple[int, np.ndarray]] = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[term], self.starts[term + 1])
        return self.rows[part], self.impacts[part]

    def most(self, term: int, times: int) -> int:
        impacts = self.postings(term)[1]
        return times * int(impacts.max()) if len(impacts) else 0

    def add_pair(self, pair: tuple) -> None:
        """Store a pair's intersection list and its bound: joint maximum, or either term without the other."""
        if pair in self.pairs:
            return
        (left, left_times), (right, right_times) = pair
        x, x_impacts = self.postings(left)
        y, y_impacts = self.postings(right)
        both, at_x, at_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        bound = 0
        if len(both):
            bound = int((left_times * x_impacts[at_x] + right_times * y_impacts[at_y]).max())
        for impacts, at, times in ((x_impacts, at_x, left_times), (y_impacts, at_y, right_times)):
            alone = np.ones(len(impacts), dtype=bool)
            alone[at] = False
            if alone.any():
                bound = max(bound, times * int(impacts[alone].max()))
        self.pairs[pair] = bound, both

    def ordered(self, query: Query) -> Query:
        """A query's weighted terms by ascending maximum, those without a posting left out; neighbours are the pairs to add."""
        known = [(self.most(*weighted), weighted) for weighted in query]
        return [weighted for most, weighted in sorted(known) if most]

    def bounds(self, query: Query) -> np.ndarray:
        """For each ``j`` the bound of the first ``j`` terms of an ordered query: the least over all ways to pair neighbours."""
        upto = [0]
        for place, weighted in enumerate(query):
            bound = upto[place] + self.most(*weighted)
            pair = tuple(query[place - 1 : place + 1]) if place else None
            if pair in self.pairs:
                bound = min(bound, upto[place - 1] + self.pairs[pair][0])
            upto.append(bound)
        return np.array(upto)

    def search(self, query: Query, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows that reach ``least`` (1 at least) with their scores, and how many postings were added up.

        ``query`` is ordered; the bounds of those of its pairs that were added are used.
        """
        upto = self.bounds(query)
        least = max(least, 1)
        optional = int(np.searchsorted(upto[1:], least, side="left"))  # these together stay below
        sums = sum(self.most(*weighted) for weighted in query)
        total = np.zeros(self.n_rows, dtype=np.float64 if sums < _EXACT else np.int64)
        touched = 0
        for term, times in query[optional:]:
            rows, impacts = self.postings(term)
            total[rows] += times * impacts  # a row is in a list once
            touched += len(rows)
        rows = np.flatnonzero(total)
        scores = total[rows].astype(np.int64)
        for place in range(optional - 1, -1, -1):
            alive = scores + upto[place + 1] >= least
            rows, scores = rows[alive], scores[alive]
            if not len(rows):
                break
            term, times = query[place]
            listed, impacts = self.postings(term)
            at = np.minimum(np.searchsorted(listed, rows), len(listed) - 1)
            hit = listed[at] == rows
            scores[hit] += times * impacts[at[hit]]
            touched += int(hit.sum())
        alive = scores >= least
        return rows[alive], scores[alive], touched


def impacts_of(n: np.ndarray, of_row: np.ndarray, terms: np.ndarray, times: np.ndarray, weights: np.ndarray, documents: int, length: int) -> np.ndarray:
    """``w * ((10^9 tf) div (1000 tf + 12 m))`` of every posting."""
    if len(n) and 25 * int(n.max()) * documents >= 1 << 63:
        m = np.array([75 + 25 * int(size) * documents // length for size in n], dtype=np.int64)
    else:
        m = 75 + (25 * n * documents) // length
    return weights[terms] * ((1_000_000_000 * times) // (1000 * times + 12 * m[of_row]))


class _Best:
    """The best ``k`` so far of one query in one task."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.ids = self.scores = np.zeros(0, dtype=np.int64)

    @property
    def least(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        keep = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[keep], scores[keep]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows, postings = [], 0, 0
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            held.append(batch)
            rows += batch.num_rows
            postings += len(batch["terms"].flatten())
            if rows >= BLOCK_ROWS or postings >= BLOCK_POSTINGS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _searched(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, documents, length = shared.value
        best = {item: _Best(k) for item, _ in queries}
        for table in _gathered(batches):
            lists = table["terms"].combine_chunks()
            per_row = np.diff(lists.offsets.to_numpy())
            of_row = np.repeat(np.arange(len(per_row)), per_row)
            terms = lists.flatten().to_numpy()
            times = table["times"].combine_chunks().flatten().to_numpy()
            ids = table["id"].fill_null(_LAST).to_numpy()
            n = table["n"].to_numpy()
            impacts = impacts_of(n, of_row, terms, times, weights, documents, length)
            index = PairIndex(of_row, terms, impacts, len(ids), len(weights))
            here = [(item, index.ordered(query)) for item, query in queries]
            for _, query in here:
                for pair in zip(query, query[1:]):
                    index.add_pair(pair)
            for item, query in here:
                rows, scores, _ = index.search(query, best[item].least)
                if len(rows):
                    best[item].add(ids[rows], scores)
        for item, found in best.items():
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found.ids), item)),
                        pa.array(found.ids, mask=found.ids == _LAST),
                        pa.array(found.scores),
                    ],
                    names=["item", "doc_id", "score"],
                )

    return run


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    query_terms: int = QUERY_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower
    case. A term weighs ``floor(1000 ln((2N+2)/(2df+1)))``; a document of ``n`` terms has
    ``m = 75 + 25nN div L`` and scores ``w * (10^9 tf div (1000 tf + 12 m))`` summed over the
    item's terms, repeats included. ``N`` counts the documents with a term, ``L`` all
    terms. Equal scores come by ascending id; ids are whole numbers.

    Every row of either table stands for itself: documents that repeat an id count
    and rank apart, items that repeat an id are each searched by their own text.
    Documents without an id count too and rank behind others of their score.
    Null, empty and termless texts have no terms: such documents count for
    nothing, such items have no rows. Fewer than ``k`` documents: all are given;
    an empty table on either side gives no rows. Further columns are not read. Terms are
    known by 64-bit hashes; equal hashes count as equal.

    Items are searched together in blocks of about ``query_terms`` distinct terms,
    which bounds what the driver holds and broadcasts; only a longer item exceeds it, alone.
    """
    spark = docs.sparkSession
    reachable(spark)
    asked = cut(
        items.select(F.col(quoted(item_col)).alias("item_id"), text_of(item_text_col).alias("text")).select(
            F.monotonically_increasing_id().alias("item"), "item_id", "text"
        ),
        "lexical-items",
    )
    listed = cut(asked.mapInArrow(_item_terms, "item long, terms array<long>, times array<long>"), "lexical-queries")
    total = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = math.ceil(total / query_terms)
    kind = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), text_of(text_col).alias("text"))
    parts = []
    for block in range(blocks):
        own = listed.where((F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) & (F.size("terms") > 0))
        queries = [(row["item"], np.array(row["terms"], np.int64).view(np.uint64), np.array(row["times"])) for row in own.collect()]
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *[terms for _, terms, _ in queries]]))
        known = spark.sparkContext.broadcast(vocabulary)
        postings = cut(
            kind.mapInArrow(_postings(known), "id long, n long, terms array<int>, times array<long>").where("n > 0"),
            "lexical-postings",
        )
        size = postings.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
        if not size["documents"]:
            continue
        weights = np.zeros(len(vocabulary), dtype=np.int64)  # a term of no document adds nothing
        counts = postings.select("terms").mapInArrow(_frequencies(len(vocabulary)), "term int, df long")
        for row in counts.groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row per query term
            weights[row["term"]] = math.floor(1000 * math.log((2 * size["documents"] + 2) / (2 * row["df"] + 1)))
        weighted = [
            (item, list(zip(np.searchsorted(vocabulary, terms).tolist(), times.tolist()))) for item, terms, times in queries
        ]
        shared = spark.sparkContext.broadcast((weighted, weights, size["documents"], size["length"]))
        parts.append(postings.mapInArrow(_searched(shared, k), "item long, doc_id long, score long"))
    if not parts:
        return asked.where("false").select(
            "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")
        )
    found = reduce(DataFrame.unionByName, parts)
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_pairmax(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ranked_search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
i AS (
  SELECT r, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS r, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), f AS MATERIALIZED (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM f, s GROUP BY term
), p AS (
  SELECT i.r AS q, item_id, f.r, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM i JOIN f USING (term) JOIN w USING (term), s GROUP BY ALL
), k AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM p WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""
