"""Quality by weak labels: heuristic labellers, their accuracies by EM, a hashed linear scorer.

Ten labellers look at whole texts and vote good, bad or nothing. Votes are
counted by pattern, of which there are at most 3 ** 10 however many documents, and
expectation-maximisation on the counts estimates how often each labeller is right
when it votes, and so how likely each pattern's texts are good. These posteriors
are the targets of a linear scorer over hashed word shapes, which scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linktally.llm.common import cut, lowered, mixed, quoted, reachable, runs, slices, span_hashes, text_of, utf8, without, words
from linktally.llm.hashed import BUCKETS, Adam, Rows, bounded_rows, bucketed, sampled_features, scored, sigmoid

LABELLERS = ("symbols", "shouting", "exclamation", "tables", "repetition", "sentences", "word_length", "lines", "endings", "variety")
GOOD, BAD, NONE = 1, 0, 2
#: Bound of the sample that the scorer is fitted on.
SAMPLE = 6_000

ADDED = ("votes", "weak_label", "score", "kept")

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#$%&*@^~\\{}[]<>=+_")] = True


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


class Facts:
    """What the labellers ask about each text of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.sizes = np.diff(offsets)
        rows = len(self.sizes)
        self.starts, self.ends, self.words = words(data, offsets)
        self.row = np.repeat(np.arange(rows), self.words)
        self.letters = self._bytes(_LETTER[data], offsets)
        self.upper = self._bytes(_UPPER[data], offsets)
        self.symbols = self._bytes(_SYMBOL[data], offsets)
        self.marks = self._bytes(data == ord("!"), offsets)
        self.bars = self._bytes(data == ord("|"), offsets)
        self.length = np.bincount(self.row, weights=self.ends - self.starts, minlength=rows)
        closing = np.isin(data[self.ends - 1], np.frombuffer(b".!?", np.uint8)) if len(self.ends) else self.row > 0
        self.closings = np.bincount(self.row[closing], minlength=rows)
        ending = _SYMBOL[data[self.ends - 1]] if len(self.ends) else self.row > 0
        self.endings = np.bincount(self.row[ending], minlength=rows)
        self.top, self.variety = self._most(self.row, span_hashes(lowered(data), self.starts, self.ends), rows)
        opens, closes, self.lines = runs(data != 10, offsets)
        self.line_top, _ = self._most(np.repeat(np.arange(rows), self.lines), span_hashes(data, opens, closes), rows)

    @staticmethod
    def _bytes(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        counted = np.zeros(len(marked) + 1, dtype=np.int64)
        np.cumsum(marked, out=counted[1:])
        return counted[offsets[1:]] - counted[offsets[:-1]]

    @staticmethod
    def _most(row: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """How often the commonest value of each row occurs, and how many values it has."""
        codes = np.sort((row.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(codes)))
        most = np.zeros(rows, dtype=np.int64)
        of_row = (codes[first] >> np.uint64(44)).astype(np.int64)
        np.maximum.at(most, of_row, times)
        return most, np.bincount(of_row, minlength=rows)


def _vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE))


def cast_votes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Votes of every labeller, one column each."""
    f = Facts(data, offsets)
    some, many = f.words >= 5, f.words >= 20
    symbols, upper = _share(f.symbols, f.sizes), _share(f.upper, f.letters)
    marks, bars, closings = _share(f.marks, f.words), _share(f.bars, f.words), _share(f.closings, f.words)
    length, top, line = _share(f.length, f.words), _share(f.top, f.words), _share(f.line_top, f.lines)
    endings = _share(f.endings, f.words)
    return np.stack(
        [
            _vote(some & (symbols < 0.01), some & (symbols > 0.03)),
            _vote(some & (upper < 0.15), some & (upper > 0.3)),
            _vote(many & (marks < 0.05), some & (marks > 0.3)),
            _vote(many & (bars < 0.02), some & (bars > 0.2)),
            _vote(many & (top < 0.15), many & (top > 0.25)),
            _vote(some & (closings > 0.02) & (closings < 0.35), (f.words >= 60) & (closings == 0)),
            _vote(some & (length >= 3) & (length <= 9), some & ((length > 14) | (length < 2))),
            _vote((f.lines >= 3) & (line < 0.5), (f.lines >= 4) & (line > 0.5)),
            _vote(some & (endings < 0.05), some & (endings > 0.2)),
            _vote(many & (f.variety > f.words**0.6), many & (f.variety < f.words**0.5)),
        ],
        axis=1,
    )


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of good texts, accuracies by class (bad, good) of each labeller, posterior of each pattern.

    Labellers err independently given the truth, and abstain without regard to it.
    A labeller has one accuracy for good texts and one for bad, since each looks for
    one fault and passes texts with others. The start, that most texts are good and
    that votes for good are hardly ever wrong about a good text, tells which of the
    two classes is which; no labeller may be worse than chance.
    """
    voted, good = patterns != NONE, patterns == GOOD
    share, accuracy = 0.8, np.stack([np.full(patterns.shape[1], 0.3), np.full(patterns.shape[1], 0.95)])
    posterior = np.full(len(patterns), share)
    weight = counts / max(counts.sum(), 1)
    for _ in range(rounds):
        on_bad, on_good = accuracy
        if_good = np.log(share) + (voted * np.log(np.where(good, on_good, 1 - on_good))).sum(axis=1)
        if_bad = np.log(1 - share) + (voted * np.log(np.where(good, 1 - on_bad, on_bad))).sum(axis=1)
        posterior = sigmoid(if_good - if_bad)
        before = accuracy
        share = float(np.clip((weight * posterior).sum(), 0.01, 0.99))
        is_good, is_bad = voted * (weight * posterior)[:, None], voted * (weight * (1 - posterior))[:, None]
        on_good = ((is_good * good).sum(axis=0) + 9.5e-4) / (is_good.sum(axis=0) + 1e-3)
        on_bad = ((is_bad * ~good).sum(axis=0) + 3e-4) / (is_bad.sum(axis=0) + 1e-3)
        on_good = np.clip(on_good, 0.5, 0.9999)
        accuracy = np.stack([np.clip(on_bad, 1.0001 - on_good, 0.9999), on_good])
        if np.abs(accuracy - before).max() < 1e-9:
            break
    return share, accuracy, posterior


def shape_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How dense word shapes are in each text, and a few sizes of it.

    A shape keeps one letter of each run of small or capital letters or digits, and
    all other bytes.
    """
    f = Facts(data, offsets)
    rows = len(f.sizes)
    kinds = data.copy()
    kinds[_LETTER[data]] = ord("a")
    kinds[_UPPER[data]] = ord("A")
    kinds[(data >= 48) & (data <= 57)] = ord("0")
    kept = np.ones(len(kinds), dtype=bool)
    kept[1:] = (kinds[1:] != kinds[:-1]) | ~np.isin(kinds[1:], np.frombuffer(b"aA0", np.uint8))
    kept[f.starts] = True
    at = np.concatenate([[0], np.cumsum(kept)])
    shapes = span_hashes(kinds[kept], at[f.starts], at[f.ends])
    codes, times = np.unique((f.row.astype(np.int64) << 18) | bucketed(mixed(shapes)), return_counts=True)
    row = codes >> 18
    values = np.minimum(20.0 * times / (f.words[row] + 10), 10.0)
    extra = [
        np.minimum(10 * _share(f.top, f.words), 9).astype(np.int64),
        np.minimum(_share(f.length, f.words), 20).astype(np.int64),
        np.log2(f.words + 1).astype(np.int64),
        np.minimum(10 * _share(f.line_top, f.lines), 9).astype(np.int64) * (f.lines >= 4),
    ]
    sizes = np.concatenate([mixed((e + 1000 * (k + 1)).astype(np.uint64)) for k, e in enumerate(extra)])
    row = np.concatenate([row, np.tile(np.arange(rows), len(extra))])
    bucket = np.concatenate([codes & (BUCKETS - 1), bucketed(sizes)])
    values = np.concatenate([values, np.ones(len(sizes))])
    place = np.argsort(row, kind="stable")
    return row[place], bucket[place], values[place]


def fit_soft(targets: np.ndarray, rows: Rows, epochs: int = 20, batches: int = 20, rate: float = 0.03, seed: int = 3):
    """Weights and bias of a logistic scorer for targets between 0 and 1."""
    weights, bias = np.zeros(BUCKETS), np.zeros(1)
    of_weights, of_bias = Adam(BUCKETS, rate, 0.001), Adam(1, rate, 0.0)
    random = np.random.default_rng(seed)
    for _ in range(epochs if len(targets) else 0):
        for part in np.array_split(random.permutation(len(targets)), max(1, min(batches, len(targets)))):
            own = rows.take(part)
            slope = (sigmoid(own.dot(weights) + bias) - targets[part]) / len(part)
            of_weights.step(weights, own.gradient(slope))
            of_bias.step(bias, np.array([slope.sum()]))
    return weights, float(bias[0])


def with_votes(docs: DataFrame, text_col: str) -> DataFrame:
    """The documents with ``votes``, a letter per labeller: ``g``, ``b`` or ``-``."""
    reachable(docs.sparkSession)
    letters = np.array(["b", "g", "-"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            out: list[str] = []
            for start, end in slices(offsets):
                part = data[offsets[start] : offsets[end]]
                votes = cast_votes(part, offsets[start : end + 1] - offsets[start])
                out += ["".join(v) for v in letters[votes]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.string())], names=[*batch.schema.names[:-1], "votes"]
            )

    given = docs.select(*[F.col(quoted(c)) for c in docs.columns], text_of(text_col).alias("__quality_text"))
    return given.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("votes", T.StringType())]))


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The documents with ``votes, weak_label, score, kept`` added.

    ``weak_label`` is the posterior of the text's votes, ``score`` (0 to 1, higher:
    better) the linear scorer's, ``kept`` whether that is 0.5 or more. Votes are
    counted over all documents; the scorer is fitted on at most ``sample`` rows,
    those with the least hashed ids and, of rows that share one, the least hashed
    texts, and applied to every whole text.

    A text too short for any labeller gets no votes: its weak label is the share of
    good texts. Null text is empty. Rows are scored one by one, so repeats and null
    ids need nothing. Columns named like an added one are replaced; an empty table
    gives an empty table.
    """
    kept = without(docs, ADDED)
    ids = F.col(quoted(id_col))
    voted = cut(with_votes(docs.select(ids.alias("id"), F.col(quoted(text_col)).alias("text")), "text").select("id", "votes"), "quality-votes")
    counted = voted.groupBy("votes").count().collect()  # at most 3 ** 10 patterns
    patterns = np.array([["bg-".index(v) for v in r["votes"]] for r in counted], dtype=np.int64).reshape(-1, len(LABELLERS))
    _, _, posterior = estimate(patterns, np.array([r["count"] for r in counted], dtype=np.float64))
    table = docs.sparkSession.createDataFrame(
        [(r["votes"], float(p)) for r, p in zip(counted, posterior)], "votes string, weak_label double"
    )
    chosen = (
        voted.join(F.broadcast(table), "votes")
        .select("id", F.xxhash64("id").alias("place"), F.col("weak_label").alias("target"))
        .orderBy("place")
        .limit(sample)
    )
    fitted = docs.join(F.broadcast(chosen.dropDuplicates(["id"])), ids.eqNullSafe(F.col("id"))).select(
        "place", "target", F.col(quoted(text_col)).alias("text")
    )
    targets, rows = sampled_features(bounded_rows(fitted, sample), "text", shape_features)
    weights, bias = fit_soft(targets, rows)
    both = with_votes(kept.withColumn("__quality_own", text_of(text_col)), "__quality_own")
    out = scored(both, "__quality_own", shape_features, weights, bias, "score").drop("__quality_own")
    return out.join(F.broadcast(table), "votes").select(
        *[F.col(quoted(c)) for c in kept.columns], "votes", "weak_label", "score", (F.col("score") >= 0.5).alias("kept")
    )


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_quality(docs).select("doc_id", "votes", "weak_label", "score", "kept")
