"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``order`` long. A symbol is predicted
in the longest context seen in training. Where it was never seen there, an
escape is paid, ``distinct / (total + distinct)``, and the next shorter context
is asked, without the symbols the longer one has already ruled out. Below the
empty context all symbols left are equally likely. A text ends with a symbol of
its own, so that its score is the probability of the whole text.

Pretrained, the trie is a table: one entry per context and next symbol, keyed by a
number that holds both. Documents are dealt to buckets; a bucket sends the
distinct keys of its texts with their training counts, packed, one row for every lot
that keys are dealt to by the last two bytes of their context. A lot adds up the counts
of all buckets, works out every key's log probability and answers every row with the
prices of its keys, in their order, so that keys travel once. What moves is an entry
per bucket and distinct key, packed, never one per position, and nothing is broadcast but
the two shortest orders, whose size is fixed. Words of the base model go the same way.

Adaptive, every document is coded with a trie of its own that starts empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.llm.common import crc_rest, cut, lowered, mixed, quoted, reachable, slices, span_hashes, text_of, utf8, words

#: Symbols: the bytes, the end of the text, and the start, which is only ever a context.
END, START, SYMBOLS, BITS = 256, 257, 257, 9
#: Bytes of text dealt to one bucket.
BUCKET_BYTES = 32 << 20
#: Bytes of text whose keys are sorted, or looked up, at once.
SORT_BYTES = 2 << 20
#: Keys are dealt to so many lots at least and at most; between them, one for so many bytes of text.
LEAST_LOTS, MOST_LOTS, LOT_BYTES = 64, 1024, 8 << 20


class Trie:
    """An adaptive model: contexts of up to ``order`` symbols with counts, one symbol at a time."""

    def __init__(self, order: int) -> None:
        self.order = order
        self.counts: dict[tuple[int, ...], dict[int, int]] = {}

    def log10(self, context: tuple[int, ...], symbol: int) -> float:
        """Log probability of a symbol after a context of exactly ``order`` symbols."""
        ruled_out: set[int] = set()
        total = 0.0
        for size in range(self.order, -1, -1):
            seen = self.counts.get(context[self.order - size :], {})
            left = {s: c for s, c in seen.items() if s not in ruled_out}
            if not left:
                continue
            mass = sum(left.values()) + len(left)
            if symbol in left:
                return total + math.log10(left[symbol] / mass)
            total += math.log10(len(left) / mass)
            ruled_out.update(left)
        return total - math.log10(SYMBOLS - len(ruled_out))

    def add(self, context: tuple[int, ...], symbol: int) -> None:
        for size in range(self.order + 1):
            seen = self.counts.setdefault(context[self.order - size :], {})
            seen[symbol] = seen.get(symbol, 0) + 1

    def run(self, text: bytes, learn: bool) -> float:
        """Log probability of a text and its end."""
        context, total = (START,) * self.order, 0.0
        for symbol in (*text, END):
            total += self.log10(context, symbol)
            if learn:
                self.add(context, symbol)
            context = (*context, symbol)[1:]
        return total


def gram_keys(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of each position (its context, then its symbol) and the rows' new offsets.

    Every row gains a position for its end.
    """
    rows = len(offsets) - 1
    ends = offsets + np.arange(rows + 1)
    # every row behind as many starts as a context is long, so that all keys are made alike
    places = np.repeat(np.arange(1, rows + 1) * order + np.arange(rows), np.diff(offsets))
    places += np.arange(len(data))
    symbols = np.full(ends[-1] + rows * order, START, dtype=np.int64)
    symbols[places] = data
    lasts = ends[1:] + np.arange(1, rows + 1) * order - 1
    symbols[lasts] = END
    keys = symbols.copy()
    for step in range(1, order + 1):
        keys[step:] |= symbols[:-step] << (BITS * step)
    real = np.ones(len(symbols), dtype=bool)
    for step in range(order):
        real[ends[:-1] + np.arange(rows) * order + step] = False
    return keys[real], ends


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts; quick where the input is made of sorted runs."""
    if not len(keys):
        return keys, counts
    place = np.argsort(keys, kind="stable")
    keys = keys[place]
    fresh = np.ones(len(keys), dtype=bool)
    np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
    return keys[fresh], np.add.reduceat(counts[place], np.flatnonzero(fresh))


class Tally:
    """Distinct keys of 63 bits with training counts, put together while they come."""

    def __init__(self) -> None:
        self.waiting: list[np.ndarray] = []
        self.pieces: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        """Keys of some positions, and whether each of these is learned from."""
        marked = keys.astype(np.uint64) << np.uint64(1)
        marked |= train
        self.waiting.append(marked)
        self.held += len(marked)
        if self.held >= SORT_BYTES:
            self._sort()

    def _sort(self) -> None:
        if not self.held:
            return
        marked = np.sort(np.concatenate(self.waiting))
        self.waiting, self.held = [], 0
        fresh = np.ones(len(marked), dtype=bool)
        np.not_equal(marked[1:], marked[:-1], out=fresh[1:])
        first = np.flatnonzero(fresh)
        marked, counts = marked[first], np.diff(np.append(first, len(marked)))
        self.put((marked >> np.uint64(1)).astype(np.int64), counts * (marked & np.uint64(1)).astype(np.int64))

    def put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Sorted keys with counts. Pieces are merged when the later ones outgrow the first."""
        self.pieces.append((keys, counts))
        if len(self.pieces) > 1 and sum(len(k) for k, _ in self.pieces[1:]) > max(len(self.pieces[0][0]), 1 << 20):
            self._merge()

    def _merge(self) -> None:
        if self.pieces:
            self.pieces = [_merged(*(np.concatenate(part) for part in zip(*self.pieces)))]

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        self._sort()
        self._merge()
        return self.pieces[0] if self.pieces else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _pack(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all first bytes, then all second ones, and so on."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes, "zstd", asbytes=True)


def _unpack(packed: bytes, size: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed, size * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, size).T).view(kind).reshape(size)


def _unpack_keys(packed: bytes, size: int) -> np.ndarray:
    return np.cumsum(_unpack(packed, size, np.int64))


def _lots_of(keys: np.ndarray, is_word: bool, lots: int) -> np.ndarray:
    """The lot of each key: a context's by its last two bytes; those of words follow them."""
    part = keys if is_word else (keys >> BITS) & ((1 << (2 * BITS)) - 1)
    return (mixed(part.astype(np.uint64)) % np.uint64(lots)).astype(np.int64) + lots * is_word


def _dealt(keys: np.ndarray, is_word: bool, lots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of ascending keys by lot, then key; the lots that have any, and where each ends."""
    of_key = _lots_of(keys, is_word, lots)
    place = np.argsort(of_key.astype(np.int16 if 2 * lots < 1 << 15 else np.int64), kind="stable")
    present, sizes = np.unique(of_key, return_counts=True)
    return place, present, np.cumsum(sizes)


def _mark(keys: np.ndarray) -> int:
    """A number that tells apart sets of keys."""
    return int(mixed(keys.astype(np.uint64)).sum(dtype=np.uint64).astype(np.int64))


def _texts(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(column)
    for start, end in slices(offsets, limit):
        yield start, end, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]


def _word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = lowered(data)
    opens, closes, sizes = words(data, offsets)
    return (span_hashes(data, opens, closes) >> np.uint64(1)).astype(np.int64), sizes


def _tally(order: int, lots: int):
    """Distinct keys of contexts and words of each bucket, with training counts: a row per bucket and lot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[Tally, Tally]] = {}
        for batch in batches:
            of_row = batch["bucket"].to_numpy()
            for bucket in np.unique(of_row):
                own = batch.filter(pa.array(of_row == bucket))
                train_rows = ~own["held_out"].to_numpy(zero_copy_only=False)
                tallies = found.setdefault(int(bucket), (Tally(), Tally()))
                for start, end, data, offsets in _texts(own["text"]):
                    grams, ends = gram_keys(data, offsets, order)
                    for tally, (keys, sizes) in zip(tallies, ((grams, np.diff(ends)), _word_keys(data, offsets))):
                        tally.add(keys, np.repeat(train_rows[start:end], sizes))
        for bucket in list(found):
            for is_word, tally in enumerate(found.pop(bucket)):
                keys, counts = tally.table()
                place, present, ends = _dealt(keys, bool(is_word), lots)
                for lot, start, end in zip(present.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                    own, seen = keys[place[start:end]], counts[place[start:end]]
                    row = {
                        "bucket": bucket,
                        "lot": lot,
                        "size": end - start,
                        "mark": _mark(own),
                        "keys": _pack(np.diff(own, prepend=0)),
                        "seen": _pack(seen),
                    }
                    yield pa.RecordBatch.from_pylist([row], schema=_TALLIED)

    return run


_TALLIED = pa.schema(
    [
        ("bucket", pa.int64()),
        ("lot", pa.int64()),
        ("size", pa.int64()),
        ("mark", pa.int64()),
        ("keys", pa.binary()),
        ("seen", pa.binary()),
    ]
)
_PRICED = pa.schema([("bucket", pa.int64()), ("lot", pa.int64()), ("size", pa.int64()), ("mark", pa.int64()), ("prices", pa.binary())])


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of the last two symbols of contexts."""
    sums = np.zeros(1 << (2 * BITS), dtype=np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            keys, counts = _unpack_keys(row["keys"], row["size"]), _unpack(row["seen"], row["size"], np.int64)
            np.add.at(sums, keys & ((1 << (2 * BITS)) - 1), counts)
    present = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(present), pa.array(sums[present])], names=["key", "seen"])


class Levels:
    """Trie levels ``0 .. order`` from the counts of the longest keys, in arrays."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int) -> None:
        self.order = order
        seen = counts > 0
        self.tables: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * (order + 1)
        level_keys, level_counts = _merged(keys[seen], counts[seen])
        self.tables[order] = (level_keys, level_counts)
        for size in range(order - 1, -1, -1):
            level_keys, level_counts = _merged(level_keys & ((1 << (BITS * (size + 1))) - 1), level_counts)
            self.tables[size] = (level_keys, level_counts)

    def replace(self, size: int, keys: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(keys)
        self.tables[size] = (keys[order], counts[order])

    @staticmethod
    def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
        return at, table[at] == wanted

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of the symbol of each key after its context."""
        out = np.zeros(len(keys))
        open_ = np.ones(len(keys), dtype=bool)
        ruled_out = np.zeros(len(keys), dtype=np.int64)  # symbols seen in the longer context
        above: tuple[np.ndarray, np.ndarray] | None = None  # its keys and counts
        for size in range(self.order, -1, -1):
            table, counts = self.tables[size]
            mask = (1 << (BITS * (size + 1))) - 1
            contexts = table >> BITS
            nodes, first = np.unique(contexts, return_index=True)
            bounds = np.append(first, len(table))
            sums = np.concatenate([[0], np.cumsum(counts)])
            total, distinct = sums[bounds[1:]] - sums[bounds[:-1]], np.diff(bounds)
            own = (keys & mask) >> BITS
            node, known = self._find(nodes, own)
            n = np.where(known, total[node], 0) if len(nodes) else np.zeros(len(keys), np.int64)
            d = np.where(known, distinct[node], 0) if len(nodes) else np.zeros(len(keys), np.int64)
            if above is not None:
                # symbols of the longer context leave the sums of the shorter one
                longer, _ = above
                at, found = self._find(table, longer & mask)
                gone = np.concatenate([[0], np.cumsum(np.where(found, counts[at] if len(counts) else 0, 0))])
                wide, wide_first = np.unique(longer >> BITS, return_index=True)
                wide_bounds = np.append(wide_first, len(longer))
                removed = gone[wide_bounds[1:]] - gone[wide_bounds[:-1]]
                wide_node, wide_known = self._find(wide, (keys & ((mask << BITS) | mask)) >> BITS)
                if len(wide):
                    n = n - np.where(wide_known, removed[wide_node], 0)
            d = d - ruled_out
            at, seen = self._find(table, keys & mask)
            hit = open_ & seen
            if hit.any():
                out[hit] += np.log10(counts[at[hit]] / (n[hit] + d[hit]))
            miss = open_ & ~seen & (d > 0)
            out[miss] += np.log10(d[miss] / (n[miss] + d[miss]))
            open_ &= ~seen
            ruled_out = ruled_out + d
            above = (table, counts)
        out[open_] -= np.log10(SYMBOLS - ruled_out[open_])
        return out


def _summed(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    tally = Tally()
    for row in rows:
        tally.put(_unpack_keys(row["keys"], row["size"]), _unpack(row["seen"], row["size"], np.int64))
    return tally.table()


def _answers(rows: list[dict], keys: np.ndarray, prices: np.ndarray) -> pa.Table:
    """The prices of every row's keys, in their order."""
    answers = []
    for row in rows:
        own = prices[np.searchsorted(keys, _unpack_keys(row["keys"], row["size"]))]
        answers.append({**{name: row[name] for name in ("bucket", "lot", "size", "mark")}, "prices": _pack(own)})
    return pa.Table.from_pylist(answers, schema=_PRICED)


def _priced(order: int, short):
    """Log probability of every key of some pairs of last bytes."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys, counts = _summed(rows)
        levels = Levels(keys, counts, order)
        for size, (known, sums) in enumerate(short.value):
            levels.replace(size, known, sums)
        return _answers(rows, keys, levels.log10(keys))

    return run


def _counted(table: pa.Table) -> pa.Table:
    """Training counts of some words, and in one row more, without a bucket, how many tokens and distinct words these are."""
    rows = table.to_pylist()
    keys, counts = _summed(rows)
    total = {"bucket": None, "lot": int(counts.sum()), "size": int((counts > 0).sum()), "mark": 0, "prices": b""}
    return pa.concat_tables([_answers(rows, keys, counts), pa.Table.from_pylist([total], schema=_PRICED)])


class Prices:
    """What came back to a bucket, by key. Its keys are made again from its texts, in the order they were sent in."""

    def __init__(self, tally: Tally, is_word: bool, lots: int, back: dict[int, dict], kind) -> None:
        keys, _ = tally.table()
        place, present, ends = _dealt(keys, is_word, lots)
        self.keys = pa.array(keys)
        self.values = np.zeros(len(keys), dtype=kind)
        for lot, start, end in zip(present.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
            own, row = place[start:end], back.pop(lot, None)
            if row is None or row["size"] != end - start or row["mark"] != _mark(keys[own]):
                raise RuntimeError("documents were read in other partitions than before: write them to a table first")
            self.values[own] = _unpack(row["prices"], row["size"], kind)

    def of(self, keys: np.ndarray) -> np.ndarray:
        return self.values[pc.index_in(pa.array(keys), value_set=self.keys).to_numpy(zero_copy_only=False)]


def _scored(order: int, lots: int, totals: tuple[int, int, int]):
    """Scores of a bucket's texts from the prices that came back to it."""
    train_tokens, distinct, ends = totals

    def run(frame: pa.Table, back: pa.Table) -> pa.Table:
        if not frame.num_rows:
            return _SCORED.empty_table()
        frame = frame.combine_chunks()
        texts = frame["text"].combine_chunks()
        held = frame["held_out"].combine_chunks().to_numpy(zero_copy_only=False)
        grams_of, words_of = Tally(), Tally()
        for _, _, data, offsets in _texts(texts):
            grams, _ = gram_keys(data, offsets, order)
            grams_of.add(grams, np.zeros(len(grams), dtype=bool))
            keys, _ = _word_keys(data, offsets)
            words_of.add(keys, np.zeros(len(keys), dtype=bool))
        rows = {row["lot"]: row for row in back.to_pylist()}
        prices = Prices(grams_of, False, lots, rows, np.float64)
        counts = Prices(words_of, True, lots, rows, np.int64)
        del grams_of, words_of, rows
        scale = math.log10(train_tokens + 0.5 * (distinct + 1))
        parts = []
        for start, end, data, offsets in _texts(texts, SORT_BYTES):
            keys, bounds = gram_keys(data, offsets, order)
            score = np.add.reduceat(prices.of(keys), bounds[:-1])
            hashes, sizes = _word_keys(data, offsets)
            count = counts.of(hashes)
            sums = np.concatenate([[0.0], np.cumsum(np.log10(count + 0.5) - scale)])
            known = np.concatenate([[0], np.cumsum(count > 0)])
            to = np.cumsum(sizes)
            parts.append(
                pa.table(
                    [
                        frame["id"].slice(start, end - start),
                        pa.array(held[start:end]),
                        pa.array(sizes + 1),
                        pa.array(known[to] - known[to - sizes] + int(ends > 0)),
                        pa.array(sums[to] - sums[to - sizes] + math.log10(ends + 0.5) - scale),
                        pa.array(score),
                    ],
                    schema=_SCORED,
                )
            )
        return pa.concat_tables(parts)

    return run


_SCORED = pa.schema(
    [
        ("id", pa.string()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def _adaptive(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [Trie(order).run((text or "").encode(), learn=True) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(scores, pa.float64())], names=["id", "score"])

    return run


def score_adaptive(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 4) -> DataFrame:
    """``id_col, score``: each text coded by a model that has seen only the text so far.

    Null and empty texts pay for their end alone. Every row is scored by itself.
    """
    reachable(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text"))
    return given.mapInArrow(_adaptive(order), f"id {kind}, score double").withColumnRenamed("id", id_col)


def score_pretrained(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_rest: int = 1, order: int = 5
) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The model learns from all texts but those whose crc32 of the id as text leaves
    ``held_out_rest`` modulo 5. ``score`` is the log10 probability of the whole text
    and its end. ``base_score`` is that of its words, A-Z in lower case, and one end,
    under smoothed word counts; ``n_known`` of the ``n_tokens`` were seen in training.

    Null and empty texts are an end alone. A null id is hashed as empty text. Rows
    that repeat an id are texts of their own. With nothing to learn from, all symbols
    are equally likely. Further columns are not read; an empty table gives no rows.
    Words are known by 64-bit hashes.

    ``docs`` is read twice and has to come in the same partitions: a table does, and
    what does not is found out and raises.
    """
    if not 2 <= order <= 6:
        raise ValueError("order: 2 to 6")
    spark = docs.sparkSession
    reachable(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    ids, text = F.col(quoted(id_col)), text_of(text_col)
    sizes = docs.select(
        F.spark_partition_id().alias("part"), F.octet_length(text).alias("bytes"), (crc_rest(id_col) != held_out_rest).alias("train")
    )
    sized = (
        sizes.groupBy("part")
        .agg(F.sum("bytes").alias("bytes"), F.count_if("train").alias("train"))
        .agg(F.max("bytes").alias("most"), F.sum("bytes").alias("bytes"), F.sum("train").alias("train"))
        .first()
    )
    subs = max(math.ceil((sized["most"] or 0) / BUCKET_BYTES), 1)
    lots = min(max(math.ceil((sized["bytes"] or 0) / LOT_BYTES), LEAST_LOTS), MOST_LOTS)
    ends = sized["train"] or 0
    base = docs.select(
        ids.cast("string").alias("id"),
        (crc_rest(id_col) == held_out_rest).alias("held_out"),
        text.alias("text"),
        (F.spark_partition_id().cast("long") * subs + F.pmod(F.xxhash64(ids, text), F.lit(subs))).alias("bucket"),
    )
    tallied = cut(
        base.select("bucket", "held_out", "text").mapInArrow(
            _tally(order, lots), "bucket long, lot long, size long, mark long, keys binary, seen binary"
        ),
        "ppm-tallied",
    )
    grams, terms = tallied.where(F.col("lot") < lots), tallied.where(F.col("lot") >= lots)
    back = "bucket long, lot long, size long, mark long, prices binary"
    counted = cut(terms.groupBy("lot").applyInArrow(_counted, back), "ppm-counted")
    sums = (
        counted.where("bucket IS NULL")
        .agg(F.coalesce(F.sum("lot"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("size"), F.lit(0)).alias("distinct"))
        .first()
    )
    totals = (sums["tokens"] + ends, sums["distinct"] + int(ends > 0), ends)
    rows = grams.mapInArrow(_endings, "key long, seen long").groupBy("key").agg(F.sum("seen").alias("seen")).collect()
    # at most 257 * 258 rows
    pairs = np.array([r["key"] for r in rows], np.int64), np.array([r["seen"] for r in rows], np.int64)
    shared = spark.sparkContext.broadcast([_merged(pairs[0] & ((1 << BITS) - 1), pairs[1]), pairs])
    priced = grams.groupBy("lot").applyInArrow(_priced(order, shared), back)
    answers = priced.unionByName(counted.where("bucket IS NOT NULL"))
    scored = (
        base.groupBy("bucket")
        .cogroup(answers.groupBy("bucket"))
        .applyInArrow(
            _scored(order, lots, totals),
            "id string, held_out boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.select(
        F.col("id").cast(kind).alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(totals[0]).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op3_ppm(spark, sf_dir: str) -> DataFrame:
    return score_pretrained(spark.read.parquet(f"{sf_dir}/documents.parquet"))
