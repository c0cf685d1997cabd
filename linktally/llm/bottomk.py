"""Near-duplicate groups from bottom-k sketches of word shingles.

One hash function orders all shingles; a set's sketch are its ``k`` least. The ``k``
least of the union of two sets are a sample of the union: the share of them that lies in both
sets estimates the Jaccard similarity, and where both sets have ``k`` shingles or
fewer it is the similarity. A linked pair has at least ``t`` retained values in
common, ``t`` from the binomial tail at a loss far below one pair in any corpus.

Inverted lists of retained values generate candidates. A value in one set alone is no
list at all. Ordering a sketch's values by the length of their lists, two sketches
with ``t`` in common share one of the first ``size - t + 1`` of each, so only these are looked up;
most sets have too few shared values and drop out before any pair is made. Then, in two
rounds: every set with the one set that heads most of its lists, the most central one, which joins the
copies of a group into one component; and, over the lists that still hold several
components, all pairs of different components, which pass a parity sketch of the
whole sets (it never rejects a link), the union estimate, and the exact
comparison of full sets. So a large group of near copies is never paired out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.llm.common import cut, lowered, mixed, quoted, reachable, slices, span_hashes, text_of, utf8, words
from linktally.llm.components import connected

#: Values that a sketch retains.
RETAINED = 64
#: Chance at most that a linked pair's sketches look too different.
LOSS = 1e-12
#: Members of a list that one task compares with each other.
LIST_BLOCK = 8192
#: Partners of a set that one task compares with it.
STAR = 4096
#: 64-bit words of parity sketches compared at once; bounds the arrays made from them.
AT_ONCE = 1 << 20
#: Texts of one slice.
SLICE_ROWS = 1 << 12

_PAD = np.iinfo(np.int64).max


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles, by row and ascending hash."""
    data = lowered(data)
    starts, ends, counts = words(data, offsets)
    hashes = np.concatenate([span_hashes(data, starts, ends), np.zeros(size, dtype=np.uint64)])
    rows = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(rows))
    last = np.cumsum(counts)[rows] if len(rows) else rows
    begins = place + size <= last
    begins |= (place == last - counts[rows]) & (counts[rows] < size)
    place, rows, last = place[begins], rows[begins], last[begins]
    total = np.minimum(last - place, size).astype(np.uint64)  # a short sequence differs from a longer one's start
    for step in range(size):
        factor = np.uint64((0x9E3779B97F4A7C15 * (2 * step + 3)) & (2**64 - 1))
        total += np.where(place + step < last, mixed(hashes[place + step] + np.uint64(step + 1)) * factor, np.uint64(0))
    values = np.minimum(mixed(total).view(np.int64), _PAD - 1)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[fresh], values[fresh]


def _digests(values: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mixed(values.view(np.uint64) ^ np.uint64(salt)), out=sums[1:], dtype=np.uint64)
    return (sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)


def parity(values: np.ndarray) -> bytes:
    """Parity of the values on each of 512 bits or more, the next power of two to their number.

    Two sets' parities differ in no more bits than values lie in only one set.
    """
    bits = 1 << max(int(len(values) - 1).bit_length(), 9)
    places = (mixed(values.view(np.uint64) + np.uint64(0xFEDCBA)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def shared_at_least(retained: int, percent: int, loss: float = LOSS) -> int:
    """What two linked sets' sketches share, but for a chance of ``loss``.

    The union's ``retained`` least are drawn without repeats from the union, of which
    ``percent`` or more is common: the binomial tail bounds the chance of fewer.
    """
    if percent >= 100:
        return retained
    p, below = percent / 100, 0.0
    for number in range(retained + 1):
        ways = math.lgamma(retained + 1) - math.lgamma(number + 1) - math.lgamma(retained - number + 1)
        below += math.exp(ways + number * math.log(p) + (retained - number) * math.log(1 - p))
        if below > loss:
            return number
    return retained


def required(n: np.ndarray, retained: int, percent: int) -> np.ndarray:
    """Retained values that a set of ``n`` shingles shares with any set it is linked to."""
    least = shared_at_least(retained, percent)
    whole = -(-percent * n // 100)  # of sets whose partners are retained whole
    return np.where(100 * n <= percent * retained, whole, least)


def _sign(size: int, retained: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch["text"])
            for start, end in slices(offsets, most=SLICE_ROWS):
                part = data[offsets[start] : offsets[end]]
                rows, values = shingle_hashes(part, offsets[start : end + 1] - offsets[start], size)
                counts = np.bincount(rows, minlength=end - start)
                ends = np.concatenate([[0], np.cumsum(counts)])
                place = np.arange(len(rows)) - ends[rows]
                kept = np.concatenate([[0], np.cumsum(np.minimum(counts, retained))]).astype(np.int32)
                large = counts > retained
                rest = np.concatenate([[0], np.cumsum(np.where(large, counts, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(start, end - start),
                        pa.array(_digests(values, ends, 0x1234567)),
                        pa.array(_digests(values, ends, 0x5DEECE66D5DEECE6)),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(kept), pa.array(values[place < retained])),
                        pa.array([parity(values[ends[r] : ends[r + 1]]) for r in range(end - start)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(rest), pa.array(values[large[rows]])),
                    ],
                    names=["id", "a", "b", "n", "sketch", "parity", "whole"],
                )

    return run


def _lookups(retained: int, percent: int):
    """Of sets with shared values enough: all of these, shortest list first, how many to look up, and the lists' lengths in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["shared"]
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            length, value = flat.field("length").to_numpy(), flat.field("value").to_numpy()
            node, n, shared = batch["node"].to_numpy(), batch["n"].to_numpy(), np.diff(ends)
            need = required(n, retained, percent)
            row = np.repeat(np.arange(len(node)), shared)
            enough = shared >= need
            order = np.lexsort((value, length, row))
            out = np.concatenate([[0], np.cumsum(shared[enough])]).astype(np.int32)
            weight = np.bincount(row, weights=length, minlength=len(node)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[enough]),
                    pa.array(n[enough]),
                    pa.ListArray.from_arrays(pa.array(out), pa.array(value[order][enough[row]])),
                    pa.array((shared - need + 1)[enough].astype(np.int32)),
                    pa.array(weight[enough]),
                ],
                names=["node", "n", "values", "looked_up", "weight"],
            )

    return run


def union_estimate(left: pa.ListArray, right: pa.ListArray, retained: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair, the common values among the union's ``retained`` least, and how many of these there are."""

    def padded(lists):
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        out = np.full((len(ends) - 1, retained), _PAD, dtype=np.int64)
        row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        out[row, np.arange(len(row)) - ends[row]] = lists.flatten().to_numpy()
        return out

    both = np.sort(np.concatenate([padded(left), padded(right)], axis=1), axis=1)
    twice = np.zeros(both.shape, dtype=bool)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != _PAD)
    number = np.cumsum(~twice & (both != _PAD), axis=1)
    common = (twice & (number <= retained)).sum(axis=1)
    return common, np.minimum(number[:, -1], retained)


def _spokes(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Rows of stars, the places of their spokes among these, and for each spoke that of its hub."""
    last = None
    for whole in batches:
        for start in range(0, whole.num_rows, rows):
            table = pa.Table.from_batches([whole.slice(start, rows)])
            if last is not None:
                table = pa.concat_tables([last, table])
            table = table.combine_chunks()
            is_hub = table["y"].is_null().to_numpy()
            hub = np.maximum.accumulate(np.where(is_hub, np.arange(len(is_hub)), -1))
            last = table.slice(int(hub[-1]), 1)
            spokes = np.flatnonzero(~is_hub)
            if len(spokes):
                yield table, spokes, hub[spokes]


def _estimated(retained: int, percent: int):
    """Pairs that their parities and sketches leave possible; ``sure`` where the sketches are the whole sets."""
    least = shared_at_least(retained, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, spokes, hubs in _spokes(batches, 2048):
            n = table["n"].to_numpy()
            apart = _Parities(table["parity"].to_numpy()).apart(hubs, spokes)
            low, high = np.minimum(n[hubs], n[spokes]), np.maximum(n[hubs], n[spokes])
            fit = (100 * low >= percent * high) & (apart * (100 + percent) <= (low + high) * (100 - percent))
            spokes, hubs = spokes[fit], hubs[fit]
            total = n[hubs] + n[spokes]
            sketch = table["sketch"].combine_chunks()
            left, right = sketch.take(pa.array(hubs)), sketch.take(pa.array(spokes))
            common, size = union_estimate(left, right, retained)
            sure = np.maximum(n[hubs], n[spokes]) <= retained
            passed = common >= np.minimum(least, size)
            for row in np.flatnonzero(sure):  # here the sketches are the full sets
                both = len(np.intersect1d(left[row].values, right[row].values, assume_unique=True))
                passed[row] = 100 * both >= percent * (total[row] - both)
            x, y = (table[name].combine_chunks().take(pa.array(spokes[passed])) for name in ("x", "y"))
            yield pa.RecordBatch.from_arrays([x, y, pa.array(sure[passed])], names=["x", "y", "sure"])

    return run


def _compared(percent: int):
    """Pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, spokes, hubs in _spokes(batches, 256):
            sets = table["whole"].combine_chunks()
            keep = []
            for spoke, hub in zip(spokes, hubs):
                x, y = sets[hub].values.to_numpy(), sets[spoke].values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(spoke)
            x, y = (table[name].combine_chunks().take(pa.array(keep, pa.int64())) for name in ("x", "y"))
            yield pa.RecordBatch.from_arrays([x, y], names=["x", "y"])

    return run


def _whole_lists(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Columns of sorted rows, cut between lists, and where lists start."""
    rest: dict[str, np.ndarray] = {}
    for batch in batches:
        now = {name: batch[name].to_numpy(zero_copy_only=False) for name in batch.schema.names}
        if rest:
            now = {name: np.concatenate([rest[name], column]) for name, column in now.items()}
        if not len(now[keys[0]]):
            continue
        starts = np.ones(len(now[keys[0]]), dtype=bool)
        starts[1:] = np.any([now[key][1:] != now[key][:-1] for key in keys], axis=0)
        starts = np.flatnonzero(starts)
        if len(starts) > 1:
            yield {name: column[: starts[-1]] for name, column in now.items()}, starts[:-1]
        rest = {name: column[starts[-1] :] for name, column in now.items()}
    if rest:
        yield rest, np.zeros(1, dtype=np.int64)


class _Parities:
    """Parity sketches of several widths, comparable with those of half their width."""

    def __init__(self, sketches: np.ndarray) -> None:
        self.width = np.array([len(s) // 8 for s in sketches], dtype=np.int64)
        self.at = np.zeros(len(sketches), dtype=np.int64)
        self.rows: dict[int, np.ndarray] = {}
        self.half: dict[int, np.ndarray] = {}
        for width in np.unique(self.width):
            own = np.flatnonzero(self.width == width)
            self.at[own] = np.arange(len(own))
            bits = np.frombuffer(b"".join(sketches[own]), dtype=np.uint64).reshape(-1, width)
            self.rows[int(width)] = bits
            self.half[int(width)] = bits[:, : width // 2] ^ bits[:, width // 2 :]

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """At most the number of values in only one set of each pair."""
        out = np.zeros(len(i), dtype=np.int64)
        for left, right in {*zip(self.width[i].tolist(), self.width[j].tolist())}:
            at = (self.width[i] == left) & (self.width[j] == right)
            if max(left, right) > 2 * min(left, right):
                continue  # sizes rule such a pair out
            x = self.rows[left] if left <= right else self.half[left]
            y = self.rows[right] if right <= left else self.half[right]
            here, step = np.flatnonzero(at), max(AT_ONCE // min(left, right), 1)
            for start in range(0, len(here), step):
                some = here[start : start + step]
                bits = x[self.at[i[some]]] ^ y[self.at[j[some]]]
                out[some] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        return out


def _meet_before(i: np.ndarray, j: np.ndarray, earlier: np.ndarray, firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each pair, do the two have an earlier value in common?"""
    ends = np.concatenate([i, j])
    pair = np.repeat(np.tile(np.arange(len(i)), 2), lengths[ends])
    begin = np.repeat(firsts[ends] - (np.cumsum(lengths[ends]) - lengths[ends]), lengths[ends])
    values = earlier[begin + np.arange(len(pair))]
    order = np.lexsort((values, pair))
    pair, values = pair[order], values[order]
    out = np.zeros(len(i), dtype=bool)
    out[pair[1:][(pair[1:] == pair[:-1]) & (values[1:] == values[:-1])]] = True
    return out


def _paired(percent: int):
    """Pairs of a list between components that sizes and parities leave possible, each from one list only.

    Where a list is dealt over blocks, members of one block meet in one of its tasks.
    Two sets are a pair of the first list that both are looked up in; ``earlier``
    has those before this one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, starts in _whole_lists(batches, ("value", "low", "high")):
            node, n, label = columns["node"], columns["n"], columns["label"]
            parities = _Parities(columns["parity"])
            crossed, block = columns["low"] != columns["high"], columns["block"]
            lengths = np.array([len(values) for values in columns["earlier"]], dtype=np.int64)
            earlier = np.concatenate([*columns["earlier"], np.zeros(0, dtype=np.int64)])
            firsts = np.cumsum(lengths) - lengths
            sizes = np.diff(np.concatenate([starts, [len(node)]]))
            begin = np.repeat(starts, sizes)
            work = np.concatenate([[0], np.cumsum(np.arange(len(node)) - begin)])
            at = 0
            while at < len(node):
                to = max(int(np.searchsorted(work, work[at] + AT_ONCE, side="right")) - 1, at + 1)
                many = np.arange(at, to) - begin[at:to]
                j = np.repeat(np.arange(at, to), many)
                i = begin[j] + np.arange(len(j)) - np.repeat(np.cumsum(many) - many, many)
                fit = (label[i] != label[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
                fit &= ~crossed[j] | (block[i] != block[j])
                i, j = i[fit], j[fit]
                fit = parities.apart(i, j) * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
                i, j = i[fit], j[fit]
                for start in range(0, len(i), 1 << 16):
                    some = slice(start, start + (1 << 16))
                    new = ~_meet_before(i[some], j[some], earlier, firsts, lengths)
                    x, y = node[i[some][new]], node[j[some][new]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["x", "y"]
                    )
                at = to

    return run


class BottomK:
    """The steps over one table, for one shingle size and threshold."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, retained: int) -> None:
        if not 50 <= percent <= 100:
            raise ValueError(f"similarity of {percent} percent: 50 to 100")
        reachable(docs.sparkSession)
        self.percent, self.retained = percent, retained
        kind = docs.schema[id_col].dataType.simpleString()
        given = docs.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text"))
        signed = given.mapInArrow(
            _sign(size, retained),
            f"id {kind}, a long, b long, n long, sketch array<long>, parity binary, whole array<long>",
        )
        self.signed = cut(signed.withColumn("row", F.monotonically_increasing_id()), "bottomk-signed")
        self.rows = self.signed.select("id", "row", "a", "b", "n")
        # a set is one node however many texts have it, known by its row of the least id
        first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("first")
        nodes = (
            self.signed.where("n > 0")
            .groupBy("a", "b")
            .agg(first, F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"), F.any_value("parity").alias("parity"))
        )
        self.nodes = cut(nodes.withColumn("node", F.col("first.row")), "bottomk-nodes")

    def _looked_up(self, shared: DataFrame) -> DataFrame:
        lists = shared.groupBy("node").agg(F.collect_list(F.struct("length", "value")).alias("shared"))
        return lists.join(self.nodes.select("node", "n"), "node").mapInArrow(
            _lookups(self.retained, self.percent), "node long, n long, values array<long>, looked_up int, weight long"
        )

    def lists(self) -> DataFrame:
        """Sets with enough values in lists of two or more."""
        entries = self.nodes.select("node", F.explode("sketch").alias("value"))
        found = entries.groupBy("value").agg(F.count("*").alias("length")).where("length > 1")
        return cut(self._looked_up(entries.join(found, "value")), "bottomk-lists")

    def partners(self, lists: DataFrame) -> DataFrame:
        """For each set ``y`` the set ``x`` that heads most of the lists it is looked up in, itself aside.

        A list is headed by its member with the longest lists: of a group of near copies, the
        one that the others were made from has most values in common with them.
        """
        member = lists.select("node", "weight", F.explode(F.slice("values", F.lit(1), F.col("looked_up"))).alias("value"))
        heads = member.groupBy("value").agg(F.max(F.struct("weight", "node"))["node"].alias("head"))
        votes = member.join(heads, "value").where("head <> node").groupBy("node", "head").agg(F.count("*").alias("votes"))
        best = F.max(F.struct("votes", "head"))["head"]
        return cut(votes.groupBy("node").agg(best.alias("x")).select("x", F.col("node").alias("y")), "bottomk-partners")

    def _stars(self, pairs: DataFrame, about: DataFrame) -> DataFrame:
        """``x, part, y`` and what is known ``about`` a node: for each ``x`` its own row, ``y`` null, then one for each partner.

        A star of many partners is dealt out, its hub with every part. Partners are
        shuffled once, hubs once for each part.
        """
        parts = pairs.groupBy("x").agg(F.ceil(F.count("*") / STAR).alias("parts"))
        dealt = pairs.join(parts, "x").select("x", "y", F.pmod(F.xxhash64("y"), F.col("parts")).alias("part"))
        hubs = dealt.select("x", "part").distinct().select("x", "part", F.lit(None).cast("long").alias("y"), F.col("x").alias("node"))
        ends = cut(dealt.select("x", "part", "y", F.col("y").alias("node")).unionByName(hubs), "bottomk-ends")
        return (
            ends.join(about, "node").drop("node").repartition("x", "part").sortWithinPartitions("x", "part", F.asc_nulls_first("y"))
        )

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Of pairs ``x, y`` the links: by union estimate, then on full sets."""
        possible = cut(
            self._stars(pairs, self.nodes.select("node", "n", "sketch", "parity")).mapInArrow(
                _estimated(self.retained, self.percent), "x long, y long, sure boolean"
            ),
            "bottomk-possible",
        )
        # a set is in its sketch if that retains it whole
        whole = F.when(F.col("n") <= self.retained, F.col("sketch")).otherwise(F.col("whole")).alias("whole")
        compared = self._stars(
            possible.where("NOT sure").select("x", "y"), self.signed.select(F.col("row").alias("node"), whole)
        ).mapInArrow(_compared(self.percent), "x long, y long")
        return cut(possible.where("sure").select("x", "y").union(compared), "bottomk-links")

    def pairs_between(self, lists: DataFrame, labels: DataFrame) -> DataFrame:
        """Possible pairs of different components."""
        labelled = lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        member = labelled.select("node", "label", F.explode("values").alias("value"))
        mixed_lists = (
            member.groupBy("value")
            .agg(F.count("*").alias("length"), F.min("label").alias("least"), F.max("label").alias("most"))
            .where("least < most")
            .select("value", "length")
        )
        again = self._looked_up(member.join(mixed_lists, "value"))
        looked_up = again.select("node", F.slice("values", F.lit(1), F.col("looked_up")).alias("values"))
        entries = cut(
            looked_up.select("node", "values", F.posexplode("values").alias("place", "value")).select(
                "node", "value", F.slice("values", F.lit(1), F.col("place")).alias("earlier")
            ),
            "bottomk-entries",
        )
        counts = entries.groupBy("value").agg(F.ceil(F.count("*") / LIST_BLOCK).alias("blocks"), F.count("*").alias("members"))
        block = F.pmod(F.xxhash64("node"), F.col("blocks"))
        dealt = entries.join(counts.where("members > 1"), "value").select(
            "value", "node", "earlier", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
        )
        about = self.nodes.select("node", "n", "parity").join(labelled.select("node", "label"), "node")
        return (
            dealt.join(about, "node")
            .select(
                "value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                "node", "block", "n", "label", "parity", "earlier",
            )
            .repartition("value", "low", "high")
            .sortWithinPartitions("value", "low", "high", "n", "node")
            .mapInArrow(_paired(self.percent), "x long, y long")
        )

    def labels(self) -> DataFrame:
        """``node, label`` of every set that has a link."""
        lists = self.lists()
        links = self.linked(self.partners(lists))
        labels = connected(links)
        further = self.linked(cut(self.pairs_between(lists, labels), "bottomk-pairs"))
        return labels if further.isEmpty() else connected(links.union(further))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    retained: int = RETAINED,
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept, stays`` of every row.

    A text's set are its distinct shingles of ``shingle_words`` words, A-Z in lower
    case; with fewer words it is the whole sequence. Two texts link when ``100 *
    intersection >= percent * union``, told on full sets; a component is what links
    connect, and ``component_id`` the least id in it. ``kept`` says that a row has that id,
    ``stays`` is true of one row of each component: of the least id, or any where no row
    has an id. Texts without words, null ones too, are linked with nothing and keep their
    own id.

    Every row is given once. Rows that repeat an id are placed each by its own text.
    Null ids are linked like others but name no component: it is null, and so is the
    name compared for ``kept``, where a component has no other. Further columns are not read; an empty table
    gives no rows. Shingles are 64-bit and sets 128-bit hashes; equal hashes count as equal.
    A link is missed with a chance of at most 1e-12.
    """
    steps = BottomK(docs, id_col, text_col, shingle_words, percent, retained)
    labels = steps.labels()
    labelled = steps.nodes.select("node", "a", "b", "first").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("first").alias("least"))
    named = cut(labelled.join(least, "label").select("a", "b", "least"), "bottomk-components")
    placed = steps.rows.where("n > 0").join(named, ["a", "b"])
    alone = steps.rows.where("n = 0")
    own = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    every = placed.select("id", "row", "n", "least").unionByName(alone.select("id", "row", "n", own.alias("least")))
    return every.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("least.id").alias("component_id"),
        F.col("id").eqNullSafe(F.col("least.id")).alias("kept"),
        (F.col("row") == F.col("least.row")).alias("stays"),
    )


def op11_bottomk(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, percent=85).drop("stays")


OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]) END AS grams
  FROM w
), n AS (SELECT doc_id, len(grams) AS n FROM s), t AS (SELECT doc_id, unnest(grams) AS gram FROM s),
o AS (SELECT x.doc_id AS x, y.doc_id AS y, count(*) AS shared FROM t x JOIN t y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) c ON c.x = n.doc_id
"""
