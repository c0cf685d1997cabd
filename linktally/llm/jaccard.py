"""N-gram Jaccard join by prefixes of token combinations, to connected components.

Tokens are word shingles. All tokens have one order: those of the rare class
first, by hash, then those of the frequent class, by hash. Two sets that are
similar enough share a token among the first ``n - a + 1`` of each (``a``: the
least overlap), and two among the first ``n - a + 2``. So a set is indexed under
each rare token of its prefix, and under each pair of frequent tokens of its
extended prefix. Which class a token is in is told by a fixed array of counters
over the tokens of all documents; a wrong class costs time, never a link.

Members of an index list are compared by sketches: the parity of the tokens in cells
whose number grows with the set. The differing bits are never more than the tokens in
only one of two sets, so no similar pair is lost. What survives is compared by sketches
of about a bit per token, and what survives that is verified on the sets themselves, in
rounds. In the first ones each set meets its least and its nearest partner, after the first
round those outside the component found so far, until the components hardly grow; the last
one takes every surviving pair that lies in different components. So the copies of a large
group are not all paired, and no link between components is missed. Two sets that share
many frequent tokens meet in a list for every two of them; the last round gives them
out in the list of the first two alone.

Texts with equal sets are one node throughout, known by a 128-bit digest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.llm.common import cut, distinct, lowered, mixed, quoted, reachable, slices, span_hashes, text_of, utf8, words
from linktally.llm.components import connected

#: A token is 52 bits of a hash, so that a row number fits above it while sorting.
TOKEN_BITS, SLICE_ROWS = 52, 1 << 12
#: Counters of token frequency, dealt in chunks; of fixed size however many tokens there are.
COUNTERS, CHUNK = 1 << 20, 1 << 16
#: Counter sums meet in groups of so many.
FAN_IN = 64
#: Bits of the filter that tells which sets are needed for verification.
FILTER_BITS = 1 << 24
#: Sets with more frequent tokens in their prefix are listed under single tokens,
#: among themselves and with all others, since pairs grow with the square.
MOST_PAIRED = 64
#: Members of an index list that one task compares with each other.
BLOCK = 4096
#: Pairs compared at once.
PAIRS = 1 << 18
#: Bits of the sketches in the lists: by size of the set, within these.
NARROW, WIDE = 1 << 9, 1 << 14
#: Words of sketches laid side by side at once.
SKETCH_WORDS = 1 << 21
#: The first round looks into one in so many of the lists under pairs of tokens.
FIRST_LISTS = 16
#: Rounds over partners at most, the first one among them, and what is few new links for one.
PARTNER_ROUNDS, FEW_LINKS = 3, 16

_MASK = np.uint64((1 << TOKEN_BITS) - 1)


def shingle_tokens(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and token of the distinct shingles, by row and token."""
    data = lowered(data)
    starts, ends, counts = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    rows = np.repeat(np.arange(len(counts)), counts)
    last = np.cumsum(counts)[rows] if len(rows) else rows
    place = np.arange(len(rows))
    first = place == last - counts[rows]
    full = place + size <= last
    short = first & (counts[rows] < size)
    total = np.zeros(len(hashes) + size, dtype=np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, dtype=np.uint64)])
    for step in range(size):
        inside = place + step < last
        factor = np.uint64(0x9E3779B97F4A7C15 * (2 * step + 3) & (2**64 - 1))
        total[: len(hashes)] += np.where(inside, mixed(padded[step : step + len(hashes)] + np.uint64(step)) * factor, 0)
    used = full | short
    tokens = mixed(total[: len(hashes)][used] + np.minimum(counts[rows[used]], size).astype(np.uint64)) >> np.uint64(64 - TOKEN_BITS)
    codes = (rows[used].astype(np.uint64) << np.uint64(TOKEN_BITS)) | tokens
    codes = distinct(codes)
    return (codes >> np.uint64(TOKEN_BITS)).astype(np.int64), codes & _MASK


def _row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:], dtype=np.uint64)
    return sums[ends[1:]] - sums[ends[:-1]]


def digests(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each row's set; zero for an empty one alone."""
    a = _row_sums(mixed(tokens + np.uint64(0x1234567)), ends)
    b = _row_sums(mixed(tokens ^ np.uint64(0x5DEECE66D5DEECE6)), ends)
    filled = ends[1:] > ends[:-1]
    a = np.where(filled & (a == 0), np.uint64(1), a)
    return a.view(np.int64), b.view(np.int64)


def long_sketches(tokens: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Parity of the tokens on each of 512 bits or more, the next power of two to their number."""
    spread = mixed(tokens + np.uint64(0xFEDCBA))
    out = []
    for start, end in zip(ends[:-1], ends[1:]):
        bits = 1 << max(int(end - start - 1).bit_length(), 9)
        places = (spread[start:end] & np.uint64(bits - 1)).astype(np.int64)
        out.append(np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes())
    return out


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """A sketch, or a table of them, on fewer words: bits whose places agree there are added up."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def list_sketches(parities: list[bytes], sizes: np.ndarray, percent: int) -> list[bytes]:
    """The long sketches folded to what the lists carry.

    Half the bits of two unrelated sets differ; that has to be clearly more than the
    most that two linked sets may differ in, ``2 n (1 - t) / (1 + t)`` tokens.
    """
    out = []
    for parity, size in zip(parities, sizes):
        least = int(4.5 * size * (100 - percent) / (100 + percent))
        bits = min(max(1 << max(least - 1, 0).bit_length(), NARROW), WIDE)
        out.append(folded(np.frombuffer(parity, dtype=np.uint64), bits // 64).tobytes())
    return out


class Sketches:
    """Sketches of different widths, ready to be compared at the lesser of two widths."""

    def __init__(self, column: np.ndarray) -> None:
        self.words = np.array([len(s) // 8 for s in column], dtype=np.int64)
        self.at: dict[int, np.ndarray] = {}
        self.table: dict[int, np.ndarray] = {}
        width = int(self.words.max())
        rows, table = np.zeros(0, dtype=np.int64), np.zeros((0, width), dtype=np.uint64)
        while width >= self.words.min():
            own = np.flatnonzero(self.words == width)
            plain = np.frombuffer(b"".join(column[own]), dtype=np.uint64).reshape(-1, width)
            rows, table = np.concatenate([rows, own]), np.concatenate([folded(table, width), plain])
            self.at[width] = np.zeros(len(column), dtype=np.int64)
            self.at[width][rows] = np.arange(len(rows))
            self.table[width] = table
            width //= 2

    def distance(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """At most the number of tokens in only one of the sets of rows ``i`` and ``j``."""
        out = np.zeros(len(i), dtype=np.int64)
        level = np.minimum(self.words[i], self.words[j])
        for width in np.unique(level):
            chosen = np.flatnonzero(level == width)
            at, table = self.at[int(width)], self.table[int(width)]
            lot = max(SKETCH_WORDS // int(width), 1)
            for start in range(0, len(chosen), lot):
                piece = chosen[start : start + lot]
                out[piece] = np.bitwise_count(table[at[i[piece]]] ^ table[at[j[piece]]]).sum(axis=1, dtype=np.int64)
        return out


def _parts(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row range, row numbers inside it, tokens and row ends of each slice of a batch."""
    data, offsets = utf8(batch["text"])
    for start, end in slices(offsets, most=SLICE_ROWS):
        part = data[offsets[start] : offsets[end]]
        rows, tokens = shingle_tokens(part, offsets[start : end + 1] - offsets[start], size)
        ends = np.zeros(end - start + 1, dtype=np.int64)
        np.cumsum(np.bincount(rows, minlength=end - start), out=ends[1:])
        yield start, end, rows, tokens, ends


def _sign(size: int, percent: int):
    """One row per document, then the counters of the task in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, dtype=np.int64)
        id_type = None
        for batch in batches:
            id_type = batch["id"].type
            for start, end, rows, tokens, ends in _parts(batch, size):
                a, b = digests(tokens, ends)
                once = np.zeros(end - start, dtype=bool)
                once[np.unique(a, return_index=True)[1]] = True
                counters += np.bincount((tokens[once[rows]] >> np.uint64(TOKEN_BITS - 20)).astype(np.int64), minlength=COUNTERS)
                parities = long_sketches(tokens, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(start, end - start),
                        pa.array(a),
                        pa.array(b),
                        pa.array(np.diff(ends)),
                        pa.array(list_sketches(parities, np.diff(ends), percent), pa.binary()),
                        pa.array(parities, pa.binary()),
                        pa.nulls(end - start, pa.int32()),
                        pa.nulls(end - start, pa.binary()),
                    ],
                    names=["id", "a", "b", "n", "sketch", "parity", "chunk", "counts"],
                )
        if id_type is not None:
            chunks = COUNTERS // CHUNK
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(chunks, id_type),
                    *[pa.nulls(chunks, pa.int64()) for _ in range(3)],
                    *[pa.nulls(chunks, pa.binary()) for _ in range(2)],
                    pa.array(range(chunks), pa.int32()),
                    pa.array([c.astype("<u4").tobytes() for c in counters.reshape(chunks, CHUNK)], pa.binary()),
                ],
                names=["id", "a", "b", "n", "sketch", "parity", "chunk", "counts"],
            )

    return run


def _counters(signed: DataFrame) -> np.ndarray:
    """The sum of all tasks' counters, added up in groups of bounded size."""

    def add(key, frame):
        import pandas as pd

        total = sum(np.frombuffer(c, dtype="<i8").astype(np.int64) for c in frame["counts"])
        return pd.DataFrame({"chunk": [key[0]], "part": [key[1]], "counts": [total.tobytes()]})

    def widen(batches):
        for batch in batches:
            wide = [np.frombuffer(c.as_py(), dtype="<u4").astype("<i8").tobytes() for c in batch["counts"]]
            yield pa.RecordBatch.from_arrays(
                [batch["chunk"], batch["part"], pa.array(wide, pa.binary())], names=["chunk", "part", "counts"]
            )

    schema = "chunk int, part long, counts binary"
    parts = (
        signed.where("chunk IS NOT NULL")
        .select("chunk", F.spark_partition_id().cast("long").alias("file"), F.monotonically_increasing_id().alias("number"), "counts")
        .select("chunk", F.xxhash64("file", "number").alias("part"), "counts")
        .mapInArrow(widen, schema)
    )
    tasks = signed.where("chunk = 0").count()
    while tasks > 1:
        groups = math.ceil(tasks / FAN_IN)
        parts = cut(
            parts.groupBy("chunk", F.pmod(F.xxhash64("part"), F.lit(groups)).alias("part")).applyInPandas(add, schema),
            "jaccard-counters",
        )
        tasks = groups
    total = np.zeros(COUNTERS, dtype=np.int64)
    for row in parts.select("chunk", "counts").collect():  # at most one row per chunk
        total[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], dtype="<i8")
    return total


def _ranks(marked: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each token its number among the marked tokens of its row (meaningful where marked)."""
    counted = np.zeros(len(marked) + 1, dtype=np.int64)
    np.cumsum(marked, out=counted[1:])
    return counted[:-1] - counted[ends[:-1]][rows]


def prefix_signatures(
    rows: np.ndarray, tokens: np.ndarray, ends: np.ndarray, frequent: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, signature, kind and place of each index entry of each set.

    Kinds: 0 a rare token, 1 a pair of frequent ones, 2 a single frequent token, 3
    the same of a set with too many of them to pair. The place is that of the frequent
    token among those of the set's prefix, for pairs ``second * MOST_PAIRED + first``.
    """
    sizes = np.diff(ends)
    prefix = sizes - -(-percent * sizes // 100) + 1
    rare = ~frequent[(tokens >> np.uint64(TOKEN_BITS - 20)).astype(np.int64)]
    n_rare = np.bincount(rows[rare], minlength=len(sizes)) if len(rows) else np.zeros(len(sizes), np.int64)
    single = rare & (_ranks(rare, ends, rows) < prefix[rows])
    often = ~rare & (_ranks(~rare, ends, rows) < np.minimum(prefix + 1, sizes)[rows] - n_rare[rows])
    out_rows, out_sigs = [rows[single]], [mixed(tokens[single])]
    out_kinds = [np.zeros(int(single.sum()), dtype=np.int8)]
    out_places = [np.zeros(int(single.sum()), dtype=np.int16)]
    of_row, of_token = rows[often], tokens[often]
    counts = np.bincount(of_row, minlength=len(sizes)) if len(of_row) else np.zeros(len(sizes), np.int64)
    at = np.concatenate([[0], np.cumsum(counts)])
    if len(of_row):
        heavy = counts[of_row] > MOST_PAIRED
        out_rows.append(of_row)
        out_sigs.append(mixed(of_token ^ np.uint64(0x7777777777777777)))
        out_kinds.append(np.where(heavy, 3, 2).astype(np.int8))
        out_places.append(np.where(heavy, 0, np.arange(len(of_row)) - at[of_row]).astype(np.int16))
    for row in np.flatnonzero((counts > 1) & (counts <= MOST_PAIRED)):
        own = mixed(of_token[at[row] : at[row + 1]])
        i, j = np.triu_indices(len(own), 1)
        out_rows.append(np.full(len(i), row))
        out_sigs.append(mixed(own[i] * np.uint64(0x9E3779B97F4A7C15) + own[j]))
        out_kinds.append(np.ones(len(i), dtype=np.int8))
        out_places.append((j * MOST_PAIRED + i).astype(np.int16))
    return tuple(np.concatenate(out) for out in (out_rows, out_sigs, out_kinds, out_places))


def _post(size: int, percent: int, frequent):
    """Index entries of every set of two tokens or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.unpackbits(np.frombuffer(frequent.value, dtype=np.uint8)).astype(bool)
        for batch in batches:
            for start, end, rows, tokens, ends in _parts(batch, size):
                a, _ = digests(tokens, ends)
                once = np.zeros(end - start, dtype=bool)
                once[np.unique(a, return_index=True)[1]] = True
                once &= np.diff(ends) > 1
                used = once[rows]
                kept = np.zeros(end - start + 1, dtype=np.int64)
                np.cumsum(np.where(once, np.diff(ends), 0), out=kept[1:])
                row, sig, kind, place = prefix_signatures(rows[used], tokens[used], kept, often, percent)
                for lot in range(0, len(row), 1 << 18):
                    piece = slice(lot, lot + (1 << 18))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(sig[piece].view(np.int64)),
                            pa.array(a[row[piece]]),
                            pa.array(kind[piece]),
                            pa.array(place[piece]),
                        ],
                        names=["sig", "a", "kind", "place"],
                    )

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Columns and group starts of sorted rows, cut between groups of equal keys."""
    rest: dict[str, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {name: batch[name].to_numpy(zero_copy_only=False) for name in batch.schema.names}
        if rest:
            now = {name: np.concatenate([rest[name], now[name]]) for name in now}
        change = np.zeros(len(now[keys[0]]), dtype=bool)
        change[0] = True
        for key in keys:
            change[1:] |= now[key][1:] != now[key][:-1]
        starts = np.flatnonzero(change)
        if len(starts) > 1:
            yield {name: column[: starts[-1]] for name, column in now.items()}, starts[:-1]
        rest = {name: column[starts[-1] :] for name, column in now.items()}
    if rest:
        yield rest, np.zeros(1, dtype=np.int64)


def _live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in (signature, set) order without repeats; lists of rare tokens with one set go.

    A list is never held: an entry waits for the next one, and it goes out when that
    one has the same signature or the one before it had.
    """
    names = ["sig", "a", "kind", "place"]
    last: list[np.ndarray] = []
    matched = False
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[name].to_numpy(zero_copy_only=False) for name in names]
        if last:
            columns = [np.concatenate(both) for both in zip(last, columns)]
        sig, a = columns[:2]
        fresh = np.ones(len(sig), dtype=bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (a[1:] != a[:-1])
        columns = [column[fresh] for column in columns]
        sig, kind = columns[0], columns[2]
        same = sig[1:] == sig[:-1]
        shared = np.zeros(len(sig), dtype=bool)
        shared[1:] |= same
        shared[:-1] |= same
        shared[0] |= matched
        shared |= kind > 0
        matched = bool(shared[-1]) and len(sig) > 1 and bool(same[-1]) or (matched and len(sig) == 1)
        last = [column[-1:] for column in columns]
        out = shared[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(column[:-1][out]) for column in columns], names=names)
    if last and (matched or last[2][0] > 0):
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in last], names=names)


def _earlier_bits(often: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each member of a list under two tokens, which other frequent tokens it has before the second.

    A bit each, for tokens that several members have.
    """
    before = []
    for tokens, spot in zip(often, place):
        second, first = divmod(int(spot), MOST_PAIRED)
        before.append(np.delete(np.asarray(tokens[:second]), first))
    owner = np.repeat(np.arange(len(before)), [len(tokens) for tokens in before])
    _, token, counts = np.unique(np.concatenate(before), return_inverse=True, return_counts=True)
    common = counts[token] > 1
    number = (np.cumsum(counts > 1) - 1)[token[common]]
    bits = np.zeros((len(before), int((counts > 1).sum()) // 64 + 1), dtype=np.uint64)
    np.bitwise_or.at(bits, (owner[common], number >> 6), np.uint64(1) << (number & 63).astype(np.uint64))
    return bits


def _candidates(percent: int, first_only: bool):
    """Pairs of an index list that sketch and size leave possible.

    All differ in ``label``. ``first_only``: for each member the first possible partner before
    and after it, and the nearest. Otherwise every one, whose ``side`` differs if they have one;
    of the lists under pairs of tokens only that of the first two tokens both have.
    """

    def least_list(columns, i, j, begin, end, cache):
        keep = np.ones(len(i), dtype=bool)
        paired = np.flatnonzero(columns["family"][j] == 1)
        for start in np.unique(begin[j[paired]]):
            of_list = paired[begin[j[paired]] == start]
            if cache.get("start") != start:
                members = slice(start, end[start])
                cache.update(start=start, bits=_earlier_bits(columns["often"][members], columns["place"][members]))
            bits = cache["bits"]
            lot = max(SKETCH_WORDS // bits.shape[1], 1)
            for at in range(0, len(of_list), lot):
                piece = of_list[at : at + lot]
                keep[piece] = ~(bits[i[piece] - start] & bits[j[piece] - start]).any(axis=1)
        return keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, starts in _groups(batches, ["sig", "family", "block", "block2"]):
            a, n, label, side = columns["a"], columns["n"], columns["label"], columns["side"]
            sketches, kind, cache = Sketches(columns["sketch"]), columns["kind"], {}
            sizes = np.diff(np.concatenate([starts, [len(a)]]))
            place = np.arange(len(a)) - np.repeat(starts, sizes)
            begin = np.arange(len(a)) - place
            end = begin + np.repeat(sizes, sizes)
            crossed = columns["block"] != columns["block2"]
            work = np.concatenate([[0], np.cumsum(place)])
            at = 0
            while at < len(a):
                to = max(int(np.searchsorted(work, work[at] + PAIRS, side="right")) - 1, at + 1)
                many = place[at:to]
                j = np.repeat(np.arange(at, to), many)
                i = begin[j] + np.arange(len(j)) - np.repeat(np.cumsum(many) - many, many)
                low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
                fit = (100 * low >= percent * high) & (a[i] != a[j])
                fit &= label[i] != label[j]
                fit &= ~crossed[j] | (side[i] != side[j])
                # sets whose frequent tokens are paired meet in the lists of pairs
                fit &= (kind[i] != 2) | (kind[j] != 2)
                i, j = i[fit], j[fit]
                apart = sketches.distance(i, j)
                fit = apart * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
                i, j = i[fit], j[fit]
                if first_only and len(i):
                    keep = np.zeros(len(i), dtype=bool)
                    near = np.argsort(apart[fit], kind="stable")
                    for member in (i, j):
                        keep[np.unique(member, return_index=True)[1]] = True
                        keep[near[np.unique(member[near], return_index=True)[1]]] = True
                    i, j = i[keep], j[keep]
                elif len(i):
                    keep = least_list(columns, i, j, begin, end, cache)
                    i, j = i[keep], j[keep]
                if len(i):
                    x, y = np.minimum(a[i], a[j]), np.maximum(a[i], a[j])
                    order = np.lexsort((y, x))
                    x, y = x[order], y[order]
                    fresh = np.ones(len(x), dtype=bool)
                    fresh[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
                    x, y = x[fresh], y[fresh]
                    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])
                at = to

    return run


def _by_parity(percent: int):
    """Pairs that their longer sketches leave possible, and in how many bits these differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, bits = [], []
            total = batch["n_left"].to_numpy() + batch["n_right"].to_numpy()
            for left, right, both in zip(batch["left"], batch["right"], total):
                x = np.frombuffer(left.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(right.as_buffer(), dtype=np.uint64)
                while len(x) != len(y):  # the longer one folds onto half its bits
                    if len(x) > len(y):
                        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                    else:
                        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
                apart = int(np.bitwise_count(x ^ y).sum())
                keep.append(apart * (100 + percent) <= both * (100 - percent))
                bits.append(apart)
            pairs = batch.select(["x", "y"]).append_column("apart", pa.array(bits, pa.int64()))
            yield pairs.filter(pa.array(keep, pa.bool_()))

    return run


def _needed_sets(size: int, needed):
    """The sets whose digest the filter lets through, once per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(needed.value, dtype=np.uint64)
        for batch in batches:
            for _, _, _, tokens, ends in _parts(batch, size):
                a, b = digests(tokens, ends)
                spot = (mixed(a.view(np.uint64)) >> np.uint64(40)).astype(np.int64)
                passed = (bits[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1
                first = np.unique(a, return_index=True)[1]
                chosen = first[passed[first]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a[chosen]),
                        pa.array(b[chosen]),
                        pa.array([tokens[ends[r] : ends[r + 1]].tobytes() for r in chosen], pa.binary()),
                    ],
                    names=["a", "b", "tokens"],
                )

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch["left"], batch["right"]):
                x = np.frombuffer(left.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(right.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["x", "y"])

    return run


class JaccardJoin:
    """The steps of the join over one table, for one shingle size and threshold."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, frequent: int) -> None:
        if not 50 < percent <= 100:
            raise ValueError(f"similarity of {percent} percent: over 50, to 100")
        self.spark = docs.sparkSession
        reachable(self.spark)
        self.docs = docs.select(F.col(quoted(id_col)).alias("id"), text_of(text_col).alias("text"))
        self.size, self.percent, self.frequent = size, percent, frequent
        kind = docs.schema[id_col].dataType.simpleString()
        signed = self.docs.mapInArrow(
            _sign(size, percent),
            f"id {kind}, a long, b long, n long, sketch binary, parity binary, chunk int, counts binary",
        )
        self.signed = cut(signed, "jaccard-signed")
        self.rows = self.signed.where("chunk IS NULL").select("id", "a", "b", "n")
        self.nodes = cut(
            self.signed.where("chunk IS NULL AND n > 0")
            .groupBy("a", "b")
            .agg(F.min("id").alias("least_id"), F.max("n").alias("n"), F.max("sketch").alias("sketch"), F.max("parity").alias("parity")),
            "jaccard-nodes",
        )

    def entries(self) -> DataFrame:
        counters = _counters(self.signed)
        # other tokens that share a counter add its mean, give or take
        often = counters > self.frequent + counters.mean() + 4 * math.sqrt(counters.mean())
        broadcast = self.spark.sparkContext.broadcast(np.packbits(often).tobytes())
        posted = self.docs.select("text").mapInArrow(
            _post(self.size, self.percent, broadcast), "sig long, a long, kind byte, place short"
        )
        # lists of frequent tokens are dealt out; whether they hold several sets is asked later
        salt = F.when(F.col("kind") > 0, F.pmod(F.col("a"), F.lit(64))).otherwise(0)
        live = posted.repartition("sig", salt).sortWithinPartitions("sig", "a").mapInArrow(_live, posted.schema)
        return cut(live, "jaccard-entries")

    def listed(self, entries: DataFrame, labels: DataFrame | None, partners: bool = False) -> DataFrame:
        """Pairs ``x < y`` between components that the lists leave possible: all, or a few ``partners`` of each set."""
        member = entries
        if labels is not None:
            member = member.join(labels.select(F.col("node").alias("a"), "label"), "a", "left").withColumn(
                "label", F.coalesce("label", "a")
            )
        else:
            # this round need not see all lists: what it misses, the next ones find
            member = member.where((F.col("kind") != 1) | (F.pmod("sig", F.lit(FIRST_LISTS)) == 0))
            member = member.withColumn("label", F.col("a"))
        family = F.least("kind", F.lit(2).cast("byte")).alias("family")
        lists = (
            member.groupBy("sig", family)
            .agg(
                F.min("label").alias("low"),
                F.max("label").alias("high"),
                F.min(F.struct("a", "label")).alias("hub"),
                F.max("kind").alias("most"),
                F.count("*").alias("members"),
            )
            # lists under single frequent tokens serve the sets with too many of them alone
            .where((F.col("low") < F.col("high")) & ((F.col("family") < 2) | (F.col("most") == 3)))
            .select("sig", "family", "hub", F.ceil(F.col("members") / BLOCK).alias("blocks"))
        )
        found = member.select("*", family).join(lists, ["sig", "family"])
        own = F.pmod(F.xxhash64("a"), F.col("blocks"))
        if partners:
            placed = found.select("sig", "family", "a", "label", "kind", own.alias("block"))
            hubs = lists.where("blocks > 1").select(
                "sig", "family", "hub.a", "hub.label", F.lit(3).cast("byte").alias("kind"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
            )
            placed = placed.unionByName(hubs).select("*", F.col("block").alias("block2"), F.col("block").alias("side"))
            sized = placed.join(self.nodes.select("a", "n", "sketch"), "a")
        else:
            placed = found.select(
                "sig", "family", "a", "label", "kind", "place", own.alias("side"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
            ).select(
                "sig", "family", "a", "label", "kind", "place", "side", F.least("side", "other").alias("block"), F.greatest("side", "other").alias("block2")
            )
            # at most MOST_PAIRED of a set
            often = (
                entries.where("kind = 2")
                .groupBy("a")
                .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "sig"))), lambda e: e["sig"]).alias("tokens"))
            )
            sized = (
                placed.join(self.nodes.select("a", "n", "sketch"), "a")
                .join(often, "a", "left")
                .withColumn("often", F.when(F.col("kind") == 1, F.col("tokens")))
                .drop("tokens")
            )
        return (
            sized.repartition("sig", "block", "block2")
            .sortWithinPartitions("sig", "family", "block", "block2", "n", "a")
            .mapInArrow(_candidates(self.percent, partners), "x long, y long")
        )

    def candidates(self, entries: DataFrame, labels: DataFrame | None, partners: bool = False) -> DataFrame:
        """The pairs of the lists, each once, that their longer sketches leave possible too."""
        pairs = self.listed(entries, labels, partners).distinct()
        left = self.nodes.select(F.col("a").alias("x"), F.col("n").alias("n_left"), F.col("parity").alias("left"))
        right = self.nodes.select(F.col("a").alias("y"), F.col("n").alias("n_right"), F.col("parity").alias("right"))
        return pairs.join(left, "x").join(right, "y").mapInArrow(_by_parity(self.percent), "x long, y long, apart long")

    def chosen(self, entries: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Possible pairs between components: of each set that with its least partner and that with its nearest."""
        possible = cut(self.candidates(entries, labels, partners=True), "jaccard-possible")
        of_x = possible.groupBy("x").agg(F.min_by("y", F.struct("apart", "y")).alias("y"))
        of_y = possible.groupBy("y").agg(F.min_by("x", F.struct("apart", "x")).alias("x"))
        least = possible.groupBy("y").agg(F.min("x").alias("x"))
        return of_x.unionByName(of_y).unionByName(least).distinct()

    def sets_of(self, pairs: DataFrame) -> DataFrame:
        """``a, tokens`` of every set in a pair, and of few others."""
        ends = pairs.select(F.explode(F.array("x", "y")).alias("a"))

        def spots(batches):
            for batch in batches:
                spot = (mixed(batch["a"].to_numpy().view(np.uint64)) >> np.uint64(40)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(spot)], names=["spot"])

        bit = F.expr("shiftleft(1L, CAST(spot & 63 AS INT))")
        filled = (
            ends.mapInArrow(spots, "spot long")
            .groupBy(F.shiftright("spot", 6).alias("word"))
            .agg(F.bit_or(bit).alias("bits"))
        )
        needed = np.zeros(FILTER_BITS // 64, dtype=np.int64)
        table = filled.toArrow()  # at most one row per word of the filter
        needed[table["word"].to_numpy()] = table["bits"].to_numpy()
        broadcast = self.spark.sparkContext.broadcast(needed.tobytes())
        found = self.docs.select("text").mapInArrow(
            _needed_sets(self.size, broadcast), "a long, b long, tokens binary"
        )
        return cut(found.dropDuplicates(["a", "b"]).select("a", "tokens"), "jaccard-sets")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        left = sets.select(F.col("a").alias("x"), F.col("tokens").alias("left"))
        right = sets.select(F.col("a").alias("y"), F.col("tokens").alias("right"))
        return pairs.join(left, "x").join(right, "y").select("x", "y", "left", "right").mapInArrow(
            _verify(self.percent), "x long, y long"
        )

    def with_sets(self, sets: DataFrame | None, pairs: DataFrame) -> DataFrame:
        """``sets`` and those that the pairs need beside them."""
        if sets is None:
            return self.sets_of(pairs)
        ends = pairs.select(F.explode(F.array("x", "y")).alias("x")).distinct()
        absent = ends.join(sets.select(F.col("a").alias("x")), "x", "left_anti").withColumn("y", F.col("x"))
        if absent.isEmpty():
            return sets
        return sets.unionByName(self.sets_of(absent).join(sets.select("a"), "a", "left_anti"))

    def labels(self) -> DataFrame:
        """``node, label`` of every set that has a link."""
        entries = self.entries()
        labels = tried = sets = links = None
        for _ in range(PARTNER_ROUNDS):
            pairs = self.chosen(entries, labels)
            if tried is not None:
                pairs = pairs.join(tried, ["x", "y"], "left_anti")
            pairs = cut(pairs.select("x", "y"), "jaccard-partners")
            sets = self.with_sets(sets, pairs)
            found = cut(self.verified(pairs, sets), "jaccard-links")
            tried = pairs if tried is None else tried.union(pairs)
            links = found if links is None else links.union(found)
            more = found.limit(FEW_LINKS + 1).count()
            if more or labels is None:
                labels = connected(links)
            if more <= FEW_LINKS:
                break
        rest = cut(self.candidates(entries, labels, partners=False).select("x", "y").join(tried, ["x", "y"], "left_anti"), "jaccard-possible")
        further = cut(self.verified(rest, self.with_sets(sets, rest)), "jaccard-links")
        if further.isEmpty():
            return labels
        return connected(links.union(further))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    frequent: int = 64,
) -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row.

    A text's set are its distinct shingles of ``shingle_words`` words, A-Z in lower
    case; with fewer words it is the whole sequence. Two texts link when ``100 *
    intersection >= percent * union``; a component is what links connect, and
    ``component_id`` the least id in it. Texts without words are linked with nothing
    and keep their own id. ``percent`` is over 50.

    Every row is given once. Rows that repeat an id are placed each by its own text.
    Null ids are linked like others but name no component: it is null where a
    component has no other. Further columns are not read; an empty table gives no
    rows. Tokens are 52-bit and sets 128-bit hashes; equal hashes count as equal.
    """
    join = JaccardJoin(docs, id_col, text_col, shingle_words, percent, frequent)
    labels = join.labels()
    labelled = join.nodes.join(labels.withColumnRenamed("node", "a"), "a", "left").select(
        "a", "b", "least_id", F.coalesce("label", "a").alias("label"), F.when(F.col("label").isNull(), F.col("b")).alias("alone")
    )
    key = ["label", F.coalesce("alone", F.lit(0)).alias("alone")]
    least = labelled.groupBy(*key).agg(F.min("least_id").alias("component_id"))
    named = cut(
        labelled.select("a", "b", *key).join(least, ["label", "alone"]).select("a", "b", "component_id"),
        "jaccard-components",
    )
    ids = F.col("id")
    return (
        join.rows.join(named, ["a", "b"], "left")
        .select(
            ids.alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(ids).alias("component_id"),
        )
    )


def op4_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(docs, shingle_words=3, percent=90)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)]) END AS grams
  FROM w
), n AS (SELECT doc_id, len(grams) AS n FROM s), t AS (SELECT doc_id, unnest(grams) AS gram FROM s),
o AS (SELECT x.doc_id AS x, y.doc_id AS y, count(*) AS shared FROM t x JOIN t y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 90 * (a.n + b.n - shared)
), r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.component_id
FROM n JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) c ON c.x = n.doc_id
"""
