"""BPE encoding and decoding with a contiguous rank array per word.

A word is an array of part boundaries and, beside it, the rank of the merge of
each part with the next. The smallest rank is found by a scan, its boundary is
deleted, and the two ranks beside it are looked up anew. Scans are the fastest
way for short words; longer ones, where the square of the length would count,
keep the same ranks in a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linktally.llm.common import quoted, reachable, text_of, without

#: The splitting pattern and word ending of the vocabulary file.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
NO_RANK = 1 << 62
#: Parts up to which a word is merged by scanning.
SCAN_PARTS = 64
#: Words remembered by a task; a full memory is emptied, so it stays bounded.
REMEMBERED = 400_000

ADDED = ("token_ids", "n_tokens", "decoded")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one past 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = dict.fromkeys(range(256), "")
    letters.update({byte: chr(byte) for byte in shown})
    hidden = (byte for byte in range(256) if not letters[byte])
    letters.update({byte: chr(256 + place) for place, byte in enumerate(hidden)})
    return [letters[byte] for byte in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a tokenizer file; picklable, of fixed size."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model = stored["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.tokens: dict[int, str] = {i: t for t, i in self.ids.items()}
        self.tokens.update({i: t for t, i in self.special.items()})
        #: pair of ids -> (rank, id of the merged part)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(
                (self.ids[left], self.ids[right]), (rank, self.ids[left + right])
            )
        letters = byte_letters()
        self.inner = [self.ids[letter] for letter in letters]
        self.last = [self.ids[letter + self.end] for letter in letters]


def merged_by_scan(parts: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge with ranks in an array beside the parts."""

    def rank(place: int) -> int:
        if place + 1 < len(parts):
            return merges.get((parts[place], parts[place + 1]), (NO_RANK,))[0]
        return NO_RANK

    ranks = [rank(place) for place in range(len(parts))]
    while True:
        least = min(ranks)
        if least == NO_RANK:
            return parts
        place = ranks.index(least)
        parts[place] = merges[parts[place], parts[place + 1]][1]
        del parts[place + 1], ranks[place + 1]
        ranks[place] = rank(place)
        if place:
            ranks[place - 1] = rank(place - 1)


def merged_by_heap(parts: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same merges in the same order, for long words."""
    size = len(parts)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < size and (found := merges.get((parts[left], parts[right]))):
            heapq.heappush(heap, (found[0], left, parts[left], parts[right]))

    for place in range(size - 1):
        offer(place)
    while heap:
        _, left, a, b = heapq.heappop(heap)
        right = after[left]
        if parts[left] != a or right >= size or parts[right] != b:
            continue
        parts[left] = merges[a, b][1]
        parts[right] = -1
        after[left] = after[right]
        if after[left] < size:
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [part for part in parts if part >= 0]


class Encoder:
    """Encodes texts with a memory of the chunks seen."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.pattern = regex.compile(SPLIT)
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))))
        self.memory: dict[str, tuple[int, ...]] = {}
        self.separators = re.compile("[\x1c-\x1f]")

    def word(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        parts = [self.vocabulary.inner[byte] for byte in data[:-1]]
        parts.append(self.vocabulary.last[data[-1]])
        merge = merged_by_scan if len(parts) <= SCAN_PARTS else merged_by_heap
        return merge(parts, self.vocabulary.merges)

    def chunk(self, chunk: str) -> tuple[int, ...]:
        found = self.memory.get(chunk)
        if found is None:
            found = tuple(i for word in self.pattern.findall(chunk) for i in self.word(word))
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            if len(chunk) <= 256:
                self.memory[chunk] = found
        return found

    def plain(self, text: str) -> list[int]:
        """Ids of text without special tokens. No word spans white space."""
        text = unicodedata.normalize("NFC", text)
        # letter by letter: the whole-text form would write a final sigma
        text = text.lower() if text.isascii() or "Σ" not in text else "".join(map(str.lower, text))
        ids: list[int] = []
        # str.split also takes the four separators, which the vocabulary's \s does not
        chunks = regex.split(r"\p{White_Space}+", text) if self.separators.search(text) else text.split()
        for chunk in chunks:
            ids += self.chunk(chunk)
        return ids

    def encode(self, text: str) -> list[int]:
        if not self.vocabulary.special or not self.special.search(text):
            return self.plain(text)
        ids: list[int] = []
        at = 0
        for found in self.special.finditer(text):
            ids += self.plain(text[at : found.start()])
            ids.append(self.vocabulary.special[found.group()])
            at = found.end()
        return ids + self.plain(text[at:])

    def decode(self, ids: list[int]) -> str:
        """Tokens with spaces between: the vocabulary file names no decoder."""
        return " ".join(map(self.vocabulary.tokens.__getitem__, ids))


def _encoded(broadcast, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(broadcast.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [encoder.encode(t or "") for t in texts.slice(start, 256).to_pylist()]
                counts = pa.array([len(i) for i in ids], pa.int64())
                if digests:
                    new = [
                        counts,
                        pa.array([hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest() for i in ids], pa.string()),
                        pa.array([hashlib.sha256(encoder.decode(i).encode()).hexdigest() for i in ids], pa.string()),
                    ]
                    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    new = [
                        pa.array(ids, pa.list_(pa.int32())),
                        counts,
                        pa.array([encoder.decode(i) for i in ids], pa.string()),
                    ]
                    names = list(ADDED)
                kept = part.columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[*batch.schema.names[:-1], *names])

    return run


def bpe_encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", digests: bool = False) -> DataFrame:
    """The documents with ``token_ids, n_tokens, decoded`` added.

    With ``digests``, instead of these: ``n_tokens, ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers) ``, decoded_sha256`` (of UTF-8), so
    that long lists never leave the task. Null and empty texts have no tokens.
    Columns named like an added one are replaced; all others stay. Rows are
    worked on one by one, so repeats and empty tables need nothing.

    The driver reads the vocabulary file and broadcasts it: its size is fixed.
    """
    spark = docs.sparkSession
    reachable(spark)
    added = ("n_tokens", "ids_sha256", "decoded_sha256") if digests else ADDED
    kept = without(docs, added)
    given = kept.select(*[F.col(quoted(c)) for c in kept.columns], text_of(text_col).alias("__bpe_text"))
    types = {"token_ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType()}
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, types.get(n, T.StringType())) for n in added]])
    broadcast = spark.sparkContext.broadcast(Vocabulary(vocabulary_path))
    return given.mapInArrow(_encoded(broadcast, digests), schema)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    encoded = bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
