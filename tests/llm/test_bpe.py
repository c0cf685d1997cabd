"""BPE: the library's ids and texts, the two merge loops, edge cases."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linktally.llm.bpe import Encoder, Vocabulary, bpe_encode, merged_by_heap, merged_by_scan

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, n_tokens string, decoded int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


TEXTS = [
    None,
    "",
    " \n\t ",
    "The QUICK brown fox's 12 tests, isn't it?",
    "ΣΑΣ ΟΔΟΣ İstanbul ǅ ﬁ é é ñ",
    "日本語 👍🏽 עברית ا́",
    "a<|endoftext|>B<|startoftext|> <|endoftext|",
    "tabs\x0bfeeds\x0cseparators\x1c\x1dmore\x85nel\xa0nbsp line",
    "x" * 3000 + "ab" * 2000,
    "word " * 5000,
]


def test_same_as_the_library(spark, library):
    random.seed(1)
    pool = "abcdeé ßñ'ts1!?. \n"
    texts = TEXTS + ["".join(random.choices(pool, k=random.randrange(80))) for _ in range(200)]
    rows = [(i, t, "old", 1) for i, t in enumerate(texts)] + [(None, "again", "old", 2), (3, TEXTS[3], "old", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = bpe_encode(df, PATH)
    assert out.columns == ["doc_id", "text", "token_ids", "n_tokens", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    for r in bpe_encode(df, PATH, digests=True).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_scan_and_heap_merge_alike(vocabulary):
    random.seed(2)
    for _ in range(300):
        parts = [vocabulary.inner[random.choice(b"aabbtehin")] for _ in range(random.randrange(1, 60))]
        assert merged_by_scan(list(parts), vocabulary.merges) == merged_by_heap(list(parts), vocabulary.merges)


def test_memory_stays_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr("linktally.llm.bpe.REMEMBERED", 10)
    encoder = Encoder(vocabulary)
    once = [encoder.encode(f"some words {i}") for i in range(50)]
    assert len(encoder.memory) <= 10
    assert once == [Encoder(vocabulary).encode(f"some words {i}") for i in range(50)]


def test_empty_table(spark):
    assert bpe_encode(spark.createDataFrame([], SCHEMA), PATH).collect() == []
