"""From documents to token ids: toxicity, copies, near copies, mixture, tokens.

Every stage takes what its predecessor kept and returns the columns of
``documents``; the last one returns tokens and each text's place in the mixed
stream. Each is written as Parquet and read again before the next, so that a lost
executor never costs more than a stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktally.llm.bpe import bpe_encode
from linktally.llm.common import cut, numbered, quoted
from linktally.llm.exact_dedup import exact_dedup
from linktally.llm.jaccard import jaccard_components
from linktally.llm.mixing import mix_sources
from linktally.llm.toxicity import score_toxicity

#: Target weights of sources are their sizes to this power.
TEMPER = 0.5


def _columns(docs: DataFrame) -> list:
    return [F.col(quoted(c)) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(docs, labels).where("predicted = 0").select(*_columns(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, white space aside, the one with the least id."""
    return exact_dedup(docs).where("kept").select(*_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group linked by five-word shingles at 0.8.

    Documents without an id stay.
    """
    placed = jaccard_components(docs, shingle_words=5, percent=80)
    kept = placed.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi")
    return named.select(*_columns(docs)).unionByName(docs.where("doc_id IS NULL"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixed stream: sorted over the files, in order of their names."""
    return mix_sources(docs, temper=TEMPER).orderBy("mix_slot", "mix_place").select(*_columns(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, the text that they decode to, and ``position`` in the mixed stream.

    The position counts from 0 over the files of the stage before, in order of their
    names: a reader sorts by it, whatever way the rows were read here.
    """
    placed = numbered(docs.select("doc_id", "lang", "source", "text"), "position")
    encoded = bpe_encode(placed, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("position", "doc_id", "lang", "source", "n_tokens", "token_ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix),
    ("BPE encoding and decoding", encode),
]

#: No stage but the second can be written in SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = cut(docs, f"pipeline-{place}")
    return docs
