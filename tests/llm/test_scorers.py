"""Toxicity and quality: accuracy on held-out rows, the estimators, edge cases."""

import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from linktally.llm import hashed, quality, toxicity
from linktally.llm.quality import BAD, GOOD, NONE, cast_votes, estimate, score_quality
from linktally.llm.toxicity import fit_nnpu, score_toxicity, word_features
from linktally.llm.hashed import Rows

DATA = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, score string, kept int"


def test_toxicity_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    out = score_toxicity(docs, labels)
    assert out.columns == [*docs.columns, "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id", "left").select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["toxic"] is not None]
    toxic, clean = [r for r in held if r["toxic"]], [r for r in held if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)  # 6 % of the marked texts show nothing
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def test_scores_do_not_see_labels_language_or_id(spark):
    labels = spark.createDataFrame([(i, int(i % 5 == 1)) for i in range(100)], "doc_id long, toxic int")
    rows = [(i, "awful nasty words here" if i % 5 == 1 else "calm and friendly words", "x", 1) for i in range(100)]
    rows += [(1001, rows[1][1], "y", 2), (None, rows[1][1], "z", 3), (1, rows[1][1], "again", 1)]
    rows += [(1002, None, "x", 1), (1003, "", "x", 1), (1004, "calm " * 30_000, "x", 1)]
    out = score_toxicity(spark.createDataFrame(rows, SCHEMA), labels).collect()
    assert len(out) == len(rows) and "kept" in out[0].asDict()
    assert len({r["score"] for r in out if r["text"] == rows[1][1]}) == 1
    assert len({r["score"] for r in out if not r["text"]}) == 1
    by = {r["doc_id"]: r for r in out}
    assert by[1]["score"] > 0.5 > by[0]["score"]


def test_toxicity_learns_as_many_words_as_the_data_show(spark):
    """Forty toxic words, which take far more than a hundred buckets; a toxic text has one. Half is labelled."""
    random = np.random.default_rng(4)
    word = lambda: "".join(random.choice(list("abcdefghijklmnopqrst"), 12))
    bad, calm = [word() for _ in range(40)], [word() for _ in range(400)]
    rows = []
    for i in range(16_000):
        said = list(random.choice(calm, 30))
        rows.append((i, " ".join([*said, *[bad[i // 10 % 40]] * 2] if i % 10 == 0 else said), "x", 0))
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(16_000) if i // 400 % 2], "doc_id long, toxic int")
    out = score_toxicity(spark.createDataFrame(rows, SCHEMA), labels).where("held_out").collect()
    toxic, clean = [r for r in out if r["doc_id"] % 10 == 0], [r for r in out if r["doc_id"] % 10]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def test_toxicity_without_examples_or_rows(spark):
    labels = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    df = spark.createDataFrame([(1, "a b", None, None), (2, None, None, None)], SCHEMA)
    assert len({r["score"] for r in score_toxicity(df, labels).collect()}) == 1
    assert score_toxicity(spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_negative_risk_is_not_followed():
    """Positives that fill the unlabelled texts do not drive scores of these to zero."""
    rows = Rows(np.arange(201), np.array([5] * 200), np.ones(200))
    targets = np.array([1.0] * 100 + [0.0] * 100)
    weights, bias = fit_nnpu(targets, rows, prior=0.5)
    assert np.isfinite(weights).all() and weights[5] + bias > -1


def test_features_are_the_same_in_one_slice_or_two():
    texts = [b"Some words, SOME more", b"", b"other words words"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, bucket, value = word_features(data, ends)
    for i, t in enumerate(texts):
        _, b, v = word_features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert (bucket[row == i] == b).all() and np.allclose(value[row == i], v)


def test_em_finds_accuracies():
    random = np.random.default_rng(1)
    truth = random.random(20_000) < 0.85
    on_bad, on_good, votes_at_all = [0.7, 0.5, 0.6, 0.4], [0.99, 0.97, 0.98, 0.995], [1, 0.8, 0.9, 0.7]
    columns = []
    for b, g, v in zip(on_bad, on_good, votes_at_all):
        right = random.random(20_000) < np.where(truth, g, b)
        columns.append(np.where(random.random(20_000) < v, np.where(right == truth, GOOD, BAD), NONE))
    patterns, counts = np.unique(np.stack(columns, axis=1), axis=0, return_counts=True)
    share, accuracy, _ = estimate(patterns, counts)
    assert abs(share - 0.85) < 0.03
    assert np.abs(accuracy[0] - on_bad).max() < 0.08 and np.abs(accuracy[1] - on_good).max() < 0.02


def test_quality_keeps_clean_texts_and_finds_junk(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    rows = score_quality(docs).join(labels, "doc_id").select("quality", "kept", "score").collect()
    good, bad = [r for r in rows if r["quality"]], [r for r in rows if not r["quality"]]
    assert sum(r["kept"] for r in good) >= 0.995 * len(good)
    assert sum(not r["kept"] for r in bad) >= 0.75 * len(bad)


def test_quality_edge_cases(spark):
    rows = [(1, None, "x", 1), (1, "", "x", 1), (None, "a", "x", 1), (2, "word " * 40_000, "x", 1), (2, "OF!! " * 50, "x", 1)]
    out = score_quality(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "votes", "weak_label", "score", "kept"]
    got = {r["text"]: r for r in out.collect()}
    assert len(got) == 5 and got[None]["votes"] == got[""]["votes"] == "-" * 10
    assert score_quality(spark.createDataFrame([], SCHEMA)).collect() == []
    votes = cast_votes(np.frombuffer(b"word " * 100, np.uint8), np.array([0, 500]))
    assert votes[0][4] == BAD


@pytest.mark.parametrize("doc_id", [1, None])
def test_a_hot_id_does_not_fill_the_sample(spark, monkeypatch, doc_id):
    """A third of all rows and more under one id, or none: the driver gets rows as bounded."""
    met = []

    def watched(sample, *rest):
        met.append(sample.groupBy("target").count().collect())
        return hashed.sampled_features(sample, *rest)

    monkeypatch.setattr(quality, "sampled_features", watched)
    monkeypatch.setattr(toxicity, "sampled_features", watched)
    id_of = F.when(F.col("id") % 3 > 0, F.lit(doc_id)).otherwise(F.col("id"))
    text = F.concat(F.lit("some words of text number "), (F.col("id") % 9000).cast("string"), F.when(F.col("id") % 2 == 0, F.lit(" hateful")).otherwise(""))
    docs = spark.range(1, 30_001, 1, 6).select(id_of.cast("long").alias("doc_id"), text.alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).distinct()
    assert score_quality(docs, sample=500).count() == 30_000
    assert score_toxicity(docs, labels, positives=100, unlabelled=300).count() == 30_000
    assert sum(r["count"] for r in met[0]) <= 500
    sizes = {r["target"]: r["count"] for r in met[1]}
    assert sizes[1.0] <= 100 and 0 < sizes[0.0] <= 300
