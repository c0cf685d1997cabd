"""The pipeline: what each stage keeps, on planted cases, and the whole run."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from linktally.llm.common import cut
from linktally.llm.mixing import mix_sources
from linktally.llm.toxicity import score_toxicity
from linktally.session import scratch_path

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted(spark):
    random.seed(8)
    word = lambda: "".join(random.choices("abcdefghij", k=5))
    texts = [" ".join(word() for _ in range(120)) for _ in range(40)]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(100, texts[1].replace(" ", "\n "), "en", "src0", 1), (101, texts[2], None, None, None)]
    near = texts[3].split()
    near[60] = "changed"
    rows += [(102, " ".join(near), "en", "src1", 2), (103, None, "en", "src1", 0), (104, "", "en", None, 0), (None, "no id at all here", "en", "src2", 5)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_the_first_stage_drops_what_the_classifier_rejects(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert kept.columns == docs.columns
    predicted = {r["doc_id"] for r in score_toxicity(docs, labels).where("predicted = 1").select("doc_id").collect()}
    assert predicted and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - predicted


def test_later_stages_keep_the_right_rows_and_columns(spark):
    docs = planted(spark)
    ids = {r["doc_id"] for r in docs.collect()}
    gone = [{100, 101, 104}, {102}, set()]
    for (name, stage), lost in zip(corpus_pipeline.STAGES[1:-1], gone):
        docs = cut(stage(spark, docs, SF), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids -= lost
        assert sorted(map(str, [r["doc_id"] for r in docs.collect()])) == sorted(map(str, ids)), name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == len(ids) and out.where(F.size("token_ids") != F.col("n_tokens")).count() == 0


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
        docs = spark.createDataFrame([], SCHEMA)


def test_the_run_drops_toxic_texts_and_copies_only(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = cut(corpus_pipeline.run(spark, SF), "run")
    assert out.groupBy("doc_id").count().where("count > 1").count() == 0
    left = docs.join(out, "doc_id", "left_semi")
    assert left.groupBy("text").count().where("count > 1").count() == 0
    clean = labels.where("toxic = 0").join(docs, "doc_id")
    texts = left.select("text").distinct()
    # a clean text goes only as a copy or near copy: most of them stay
    assert clean.join(texts, "text", "left_semi").count() >= 0.85 * clean.count()


def test_the_run_gives_positions_in_the_mixed_order(spark, monkeypatch):
    """Rows sorted by position interleave the sources as the mixing stage decided."""
    random.seed(9)
    rows = [(i, f"text number {i} " + "word " * random.randrange(300), "en", f"src{min(i % 7, 2)}", i) for i in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[3:])
    path = scratch_path(spark, "mixed")
    docs.write.parquet(f"{path}/documents.parquet")
    out = corpus_pipeline.run(spark, path).select("position", "doc_id").orderBy("position").collect()
    mixed = mix_sources(docs, temper=corpus_pipeline.TEMPER).orderBy("mix_slot", "mix_place").collect()
    assert [r["position"] for r in out] == list(range(2000))
    assert [r["doc_id"] for r in out] == [r["doc_id"] for r in mixed]
