"""Quality classifier and toxicity grades: held-out accuracy, and odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradelake.llm import quality, queries, sampling, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("toxic", "label")


def test_quality_of_held_out_rows(spark, labels):
    out = queries.op8_quality_classifier(spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    got = out.join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 900 and np.mean([r.predicted == r.quality for r in got]) > 0.97


def test_class_prior_is_found():
    r = np.random.default_rng(0)
    for prior in (0.3, 0.6, 0.9):
        positive = r.normal(2, 1, 8000)
        mixed = np.concatenate((r.normal(2, 1, int(8000 * prior)), r.normal(-2, 1, 8000 - int(8000 * prior))))
        assert abs(quality.class_prior(positive, mixed) - prior) < 0.06


def test_non_negative_risk_separates():
    r = np.random.default_rng(1)
    positive = r.normal(1.5, 1, (3000, 4))
    good = r.random(6000) < 0.7
    mixed = np.where(good[:, None], r.normal(1.5, 1, (6000, 4)), r.normal(-1.5, 1, (6000, 4)))
    net = quality.fit(positive, mixed, 0.7, epochs=20)
    assert np.mean((net.forward(mixed)[2] > 0) == good) > 0.97


def test_labels_of_held_out_rows_are_not_learned(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = labels.select("doc_id", "quality")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = (quality.scored(docs, quality.train(docs, x)[0]).orderBy("doc_id").collect() for x in (labels, turned))
    assert one == other


def test_quality_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = odd_docs.select("doc_id", F.lit(1).alias("quality"))
    model, prior = quality.train(odd_docs, labels)
    got = quality.scored(odd_docs, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.scored(no_docs, model).collect() == []
    none, _ = quality.train(odd_docs, labels.limit(0))
    assert none is None and {r.score for r in quality.scored(odd_docs, none).collect()} == {0.5}
    assert quality.train(no_docs, labels)[0] is None


def test_sample_does_not_depend_on_texts_that_many_rows_share(spark):
    """A third of all rows has one text, a third of those no id: the sample keeps to its bound and has its share of them."""
    docs = spark.range(9000).select(F.when(F.col("id") % 9 != 0, F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") % 3 == 0, "copyright").otherwise(F.concat(F.lit("words of "), "id")).alias("text"))
    chosen = docs.filter(sampling.by_hash(3000, 9000, quality._own_id())).collect()
    assert abs(len(chosen) - 3000) < 200
    assert abs(sum(r.text == "copyright" for r in chosen) - 1000) < 150 and abs(sum(r.doc_id is None for r in chosen) - 333) < 100


def test_scores_of_all_rows_are_counted(spark, odd_docs, odd_rows):
    model = quality.fit(*np.random.default_rng(1).normal(size=(2, 50, quality.features(pa.array(["a"])).shape[1])), None, epochs=1)
    assert quality.score_counts(odd_docs, model).sum() == len(odd_rows)


def test_toxic_texts_are_found_and_clean_ones_left(spark, labels):
    got = queries.op7_toxicity(spark, SF).join(labels, "doc_id").collect()
    toxic, clean = [r for r in got if r.label == 1], [r for r in got if r.label == 0]
    assert np.mean([r.toxic for r in toxic]) > 0.9 and np.mean([r.toxic for r in clean]) < 0.01
    assert {r.grade for r in got} == {0, 1, 2} and all(0 <= r.severity <= 2 for r in got)


def test_ordinal_fit_finds_weights_and_thresholds():
    r = np.random.default_rng(2)
    n, weights, cut = 20000, np.array([2.0, -1.0, 0.5]), np.array([0.0, 1.5])
    x = r.normal(size=(n, 3))
    latent = x @ weights + r.logistic(size=n)
    grade = (latent[:, None] > cut[None, :]).sum(1)
    rows, columns = np.repeat(np.arange(n), 3), np.tile(np.arange(3), n)
    w, t = toxicity.fit(rows, columns, x.ravel(), grade, 3, 3, ridge=0)
    assert np.abs(w - weights).max() < 0.1 and np.abs(t - cut).max() < 0.1


def test_toxicity_of_odd_rows(odd_docs, odd_rows, no_docs):
    grades = odd_docs.select("doc_id", (F.col("doc_id") % 3).cast("int").alias("grade"))
    model = toxicity.train(toxicity.labelled(odd_docs, grades), least=-99)
    got = toxicity.graded(odd_docs, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.severity <= 2 for r in got)
    assert toxicity.graded(no_docs, model).collect() == []
    assert toxicity.train(toxicity.labelled(odd_docs, grades.limit(0))) is None
    assert {r.severity for r in toxicity.graded(odd_docs, None).collect()} == {0.0}
