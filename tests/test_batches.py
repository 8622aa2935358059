"""Counts stored by batch, audits on write, merged sketches, models bound to their vocabulary."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chorale.operators import corpus, joint, learning
from chorale.operators.tfidf import TfidfModel, TfidfParams
from chorale.sources.checks import audited_write
from chorale.streaming import batches

ROWS = "id long, polarite string, ton string, target string"


def labelled(spark, labels):
    return spark.createDataFrame([(i, p, "Autres", "Autre") for i, p in enumerate(labels)], ROWS)


def counts(spark, out, until=None):
    return {(r.axis, r.label): r["count"] for r in batches.running_counts(spark, out, until).collect()}


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    batches.write_batch(labelled(spark, "ab"), 0, out, batches.label_counts)
    batches.write_batch(labelled(spark, "a"), 1, out, batches.label_counts)
    expected = {("polarite", "a"): 2, ("polarite", "b"): 1, ("ton", "Autres"): 3, ("target", "Autre"): 3}
    assert counts(spark, out) == expected
    batches.write_batch(labelled(spark, "a"), 1, out, batches.label_counts)
    assert counts(spark, out) == expected
    assert counts(spark, out, until=0)["polarite", "a"] == 1
    stored = batches.read_batches(spark, out, ROWS)
    assert sorted((r.batch, r.id) for r in stored.collect()) == [(0, 0), (0, 1), (1, 0)]


def test_predicted_tones_count_one_by_one(spark):
    rows = spark.createDataFrame([("p", ["x", "y"], "t"), ("p", ["x"], "t")], "polaritePred string, tonPred array<string>, targetPred string")
    got = {(r.axis, r.label): r["count"] for r in batches.prediction_counts(rows).collect()}
    assert got == {("polarite", "p"): 2, ("ton", "x"): 2, ("ton", "y"): 1, ("target", "t"): 2}


def test_audit_counts_while_writing(spark, tmp_path):
    rows = [(1, "x", "a;b"), (1, None, "c"), (None, " ", ""), (2, "", None)]
    df = spark.createDataFrame(rows, "id long, text string, ton string")
    audit = audited_write(df, str(tmp_path / "t"), labels={"ton": ["a", "b"]}).first()
    assert (audit.rows, audit.null_ids, audit.null_texts, audit.empty_texts, audit.bad_ton, audit.distinct_ids) == (4, 1, 1, 2, 1, 2)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    with pytest.raises(ValueError, match="audit"):
        audited_write(df.drop("text"), str(tmp_path / "u"))


def test_sketches_of_parts_merge(spark):
    df = spark.range(6000).select((F.col("id") % 3).alias("part"), F.concat_ws(" ", F.col("id").cast("string"), F.lit("all")).alias("text"))
    sketches = corpus.vocabulary_sketches(df, "part")
    assert sketches.count() == 3
    assert abs(corpus.merged_vocabulary(sketches).first().vocabSize - 6001) < 60
    assert corpus.merged_vocabulary(sketches.limit(0)).first().vocabSize == 0


def test_a_foreign_vocabulary_is_refused(spark, tmp_path):
    own, foreign = (TfidfModel.fit(spark.createDataFrame([(t,)] * 4, "text string"), params=TfidfParams(max_df=1.0)) for t in ("bravo", "calme"))
    classes = {"polarite": ["a", "b"], "target": ["c"], "ton": ["d"]}
    axes = joint.stack(classes, {"polarite", "target"})
    size = own.vocabulary.count()
    model = learning.MessageClassifier(classes, {}, linear=joint.LinearModel(axes, np.arange((size + 1) * 4.0).reshape(size + 1, 4)))
    model.save(spark, str(tmp_path / "m"), own)
    own.save(str(tmp_path / "v"))
    loaded = learning.MessageClassifier.load(spark, str(tmp_path / "m"), TfidfModel.load(spark, str(tmp_path / "v"), own.params))
    assert np.array_equal(loaded.linear.weights, model.linear.weights) and loaded.classes == classes
    with pytest.raises(ValueError, match="another vocabulary"):
        learning.MessageClassifier.load(spark, str(tmp_path / "m"), foreign)
