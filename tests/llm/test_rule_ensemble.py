import zlib

import numpy as np
from farelens.llm import rule_ensemble
from farelens.llm.common import fold, labelled
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .helpers import documents, sha

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


def test_rules_are_found_and_sparse():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 6))
    y = ((x[:, 1] > 0.6) & (x[:, 4] <= 0.5)).astype(float)
    b, rules = rule_ensemble.fit(x, y)
    score = b + sum(w * rule_ensemble.holds(r, x) for w, r in rules)
    assert ((score > 0) == (y > 0)).mean() > 0.97 and len(rules) < 120


def test_compiled_column_is_the_model(spark):
    docs = documents(spark, [(k, "word " * k + "!!" * (k % 3) + "\nLine." * (k % 5)) for k in range(40)], clash=True)
    names = list(rule_ensemble.statistics(F.lit("")))
    x = rule_ensemble.with_statistics(docs, [F.col("doc_id").alias("id")], "text").orderBy("id").drop("id").toPandas().to_numpy(float)
    model = (0.3, [(1.5, ((0, True, 60.0),)), (-2.0, ((1, False, 20.0), (9, True, 0.001)))])
    want = 1 / (1 + np.exp(-(0.3 + sum(w * rule_ensemble.holds(r, x) for w, r in model[1]))))
    got = [r.score for r in rule_ensemble.score(docs, model).orderBy("doc_id").collect()]
    assert np.allclose(got, want) and x.shape[1] == len(names)


def test_null_empty_long_and_repeated_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "x y\n" * 90_000)], clash=True)
    model = (0.0, [(1.0, ((1, True, 3.0),))])
    got = sorted((str(r.doc_id), round(r.score, 3)) for r in rule_ensemble.score(docs, model).collect())
    assert got == [("1", 0.5), ("2", 0.5), ("3", 0.5), ("3", 0.5), ("None", 0.731)]
    assert rule_ensemble.score(documents(spark, []), model).count() == 0


def test_training_rows_and_folds(spark):
    docs = documents(spark, [(k, "ok words here. " * 5 if k % 2 else "### $$$ " * 9) for k in range(400)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(300)] + [(1, None, None), (None, 1, 1), (0, 0, 0)], LABELS)
    model = rule_ensemble.train(docs, labels, allowed=fold(F.col("doc_id"), 5) != 0)
    score = {r.doc_id: r.score for r in rule_ensemble.score(docs, model).collect()}
    assert all((score[k] > 0.5) == bool(k % 2) for k in range(400))
    held = docs.select("doc_id", fold(F.col("doc_id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in held)
    flat = rule_ensemble.train(docs, labels.where("quality = 1"))
    assert flat[1] == [] and rule_ensemble.train(docs, labels.limit(0)) == (0.0, [])


def test_held_out_accuracy(spark):
    got = rule_ensemble.op9_quality(spark, "/root/testdata/sf0.01").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels, "doc_id").select("score", "predicted", "quality").collect()
    right = np.mean([(r.score >= 0.5) == (r.quality == 1) for r in rows])
    assert len(rows) > 40 and right > 0.9


def test_repeated_ids_are_one_labelled_row(spark):
    docs = documents(spark, [(1, f"text {k % 3}") for k in range(30)] + [(2, None), (2, None), (3, "x")], clash=True)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0)], LABELS)
    got = labelled(docs, labels, "quality", F.lit(True), 2, "doc_id", "text").collect()
    assert sorted((r.id, r.label, r.body) for r in got) == [(1, 1, max((f"text {k}" for k in range(3)), key=sha)), (2, 1, "")]
