import numpy as np
from cases import documents, odd_documents
from pyspark.sql import functions as F

from trendloom.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = q.score(docs, q.fit(docs, labels)).join(labels, "doc_id").where(
        q.fold("doc_id", q.FOLDS) == q.HELD_OUT).toPandas()
    good, bad = scored[scored.quality == 1], scored[scored.quality == 0]
    assert (good.predicted == 1).mean() >= 0.98
    assert (bad.predicted == 0).mean() >= 0.8
    assert good.score.min() > 0 and scored.score.between(0, 1).all()
    assert (scored.predicted == (scored.score >= 0.3)).all()


def test_training_is_repeatable_and_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one, two = (q.fit(d, labels, size=40) for d in (docs, docs.repartition(5)))
    assert np.array_equal(one, two)


def test_odd_rows(spark):
    rows = odd_documents()
    docs = documents(spark, rows).withColumns({"score": F.lit("x"), "_key": F.lit(1)})
    labels = spark.createDataFrame(
        [(1, 1, 0), (7, 0, 0), (7, 1, None), (None, 1, 0), (5, None, 0), (99, 0, 1), (1, 1, 0)],
        "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    weights = q.fit(docs, labels)
    got = q.score(docs, weights).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (2, 3, 4)}
    assert len(empty) == 1  # the bias alone


def test_empty_tables(spark):
    docs, labels = documents(spark, []), spark.createDataFrame([], "doc_id long, quality int")
    weights = q.fit(docs, labels)
    assert not weights.any() and q.score(docs, weights).count() == 0
    some = q.score(documents(spark, [(1, "a b")]), weights).first()
    assert some.score == 0.5


def test_features_per_text():
    data = np.frombuffer(b"one two ONE!!x", np.uint8)
    indices, bounds = q.features(data, np.array([0, 7, 7, 14]), 18)
    assert bounds.tolist() == [0, 10, 10, 15]
    alone, _ = q.features(data[:7], np.array([0, 7]), 18)
    assert indices[:10].tolist() == alone.tolist()
