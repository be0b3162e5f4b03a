import itertools

import numpy as np
from pyspark.sql import functions as F

import brute
from conftest import DATA
from ferry.llm import quality
from ferry.llm.common import table


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=quality.FEATURES).astype(np.float32), rng.normal(size=(quality.FEATURES, quality.RANK)).astype(np.float32))
    rows = [(rng.integers(0, quality.FEATURES, 12).astype(np.int32), rng.normal(size=12).astype(np.float32)) for _ in range(5)]
    for (n, v), got in zip(rows, m.scores(rows)):
        raw = 0.3 + (m.linear[n] * v).sum() + sum(float(m.factors[n[i]] @ m.factors[n[j]]) * v[i] * v[j] for i, j in itertools.combinations(range(12), 2))
        assert abs(got - 1 / (1 + np.exp(-np.clip(raw, -30, 30)))) < 1e-3


def test_held_out_accuracy(spark):
    """Trained on the larger table, judged on rows it never saw."""
    data = DATA.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    rows = quality.quality_report(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert len(rows) > 60 and right > 0.95
    good = [r.predicted for r in rows if r.quality == 1]
    assert sum(good) >= 0.98 * len(good)


def test_the_same_rows_give_the_same_scores_whatever_labels_are_held_out(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    a = {r.id: r.score for r in quality.score(docs, quality.train(docs, labels)).collect()}
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    changed = docs.repartition(5).withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert a == {r.id: r.score for r in quality.score(changed, quality.train(changed, flipped)).collect()}


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(brute.TEXTS))] + [(0, 1, 0), (None, 1, 0), (3, None, 0), (99, 7, 0)], "doc_id long, quality int, toxic int")
    for ids in (None, [None] * 3 + [7, 7] + list(range(10, 26))):
        docs = brute.documents(spark, ids=ids)
        rows = quality.quality_report(docs, labels).collect()
        assert len(rows) == len(brute.TEXTS) and all(0 <= r.score <= 1 for r in rows)
        assert quality.accepted(docs, labels).columns == docs.columns
    none = labels.filter("doc_id < 0")
    assert {r.score for r in quality.quality_report(brute.documents(spark), none).collect()} == {0.5}
    assert quality.quality_report(brute.documents(spark, []), labels).count() == 0
    assert quality.accepted(brute.documents(spark, []), labels).count() == 0
