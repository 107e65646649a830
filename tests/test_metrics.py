import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ringcast.operators import metrics


def scored(spark, n, seed, ties):
    rng = random.Random(seed)
    rows = [
        (int(rng.random() < 0.3), 0.5 if rng.random() < ties else round(rng.random(), 3), rng.randrange(2))
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, "target int, score double, pred int")


@pytest.mark.parametrize("slices", [2, 5, 64])
def test_running_totals(spark, slices):
    rng = random.Random(slices)
    rows = [(v / 7, rng.randrange(9)) for v in rng.sample(range(10000), 500)]
    df = spark.createDataFrame(rows, "t double, n long")
    got = {r.t: r.cum_n for r in metrics.running_totals(df, "t", ["n"], slices).collect()}
    assert len(got) == 500
    total = 0
    for t, n in sorted(rows, reverse=True):
        total += n
        assert got[t] == total


@pytest.mark.parametrize("ties", [0.0, 0.4, 1.0])
def test_auc_equals_evaluator_and_pairs(spark, ties):
    rows, df = scored(spark, 400, 3, ties)
    got = metrics.roc_auc(df).first().roc_auc
    pairs = [(a[1] > b[1]) + (a[1] == b[1]) / 2 for a in rows if a[0] for b in rows if not b[0]]
    assert math.isclose(got, sum(pairs) / len(pairs), rel_tol=1e-12)
    ready = df.withColumn("raw", F.col("score"))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="target", numBins=0)
    assert math.isclose(got, evaluator.evaluate(ready.withColumn("target", F.col("target").cast("double"))), rel_tol=1e-9)


def test_curves(spark):
    rows, df = scored(spark, 200, 5, 0.3)
    p, n = sum(r[0] for r in rows), sum(1 - r[0] for r in rows)
    roc = {r.threshold: r for r in metrics.roc_curve(df).collect()}
    pr = {r.threshold: r for r in metrics.pr_curve(df).collect()}
    assert len(roc) == len({r[1] for r in rows}) + 1
    for t in {r[1] for r in rows}:
        tp = sum(r[0] for r in rows if r[1] >= t)
        fp = sum(1 - r[0] for r in rows if r[1] >= t)
        assert math.isclose(roc[t].tpr, tp / p) and math.isclose(roc[t].fpr, fp / n)
        assert math.isclose(pr[t].precision, tp / (tp + fp)) and math.isclose(pr[t].recall, tp / p)
    assert (roc[None].fpr, roc[None].tpr) == (0.0, 0.0)
    assert (pr[None].precision, pr[None].recall) == (1.0, 0.0)


def test_precision_recall(spark):
    rows, df = scored(spark, 300, 7, 0.0)
    got = metrics.precision_recall(df).first()
    hit = sum(1 for r in rows if r[0] and r[2])
    assert math.isclose(got.precision, hit / sum(r[2] for r in rows))
    assert math.isclose(got.recall, hit / sum(r[0] for r in rows))


def test_nothing_predicted(spark):
    df = spark.createDataFrame([(1, 0.2, 0), (0, 0.1, 0)], "target int, score double, pred int")
    assert tuple(metrics.precision_recall(df).first()) == (0.0, 0.0)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.1)], "target int, score double")
    assert metrics.roc_auc(df).first().roc_auc is None


@pytest.mark.parametrize("bad", [None, float("nan")])
@pytest.mark.parametrize("measure", [metrics.roc_auc, metrics.roc_curve, metrics.pr_curve])
def test_scores_without_a_place_raise(spark, bad, measure):
    df = spark.createDataFrame([(1, 0.9), (0, bad), (0, 0.2)], "target int, score double")
    with pytest.raises(Exception, match="NULL or NaN"):
        measure(df).collect()


def test_no_rows(spark):
    df = spark.createDataFrame([], "target int, score double, pred int")
    assert [tuple(r) for r in metrics.roc_auc(df).collect()] == [(None,)]
    assert [tuple(r) for r in metrics.roc_curve(df).collect()] == [(None, 0.0, 0.0)]
    assert [tuple(r) for r in metrics.pr_curve(df).collect()] == [(None, 1.0, 0.0)]
    assert tuple(metrics.precision_recall(df).first()) == (0.0, 0.0)
