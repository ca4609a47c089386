import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from larkspur.operators import metrics


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label int, prediction int")


def one(df):
    return df.first().asDict()


def test_binary(spark):
    df = scored(spark, [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] + [(0, 0)] * 3)
    got = one(metrics.averages(metrics.class_scores(metrics.confusion(df))))
    p1, r1, p0, r0 = 6 / 7, 6 / 8, 3 / 5, 3 / 4
    assert got["accuracy"] == 9 / 12 and got["n"] == 12 and got["n_classes"] == 2
    assert got["precision"] == pytest.approx((8 * p1 + 4 * p0) / 12)
    assert got["recall"] == pytest.approx((8 * r1 + 4 * r0) / 12)
    f1 = (8 * 2 * p1 * r1 / (p1 + r1) + 4 * 2 * p0 * r0 / (p0 + r0)) / 12
    assert got["f1_score"] == pytest.approx(f1)


def test_class_never_true_and_never_predicted(spark):
    df = scored(spark, [(0, 0), (0, 2), (1, 0)])
    rows = {r["class"]: r for r in metrics.class_scores(metrics.confusion(df)).collect()}
    assert (rows[1].precision, rows[1].recall) == (0.0, 0.0) and (rows[2].support, rows[2].recall) == (0, 0.0)
    dense = {(r.label, r.prediction): r.n for r in metrics.dense_confusion(metrics.confusion(df)).collect()}
    assert len(dense) == 9 and sum(dense.values()) == 3 and dense[(2, 2)] == 0 and dense[(0, 2)] == 1


def test_report_lists_only_beyond_two_classes(spark):
    two = one(metrics.evaluation_report(scored(spark, [(0, 0), (1, 1)])))
    assert two["precision_per_class"] is None and two["class_distribution"] == {"0": 1, "1": 1}
    three = one(metrics.evaluation_report(scored(spark, [(0, 0), (1, 1), (2, 1)])))
    assert three["recall_per_class"] == [1.0, 1.0, 0.0] and three["test_samples"] == 3


def test_one_class_has_no_roc_area(spark):
    df = spark.createDataFrame([(1, 1, 0.5)] * 3, "label int, prediction int, score double")
    got = one(metrics.evaluation_report(df, score="score"))
    assert got["roc_auc"] is None and got["accuracy"] == 1.0


def test_roc_area_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, score double")
    assert metrics.roc_auc(df).first()[0] == 3.5 / 4


def test_roc_area_equals_the_evaluator(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.25)).otherwise(F.round(F.rand(5), 3)).alias("score"),
        (F.rand(6) < 0.4).cast("int").alias("label"),
    ).persist()
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    area = metrics.roc_auc(df.repartition(5)).first()[0]
    assert area == pytest.approx(judge.evaluate(df), abs=1e-12)
    flipped = metrics.roc_auc(df.withColumn("score", 1 - F.col("score"))).first()[0]
    assert flipped == pytest.approx(1 - area, abs=1e-12)


def test_batch_report(spark):
    df = scored(spark, [(0, 0), (1, 0), (None, 1)])
    assert one(metrics.batch_report(df, "label"))["n"] == 2
    assert metrics.batch_report(df, "no_target").collect() == []
    assert metrics.batch_report(df.where("false"), "label").collect() == []


def test_text_classes(spark):
    df = spark.createDataFrame([("yes", "yes"), ("no", "yes")], "label string, prediction string")
    assert one(metrics.averages(metrics.class_scores(metrics.confusion(df))))["accuracy"] == 0.5


def test_regression(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 2.0)], "label double, prediction double")
    assert one(metrics.regression_report(df)) == {"rmse": 5 ** 0.5, "mae": 2.0}
