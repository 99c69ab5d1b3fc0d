"""Boosted trees fitted in one job equal Spark's own, whatever the number of tasks."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import functions as F

from tidemark.operators import boosting as B
from tidemark.operators import encode as M
from tidemark.operators import train as T


def rows(spark, n=3000):
    rng = np.random.default_rng(5)
    made = []
    for i in range(n):
        x, y, kind = rng.normal(), int(rng.integers(0, 40)), "abc"[rng.integers(3)]
        p = 1 / (1 + np.exp(-(1.5 * x + (kind == "b") - 0.1 * (y % 7) * x)))
        made.append((i, float(x), float(y), kind, float(rng.random() < p)))
    df = spark.createDataFrame(made, "id long, x double, y double, kind string, label double")
    return M.encode(df, M.fit_encoder(df, ["x", "y"], ["kind"])).repartition(3, "id").cache()


def scores(model, df):
    out = model.transform(df).select("id", F.get(vector_to_array("probability"), 1).alias("p"))
    return np.array([r.p for r in out.orderBy("id").collect()])


PARAMS = {"labelCol": "label", "featuresCol": "features", "seed": 42, "maxIter": 8, "maxDepth": 4, "stepSize": 0.3}


def test_equal_to_spark_with_one_task_and_many(spark, monkeypatch):
    df = rows(spark)
    expected = GBTClassifier(**PARAMS).fit(df)
    for per in (10**9, 500):
        monkeypatch.setattr(B, "ROWS_PER_WORKER", per)
        model = B.BoostedTrees(**PARAMS).fit(df)
        assert np.allclose(scores(model, df), scores(expected, df), atol=1e-9)
        assert model.treeWeights == expected.treeWeights and model.numFeatures == expected.numFeatures
    first, second = expected.trees[0], model.trees[0]
    assert first.toDebugString.split("\n", 1)[1] == second.toDebugString.split("\n", 1)[1]
    assert model.featureImportances.toArray().sum() == pytest.approx(1)


def test_a_fit_takes_no_job_for_every_level(spark, monkeypatch):
    df = rows(spark)
    df.count()
    monkeypatch.setattr(B, "ROWS_PER_WORKER", 500)
    spark.sparkContext.setJobGroup("boosting", "fit")
    try:
        T.boosted_trees(maxIter=30, maxDepth=5).fit(df)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("boosting"))
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert 0 < jobs < 30  # Spark's own starts one for each of 150 levels


def test_samples_and_subsets_do_not_depend_on_the_tasks(spark, monkeypatch):
    df = rows(spark)
    some = PARAMS | {"subsamplingRate": 0.7, "featureSubsetStrategy": "0.6"}
    got = []
    for per in (10**9, 700):
        monkeypatch.setattr(B, "ROWS_PER_WORKER", per)
        got.append(scores(B.BoostedTrees(**some).fit(df), df))
    assert np.allclose(*got, atol=1e-9)
    whole = scores(B.BoostedTrees(**PARAMS).fit(df), df)
    assert not np.allclose(got[0], whole) and np.corrcoef(got[0], whole)[0, 1] > 0.9


def test_search_bins_once_for_all_trials_and_chooses_as_spark(spark, monkeypatch):
    df = rows(spark)
    space = {"maxIter": [2, 5, 9], "maxDepth": [1, 3, 4], "stepSize": (0.05, 0.3)}
    calls, of = [], B.Binned.of
    monkeypatch.setattr(B.Binned, "of", staticmethod(lambda *a, **k: calls.append(1) or of(*a, **k)))
    found, draws = T.random_search(df, trials=3, space=space)
    assert len(calls) == 2  # the trials together, and the refit
    own = GBTClassifier(labelCol="label", featuresCol="features", seed=42)
    f1 = MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0
    )
    maps = [{own.getParam(k): v for k, v in d.items()} for d in draws]
    expected = TrainValidationSplit(
        estimator=own, estimatorParamMaps=maps, evaluator=f1, trainRatio=0.8, seed=42
    ).fit(rows(spark))
    assert found.validationMetrics == pytest.approx(expected.validationMetrics, abs=1e-9)
    assert np.allclose(scores(found.bestModel, df), scores(expected.bestModel, df), atol=1e-9)


@pytest.mark.parametrize("label", [None, 2.0])
def test_labels_other_than_0_and_1_are_refused(spark, label):
    df = rows(spark, 50).withColumn("label", F.when(F.col("id") == 7, F.lit(label)).otherwise(F.col("label")))
    with pytest.raises(Exception, match="(?i)label"):
        B.BoostedTrees(**PARAMS).fit(df)


def test_splits_of_a_feature():
    assert B.continuous_splits(np.array([1.0, 2.0, 2.0, 4.0]), 4, 32).tolist() == [1.5, 3.0]
    assert B.continuous_splits(np.zeros(5), 5, 32).tolist() == []
    assert len(B.continuous_splits(np.arange(1.0, 1001.0), 1000, 32)) == 31
    groups = B.packed([32, 2, 32, 2, 11, 32])
    assert sorted(f for g in groups for f in g) == list(range(6))
    assert all(np.prod([[32, 2, 32, 2, 11, 32][f] for f in g]) <= B.PACKED_BINS for g in groups)
