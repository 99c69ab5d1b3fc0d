"""Training, search and batch scoring with Spark ML."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, join_small, shared_dir
from .boosting import BoostedSearch, BoostedTrees
from .evaluate import evaluate_scores

LABEL = "label"
WEIGHT = "class_weight"


def with_class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights ``n / (2 * n_class)`` for a 0/1 label."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(label) == 1).alias("_n1"),
    )
    mine = F.when(F.col(label) == 1, F.col("_n1")).otherwise(F.col("_n") - F.col("_n1"))
    return join_small(df, counts, []).withColumn(
        WEIGHT, F.col("_n") / (mine * 2)
    ).drop("_n", "_n1")


#: Rows that one task of a pass takes, about; a fit makes up to thousands of passes.
ROWS_PER_TASK = 1_000_000


def written(df: DataFrame, name: str) -> DataFrame:
    """Write rows that many passes read as Parquet to the shared folder, and read them again."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_for_training(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Deal rows evenly to as many partitions as the many passes of a fit need.

    Every pass of a fit starts one task per partition, and boosting makes one
    pass per level of each tree: there is one partition per core, or a multiple
    of that where a task would get more than about :data:`ROWS_PER_TASK` rows.
    ``rows`` saves the count where it is known.
    """
    rows = df.count() if rows is None else rows
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    turns = max(1, -(-rows // (cores * ROWS_PER_TASK)))
    return df.repartition(cores * turns, *df.columns)


def fitted(estimator, train: DataFrame):
    """Fit on rows that are kept with ``persist`` and release them.

    Boosted trees read them only to bin them: they are kept on disk alone.
    """
    if isinstance(estimator, BoostedTrees | BoostedSearch):
        train = train.unpersist().persist(StorageLevel.DISK_ONLY)
    try:
        return estimator.fit(train)
    finally:
        train.unpersist()


def logistic_regression(rows: int, inverse_penalty: float = 1.0, **params) -> LogisticRegression:
    """L2 logistic regression on already scaled features.

    The penalty ``C`` of a summed loss is ``1 / (n * C)`` of the mean loss.
    """
    return LogisticRegression(
        labelCol=LABEL, featuresCol="features", weightCol=WEIGHT,
        regParam=1.0 / (rows * inverse_penalty), standardization=False, **params,
    )


def random_forest(seed: int = 42, **params) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=LABEL, featuresCol="features", weightCol=WEIGHT, seed=seed, **params
    )


def boosted_trees(seed: int = 42, **params) -> BoostedTrees:
    """Boosted trees whose fit is one job (:mod:`.boosting`)."""
    return BoostedTrees(labelCol=LABEL, featuresCol="features", seed=seed, **params)


# Fixed search space of the boosted trees: choices and uniform ranges.
SEARCH_SPACE: Mapping[str, list | tuple] = {
    "maxIter": [50, 100, 200, 300],
    "maxDepth": [3, 4, 5, 6],
    "stepSize": (0.01, 0.3),
    "subsamplingRate": (0.7, 1.0),
    "featureSubsetStrategy": (0.7, 1.0),
}


def sample_params(
    space: Mapping[str, list | tuple], trials: int, seed: int = 42
) -> list[dict[str, object]]:
    """Independent random draws: lists are choices, pairs are uniform ranges."""
    rng = random.Random(seed)
    draws = []
    for _ in range(trials):
        draw: dict[str, object] = {}
        for name, options in space.items():
            value = (
                rng.choice(options) if isinstance(options, list) else rng.uniform(*options)
            )
            draw[name] = str(value) if name == "featureSubsetStrategy" else value
        draws.append(draw)
    return draws


def random_search(
    train: DataFrame, trials: int = 4, space: Mapping[str, list | tuple] = SEARCH_SPACE,
    seed: int = 42, train_ratio: float = 0.8, parallelism: int = 2,
):
    """Random search over boosted trees by validation F1 of class 1.

    Returns the fitted ``TrainValidationSplitModel`` and the drawn parameters;
    its best model is refitted on all of ``train``.
    """
    estimator = boosted_trees(seed)
    draws = sample_params(space, trials, seed)
    maps = [{estimator.getParam(k): v for k, v in d.items()} for d in draws]
    f1 = MulticlassClassificationEvaluator(
        labelCol=LABEL, predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0
    )
    split = BoostedSearch(
        estimator=estimator, estimatorParamMaps=maps, evaluator=f1, trainRatio=train_ratio,
        parallelism=parallelism, seed=seed,
    )
    ensure_checkpoint_dir(train.sparkSession)
    return fitted(split, train), draws


def score(df: DataFrame, model, keep: Sequence[str] | None = None) -> DataFrame:
    """Batch scoring: ``prediction`` and ``probability_score`` of class 1."""
    out = model.transform(df)
    keep = list(keep if keep is not None else df.columns)
    return out.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        F.get(vector_to_array("probability"), 1).alias("probability_score"),
    )


def score_raw(df: DataFrame, encoder: PipelineModel, model, keep: Sequence[str]) -> DataFrame:
    """Encode and score a prepared table in one pass."""
    return score(encoder.transform(df), model, keep)


def evaluate(df: DataFrame, model, label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """Metrics of a model; the scores are written once, as several passes read them."""
    scored = written(score(df, model, [label, *by]), "scores")
    return evaluate_scores(
        scored.withColumn("label", F.col(label).cast("int")), "label", "probability_score", by
    )
