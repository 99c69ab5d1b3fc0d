"""Binary-classifier evaluation and prediction drift."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import flag_list, positive_ratio, ratio
from ..session import join_small
from .drift import P_LIMIT, distinct_values, long_form, rank_statistics, side_moments
from .prefix import collapse, running_totals
from .sides import IS_REF, NUMERIC


def predicted(score: Column | str, threshold: float = 0.5) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return (s > threshold).cast("int")


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """True/false negatives and positives."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _scores(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    return (
        ratio(tp, tp + fp, 0.0),
        ratio(tp, tp + fn, 0.0),
        ratio(tp * 2, tp * 2 + fp + fn, 0.0),
    )


def binary_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; undefined ratios are 0."""
    c = confusion(df, label, prediction, by)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    precision, recall, f1 = _scores(tp, fp, fn)
    return c.select(
        *by,
        (tn + fp + fn + tp).alias("support"),
        ratio(tp + tn, tn + fp + fn + tp, 0.0).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
    )


def classification_report(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """Per class, macro average, weighted average and accuracy rows."""
    c = confusion(df, label, prediction, by)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    p1, r1, f1 = _scores(tp, fp, fn)
    p0, r0, f0 = _scores(tn, fn, fp)
    n0, n1 = tn + fp, fn + tp
    total = n0 + n1
    accuracy = ratio(tp + tn, total, 0.0)

    def row(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
            f.alias("f1"), support.alias("support"),
        )

    def weighted(a: Column, b: Column) -> Column:
        return ratio(a * n0 + b * n1, total, 0.0)

    rows = F.array(
        row("0", p0, r0, f0, n0),
        row("1", p1, r1, f1, n1),
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
    )
    return c.select(*by, F.inline(rows))


def _score_totals(
    df: DataFrame, label: str, order: Column, by: Sequence[str], following: Sequence[str] = (),
) -> DataFrame:
    y = F.col(label).cast("bigint")
    weighted = df.where(F.col(label).isNotNull()).select(
        *by, order.cast("double").alias("_order"), y.alias("pos"), (F.lit(1) - y).alias("neg")
    )
    distinct = collapse(weighted, by, "_order", ["pos", "neg"])
    return running_totals(distinct, by, "_order", ["pos", "neg"], following)


def auc(
    df: DataFrame, label: str, score: str, by: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve as a rank statistic, ties counted half.

    With a single class the area is 0.
    """
    run = _score_totals(df, label, F.col(score), by)
    below = F.col("cum_neg") - F.col("neg")
    return run.groupBy(*by).agg(
        ratio(
            F.sum(F.col("pos") * (below + F.col("neg") / 2.0)),
            F.max("total_pos") * F.max("total_neg"),
            0.0,
        ).alias("auc"),
        F.max("total_pos").alias("positives"),
        F.max("total_neg").alias("negatives"),
    )


def roc_points(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), thin: bool = True,
) -> DataFrame:
    """``(threshold, fpr, tpr)`` by descending score, from ``(inf, 0, 0)`` on.

    ``thin`` leaves out points on a straight segment: a point whose step equals
    the following step.  The first and last real points always stay.
    """
    run = _score_totals(df, label, -F.col(score), by, ["pos", "neg"])
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    keep = (
        first
        | F.col("next_pos").isNull()
        | (F.col("next_pos") != F.col("pos"))
        | (F.col("next_neg") != F.col("neg"))
    )
    points = run.where(keep) if thin else run
    curve = points.select(
        *by,
        (-F.col("_order")).alias("threshold"),
        ratio(F.col("cum_neg"), F.col("total_neg")).alias("fpr"),
        ratio(F.col("cum_pos"), F.col("total_pos")).alias("tpr"),
    )
    origin = (df.select(*by).distinct() if by else df.sparkSession.range(1)).select(
        *by, F.lit(math.inf).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(curve)


def evaluate_scores(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), threshold: float = 0.5
) -> DataFrame:
    """AUC next to accuracy, precision, recall and F1 at a threshold."""
    marked = df.withColumn("_pred", predicted(score, threshold))
    table = binary_metrics(marked, label, "_pred", by)
    area = auc(df, label, score, by).select(*by, "auc")
    return table.join(area, list(by)) if by else join_small(table, area, [])


def pair_scores(
    champion: DataFrame, challenger: DataFrame, key: Sequence[str]
) -> DataFrame:
    """Two scored tables of the same rows as one long table with ``model``.

    Only rows scored by both count; ``champion`` must carry the label.
    """
    both = champion.withColumnRenamed("score", "score_champion").join(
        challenger.select(*key, F.col("score").alias("score_challenger")), list(key)
    )
    return both.select(
        *key, "label",
        F.inline(
            F.array(
                F.struct(F.lit("champion").alias("model"), F.col("score_champion").alias("score")),
                F.struct(F.lit("challenger").alias("model"), F.col("score_challenger").alias("score")),
            )
        ),
    )


# ------------------------------------------------------------ prediction drift
def prediction_drift(sided: DataFrame, score: str) -> DataFrame:
    """Shift of the score distribution between the sides (population deviation)."""
    moments = side_moments(sided, [score]).agg(
        *[
            F.max(F.when(F.col(IS_REF) == F.lit(is_ref), F.col(m))).alias(f"{side}_prediction_{out}")
            for side, is_ref in (("ref", True), ("new", False))
            for m, out in (("mean", "mean"), ("std_pop", "std"))
        ]
    )
    ranks = rank_statistics(
        distinct_values(long_form(sided, [score], NUMERIC))
    ).select(
        F.col("ks_statistic").alias("prediction_ks_statistic"),
        F.col("ks_pvalue").alias("prediction_ks_pvalue"),
        (F.col("ks_pvalue") < P_LIMIT).alias("prediction_ks_drift"),
        F.col("wasserstein").alias("prediction_wasserstein"),
    )
    shift = F.abs(F.col("new_prediction_mean") - F.col("ref_prediction_mean"))
    return join_small(moments, ranks, []).select(
        "*",
        shift.alias("prediction_mean_shift"),
        positive_ratio(F.col("new_prediction_std"), F.col("ref_prediction_std"), 1.0)
        .alias("prediction_std_ratio"),
    )


def performance_drift(sided: DataFrame, label: str, score: str, limit: float = 0.05) -> DataFrame:
    """Change of accuracy, F1 and AUC between the sides.

    Scores with more than two distinct reference values are probabilities and
    are cut at 0.5; otherwise they are taken as predictions.  The new AUC needs
    more than two distinct new scores, the reference AUC and the difference need
    that on both sides; a side with one class has no AUC.
    """
    # two distinct values are told by min, max and anything strictly between
    span = sided.groupBy(IS_REF).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    inner = join_small(sided.select(IS_REF, score), span, [IS_REF])
    inner = inner.where((F.col(score) > F.col("_lo")) & (F.col(score) < F.col("_hi")))
    kind = inner.agg(
        F.coalesce(F.bool_or(IS_REF), F.lit(False)).alias("_ref"),
        F.coalesce(F.bool_or(~F.col(IS_REF)), F.lit(False)).alias("_new"),
    )
    marked = join_small(sided, kind, []).withColumn(
        "_pred", F.when(F.col("_ref"), predicted(score)).otherwise(F.col(score).cast("int"))
    )
    metrics = binary_metrics(marked, label, "_pred", [IS_REF])
    areas = auc(sided, label, score, [IS_REF]).join(
        sided.groupBy(IS_REF).agg(F.count_distinct(label).alias("_classes")), IS_REF
    ).select(IS_REF, F.when(F.col("_classes") > 1, F.col("auc")).alias("auc"))
    both = join_small(join_small(metrics, areas, [IS_REF]), kind, [])
    picks = [
        F.max(F.when(F.col(IS_REF) == F.lit(is_ref), F.col(m))).alias(f"{side}_data_{m}")
        for side, is_ref in (("ref", True), ("new", False))
        for m in ("accuracy", "f1", "auc")
    ]
    wide = both.agg(F.max("_ref").alias("_ref"), F.max("_new").alias("_new"), *picks)
    acc = F.abs(F.col("new_data_accuracy") - F.col("ref_data_accuracy"))
    f1 = F.abs(F.col("new_data_f1") - F.col("ref_data_f1"))
    area = F.abs(F.col("new_data_auc") - F.col("ref_data_auc"))
    shown = F.col("_ref") & F.col("_new")
    return wide.select(
        "ref_data_accuracy", "new_data_accuracy", "ref_data_f1", "new_data_f1",
        F.when(shown, F.col("ref_data_auc")).alias("ref_data_auc"),
        F.when(F.col("_new"), F.col("new_data_auc")).alias("new_data_auc"),
        acc.alias("accuracy_drift"),
        f1.alias("f1_drift"),
        F.when(shown, area).alias("auc_drift"),
        (F.col("ref_data_accuracy") - F.col("new_data_accuracy")).alias("performance_degradation"),
        ((acc > limit) | (f1 > limit)).alias("performance_concept_drift"),
    )


def concept_verdict(prediction: DataFrame, performance: DataFrame | None = None) -> DataFrame:
    """Concept drift from distribution, relative mean shift and performance."""
    joined = prediction
    degraded: Column = F.lit(False)
    if performance is not None:
        joined = join_small(prediction, performance, [])
        degraded = F.col("performance_concept_drift")
    scale = F.greatest(
        F.abs(F.col("ref_prediction_mean")), F.abs(F.col("new_prediction_mean")), F.lit(0.1)
    )
    indicators = flag_list(
        [
            ("prediction_distribution", F.col("prediction_ks_drift")),
            ("prediction_mean_shift", F.col("prediction_mean_shift") / scale > 0.1),
            ("performance_degradation", degraded),
        ]
    )
    return joined.withColumn("concept_drift_indicators", indicators).select(
        "*",
        (F.size("concept_drift_indicators") > 0).alias("concept_drift_detected"),
        (F.size("concept_drift_indicators") / F.lit(3.0)).alias("concept_drift_confidence"),
    )
