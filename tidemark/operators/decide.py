"""Decisions over monitor rows: severity, action, escalation, deploy gates.

A monitor row is one evaluation of one monitor:
``(monitor, ts, dataset_drift_score, feature_drift_count, total_features,
concept_drift_score, prediction_drift_score, performance_degradation, retrained)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import fixed, hours_between, lookup, percent
from . import segments
from .evaluate import evaluate_scores


@dataclass(frozen=True)
class Thresholds:
    """Fixed default thresholds of the graded response; override with ``replace``."""

    minor_score: float = 0.05
    moderate_score: float = 0.15
    major_score: float = 0.30
    concept_score: float = 0.20
    minor_features: float = 0.10
    moderate_features: float = 0.25
    major_features: float = 0.50
    minor_drop: float = 0.02
    moderate_drop: float = 0.05
    major_drop: float = 0.10
    automatic_retraining: bool = True
    cooldown_hours: int = 6
    escalation_runs: int = 3
    retraining_failures: int = 2

    def override(self, **changes) -> Thresholds:
        return replace(self, **changes)


DEFAULTS = Thresholds()

# Fixed order of severities, least to most severe.
SEVERITIES = ("none", "minor", "moderate", "major", "concept")
_RANK = {name: i for i, name in enumerate(SEVERITIES)}

# Fixed mapping of an action to the next step of the workflow.
NEXT_STEP = {
    "continue_monitoring": "no_drift_continue_monitoring",
    "log_and_monitor": "minor_drift_enhanced_logging",
    "incremental_retrain": "moderate_drift_trigger_retraining",
    "full_retrain": "major_drift_trigger_retraining",
    "architecture_review": "concept_drift_architecture_alert",
}

# Fixed recommendation texts per severity.
RECOMMENDATIONS = {
    "none": [],
    "minor": [
        "Increase monitoring frequency to detect trend patterns",
        "Review feature distributions for gradual changes",
        "Consider feature engineering improvements",
    ],
    "moderate": [
        "Analyze specific features showing highest drift",
        "Consider incremental model updates",
        "Review data quality and collection processes",
        "Implement more frequent model validation",
    ],
    "major": [
        "Conduct comprehensive data analysis",
        "Review feature engineering pipeline",
        "Consider model architecture changes",
        "Implement enhanced monitoring and alerting",
        "Review data collection and preprocessing",
    ],
    "concept": [
        "Analyze target variable relationships",
        "Review model assumptions and architecture",
        "Consider ensemble or adaptive modeling approaches",
        "Implement concept drift detection algorithms",
        "Review business logic and domain expertise",
    ],
}


def _ladder(value: Column, steps: Sequence[tuple[float, str, float]], otherwise) -> Column:
    """First step whose limit ``value`` reaches, as struct(rank, confidence)."""

    def grade(severity: str, confidence: float) -> Column:
        return F.struct(F.lit(_RANK[severity]).alias("rank"), F.lit(confidence).alias("confidence"))

    out = grade(*otherwise) if otherwise else F.lit(None)
    for limit, severity, confidence in reversed(steps):
        out = F.when(value >= limit, grade(severity, confidence)).otherwise(out)
    return F.when(value.isNotNull(), out)


def with_severity(rows: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Add ``severity`` and ``severity_confidence``.

    Four signals are graded; the most severe wins, and among equally severe
    ones the highest confidence.
    """
    share = F.when(
        F.col("total_features") > 0, F.col("feature_drift_count") / F.col("total_features")
    )
    signals = F.array(
        _ladder(
            F.col("dataset_drift_score"),
            [(limits.major_score, "major", 0.9), (limits.moderate_score, "moderate", 0.8),
             (limits.minor_score, "minor", 0.7)],
            ("none", 0.9),
        ),
        _ladder(
            share,
            [(limits.major_features, "major", 0.8), (limits.moderate_features, "moderate", 0.7),
             (limits.minor_features, "minor", 0.6)],
            ("none", 0.8),
        ),
        _ladder(F.col("concept_drift_score"), [(limits.concept_score, "concept", 0.9)], None),
        _ladder(
            F.col("performance_degradation"),
            [(limits.major_drop, "major", 0.9), (limits.moderate_drop, "moderate", 0.8),
             (limits.minor_drop, "minor", 0.7)],
            None,
        ),
    )
    worst = F.array_max(signals)
    names = F.array(*[F.lit(s) for s in SEVERITIES])
    return rows.withColumn("_worst", worst).select(
        "*",
        F.coalesce(F.get(names, F.col("_worst.rank")), F.lit("none")).alias("severity"),
        F.coalesce(F.col("_worst.confidence"), F.lit(0.0)).alias("severity_confidence"),
    ).drop("_worst")


def with_hours_since_retrain(
    rows: DataFrame, monitor: Sequence[str] = ("monitor",), ts: str = "ts",
    retrained: str = "retrained", rows_per_lane: int = segments.ROWS_PER_LANE,
) -> DataFrame:
    """Hours since the monitor's latest earlier retraining; NULL if there was none.

    A scan over time lanes (:mod:`.segments`): a monitor with most of the rows
    is spread over tasks of ``rows_per_lane`` rows.
    """
    last = segments.latest_before(
        rows, list(monitor), ts, F.col(retrained), "_last", rows_per_lane
    )
    return last.withColumn(
        "hours_since_retrain", hours_between(F.col(ts), F.col("_last"))
    ).drop("_last")


def with_action(rows: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Add ``action``, ``reasoning`` and ``next_step`` from the severity and cooldown."""
    severity = F.col("severity")
    cooling = F.coalesce(F.col("hours_since_retrain") < limits.cooldown_hours, F.lit(False))
    waiting = F.concat(
        F.initcap(severity),
        F.lit(" drift detected but retraining cooldown active ("),
        fixed(F.col("hours_since_retrain"), 1),
        F.lit(f"h < {limits.cooldown_hours}h)"),
    )
    if limits.automatic_retraining:
        moderate = ("incremental_retrain",
                    "Moderate drift detected, triggering incremental retraining with recent data")
        major = ("full_retrain",
                 "Major drift detected, triggering full model retraining with cumulative data")
    else:
        moderate = ("log_and_monitor",
                    "Moderate drift detected but automatic retraining disabled")
        major = ("architecture_review",
                 "Major drift detected but automatic retraining disabled, manual review needed")

    def choose(i: int) -> Column:
        held = F.lit("log_and_monitor") if i == 0 else waiting
        return (
            F.when(
                severity == "minor",
                ("log_and_monitor",
                 "Minor drift detected, increasing monitoring frequency and logging")[i],
            )
            .when(severity.isin("moderate", "major") & cooling, held)
            .when(severity == "moderate", moderate[i])
            .when(severity == "major", major[i])
            .when(
                severity == "concept",
                ("architecture_review",
                 "Concept drift detected, model architecture and feature engineering review "
                 "required")[i],
            )
            .otherwise(
                ("continue_monitoring",
                 "No significant drift detected, continuing normal monitoring")[i]
            )
        )

    return rows.select("*", choose(0).alias("action"), choose(1).alias("reasoning")).withColumn(
        "next_step", next_step(F.col("action"))
    )


def next_step(action: Column) -> Column:
    return lookup(action, NEXT_STEP, NEXT_STEP["continue_monitoring"])


def with_recommendations(rows: DataFrame) -> DataFrame:
    """Texts for the severity, then texts triggered by the metrics of the row."""
    general = F.array().cast("array<string>")
    for severity, texts in RECOMMENDATIONS.items():
        if texts:
            general = F.when(
                F.col("severity") == severity, F.array(*[F.lit(t) for t in texts])
            ).otherwise(general)
    specific = F.array_compact(
        F.array(
            F.when(
                F.col("feature_drift_count") > 5,
                F.concat(
                    F.lit("High feature drift count ("),
                    F.col("feature_drift_count").cast("string"),
                    F.lit(" features): Focus on most important features"),
                ),
            ),
            F.when(
                F.col("prediction_drift_score") > 0.2,
                F.lit("High prediction drift: Review model confidence and uncertainty estimates"),
            ),
            F.when(
                F.col("performance_degradation") > 0.05,
                F.concat(
                    F.lit("Performance degradation detected ("),
                    percent(F.col("performance_degradation"), 1),
                    F.lit("): Prioritize model retraining"),
                ),
            ),
        )
    )
    return rows.withColumn("recommendations", F.concat(general, specific))


def with_escalation(
    rows: DataFrame, limits: Thresholds = DEFAULTS, monitor: Sequence[str] = ("monitor",),
    ts: str = "ts", failures: str | None = None, rows_per_lane: int = segments.ROWS_PER_LANE,
) -> DataFrame:
    """Add the current run length of major drift and whether to involve a person.

    The run is a scan over time lanes (:mod:`.segments`), so one monitor with
    most of the rows is spread over tasks of ``rows_per_lane`` rows.  A null
    severity breaks the run.
    """
    counted = segments.run_length(
        rows, list(monitor), ts, F.col("severity") == "major", "consecutive_major", rows_per_lane
    )
    failed = F.col(failures) > limits.retraining_failures if failures else F.lit(False)
    return counted.withColumn(
        "escalate",
        (F.col("consecutive_major") >= limits.escalation_runs)
        | F.coalesce(F.col("severity") == "concept", F.lit(False))
        | F.coalesce(failed, F.lit(False)),
    )


def respond(rows: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """The whole graded response for a table of monitor rows."""
    out = with_hours_since_retrain(with_severity(rows, limits))
    return with_escalation(with_recommendations(with_action(out, limits)), limits)


# ----------------------------------------------------------------------- gates
DRIFT_GATE = 0.30
REGRESSION_LIMIT = -0.02
IMPROVEMENT = 0.02


def drift_gate(
    runs: DataFrame, limit: float = DRIFT_GATE, force: bool | str = False
) -> DataFrame:
    """``RETRAIN`` or ``EVALUATE_ONLY`` per drift run, with the reason.

    Drift counts when the dataset verdict says so or the share of drifted
    columns is strictly above ``limit``; ``force`` is a flag or a column name.
    """
    forced = F.col(force) if isinstance(force, str) else F.lit(force)
    share = F.coalesce("drift_share", F.lit(0.0))
    detected = F.coalesce("dataset_drift", F.lit(False)) | (share > limit)
    shown = fixed(share, 3)
    return runs.withColumn("drift_detected", detected).select(
        "*",
        F.when(detected | forced, "RETRAIN").otherwise("EVALUATE_ONLY").alias("gate"),
        F.when(detected, F.concat(F.lit("drift_share="), shown, F.lit(" exceeds threshold")))
        .when(forced, F.lit("force_retrain=True"))
        .otherwise(F.concat(F.lit("no drift, drift_share="), shown))
        .alias("gate_reason"),
    )


def model_scores(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Champion and challenger metrics on one row, from ``(label, model, score)``."""
    table = evaluate_scores(scored, "label", "score", [*by, "model"])
    return table.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("model") == model, F.col(m))).alias(f"{out}_{m}")
            for model, out in (("champion", "prod"), ("challenger", "new"))
            for m in ("auc", "f1", "precision", "recall")
        ],
        F.max("support").alias("test_rows"),
    )


def quality_gate(
    scores: DataFrame, metric: str = "auc", threshold: float = IMPROVEMENT
) -> DataFrame:
    """Approve any improvement; the reason tells a clear one from a minor one."""
    if metric not in ("auc", "f1"):
        raise ValueError(f"unknown metric {metric!r}")
    change = F.col(f"new_{metric}") - F.col(f"prod_{metric}")
    shown, name = fixed(F.col("improvement"), 3), metric.upper()
    return scores.withColumn("improvement", change).select(
        "*",
        F.lit(metric).alias("metric"),
        (F.col("improvement") >= 0).alias("approve"),
        F.when(
            F.col("improvement") >= threshold,
            F.concat(F.lit(f"{name} improved by "), shown, F.lit(f" (>= {threshold:.3f} threshold)")),
        )
        .when(F.col("improvement") >= 0, F.concat(F.lit(f"Minor {name} improvement: "), shown))
        .otherwise(F.concat(F.lit(f"{name} regression: "), shown))
        .alias("reason"),
    )


def three_way_gate(scores: DataFrame, threshold: float = IMPROVEMENT) -> DataFrame:
    """``DEPLOY`` on a clear improvement, ``DEPLOY_REFRESH`` on any, else ``SKIP``."""
    change = F.col("new_auc") - F.col("prod_auc")
    return scores.withColumn(
        "decision",
        F.when(change >= threshold, "DEPLOY").when(change >= 0, "DEPLOY_REFRESH").otherwise("SKIP"),
    )


def regression_gate(scores: DataFrame, limit: float = REGRESSION_LIMIT) -> DataFrame:
    """Deploy unless the new model loses more than ``-limit`` of AUC.

    A missing champion (``prod_auc`` NULL) always means deploy.
    """
    first = F.col("prod_auc").isNull()
    change = F.when(first, F.col("new_auc")).otherwise(F.col("new_auc") - F.col("prod_auc"))
    shown = fixed(F.col("auc_improvement"), 3)
    delta = F.col("auc_improvement")
    return scores.withColumn("auc_improvement", change).select(
        "*",
        F.when(first | (delta >= 0), "DEPLOY")
        .when(delta >= limit, "DEPLOY_REFRESH")
        .otherwise("SKIP")
        .alias("decision"),
        F.when(first, F.lit("No production model - deploying first model"))
        .when(delta >= 0, F.concat(F.lit("AUC maintained/improved by "), shown))
        .when(
            delta >= limit,
            F.concat(F.lit("Minor AUC regression ("), shown, F.lit(f") within threshold ({limit})")),
        )
        .otherwise(F.concat(F.lit("AUC regression "), shown, F.lit(f" exceeds threshold ({limit})")))
        .alias("reason"),
    )


def production_only(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metrics of the unchanged production model for a batch without drift.

    Logged as both the new and the production result.
    """
    table = evaluate_scores(scored, "label", "score", by)
    pairs = [
        F.col(m).alias(f"{side}_{m}_test")
        for side in ("new", "prod")
        for m in ("auc", "f1", "precision", "recall")
    ]
    return table.select(
        *by, *pairs, F.lit(0.0).alias("auc_improvement"), F.lit(0.0).alias("f1_improvement"),
        F.lit("SKIP_NO_DRIFT").alias("decision"),
    )


def compare_metrics(
    baseline: DataFrame, new: DataFrame, by: Sequence[str] = (), max_drop_pct: float = 5.0
) -> DataFrame:
    """Metric-by-metric change against a baseline; both tables are (metric, value)."""
    joined = new.select(*by, "metric", F.col("value").alias("new_value")).join(
        baseline.select("metric", F.col("value").alias("baseline")), "metric"
    )
    change = F.col("new_value") - F.col("baseline")
    pct = F.when(F.col("baseline") > 0, change / F.col("baseline") * 100).otherwise(F.lit(0.0))
    return joined.select(
        *by, "metric", "baseline", "new_value", change.alias("change"), pct.alias("change_percent"),
        (pct >= -max_drop_pct).alias("maintained"),
    )


def overall_assessment(compared: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return compared.groupBy(*by).agg(
        F.when(F.bool_and("maintained"), "maintained").otherwise("degraded").alias("assessment")
    )

