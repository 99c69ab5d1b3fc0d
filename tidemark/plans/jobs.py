"""End-to-end jobs: drift run, retraining data, scoring, baseline, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import cleaning, combine, consensus, decide, report, sampling
from ..operators.contract import encounter_contract, split_by_contract
from ..operators.drift import feature_table
from ..operators.evaluate import (
    concept_verdict, evaluate_scores, performance_drift, prediction_drift,
)
from ..operators.sides import feature_kinds, stack_sides
from ..operators.train import score_raw
from ..sources import runlog, tables

DRIFT_EXPERIMENT = "drift_monitoring"
TRAINING_EXPERIMENT = "training"
DRIFT_METRICS = (
    "ks_drift_count", "psi_drift_count", "chi2_drift_count", "avg_ks_statistic", "avg_psi",
    "avg_wasserstein", "avg_js_divergence", "statistical_drift_share",
)
CONCEPT_METRICS = (
    "prediction_mean_shift", "prediction_std_ratio", "prediction_ks_statistic",
    "prediction_ks_pvalue", "prediction_wasserstein", "concept_drift_detected",
    "concept_drift_confidence",
)


def drift_run(
    reference: DataFrame, current: DataFrame, batch_number: int, log_path: str | None = None,
    features: Mapping[str, str] | None = None, tests: tuple[str, str] = ("ks", "chi2"),
    threshold: float = consensus.DATASET_SHARE, on_error: str = "raise",
    score: str | None = None, label: str | None = None,
) -> DataFrame:
    """Verdict for one batch against the reference, optionally logged.

    ``score`` names a column of model scores on both sides, ``label`` that of
    the true 0/1 class; with a score, concept drift is the sixth indicator, and
    with a label the change of performance belongs to it.  Neither column is a
    feature then.  The log row holds the counts per test, the metric averages,
    the shares, the confidence and the concept metrics.

    With ``on_error='assume_drift'`` a failing computation yields a row that
    assumes drift, with ``status`` telling so.
    """
    if on_error not in ("raise", "assume_drift"):
        raise ValueError(f"unknown on_error {on_error!r}")
    spark = current.sparkSession
    kinds = dict(features or feature_kinds(reference))
    kinds = {f: k for f, k in kinds.items() if f not in (score, label)}
    measured = list(DRIFT_METRICS) + (list(CONCEPT_METRICS) if score else [])
    try:
        sided = stack_sides(reference, current)
        concept = None
        if score is not None:
            concept = concept_verdict(
                prediction_drift(sided, score),
                performance_drift(sided, label, score) if label is not None else None,
            )
        columns = consensus.column_drift(feature_table(sided, kinds), *tests)
        summary = consensus.drift_summary(columns, threshold=threshold)
        decided = consensus.consensus(summary, concept=concept)
        if concept is not None:
            decided = decided.drop("concept_drift_detected").crossJoin(F.broadcast(concept))  # one row
        row = decided.select(
            "n_drifted_columns", "n_columns", "drift_share", "dataset_drift", "consensus_drift",
            "confidence_score", F.array_join("drift_indicators", ",").alias("indicators"), "status",
            *[F.col(m).cast("double").alias(m) for m in measured],
        )
        if on_error == "assume_drift":
            # the verdict is one row; computing it here is what can fail
            row = spark.createDataFrame(row.collect(), row.schema)
    except Exception:
        if on_error == "raise":
            raise
        row = consensus.assumed_drift(spark, len(kinds)).select(
            "*", F.lit(True).alias("consensus_drift"), F.lit(0.0).alias("confidence_score"),
            F.lit("").alias("indicators"), F.lit("ERROR_ASSUMED_DRIFT").alias("status"),
            *[F.lit(None).cast("double").alias(m) for m in measured],
        )
    row = row.withColumn("batch_number", F.lit(batch_number))
    if log_path is not None:
        runlog.append(
            runlog.run_rows(
                row, F.lit(f"drift_batch_{batch_number}"), DRIFT_EXPERIMENT, F.current_timestamp(),
                params={"batch_number": F.col("batch_number")},
                metrics={
                    "drift_share": F.col("drift_share"),
                    "n_drifted_columns": F.col("n_drifted_columns"),
                    "n_total_columns": F.col("n_columns"),
                    "dataset_drift": F.col("dataset_drift").cast("int"),
                    "consensus_drift": F.col("consensus_drift").cast("int"),
                    "confidence_score": F.col("confidence_score"),
                    **{m: F.col(m) for m in measured},
                },
                tags={"status": F.col("status"), "indicators": F.col("indicators")},
            ),
            log_path,
        )
    return row


def retraining_data(
    initial: Sequence[DataFrame], batches: DataFrame, batch: DataFrame, batch_number: int,
    key: Sequence[str], label: str | None = S.TARGET, held_out: float = 0.3,
    validation: float = 0.2, seed: int = 42,
) -> DataFrame:
    """Cumulative training table for a batch with its ``part``: train or validation.

    The batch gives ``1 - held_out`` of its rows; initial sets and all earlier
    batches are added, duplicates removed, and the result split again.
    """
    train_part = sampling.stratified_split(batch, key, label, held_out, seed).where(
        "split = 'train'"
    ).drop("split")
    merged = combine.cumulative_training_set(
        initial, batches, batch_number, train_part, tables.BATCH
    )
    marked = sampling.stratified_split(merged, key, label, validation, seed)
    return marked.withColumn(
        "part", F.when(F.col("split") == "train", "train").otherwise("validation")
    ).drop("split")


def score_requests(
    requests: DataFrame, encoder: PipelineModel, model, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Check, clean, featurise and score a table of encounter requests.

    Returns scored rows and rejected rows with their violations.
    """
    accepted, rejected = split_by_contract(requests, encounter_contract())
    ready = cleaning.rename_to_stored(cleaning.featurise(cleaning.clean(accepted)))
    ready = ready.drop(S.TARGET, S.TARGET_SOURCE, "age")
    return score_raw(ready, encoder, model, list(keep)), rejected


def baseline_runs(scored: DataFrame, at) -> DataFrame:
    """Run-log rows of batch 0: the production model on the initial test set.

    The same metrics are logged as new and as production, with no improvement,
    next to a drift run that is zero by definition.
    """
    metrics = evaluate_scores(scored, "label", "score")
    pairs = {
        f"{side}_{m}_test": F.col(m)
        for side in ("new", "prod")
        for m in ("auc", "f1", "precision", "recall")
    }
    quality = runlog.run_rows(
        metrics, F.lit("quality_gate_batch_0"), TRAINING_EXPERIMENT, at,
        params={"batch_number": F.lit(0), "test_set_used": F.lit("initial_test")},
        metrics={**pairs, "auc_improvement": F.lit(0.0), "f1_improvement": F.lit(0.0)},
        tags={"quality_gate": F.lit("True"), "decision": F.lit("BASELINE")},
    )
    drift = runlog.run_rows(
        scored.sparkSession.range(1), F.lit("drift_batch_0"), DRIFT_EXPERIMENT, at,
        params={"batch_number": F.lit(0)},
        metrics={
            "drift_share": F.lit(0.0), "n_drifted_columns": F.lit(0),
            "n_total_columns": F.lit(0), "dataset_drift": F.lit(0.0),
        },
    )
    return quality.unionByName(drift)


def gate_and_log(
    scored_pairs: DataFrame, batch_number: int, run_id: str, at, log_path: str | None = None
) -> DataFrame:
    """Compare champion and challenger on the test set, decide, and log the run."""
    decided = decide.regression_gate(decide.model_scores(scored_pairs))
    runs = runlog.run_rows(
        decided, F.lit(f"quality_gate_batch_{batch_number}"), TRAINING_EXPERIMENT, at,
        params={"batch_number": F.lit(batch_number), "training_run_id": F.lit(run_id)},
        metrics={
            **{
                f"{side}_{m}_test": F.col(f"{side}_{m}")
                for side in ("new", "prod")
                for m in ("auc", "f1", "precision", "recall")
            },
            "auc_improvement": F.col("auc_improvement"),
            "f1_improvement": F.col("new_f1") - F.col("prod_f1"),
        },
        tags={"quality_gate": F.lit("True"), "decision": F.col("decision")},
    )
    if log_path is not None:
        runlog.append(runs, log_path)
    return decided


def experiment_report(spark: SparkSession, log_path: str) -> DataFrame:
    """The per-batch report straight from the run log."""
    runs = runlog.read(spark, log_path)
    return report.experiment_report(
        runs.where(F.col("experiment") == DRIFT_EXPERIMENT),
        runs.where(F.col("experiment") == TRAINING_EXPERIMENT),
    )
