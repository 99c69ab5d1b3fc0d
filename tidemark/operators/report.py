"""Run-log views: latest run per batch, experiment report, registry, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import fixed, map_get, ratio, to_number

DRIFT_THRESHOLD = 0.30
DASH = "—"
SAME = 0.001


def metric_or_param(name: str, default: Column | None = None) -> Column:
    """A run's metric, else its parameter of the same name, as a number."""
    return F.coalesce(
        map_get("metrics", name),
        to_number(map_get("params", name)),
        *([default] if default is not None else []),
    )


def search_runs(
    runs: DataFrame, where: Column | str | None = None, experiment: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Most recent runs first, with an optional filter; all of them unless ``limit`` is given."""
    found = runs
    if experiment is not None:
        found = found.where(F.col("experiment") == experiment)
    if where is not None:
        found = found.where(where)
    found = found.orderBy(F.desc("start_time"), "run_id")
    return found if limit is None else found.limit(limit)


def latest_per_batch(runs: DataFrame) -> DataFrame:
    """The most recent run of each batch; runs without a usable batch number go.

    Reduced with ``max_by`` on every task, so re-running one batch very often
    does not build a large group.
    """
    numbered = runs.withColumn("batch", to_number(map_get("params", "batch_number"))).where(
        F.col("batch").isNotNull()
    )
    row = F.struct(*[c for c in numbered.columns if c != "batch"])
    return (
        numbered.groupBy("batch")
        .agg(F.max_by(row, F.struct("start_time", "run_id")).alias("_row"))
        .select(F.col("batch").cast("int").alias("batch"), "_row.*")
    )


_QUALITY = ["auc", "f1", "precision", "recall"]


def experiment_report(drift_runs: DataFrame, quality_runs: DataFrame) -> DataFrame:
    """One row per batch from the latest drift and quality runs, decision included."""
    drift = latest_per_batch(drift_runs).select(
        "batch",
        metric_or_param("drift_share").alias("drift_share"),
        metric_or_param("n_drifted_columns").alias("n_drifted"),
    )
    quality = latest_per_batch(
        quality_runs.where(map_get("metrics", "new_auc_test") > 0)
    ).select(
        "batch",
        "run_id",
        map_get("tags", "decision").alias("decision"),
        *[
            metric_or_param(f"{side}_{m}_test").alias(f"{side}_{m}")
            for side in ("new", "prod")
            for m in _QUALITY
        ],
        metric_or_param("auc_improvement").alias("auc_improvement"),
        metric_or_param("f1_improvement").alias("f1_improvement"),
    )
    return infer_decision(drift.join(quality, "batch", "full_outer"))


def infer_decision(report: DataFrame) -> DataFrame:
    """Fill an absent decision from the AUC change; tiny changes stay undecided."""
    logged = F.col("auc_improvement")
    measured = F.col("new_auc") - F.col("prod_auc")
    verdict = F.when(
        F.abs(logged) > SAME, F.when(logged >= 0, "DEPLOY").otherwise("DEPLOY_REFRESH")
    ).when(
        F.abs(measured) > SAME,
        F.when(F.col("new_auc") >= F.col("prod_auc"), "DEPLOY").otherwise("DEPLOY_REFRESH"),
    )
    return report.withColumn("decision", F.coalesce("decision", verdict))


def _shown(c: Column, digits: int) -> Column:
    return F.when(c.isNotNull(), fixed(c, digits)).otherwise(F.lit(DASH))


def metrics_table(report: DataFrame) -> DataFrame:
    """Display form of the report; new-model numbers only where a model was trained."""
    decision = F.coalesce("decision", F.lit(DASH))
    trained = F.col("decision").isin("DEPLOY", "DEPLOY_REFRESH")

    def new(name: str) -> Column:
        return F.when(trained & F.col(name).isNotNull(), fixed(F.col(name), 3)).otherwise(
            F.lit(DASH)
        )

    return report.select(
        "batch",
        _shown(F.col("drift_share"), 2).alias("drift_share"),
        F.when(trained, "Yes")
        .when(F.col("decision") == "SKIP_NO_DRIFT", "No")
        .when(F.col("decision") == "SKIP", "Skipped")
        .otherwise(DASH)
        .alias("retrained"),
        decision.alias("decision"),
        _shown(F.col("prod_auc"), 3).alias("prod_auc"),
        _shown(F.col("prod_f1"), 3).alias("prod_f1"),
        new("new_auc").alias("new_auc"),
        new("new_f1").alias("new_f1"),
        F.when(F.col("drift_share") >= DRIFT_THRESHOLD, "red")
        .when(F.col("drift_share").isNotNull(), "green")
        .alias("drift_colour"),
    )


def headline(report: DataFrame) -> DataFrame:
    """Retraining events, drifted batches, and AUC of the first and last batch."""
    return report.agg(
        F.count(F.lit(1)).alias("batches"),
        F.count_if(
            F.coalesce(F.col("decision").isin("DEPLOY", "DEPLOY_REFRESH"), F.lit(False))
        ).alias("retraining_events"),
        F.count_if(F.coalesce("drift_share", F.lit(0.0)) >= DRIFT_THRESHOLD)
        .alias("drifted_batches"),
        F.min_by(F.coalesce("prod_auc", "new_auc"), "batch").alias("starting_auc"),
        F.max_by(F.coalesce("new_auc", "prod_auc"), "batch").alias("ending_auc"),
    ).withColumn("auc_change", F.col("ending_auc") - F.col("starting_auc"))


# -------------------------------------------------------------------- registry
def best_run(
    runs: DataFrame, model_name: str, metric: str = "val_f1_score", require_preprocessor: bool = True
) -> DataFrame:
    """Best run of a model type by validation score, in three tiers.

    Tuned production runs first, then any tuned run, then debug runs.  The
    chosen run must have stored its preprocessor, otherwise there is none.
    """
    tuned = map_get("tags", "best_hpo_model") == "True"
    debug = map_get("tags", "debug_mode")
    tier = F.when(tuned & (debug == "False"), 1).when(tuned, 2).when(debug == "True", 3)
    ranked = (
        runs.where(map_get("tags", "model_name") == model_name)
        .withColumn("tier", tier)
        .where(F.col("tier").isNotNull())
        .withColumn("score", map_get("metrics", metric))
        .orderBy("tier", F.desc_nulls_last("score"), "run_id")
        .limit(1)
    )
    if require_preprocessor:
        ranked = ranked.where(map_get("tags", "preprocessor") == "True")
    return ranked


def registry_view(events: DataFrame) -> DataFrame:
    """Current stage of every model version from the append-only event log.

    Promoting a version archives the one that was in production before.
    """
    latest = events.groupBy("model", "version").agg(
        F.max_by(F.struct("stage", "run_id"), "ts").alias("_last"), F.max("ts").alias("since")
    ).select("model", "version", F.col("_last.stage").alias("stage"),
             F.col("_last.run_id").alias("run_id"), "since")
    promoted = F.when(F.col("stage") == "Production", F.struct("since", "version"))
    newest = F.max(promoted).over(Window.partitionBy("model"))
    return latest.withColumn("_newest", newest).select(
        "model", "version", "run_id", "since",
        F.when(
            (F.col("stage") == "Production") & (F.col("_newest.version") != F.col("version")),
            "Archived",
        ).otherwise(F.col("stage")).alias("stage"),
    )


def champion(view: DataFrame) -> DataFrame:
    """The production version of each model."""
    return view.where(F.col("stage") == "Production")


def promotion_events(best: DataFrame, view: DataFrame, model: str, ts: Column) -> DataFrame:
    """Registry event that registers the best run as the next version in production."""
    last = view.where(F.col("model") == model).agg(
        F.coalesce(F.max("version"), F.lit(0)).alias("_last")
    )
    return best.crossJoin(F.broadcast(last)).select(
        F.lit(model).alias("model"),
        (F.col("_last") + 1).cast("int").alias("version"),
        "run_id",
        F.lit("Production").alias("stage"),
        ts.alias("ts"),
    )


def registry_audit(view: DataFrame, runs: DataFrame, prefix: str = "") -> DataFrame:
    """Checks per model: its latest version is in production and its run is tagged."""
    latest = view.groupBy("model").agg(
        F.max_by(F.struct("version", "stage", "run_id"), "version").alias("_v")
    ).select("model", "_v.*")
    joined = latest.join(runs.select("run_id", "tags"), "run_id", "left")
    expected = F.replace(F.col("model"), F.lit(prefix), F.lit("")) if prefix else F.col("model")
    in_production = F.col("stage") == "Production"
    tagged = (
        (map_get("tags", "best_hpo_model") == "True") & (map_get("tags", "model_name") == expected)
    )
    failing = F.array_compact(
        F.array(
            F.when(~in_production, F.lit("latest_not_in_production")),
            F.when(in_production & F.col("tags").isNull(), F.lit("source_run_missing")),
            F.when(
                in_production & F.col("tags").isNotNull() & ~F.coalesce(tagged, F.lit(False)),
                F.lit("tags_not_as_expected"),
            ),
        )
    )
    return joined.select(
        "model", "version", "stage", "run_id",
        F.array_join(failing, ",").alias("failed_checks"), (F.size(failing) == 0).alias("passed"),
    )


# ------------------------------------------------------------------- summaries
def batch_run_summary(manifest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of batches, average size and quality, total processing time."""
    return manifest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.avg("batch_size"), F.lit(0.0)).alias("average_batch_size"),
        F.coalesce(F.avg(F.coalesce("data_quality_score", F.lit(1.0))), F.lit(1.0))
        .alias("average_quality_score"),
        F.coalesce(F.sum("processing_seconds"), F.lit(0.0)).alias("total_processing_time"),
    )


def outcome_rates(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Detection, trigger, deployment and maintenance rates of scenario results.

    The trigger rate is relative to the moderate and major scenarios.
    """
    expected = F.col("scenario_name").rlike("moderate|major")
    return results.groupBy(*by).agg(
        ratio(F.count_if("drift_detected"), F.count(F.lit(1)), 0.0)
        .alias("drift_detection_accuracy"),
        ratio(F.count_if("retraining_triggered"), F.count_if(expected), 0.0)
        .alias("retraining_trigger_success"),
        ratio(F.count_if("model_deployed"), F.count_if("retraining_triggered"), 0.0)
        .alias("deployment_success_rate"),
        ratio(F.count_if("performance_maintained"), F.count(F.lit(1)), 0.0)
        .alias("performance_maintenance_rate"),
        F.coalesce(F.avg("duration_seconds"), F.lit(0.0)).alias("average_duration"),
    )


def drift_characteristics(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Signed standardised mean shift per feature with an arrow at 0.1."""
    shift = F.when(
        F.col("ref_std_samp") > 0,
        (F.col("cur_mean") - F.col("ref_mean")) / F.col("ref_std_samp"),
    )
    return pairs.select(
        *by, "feature", "ref_mean", F.col("cur_mean").alias("batch_mean"), shift.alias("shift"),
        F.when(shift > 0.1, "^").when(shift < -0.1, "v").when(shift.isNotNull(), "=")
        .alias("arrow"),
    )


def last_responses(responses: DataFrame, n: int, ts: str = "ts", key: str = "monitor") -> DataFrame:
    return responses.orderBy(F.desc(ts), key).limit(n)


def as_key_values(row: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A one-row summary as ``(key, value)`` text rows."""
    columns = list(columns or row.columns)
    text = row.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return text.unpivot([], columns, "key", "value")
