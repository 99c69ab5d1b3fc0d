"""Column and dataset verdicts built from the feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import flag_list, ratio
from ..session import join_small

# Fixed limits of the published tests: p-values at 0.05, distances at 0.1.
P_LIMIT = 0.05
DISTANCE_LIMIT = 0.1

DATASET_SHARE = 0.5

# Fixed limits of the consensus indicators.
SHARE_LIMIT = 0.25
PSI_LIMIT = 0.1
KS_LIMIT = 0.3
JS_LIMIT = 0.1


NUMERIC_TESTS = ("ks", "wasserstein_normed", "js_divergence")
CATEGORY_TESTS = ("chi2", "z", "js_distance")


def column_drift(table: DataFrame, numeric: str = "ks", categorical: str = "chi2") -> DataFrame:
    """Score each column by the test named for its kind, and whether it drifted.

    The feature table must hold the metric of the chosen test.
    """
    if numeric not in NUMERIC_TESTS or categorical not in CATEGORY_TESTS:
        raise ValueError(f"unknown tests {numeric!r}, {categorical!r}")
    named = table.withColumn(
        "stattest", F.when(F.col("kind") == "numeric", F.lit(numeric)).otherwise(F.lit(categorical))
    )
    score = (
        F.when(F.col("stattest") == "ks", F.col("ks_pvalue"))
        .when(F.col("stattest") == "chi2", F.col("chi2_pvalue"))
        .when(F.col("stattest") == "z", F.col("z_pvalue"))
        .when(F.col("stattest") == "wasserstein_normed", F.col("wasserstein_normed"))
        .when(F.col("stattest") == "js_divergence", F.sqrt(F.col("js_divergence")))
        .otherwise(F.col("js_distance"))
    )
    p_value = F.col("stattest").isin("ks", "chi2", "z")
    return named.withColumn("drift_score", score).withColumn(
        "drifted",
        F.coalesce(
            F.when(p_value, F.col("drift_score") < P_LIMIT).otherwise(
                F.col("drift_score") >= DISTANCE_LIMIT
            ),
            F.lit(False),
        ),
    )


def dataset_drift(
    columns: DataFrame, by: Sequence[str] = (), threshold: float = DATASET_SHARE
) -> DataFrame:
    """Share of drifted columns and the dataset verdict ``share >= threshold``."""
    grouped = columns.groupBy(*by).agg(
        F.count_if("drifted").alias("n_drifted_columns"),
        F.count(F.lit(1)).alias("n_columns"),
    )
    share = F.coalesce(F.col("n_drifted_columns") / F.col("n_columns"), F.lit(0.0))
    return grouped.select(
        *by, "n_drifted_columns", "n_columns", share.alias("drift_share"),
        (share >= threshold).alias("dataset_drift"),
    )


def drift_summary(
    columns: DataFrame, by: Sequence[str] = (), threshold: float = DATASET_SHARE
) -> DataFrame:
    """Dataset verdict, drift counts per test and metric averages, in one pass.

    Averages run over *all* features: a metric that does not apply to a feature
    counts as 0; one that could not be computed for a feature it applies to is
    left out.
    """
    numeric = F.col("kind") == "numeric"

    def mean_of(metric: str) -> Column:
        return F.avg(F.when(numeric, F.col(metric)).otherwise(F.lit(0.0)))

    counts = columns.groupBy(*by).agg(
        F.count_if("drifted").alias("n_drifted_columns"),
        F.count_if(F.coalesce("ks_drift", F.lit(False))).alias("ks_drift_count"),
        F.count_if(F.coalesce("psi_drift", F.lit(False))).alias("psi_drift_count"),
        F.count_if(F.coalesce("chi2_drift", F.lit(False))).alias("chi2_drift_count"),
        F.count(F.lit(1)).alias("n_columns"),
        mean_of("ks_statistic").alias("avg_ks_statistic"),
        mean_of("psi").alias("avg_psi"),
        mean_of("wasserstein").alias("avg_wasserstein"),
        mean_of("js_divergence").alias("avg_js_divergence"),
    )
    votes = F.col("ks_drift_count") + F.col("psi_drift_count") + F.col("chi2_drift_count")
    share = ratio(F.col("n_drifted_columns"), F.col("n_columns"), 0.0)
    return counts.select(
        "*",
        share.alias("drift_share"),
        (share >= threshold).alias("dataset_drift"),
        ratio(votes, F.col("n_columns") * 3, 0.0).alias("statistical_drift_share"),
    )


def indicator_rules(concept: Column | None = None) -> dict[str, Column]:
    """All consensus indicators, by name, in reporting order."""
    return {
        "dataset": F.col("dataset_drift"),
        "statistical_share": F.col("statistical_drift_share") > SHARE_LIMIT,
        "psi": F.col("avg_psi") > PSI_LIMIT,
        "ks": F.col("avg_ks_statistic") > KS_LIMIT,
        "js_divergence": F.col("avg_js_divergence") > JS_LIMIT,
        "concept_drift": concept if concept is not None else F.lit(False),
    }


FULL_INDICATORS = (
    "dataset", "statistical_share", "psi", "ks", "js_divergence", "concept_drift",
)
LIGHT_INDICATORS = ("dataset", "psi", "ks")


def consensus(
    summary: DataFrame,
    by: Sequence[str] = (),
    concept: DataFrame | None = None,
    indicators: Sequence[str] = FULL_INDICATORS,
    divisor: int = 5,
    votes: int = 2,
) -> DataFrame:
    """Agreement of several indicators: drift when at least ``votes`` hold.

    ``concept`` is a table with ``concept_drift_detected`` per group.  The light
    variant uses :data:`LIGHT_INDICATORS` and a divisor of 3.
    """
    joined = summary
    concept_flag: Column = F.lit(False)
    if concept is not None:
        slim = concept.select(*by, "concept_drift_detected")
        joined = summary.join(slim, list(by), "left") if by else join_small(summary, slim, [])
        concept_flag = F.coalesce("concept_drift_detected", F.lit(False))
    rules: Mapping[str, Column] = indicator_rules(concept_flag)
    unknown = set(indicators) - set(rules)
    if unknown:
        raise ValueError(f"unknown indicators: {sorted(unknown)}")
    confidence = F.size("drift_indicators") / F.lit(float(divisor))
    return (
        joined.withColumn("drift_indicators", flag_list([(n, rules[n]) for n in indicators]))
        .select(
            "*",
            (F.size("drift_indicators") >= votes).alias("consensus_drift"),
            confidence.alias("confidence_score"),
            F.least(confidence, F.lit(1.0)).alias("confidence_capped"),
        )
        .withColumn("status", status_label(F.col("consensus_drift")))
    )


def status_label(detected: Column) -> Column:
    return F.when(detected, F.lit("DRIFT_DETECTED")).otherwise(F.lit("NO_DRIFT"))


def batch_set_verdict(batches: DataFrame, detected: str = "consensus_drift") -> DataFrame:
    """Verdict over a set of batches from the share of them that drifted."""
    grouped = batches.agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.count_if(F.coalesce(F.col(detected), F.lit(False))).alias("drifted_batches"),
    )
    share = F.coalesce(
        F.try_divide(F.col("drifted_batches"), F.col("total_batches")), F.lit(0.0)
    )
    return grouped.withColumn("drift_confidence", share).withColumn(
        "overall_status",
        F.when(F.col("total_batches") == 0, "unknown")
        .when(F.col("drift_confidence") >= 0.7, "major_drift")
        .when(F.col("drift_confidence") >= 0.3, "moderate_drift")
        .when(F.col("drift_confidence") > 0, "minor_drift")
        .otherwise("no_drift"),
    )


def assumed_drift(spark, n_columns: int) -> DataFrame:
    """The dataset verdict used when detection itself failed: assume drift."""
    return spark.range(1).select(
        F.lit(n_columns).cast("bigint").alias("n_drifted_columns"),
        F.lit(n_columns).cast("bigint").alias("n_columns"),
        F.lit(1.0).alias("drift_share"),
        F.lit(True).alias("dataset_drift"),
    )
