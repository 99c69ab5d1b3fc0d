"""Drift statistics, verdicts and prediction drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import consensus as C
from tidemark.operators import drift as D
from tidemark.operators import evaluate as E
from tidemark.operators import refindex
from tidemark.operators.profile import correlations, quality_profile
from tidemark.operators.sides import flag_sides, long_form, stack_sides

from .common import (
    CATEGORICAL, EVENTS_SRC, KINDS, LABELLED_SQL, LINEITEM_SRC, NUMERIC, events_by_batch, labelled,
    lineitem_sides, query, rounded, table, with_batch, BATCH_SQL,
)
from .drift_sql import METRICS, base_ctes, kolmogorov, rounded_select, summary_ctes

LI = "WITH " + base_ctes(LINEITEM_SRC, NUMERIC, CATEGORICAL)
EV_NUMERIC, EV_CATEGORICAL = ["value", "user_id"], ["event_type"]
EV_KINDS = {"value": "numeric", "user_id": "numeric", "event_type": "categorical"}
EV = "WITH " + base_ctes(EVENTS_SRC, EV_NUMERIC, EV_CATEGORICAL)


def _numeric_cells(sided):
    return long_form(sided, NUMERIC, "numeric")


@query("drift_psi", f"{LI} SELECT feature, round(psi, 6) AS psi, outside::BIGINT AS out_of_range FROM ps")
def drift_psi(spark, sf):
    sided = lineitem_sides(spark, sf)
    return rounded(D.psi(_numeric_cells(sided), D.paired_moments(sided, NUMERIC)), ["psi"])


@query(
    "drift_ks",
    f"{LI} SELECT feature, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, "
    "ks_drift FROM fts WHERE kind = 'numeric'",
)
def drift_ks(spark, sf):
    t = D.feature_table(lineitem_sides(spark, sf), {c: "numeric" for c in NUMERIC}, metrics=("ks",))
    return rounded(
        t.select("feature", "ks_statistic", "ks_pvalue", "ks_drift"), ["ks_statistic", "ks_pvalue"]
    )


@query("drift_wasserstein", f"{LI} SELECT feature, round(wd, 6) AS wasserstein FROM rk")
def drift_wasserstein(spark, sf):
    t = D.rank_statistics(D.distinct_values(_numeric_cells(lineitem_sides(spark, sf))))
    return rounded(t.select("feature", "wasserstein"), ["wasserstein"])


@query(
    "drift_wasserstein_lanes",
    f"{LI} SELECT feature, round(wd, 6) AS wasserstein, round(ks, 6) AS ks_statistic, nd AS n_distinct FROM rk",
)
def drift_wasserstein_lanes(spark, sf):
    """The same statistics through the multi-lane plan used for large features."""
    t = D.rank_statistics(
        D.distinct_values(_numeric_cells(lineitem_sides(spark, sf))), rows_per_lane=5000
    )
    return rounded(
        t.select("feature", "wasserstein", "ks_statistic", "n_distinct"),
        ["wasserstein", "ks_statistic"],
    )


@query(
    "drift_wasserstein_normed",
    f"{LI} SELECT feature, round(wasserstein_normed, 6) AS wasserstein_normed, "
    "wasserstein_normed >= 0.1 AS drifted FROM ft WHERE kind = 'numeric'",
)
def drift_wasserstein_normed(spark, sf):
    t = D.numeric_table(lineitem_sides(spark, sf), NUMERIC, metrics=("wasserstein",))
    return rounded(
        t.select("feature", "wasserstein_normed", (F.col("wasserstein_normed") >= 0.1).alias("drifted")),
        ["wasserstein_normed"],
    )


@query(
    "drift_moments",
    f"{LI} SELECT feature, round(mean_shift, 6) AS mean_shift, round(std_ratio, 6) AS std_ratio "
    "FROM ft WHERE kind = 'numeric'",
)
def drift_moments(spark, sf):
    pairs = D.paired_moments(lineitem_sides(spark, sf), NUMERIC)
    return rounded(D.moment_shift(pairs), ["mean_shift", "std_ratio"])


@query("drift_js_numeric", f"{LI} SELECT feature, round(js, 6) AS js_divergence FROM js")
def drift_js_numeric(spark, sf):
    sided = lineitem_sides(spark, sf)
    return rounded(
        D.js_numeric(_numeric_cells(sided), D.paired_moments(sided, NUMERIC)), ["js_divergence"]
    )


def _categories(spark, sf):
    sided = lineitem_sides(spark, sf)
    return D.category_statistics(D.category_counts(long_form(sided, CATEGORICAL, "categorical")))


@query(
    "drift_js_categorical",
    f"{LI} SELECT feature, round(jsd, 6) AS js_divergence, round(sqrt(greatest(jsd, 0)), 6) AS js_distance FROM cst",
)
def drift_js_categorical(spark, sf):
    return rounded(
        _categories(spark, sf).select("feature", "js_divergence", "js_distance"),
        ["js_divergence", "js_distance"],
    )


@query(
    "drift_chi2_stat",
    f"{LI} SELECT feature, round(chi, 6) AS chi2_statistic, dof AS chi2_dof, fresh AS new_categories, "
    "gone AS vanished_categories FROM cst",
)
def drift_chi2_stat(spark, sf):
    return rounded(
        _categories(spark, sf).select(
            "feature", "chi2_statistic", "chi2_dof", "new_categories", "vanished_categories"
        ),
        ["chi2_statistic"],
    )


@query("drift_chi2_p", f"{LI} SELECT feature, round(chip, 6) AS chi2_pvalue, chip < 0.05 AS drifted FROM cst")
def drift_chi2_p(spark, sf):
    t = _categories(spark, sf).select(
        "feature", "chi2_pvalue", (F.col("chi2_pvalue") < 0.05).alias("drifted")
    )
    return rounded(t, ["chi2_pvalue"])


@query(
    "drift_chi2_raw",
    f"{LI} SELECT feature, tr = tc AS comparable, round(CASE WHEN tr = tc THEN chi END, 6) AS chi2_statistic FROM cst",
)
def drift_chi2_raw(spark, sf):
    """Unscaled expectations: defined only for sides of equal size."""
    sided = lineitem_sides(spark, sf)
    counts = D.category_counts(long_form(sided, CATEGORICAL, "categorical"))
    t = D.category_statistics(counts, expected="raw")
    return rounded(
        t.select("feature", (F.col("n_ref") == F.col("n_cur")).alias("comparable"), "chi2_statistic"),
        ["chi2_statistic"],
    )


@query(
    "drift_ztest",
    f"{LI} SELECT feature, round(z, 6) AS z_statistic, round(zp, 6) AS z_pvalue FROM czz WHERE z IS NOT NULL",
)
def drift_ztest(spark, sf):
    t = _categories(spark, sf).where(F.col("z_statistic").isNotNull())
    return rounded(t.select("feature", "z_statistic", "z_pvalue"), ["z_statistic", "z_pvalue"])


FEATURE_COLUMNS = ["feature", "kind", "n_ref", "n_cur", "n_distinct", *METRICS,
                   "ks_drift", "psi_drift", "chi2_drift"]


@query(
    "drift_feature_table",
    f"{LI} SELECT feature, kind, n_ref, n_cur, n_distinct, {rounded_select(METRICS)}, "
    "ks_drift, psi_drift, chi2_drift FROM fts",
)
def drift_feature_table(spark, sf):
    t = D.feature_table(lineitem_sides(spark, sf), KINDS)
    return rounded(t.select(*FEATURE_COLUMNS), METRICS)


_LONG_SQL = " UNION ALL ".join(
    f"SELECT feature, kind, '{m}' AS metric, round({m}::DOUBLE, 6) AS value FROM fts WHERE {m} IS NOT NULL"
    for m in [*METRICS, "ks_drift", "psi_drift", "chi2_drift"]
)


@query("drift_metrics_long", f"{LI} {_LONG_SQL}")
def drift_metrics_long(spark, sf):
    t = D.feature_table(lineitem_sides(spark, sf), KINDS)
    return rounded(D.melt_metrics(t), ["value"])


@query(
    "drift_metric_maps",
    f"{LI}, lg AS ({_LONG_SQL}) SELECT feature, kind, count(*) AS n_metrics, "
    "round(max(value) FILTER (metric = 'js_distance'), 6) AS js_distance, "
    "round(max(value) FILTER (metric = 'psi'), 6) AS psi FROM lg GROUP BY ALL",
)
def drift_metric_maps(spark, sf):
    maps = D.metric_maps(D.melt_metrics(D.feature_table(lineitem_sides(spark, sf), KINDS)))
    return rounded(
        maps.select(
            "feature", "kind", F.size("metrics").cast("bigint").alias("n_metrics"),
            F.try_element_at("metrics", F.lit("js_distance")).alias("js_distance"),
            F.try_element_at("metrics", F.lit("psi")).alias("psi"),
        ),
        ["js_distance", "psi"],
    )


_LIGHT_SRC = f"SELECT value, user_id, b = 0 AS is_ref, 0 AS grp FROM (SELECT *, {BATCH_SQL} AS b FROM events)"
LIGHT = "WITH " + base_ctes(_LIGHT_SRC, EV_NUMERIC, [])


@query(
    "drift_light",
    f"{LIGHT} SELECT feature, n_ref, n_cur, {rounded_select(['ks_statistic', 'ks_pvalue', 'wasserstein', 'psi'])} FROM ft",
)
def drift_light(spark, sf):
    """Light variant: three metrics of named features over all rows."""
    events = with_batch(table(spark, sf, "events"))
    sided = flag_sides(events, F.col("batch_number") == 0)
    kinds = {c: "numeric" for c in EV_NUMERIC}
    t = D.feature_table(sided, kinds, metrics=("ks", "wasserstein", "psi"))
    metrics = ["ks_statistic", "ks_pvalue", "wasserstein", "psi"]
    return rounded(t.select("feature", "n_ref", "n_cur", *metrics), metrics)


KS_CHI2 = (
    "CASE WHEN kind = 'numeric' THEN ks_pvalue ELSE chi2_pvalue END",
    "CASE WHEN kind = 'numeric' THEN ks_pvalue ELSE chi2_pvalue END < 0.05",
)
_NAMED_TEST = "CASE WHEN kind = 'numeric' THEN 'wasserstein_normed' ELSE 'js_distance' END"
_NAMED_SCORE = "CASE WHEN kind = 'numeric' THEN wasserstein_normed ELSE js_distance END"
NAMED = (_NAMED_SCORE, f"{_NAMED_SCORE} >= 0.1")


@query(
    "drift_columns_ks_chi2",
    f"{LI}, {summary_ctes(*KS_CHI2)} SELECT feature, CASE WHEN kind = 'numeric' THEN 'ks' ELSE 'chi2' END AS stattest, "
    "round(drift_score, 6) AS drift_score, drifted FROM cd",
)
def drift_columns_ks_chi2(spark, sf):
    t = C.column_drift(D.feature_table(lineitem_sides(spark, sf), KINDS, metrics=("ks",)))
    return rounded(t.select("feature", "stattest", "drift_score", "drifted"), ["drift_score"])


@query(
    "drift_columns_named",
    f"{LI}, {summary_ctes(*NAMED)} SELECT feature, {_NAMED_TEST} AS stattest, "
    "round(drift_score, 6) AS drift_score, drifted FROM cd",
)
def drift_columns_named(spark, sf):
    t = D.feature_table(
        lineitem_sides(spark, sf), KINDS, metrics=("ks", "wasserstein", "js")
    )
    t = C.column_drift(t, "wasserstein_normed", "js_distance")
    return rounded(t.select("feature", "stattest", "drift_score", "drifted"), ["drift_score"])


@query(
    "drift_dataset",
    f"{LI}, {summary_ctes(*KS_CHI2)} SELECT n_drifted_columns, n_columns, round(drift_share, 6) AS drift_share, "
    "dataset_drift, drift_share >= 0.3 AS dataset_drift_configured FROM sm",
)
def drift_dataset(spark, sf):
    t = C.column_drift(D.feature_table(lineitem_sides(spark, sf), KINDS, metrics=("ks",)))
    strict = C.dataset_drift(t)
    return rounded(
        strict.select("*", (F.col("drift_share") >= 0.3).alias("dataset_drift_configured")),
        ["drift_share"],
    )


SUMMARY = ["n_drifted_columns", "n_columns", "ks_drift_count", "psi_drift_count", "chi2_drift_count"]
AVERAGES = ["avg_ks_statistic", "avg_psi", "avg_wasserstein", "avg_js_divergence", "drift_share",
            "statistical_drift_share"]
VERDICT = ["dataset_drift", "drift_indicators", "consensus_drift", "confidence_score",
           "confidence_capped", "status"]


def _summary_select(by: str = "") -> str:
    return (
        f"SELECT {by}{', '.join(SUMMARY)}, {rounded_select(AVERAGES)}, dataset_drift, drift_indicators, "
        "consensus_drift, round(confidence_score, 6) AS confidence_score, "
        "round(confidence_capped, 6) AS confidence_capped, status FROM cs1"
    )


def _summary(df, by=()):
    out = df.withColumn("drift_indicators", F.array_join("drift_indicators", ","))
    return rounded(
        out.select(*by, *SUMMARY, *AVERAGES, *VERDICT), [*AVERAGES, "confidence_score", "confidence_capped"]
    )


@query("drift_consensus", f"{LI}, {summary_ctes(*KS_CHI2)} {_summary_select()}")
def drift_consensus(spark, sf):
    columns = C.column_drift(D.feature_table(lineitem_sides(spark, sf), KINDS))
    return _summary(C.consensus(C.drift_summary(columns)))


_LIGHT_IND = (
    "CASE WHEN dataset_drift THEN 'dataset' END, CASE WHEN avg_psi > 0.1 THEN 'psi' END, "
    "CASE WHEN avg_ks_statistic > 0.3 THEN 'ks' END"
)


@query(
    "drift_consensus_light",
    f"{EV}, {summary_ctes(*KS_CHI2, indicators=_LIGHT_IND, divisor=3)} "
    "SELECT grp AS batch_number, drift_indicators, consensus_drift, "
    "round(confidence_score, 6) AS confidence_score FROM cs1",
)
def drift_consensus_light(spark, sf):
    t = D.feature_table(
        events_by_batch(spark, sf), EV_KINDS, by=["batch_number"], metrics=("ks", "psi")
    )
    out = C.consensus(
        C.drift_summary(C.column_drift(t), ["batch_number"]), ["batch_number"],
        indicators=C.LIGHT_INDICATORS, divisor=3,
    )
    return rounded(
        out.select(
            "batch_number", F.array_join("drift_indicators", ",").alias("drift_indicators"),
            "consensus_drift", "confidence_score",
        ),
        ["confidence_score"],
    )


@query(
    "drift_feature_table_batches",
    f"{EV} SELECT grp AS batch_number, feature, kind, n_ref, n_cur, n_distinct, {rounded_select(METRICS)} FROM ft",
)
def drift_feature_table_batches(spark, sf):
    t = D.feature_table(events_by_batch(spark, sf), EV_KINDS, by=["batch_number"])
    return rounded(
        t.select("batch_number", "feature", "kind", "n_ref", "n_cur", "n_distinct", *METRICS), METRICS
    )


def batch_consensus(spark, sf):
    t = D.feature_table(events_by_batch(spark, sf), EV_KINDS, by=["batch_number"])
    return C.consensus(
        C.drift_summary(C.column_drift(t), ["batch_number"], threshold=0.3), ["batch_number"]
    )


EV_CONSENSUS = f"{EV}, {summary_ctes(*KS_CHI2, threshold=0.3)}"


@query("drift_batches", f"{EV_CONSENSUS} {_summary_select('grp AS batch_number, ')}")
def drift_batches(spark, sf):
    return _summary(batch_consensus(spark, sf), ["batch_number"])


def _event_cells(rows, keys):
    """``(keys..., feature, value)`` of the numeric event features; nulls and NaN left out."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias("value"))
        for f in EV_NUMERIC
    ])).alias("c")
    return rows.select(*keys, cells).select(*keys, "c.feature", "c.value")


@query(
    "drift_ks_batches",
    f"{EV} SELECT grp AS batch_number, feature, round(ks, 6) AS ks_statistic FROM rk",
)
def drift_ks_batches(spark, sf):
    """KS of every batch against batch 0 through one rank index of the reference."""
    rows = events_by_batch(spark, sf)
    t = refindex.ks_by_reference_index(
        _event_cells(rows.where("is_ref"), []), _event_cells(rows.where("NOT is_ref"), ["batch_number"]),
        ["batch_number"],
    )
    return rounded(t.select("batch_number", "feature", "ks_statistic"), ["ks_statistic"])


@query(
    "batch_set_verdict",
    f"{EV_CONSENSUS} SELECT count(*) AS total_batches, count(*) FILTER (dataset_drift) AS drifted_batches, "
    "round(avg(dataset_drift::INT), 6) AS drift_confidence, "
    "CASE WHEN avg(dataset_drift::INT) >= 0.7 THEN 'major_drift' WHEN avg(dataset_drift::INT) >= 0.3 THEN 'moderate_drift' "
    "WHEN avg(dataset_drift::INT) > 0 THEN 'minor_drift' ELSE 'no_drift' END AS overall_status FROM cs1",
)
def batch_set_verdict(spark, sf):
    return rounded(
        C.batch_set_verdict(batch_consensus(spark, sf), "dataset_drift"), ["drift_confidence"]
    )


# ------------------------------------------------------------ prediction drift
def _scored_sides(spark, sf):
    """Even documents are the reference, odd ones the new data."""
    return flag_sides(labelled(spark, sf), F.col("doc_id") % 2 == 0)


_SIDES_SQL = (
    f"SELECT *, doc_id % 2 = 0 AS is_ref, 0 AS grp, score_champion AS score FROM ({LABELLED_SQL})"
)
_PRED = "WITH " + base_ctes(_SIDES_SQL, ["score"], []) + """,
pd AS (SELECT rm AS ref_prediction_mean, cm AS new_prediction_mean, rp AS ref_prediction_std, cp AS new_prediction_std,
  abs(cm - rm) AS prediction_mean_shift, CASE WHEN rp > 0 THEN cp / rp ELSE 1.0 END AS prediction_std_ratio,
  ks_statistic AS prediction_ks_statistic, ks_pvalue AS prediction_ks_pvalue, ks_pvalue < 0.05 AS prediction_ks_drift,
  wasserstein AS prediction_wasserstein FROM mom JOIN ft USING (grp, feature)),
pr AS (SELECT *, score > 0.5 AS yes FROM src),
cm0 AS (SELECT is_ref, avg((yes = (label = 1))::INT) AS accuracy,
  count(*) FILTER (yes AND label = 1) AS tp, count(*) FILTER (yes AND label = 0) AS fp,
  count(*) FILTER (NOT yes AND label = 1) AS fn FROM pr GROUP BY is_ref),
au AS (SELECT a.is_ref, sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) / count(*) AS auc
  FROM pr a JOIN pr b ON a.is_ref = b.is_ref AND a.label = 1 AND b.label = 0 GROUP BY a.is_ref),
mm AS (SELECT is_ref, accuracy, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1, auc
  FROM cm0 JOIN au USING (is_ref)),
pf AS (SELECT r.accuracy AS ref_data_accuracy, n.accuracy AS new_data_accuracy, r.f1 AS ref_data_f1, n.f1 AS new_data_f1,
  r.auc AS ref_data_auc, n.auc AS new_data_auc, abs(n.accuracy - r.accuracy) AS accuracy_drift, abs(n.f1 - r.f1) AS f1_drift,
  abs(n.auc - r.auc) AS auc_drift, r.accuracy - n.accuracy AS performance_degradation,
  abs(n.accuracy - r.accuracy) > 0.05 OR abs(n.f1 - r.f1) > 0.05 AS performance_concept_drift
  FROM mm r, mm n WHERE r.is_ref AND NOT n.is_ref)
"""
PREDICTION = ["ref_prediction_mean", "new_prediction_mean", "ref_prediction_std",
              "new_prediction_std", "prediction_mean_shift", "prediction_std_ratio",
              "prediction_ks_statistic", "prediction_ks_pvalue", "prediction_wasserstein"]
PERFORMANCE = ["ref_data_accuracy", "new_data_accuracy", "ref_data_f1", "new_data_f1",
               "ref_data_auc", "new_data_auc", "accuracy_drift", "f1_drift", "auc_drift",
               "performance_degradation"]


@query("prediction_drift", f"{_PRED} SELECT {rounded_select(PREDICTION)}, prediction_ks_drift FROM pd")
def prediction_drift(spark, sf):
    t = E.prediction_drift(_scored_sides(spark, sf), "score_champion")
    return rounded(t.select(*PREDICTION, "prediction_ks_drift"), PREDICTION)


@query(
    "performance_drift",
    f"{_PRED} SELECT {rounded_select(PERFORMANCE)}, performance_concept_drift FROM pf",
)
def performance_drift(spark, sf):
    t = E.performance_drift(_scored_sides(spark, sf), "label", "score_champion")
    return rounded(t, PERFORMANCE)


@query(
    "concept_verdict",
    f"""{_PRED}, cv AS (SELECT list_filter([CASE WHEN prediction_ks_drift THEN 'prediction_distribution' END,
  CASE WHEN prediction_mean_shift / greatest(abs(ref_prediction_mean), abs(new_prediction_mean), 0.1) > 0.1
    THEN 'prediction_mean_shift' END,
  CASE WHEN performance_concept_drift THEN 'performance_degradation' END], lambda x: x IS NOT NULL) AS ind FROM pd, pf)
SELECT array_to_string(ind, ',') AS concept_drift_indicators, len(ind) > 0 AS concept_drift_detected,
  round(len(ind) / 3.0::DOUBLE, 6) AS concept_drift_confidence FROM cv""",
)
def concept_verdict(spark, sf):
    sided = _scored_sides(spark, sf)
    t = E.concept_verdict(
        E.prediction_drift(sided, "score_champion"),
        E.performance_drift(sided, "label", "score_champion"),
    )
    return rounded(
        t.select(
            F.array_join("concept_drift_indicators", ",").alias("concept_drift_indicators"),
            "concept_drift_detected", "concept_drift_confidence",
        ),
        ["concept_drift_confidence"],
    )


# --------------------------------------------------------------- quality report
_QP_CELLS = " UNION ALL ".join(
    f"SELECT is_ref, '{f}' AS feature, '{k}' AS kind, CAST({f} AS VARCHAR) AS value, "
    f"{f if k == 'numeric' else 'NULL::DOUBLE'} AS x FROM src"
    for f, k in {"value": "numeric", "user_id": "numeric", "event_type": "categorical"}.items()
)
_QP_SRC = f"SELECT value, user_id, nullif(event_type, 'error') AS event_type, {BATCH_SQL} = 0 AS is_ref FROM events"


@query(
    "quality_profile",
    f"""WITH src AS ({_QP_SRC}), cells AS ({_QP_CELLS}),
fr AS (SELECT is_ref, feature, kind, value, count(*) AS n FROM cells GROUP BY ALL),
tt AS (SELECT is_ref, feature, kind, sum(n)::BIGINT AS rows, coalesce(sum(n) FILTER (value IS NULL), 0)::BIGINT AS missing,
  count(value) AS n_distinct, max(n) FILTER (value IS NOT NULL) AS top_n FROM fr GROUP BY ALL),
rg AS (SELECT is_ref, feature, min(x) AS min, max(x) AS max FROM cells GROUP BY ALL)
SELECT CASE WHEN is_ref THEN 'reference' ELSE 'current' END AS side, feature, kind, rows, missing,
  round(missing * 100.0::DOUBLE / rows, 6) AS missing_pct, n_distinct, n_distinct <= 1 AS is_constant,
  round(top_n * 100.0::DOUBLE / rows, 6) AS top_pct, min, max, top_value FROM tt JOIN rg USING (is_ref, feature)
  LEFT JOIN (SELECT is_ref, feature, arg_min(value, (-n, value)) AS top_value FROM (SELECT is_ref, feature, value, n FROM fr WHERE value IS NOT NULL) GROUP BY ALL) USING (is_ref, feature)""",
)
def quality_profile_query(spark, sf):
    events = with_batch(table(spark, sf, "events"))
    sided = flag_sides(
        events.select(
            "value", "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "batch_number"
        ),
        F.col("batch_number") == 0,
    ).drop("batch_number")
    return rounded(quality_profile(sided), ["missing_pct", "top_pct"])


@query(
    "correlations",
    " UNION ALL ".join(
        f"SELECT l_shipdate < TIMESTAMP '1999-01-01' AS is_ref, '{a}' AS left, '{b}' AS right, "
        f"round(corr({a}, {b}), 6) AS corr FROM lineitem GROUP BY 1"
        for i, a in enumerate(NUMERIC)
        for b in NUMERIC[i + 1 :]
    ).replace(" AS left", ' AS "left"').replace(" AS right", ' AS "right"'),
)
def correlations_query(spark, sf):
    return rounded(correlations(lineitem_sides(spark, sf), NUMERIC, ["is_ref"]), ["corr"])


__all__ = ["EV_CONSENSUS", "batch_consensus", "kolmogorov"]
