"""End-to-end jobs as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.sides import IS_REF
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import runlog

from .common import BATCH_SQL, KINDS, lineitem_sides, query, r, table, two_models, with_batch
from .drift import KS_CHI2, LI
from .drift_sql import summary_ctes
from .evaluating import _SCORES


@query(
    "drift_run",
    f"{LI}, {summary_ctes(*KS_CHI2, threshold=0.3)} SELECT 'drift_batch_1' AS run_id, round(drift_share, 6) AS drift_share, "
    "n_drifted_columns::DOUBLE AS n_drifted_columns, n_columns::DOUBLE AS n_total_columns, dataset_drift::INT::DOUBLE AS dataset_drift, status FROM cs1",
)
def drift_run(spark, sf):
    """One batch against the reference, read back from the run log."""
    sided = lineitem_sides(spark, sf)
    path = shared_dir(spark, "runs")
    jobs.drift_run(
        sided.where(IS_REF).drop(IS_REF), sided.where(f"NOT {IS_REF}").drop(IS_REF), 1, path, KINDS,
        threshold=0.3,
    )
    m = F.col("metrics")
    return runlog.read(spark, path).select(
        "run_id", r(m["drift_share"]).alias("drift_share"), m["n_drifted_columns"].alias("n_drifted_columns"),
        m["n_total_columns"].alias("n_total_columns"), m["dataset_drift"].alias("dataset_drift"),
        F.col("tags")["status"].alias("status"),
    )


_MOVED = (
    "(SELECT abs(avg(l_quantity) FILTER (NOT is_ref) - avg(l_quantity) FILTER (is_ref)) / 50 AS shift, "
    "avg(l_quantity) FILTER (is_ref) / 50 AS ref_mean, avg(l_quantity) FILTER (NOT is_ref) / 50 AS new_mean FROM "
    "(SELECT l_quantity, l_shipdate < TIMESTAMP '1999-01-01' AS is_ref FROM lineitem))"
)


@query(
    "drift_run_concept",
    f"{LI}, {summary_ctes(*KS_CHI2)} SELECT 'drift_batch_2' AS run_id, round(shift, 6) AS prediction_mean_shift, "
    "round(ks_statistic, 6) AS prediction_ks_statistic, "
    "(ks_drift OR shift / greatest(abs(ref_mean), abs(new_mean), 0.1) > 0.1)::INT::DOUBLE AS concept_drift_detected, "
    "ks_drift_count::DOUBLE AS ks_drift_count, psi_drift_count::DOUBLE AS psi_drift_count, "
    "(ks_drift OR shift / greatest(abs(ref_mean), abs(new_mean), 0.1) > 0.1) AS concept_indicator "
    f"FROM sm, {_MOVED}, (SELECT ks_statistic, ks_drift FROM fts WHERE feature = 'l_quantity')",
)
def drift_run_concept(spark, sf):
    """The drift run with model scores on both sides: concept drift is the sixth indicator."""
    sided = lineitem_sides(spark, sf).withColumn("score", F.col("l_quantity") / 50)
    path = shared_dir(spark, "runs")
    jobs.drift_run(
        sided.where(IS_REF).drop(IS_REF), sided.where(f"NOT {IS_REF}").drop(IS_REF), 2, path, KINDS,
        score="score",
    )
    m = F.col("metrics")
    return runlog.read(spark, path).select(
        "run_id", r(m["prediction_mean_shift"]).alias("prediction_mean_shift"),
        r(m["prediction_ks_statistic"]).alias("prediction_ks_statistic"),
        m["concept_drift_detected"].alias("concept_drift_detected"),
        m["ks_drift_count"].alias("ks_drift_count"), m["psi_drift_count"].alias("psi_drift_count"),
        F.col("tags")["indicators"].contains("concept_drift").alias("concept_indicator"),
    )


@query(
    "drift_run_assumed",
    "SELECT 6::BIGINT AS n_columns, 1.0::DOUBLE AS drift_share, TRUE AS dataset_drift, 'ERROR_ASSUMED_DRIFT' AS status, "
    "count(*) FILTER (l_quantity IS NOT NULL) AS rows FROM lineitem",
)
def drift_run_assumed(spark, sf):
    """A computation that fails on the rows themselves yields an assumed drift."""
    sided = lineitem_sides(spark, sf)
    broken = sided.where(f"NOT {IS_REF}").withColumn(
        "l_tax", F.when(F.col("l_quantity").isNotNull(), F.raise_error(F.lit("unreadable")).cast("double"))
    )
    row = jobs.drift_run(
        sided.where(IS_REF).drop(IS_REF), broken.drop(IS_REF), 3, None, KINDS, on_error="assume_drift"
    )
    rows = sided.agg(F.count("l_quantity").alias("rows"))
    return row.select("n_columns", "drift_share", "dataset_drift", "status").crossJoin(rows)


def _quota(source: str, share: str) -> str:
    """Training rows per class of ``source``: largest remainders, ``share`` held out."""
    return f"""(SELECT event_type, floor(s) + (row_number() OVER (ORDER BY s - floor(s) DESC, event_type) <= draw - sum(floor(s)) OVER ())::INT AS k
  FROM (SELECT *, c / n::DOUBLE * draw AS s FROM (SELECT *, sum(c) OVER () AS n, sum(c) OVER () - ceil(sum(c) OVER () * {share}::DOUBLE) AS draw
    FROM (SELECT event_type, count(*) AS c FROM {source} GROUP BY 1))))"""


@query(
    "retraining_data",
    f"""WITH e AS (SELECT event_id, event_type, value, {BATCH_SQL} AS b, md5('42:' || event_id) AS h FROM events),
cur AS (SELECT * FROM e WHERE b = 3), q1 AS {_quota('cur', '0.3')},
tr AS (SELECT cur.* FROM cur JOIN q1 USING (event_type) QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY h) <= k),
mg AS (SELECT event_id, event_type, value, h FROM e WHERE b < 3 UNION SELECT event_id, event_type, value, h FROM tr), q2 AS {_quota('mg', '0.2')}
SELECT event_id, event_type, value, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY h) <= k THEN 'train' ELSE 'validation' END AS part
FROM mg JOIN q2 USING (event_type)""",
)
def retraining_data(spark, sf):
    """Cumulative training table for batch 3, split into train and validation."""
    events = with_batch(table(spark, sf, "events")).select(
        "event_id", "event_type", "value", "batch_number"
    )
    initial = events.where("batch_number = 0").drop("batch_number")
    return jobs.retraining_data(
        [initial], events.where("batch_number > 0"), events.where("batch_number = 3"), 3,
        ["event_id"], "event_type",
    )


@query(
    "gate_and_report",
    f"""{_SCORES} SELECT 2 AS batch, CASE WHEN new_auc - prod_auc >= 0 THEN 'DEPLOY' WHEN new_auc - prod_auc >= -0.02 THEN 'DEPLOY_REFRESH' ELSE 'SKIP' END AS decision,
  round(new_auc, 6) AS new_auc, round(prod_auc, 6) AS prod_auc, round(new_auc - prod_auc, 6) AS auc_improvement FROM g""",
)
def gate_and_report(spark, sf):
    """Gate two models, log the run, and read the experiment report from the log."""
    path = shared_dir(spark, "runs")
    jobs.gate_and_log(two_models(spark, sf), 2, "r2", F.current_timestamp(), path)
    t = jobs.experiment_report(spark, path)
    return t.select(
        "batch", "decision", r(F.col("new_auc")).alias("new_auc"), r(F.col("prod_auc")).alias("prod_auc"),
        r(F.col("auc_improvement")).alias("auc_improvement"),
    )
