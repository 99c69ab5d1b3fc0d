"""Graded response over monitor rows: one row per event type and six hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import decide as R
from tidemark.operators import report as B

from .common import query, rounded, table

_MON = """SELECT event_type AS monitor, TIMESTAMP '2024-01-01' + to_hours(6 * slot) AS ts, round(abs(m - 50) / 60, 4) AS dataset_drift_score,
  (n % 12)::BIGINT AS feature_drift_count, 12::BIGINT AS total_features, CASE WHEN n % 7 = 0 THEN 0.25 ELSE 0.1 END::DOUBLE AS concept_drift_score,
  (n % 50) / 100.0::DOUBLE AS prediction_drift_score, (n % 13) / 100.0::DOUBLE AS performance_degradation, n % 5 = 0 AS retrained
FROM (SELECT event_type, ((epoch_us(ts) - 1704067200000000) // (6 * 3600 * 1000000::BIGINT))::BIGINT AS slot, count(*) AS n, round(avg(value), 4) AS m
  FROM events GROUP BY ALL)"""


def monitor_rows(spark, sf):
    slot = F.floor(
        (F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(1704067200000000))
        / F.lit(6 * 3600 * 1000000.0)
    )
    per_slot = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("monitor"), slot.alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("m"))
    )
    n = F.col("n")
    return per_slot.select(
        "monitor",
        F.timestamp_micros(F.lit(1704067200000000) + F.col("slot") * F.lit(6 * 3600 * 1000000))
        .cast("timestamp_ntz").alias("ts"),
        F.round(F.abs(F.col("m") - 50) / 60, 4).alias("dataset_drift_score"),
        (n % 12).alias("feature_drift_count"),
        F.lit(12).cast("bigint").alias("total_features"),
        F.when(n % 7 == 0, 0.25).otherwise(0.1).alias("concept_drift_score"),
        ((n % 50) / 100.0).alias("prediction_drift_score"),
        ((n % 13) / 100.0).alias("performance_degradation"),
        (n % 5 == 0).alias("retrained"),
    )


_SEV = f"""WITH mon AS ({_MON}), g AS (SELECT *,
  CASE WHEN dataset_drift_score >= 0.30 THEN 3 WHEN dataset_drift_score >= 0.15 THEN 2 WHEN dataset_drift_score >= 0.05 THEN 1 ELSE 0 END AS s1,
  CASE WHEN dataset_drift_score >= 0.30 THEN 0.9 WHEN dataset_drift_score >= 0.15 THEN 0.8 WHEN dataset_drift_score >= 0.05 THEN 0.7 ELSE 0.9 END AS c1,
  CASE WHEN feature_drift_count / 12.0 >= 0.5 THEN 3 WHEN feature_drift_count / 12.0 >= 0.25 THEN 2 WHEN feature_drift_count / 12.0 >= 0.1 THEN 1 ELSE 0 END AS s2,
  CASE WHEN feature_drift_count / 12.0 >= 0.5 THEN 0.8 WHEN feature_drift_count / 12.0 >= 0.25 THEN 0.7 WHEN feature_drift_count / 12.0 >= 0.1 THEN 0.6 ELSE 0.8 END AS c2,
  CASE WHEN concept_drift_score >= 0.2 THEN 4 ELSE -1 END AS s3, 0.9 AS c3,
  CASE WHEN performance_degradation >= 0.10 THEN 3 WHEN performance_degradation >= 0.05 THEN 2 WHEN performance_degradation >= 0.02 THEN 1 ELSE -1 END AS s4,
  CASE WHEN performance_degradation >= 0.10 THEN 0.9 WHEN performance_degradation >= 0.05 THEN 0.8 ELSE 0.7 END AS c4 FROM mon),
w AS (SELECT *, greatest(s1, s2, s3, s4) AS top FROM g),
sev AS (SELECT * EXCLUDE (s1, s2, s3, s4, c1, c2, c3, c4, top), (['none', 'minor', 'moderate', 'major', 'concept'])[top + 1] AS severity,
  greatest(CASE WHEN s1 = top THEN c1 ELSE 0 END, CASE WHEN s2 = top THEN c2 ELSE 0 END, CASE WHEN s3 = top THEN c3 ELSE 0 END,
    CASE WHEN s4 = top THEN c4 ELSE 0 END)::DOUBLE AS severity_confidence FROM w)"""


@query("severity", f"{_SEV} SELECT monitor, ts, severity, severity_confidence FROM sev")
def severity(spark, sf):
    t = R.with_severity(monitor_rows(spark, sf))
    return t.select("monitor", "ts", "severity", "severity_confidence")


_ACT = f"""{_SEV}, lr AS (SELECT *, max(CASE WHEN retrained THEN ts END) OVER (PARTITION BY monitor ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM sev),
h AS (SELECT *, (epoch_us(ts) - epoch_us(last)) / 3.6e9 AS hrs FROM lr),
act AS (SELECT *, CASE WHEN severity = 'minor' THEN 'log_and_monitor'
  WHEN severity IN ('moderate', 'major') AND coalesce(hrs < {{cool}}, FALSE) THEN 'log_and_monitor'
  WHEN severity = 'moderate' THEN {{moderate}} WHEN severity = 'major' THEN {{major}} WHEN severity = 'concept' THEN 'architecture_review'
  ELSE 'continue_monitoring' END AS action FROM h)"""
_AUTO = _ACT.format(cool=12, moderate="'incremental_retrain'", major="'full_retrain'")


@query(
    "response_action",
    f"""{_AUTO} SELECT monitor, ts, severity, round(hrs, 6) AS hours_since_retrain, action,
  CASE WHEN severity = 'minor' THEN 'Minor drift detected, increasing monitoring frequency and logging'
    WHEN action = 'log_and_monitor' THEN CASE severity WHEN 'major' THEN 'Major' ELSE 'Moderate' END ||
      ' drift detected but retraining cooldown active (' || printf('%.1f', hrs) || 'h < 12h)'
    WHEN severity = 'moderate' THEN 'Moderate drift detected, triggering incremental retraining with recent data'
    WHEN severity = 'major' THEN 'Major drift detected, triggering full model retraining with cumulative data'
    WHEN severity = 'concept' THEN 'Concept drift detected, model architecture and feature engineering review required'
    ELSE 'No significant drift detected, continuing normal monitoring' END AS reasoning,
  CASE action WHEN 'log_and_monitor' THEN 'minor_drift_enhanced_logging' WHEN 'incremental_retrain' THEN 'moderate_drift_trigger_retraining'
    WHEN 'full_retrain' THEN 'major_drift_trigger_retraining' WHEN 'architecture_review' THEN 'concept_drift_architecture_alert'
    ELSE 'no_drift_continue_monitoring' END AS next_step FROM act""",
)
def response_action(spark, sf):
    limits = R.DEFAULTS.override(cooldown_hours=12)
    t = R.with_action(
        R.with_hours_since_retrain(R.with_severity(monitor_rows(spark, sf), limits)), limits
    )
    return rounded(
        t.select("monitor", "ts", "severity", "hours_since_retrain", "action", "reasoning", "next_step"),
        ["hours_since_retrain"],
    )


@query(
    "response_action_manual",
    _ACT.format(cool=6, moderate="'log_and_monitor'", major="'architecture_review'")
    + " SELECT action, count(*) AS n FROM act GROUP BY action",
)
def response_action_manual(spark, sf):
    limits = R.DEFAULTS.override(automatic_retraining=False)
    t = R.respond(monitor_rows(spark, sf), limits)
    return t.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(
    "escalation",
    f"""{_SEV}, i AS (SELECT *, sum((severity <> 'major')::INT) OVER (PARTITION BY monitor ORDER BY ts ROWS UNBOUNDED PRECEDING) AS isl FROM sev),
r AS (SELECT *, sum((severity = 'major')::INT) OVER (PARTITION BY monitor, isl ORDER BY ts ROWS UNBOUNDED PRECEDING)::BIGINT AS consecutive_major FROM i)
SELECT monitor, ts, severity, consecutive_major, consecutive_major >= 3 OR severity = 'concept' AS escalate FROM r""",
)
def escalation(spark, sf):
    t = R.with_escalation(R.with_severity(monitor_rows(spark, sf)))
    return t.select("monitor", "ts", "severity", "consecutive_major", "escalate")


_REC = " ".join(
    f"WHEN '{s}' THEN [{', '.join(chr(39) + t + chr(39) for t in texts)}]"
    for s, texts in R.RECOMMENDATIONS.items()
    if texts
)


@query(
    "recommendations",
    f"""{_SEV} SELECT monitor, ts, array_to_string(list_concat(coalesce(CASE severity {_REC} END, []), list_filter([
  CASE WHEN feature_drift_count > 5 THEN 'High feature drift count (' || feature_drift_count || ' features): Focus on most important features' END,
  CASE WHEN prediction_drift_score > 0.2 THEN 'High prediction drift: Review model confidence and uncertainty estimates' END,
  CASE WHEN performance_degradation > 0.05 THEN 'Performance degradation detected (' || printf('%.1f%%', performance_degradation * 100) || '): Prioritize model retraining' END
  ], lambda x: x IS NOT NULL)), ' | ') AS recommendations FROM sev""",
)
def recommendations(spark, sf):
    t = R.with_recommendations(R.with_severity(monitor_rows(spark, sf)))
    return t.select("monitor", "ts", F.array_join("recommendations", " | ").alias("recommendations"))


@query(
    "recent_responses",
    f"{_SEV} SELECT monitor, ts, severity FROM sev ORDER BY ts DESC, monitor LIMIT 20",
)
def recent_responses(spark, sf):
    t = R.with_severity(monitor_rows(spark, sf))
    return B.last_responses(t, 20).select("monitor", "ts", "severity")


@query(
    "response_json",
    f"{_AUTO} SELECT severity, action, count(*) AS n FROM act GROUP BY ALL",
)
def response_json(spark, sf):
    """Responses as JSON artifacts, decoded again."""
    from tidemark.sources import artifacts as A

    limits = R.DEFAULTS.override(cooldown_hours=12)
    t = R.respond(monitor_rows(spark, sf), limits).select("monitor", "ts", "severity", "action")
    back = A.from_json_rows(
        A.to_json_rows(t, ["monitor", "ts"]), "struct<severity:string,action:string>", ["monitor", "ts"]
    )
    return back.groupBy("severity", "action").agg(F.count(F.lit(1)).alias("n"))
