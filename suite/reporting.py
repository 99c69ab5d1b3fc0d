"""Run log, experiment report, registry, summaries and error log over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import errors as X
from tidemark.operators import report as B
from tidemark.sources import batches as BT
from tidemark.sources import runlog as L

from .common import BATCH_SQL, moment, query, r, rounded, table, with_batch

# ---------------------------------------------------------------- drift/quality runs
_DRIFT_RUNS = "SELECT event_id, ts, user_id AS batch, value / 500 AS drift_share, event_id % 40 AS n_drifted FROM events WHERE event_type = 'view'"
_QUALITY_RUNS = """SELECT event_id, ts, user_id AS batch, 0.5 + (event_id % 100) / 1000.0::DOUBLE AS new_auc, 0.5 + (event_id % 91) / 1000.0::DOUBLE AS prod_auc,
  0.3 + (event_id % 50) / 1000.0::DOUBLE AS new_f1, 0.3 + (event_id % 41) / 1000.0::DOUBLE AS prod_f1,
  CASE WHEN event_id % 6 = 0 THEN 'SKIP_NO_DRIFT' WHEN event_id % 6 = 1 THEN 'SKIP' END AS decision,
  CASE WHEN event_id % 2 = 0 THEN (0.5 + (event_id % 100) / 1000.0::DOUBLE) - (0.5 + (event_id % 91) / 1000.0::DOUBLE) END AS auc_improvement
FROM events WHERE event_type = 'purchase' AND user_id % 10 <> 3"""


def drift_runs(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'view'")
    return L.run_rows(
        e, F.col("event_id"), "drift", F.col("ts"),
        params={"batch_number": F.col("user_id"), "n_drifted_columns": F.col("event_id") % 40},
        metrics={"drift_share": F.col("value") / 500},
    )


def quality_runs(spark, sf):
    i = F.col("event_id")
    e = table(spark, sf, "events").where("event_type = 'purchase' AND user_id % 10 <> 3")
    new_auc, prod_auc = F.lit(0.5) + (i % 100) / 1000.0, F.lit(0.5) + (i % 91) / 1000.0
    runs = L.run_rows(
        e, i, "training", F.col("ts"),
        params={"batch_number": F.col("user_id")},
        metrics={
            "new_auc_test": new_auc, "prod_auc_test": prod_auc,
            "new_f1_test": F.lit(0.3) + (i % 50) / 1000.0,
            "prod_f1_test": F.lit(0.3) + (i % 41) / 1000.0,
            "auc_improvement": F.when(i % 2 == 0, new_auc - prod_auc),
        },
        tags={"decision": F.when(i % 6 == 0, "SKIP_NO_DRIFT").when(i % 6 == 1, "SKIP")},
    )
    return runs


_LATEST_DRIFT = f"SELECT * FROM ({_DRIFT_RUNS}) QUALIFY row_number() OVER (PARTITION BY batch ORDER BY ts DESC, event_id::VARCHAR DESC) = 1"
_LATEST_QUALITY = f"SELECT * FROM ({_QUALITY_RUNS}) QUALIFY row_number() OVER (PARTITION BY batch ORDER BY ts DESC, event_id::VARCHAR DESC) = 1"


@query(
    "latest_per_batch",
    f"SELECT batch::INTEGER AS batch, event_id::VARCHAR AS run_id, round(drift_share, 6) AS drift_share FROM ({_LATEST_DRIFT})",
)
def latest_per_batch(spark, sf):
    t = B.latest_per_batch(drift_runs(spark, sf))
    return t.select("batch", "run_id", r(F.col("metrics")["drift_share"]).alias("drift_share"))


_JOIN = f"""WITH d AS ({_LATEST_DRIFT}), q AS ({_LATEST_QUALITY}),
j AS (SELECT coalesce(d.batch, q.batch)::INTEGER AS batch, drift_share, n_drifted, q.event_id, new_auc, prod_auc, new_f1, prod_f1, auc_improvement,
  coalesce(decision, CASE WHEN abs(auc_improvement) > 0.001 THEN CASE WHEN auc_improvement >= 0 THEN 'DEPLOY' ELSE 'DEPLOY_REFRESH' END
    WHEN abs(new_auc - prod_auc) > 0.001 THEN CASE WHEN new_auc >= prod_auc THEN 'DEPLOY' ELSE 'DEPLOY_REFRESH' END END) AS decision
  FROM d FULL JOIN q ON d.batch = q.batch)"""


def _report(spark, sf):
    return B.experiment_report(drift_runs(spark, sf), quality_runs(spark, sf))


@query(
    "report_join",
    f"{_JOIN} SELECT batch, round(drift_share, 6) AS drift_share, n_drifted::DOUBLE AS n_drifted, event_id::VARCHAR AS run_id, decision, "
    "round(new_auc, 6) AS new_auc, round(prod_auc, 6) AS prod_auc, round(auc_improvement, 6) AS auc_improvement FROM j",
)
def report_join(spark, sf):
    return rounded(
        _report(spark, sf).select(
            "batch", "drift_share", "n_drifted", "run_id", "decision", "new_auc", "prod_auc", "auc_improvement"
        ),
        ["drift_share", "new_auc", "prod_auc", "auc_improvement"],
    )


@query(
    "report_table",
    f"""{_JOIN} SELECT batch, coalesce(printf('%.2f', drift_share), '—') AS drift_share,
  CASE WHEN decision IN ('DEPLOY', 'DEPLOY_REFRESH') THEN 'Yes' WHEN decision = 'SKIP_NO_DRIFT' THEN 'No' WHEN decision = 'SKIP' THEN 'Skipped' ELSE '—' END AS retrained,
  coalesce(decision, '—') AS decision, coalesce(printf('%.3f', prod_auc), '—') AS prod_auc, coalesce(printf('%.3f', prod_f1), '—') AS prod_f1,
  CASE WHEN decision IN ('DEPLOY', 'DEPLOY_REFRESH') AND new_auc IS NOT NULL THEN printf('%.3f', new_auc) ELSE '—' END AS new_auc,
  CASE WHEN decision IN ('DEPLOY', 'DEPLOY_REFRESH') AND new_f1 IS NOT NULL THEN printf('%.3f', new_f1) ELSE '—' END AS new_f1,
  CASE WHEN drift_share >= 0.3 THEN 'red' WHEN drift_share IS NOT NULL THEN 'green' END AS drift_colour FROM j""",
)
def report_table(spark, sf):
    return B.metrics_table(_report(spark, sf))


@query(
    "report_headline",
    f"""{_JOIN} SELECT count(*) AS batches, count(*) FILTER (decision IN ('DEPLOY', 'DEPLOY_REFRESH')) AS retraining_events,
  count(*) FILTER (coalesce(drift_share, 0) >= 0.3) AS drifted_batches,
  round(first(coalesce(prod_auc, new_auc) ORDER BY batch), 6) AS starting_auc, round(last(coalesce(new_auc, prod_auc) ORDER BY batch), 6) AS ending_auc,
  round(last(coalesce(new_auc, prod_auc) ORDER BY batch) - first(coalesce(prod_auc, new_auc) ORDER BY batch), 6) AS auc_change FROM j""",
)
def report_headline(spark, sf):
    return rounded(B.headline(_report(spark, sf)), ["starting_auc", "ending_auc", "auc_change"])


# ------------------------------------------------------------------- run search
_HPO = """SELECT event_id::VARCHAR AS run_id, ts AS start_time, CASE WHEN user_id % 3 = 0 THEN 'GBT' ELSE 'LogisticRegression' END AS model_name,
  CASE WHEN event_type IN ('click', 'view') THEN 'True' END AS best_hpo_model, CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END AS debug_mode,
  CASE WHEN event_id % 3 <> 2 THEN 'True' END AS preprocessor, value AS val_f1_score FROM events"""


def hpo_runs(spark, sf):
    return L.run_rows(
        table(spark, sf, "events"), F.col("event_id"), "training", F.col("ts"),
        params={"user": F.col("user_id")},
        metrics={"val_f1_score": F.col("value")},
        tags={
            "model_name": F.when(F.col("user_id") % 3 == 0, "GBT").otherwise("LogisticRegression"),
            "best_hpo_model": F.when(F.col("event_type").isin("click", "view"), "True"),
            "debug_mode": F.when(F.col("event_id") % 2 == 0, "True").otherwise("False"),
            "preprocessor": F.when(F.col("event_id") % 3 != 2, "True"),
        },
    )


@query(
    "runlog_search",
    f"SELECT run_id, start_time, round(val_f1_score, 6) AS val_f1_score FROM ({_HPO}) WHERE model_name = 'GBT' AND best_hpo_model = 'True' "
    "ORDER BY start_time DESC, run_id",
)
def runlog_search(spark, sf):
    tags = F.col("tags")
    t = B.search_runs(
        hpo_runs(spark, sf), (tags["model_name"] == "GBT") & (tags["best_hpo_model"] == "True"), "training"
    )
    return t.select(
        "run_id", F.col("start_time").cast("timestamp_ntz").alias("start_time"),
        r(F.col("metrics")["val_f1_score"]).alias("val_f1_score"),
    )


def _best_sql(model: str) -> str:
    return f"""(SELECT * FROM (SELECT *, CASE WHEN best_hpo_model = 'True' AND debug_mode = 'False' THEN 1 WHEN best_hpo_model = 'True' THEN 2
  WHEN debug_mode = 'True' THEN 3 END AS tier FROM ({_HPO}) WHERE model_name = '{model}') WHERE tier IS NOT NULL
  ORDER BY tier, val_f1_score DESC, run_id LIMIT 1)"""


@query(
    "best_run",
    f"SELECT run_id, model_name, tier, round(val_f1_score, 6) AS score, preprocessor = 'True' AS deployable FROM {_best_sql('GBT')} "
    f"UNION ALL SELECT run_id, model_name, tier, round(val_f1_score, 6), preprocessor = 'True' FROM {_best_sql('LogisticRegression')}",
)
def best_run(spark, sf):
    runs = hpo_runs(spark, sf)
    out = None
    for model in ("GBT", "LogisticRegression"):
        t = B.best_run(runs, model, require_preprocessor=False).select(
            "run_id", F.col("tags")["model_name"].alias("model_name"), "tier", r(F.col("score")).alias("score"),
            (F.try_element_at("tags", F.lit("preprocessor")) == "True").alias("deployable"),
        )
        out = t if out is None else out.unionByName(t)
    return out


@query(
    "metric_or_param",
    "SELECT event_id::VARCHAR AS run_id, CASE WHEN event_id % 3 = 0 THEN round(value, 6) WHEN event_id % 3 = 1 THEN user_id::DOUBLE ELSE -1.0 END::DOUBLE AS score FROM events",
)
def metric_or_param(spark, sf):
    i = F.col("event_id")
    runs = L.run_rows(
        table(spark, sf, "events"), i, "x", F.col("ts"),
        params={"score": F.when(i % 3 == 1, F.col("user_id").cast("string")).otherwise("n/a")},
        metrics={"score": F.when(i % 3 == 0, F.col("value"))},
    )
    return runs.select("run_id", r(B.metric_or_param("score", F.lit(-1.0))).alias("score"))


# --------------------------------------------------------------------- registry
_REG = """SELECT 'model_' || (user_id % 7) AS model, (event_id % 30)::INTEGER AS version, event_id::VARCHAR AS run_id,
  CASE event_type WHEN 'purchase' THEN 'Production' WHEN 'signup' THEN 'Staging' ELSE 'Archived' END AS stage, ts FROM events
  WHERE event_type IN ('purchase', 'signup', 'error')"""


def registry_events(spark, sf):
    return (
        table(spark, sf, "events")
        .where("event_type IN ('purchase', 'signup', 'error')")
        .select(
            F.concat(F.lit("model_"), (F.col("user_id") % 7).cast("string")).alias("model"),
            (F.col("event_id") % 30).cast("int").alias("version"),
            F.col("event_id").cast("string").alias("run_id"),
            F.when(F.col("event_type") == "purchase", "Production")
            .when(F.col("event_type") == "signup", "Staging").otherwise("Archived").alias("stage"),
            "ts",
        )
    )


_VIEW = f"""reg AS ({_REG}), lt AS (SELECT * FROM reg QUALIFY row_number() OVER (PARTITION BY model, version ORDER BY ts DESC) = 1),
pv AS (SELECT model, arg_max(version, ts) AS prod FROM lt WHERE stage = 'Production' GROUP BY model),
vw AS (SELECT lt.model, lt.version, lt.run_id, lt.ts AS since,
  CASE WHEN stage = 'Production' AND version <> prod THEN 'Archived' ELSE stage END AS stage FROM lt LEFT JOIN pv USING (model))"""


@query("production_view", f"WITH {_VIEW} SELECT * FROM vw")
def production_view(spark, sf):
    return B.registry_view(registry_events(spark, sf))


@query("champion", f"WITH {_VIEW} SELECT model, version, run_id FROM vw WHERE stage = 'Production'")
def champion(spark, sf):
    return B.champion(B.registry_view(registry_events(spark, sf))).select("model", "version", "run_id")


@query(
    "promote_best_run",
    f"WITH {_VIEW}, b AS {_best_sql('GBT')}, ev AS (SELECT * FROM reg UNION ALL SELECT 'model_1', (SELECT max(version) + 1 FROM vw WHERE model = 'model_1')::INTEGER, "
    "run_id, 'Production', TIMESTAMP '2024-03-01' FROM b) SELECT version, run_id, 'Production' AS stage FROM ev WHERE model = 'model_1' ORDER BY ts DESC LIMIT 1",
)
def promote_best_run(spark, sf):
    """Register the best run as the next version; the earlier champion is archived."""
    events = registry_events(spark, sf)
    best = B.best_run(hpo_runs(spark, sf), "GBT", require_preprocessor=False)
    promoted = B.promotion_events(best, B.registry_view(events), "model_1", moment("2024-03-01"))
    view = B.registry_view(events.unionByName(promoted))
    return B.champion(view).where("model = 'model_1'").select("version", "run_id", "stage")


@query(
    "registry_audit",
    f"""WITH {_VIEW}, la AS (SELECT * FROM vw QUALIFY row_number() OVER (PARTITION BY model ORDER BY version DESC) = 1),
rn AS (SELECT run_id, best_hpo_model, model_name FROM ({_HPO}) WHERE run_id::BIGINT % 5 <> 0),
ch AS (SELECT la.model, version, stage, la.run_id, CASE WHEN stage <> 'Production' THEN 'latest_not_in_production'
  WHEN rn.run_id IS NULL THEN 'source_run_missing'
  WHEN NOT coalesce(best_hpo_model = 'True' AND model_name = la.model, FALSE) THEN 'tags_not_as_expected' ELSE '' END AS failed_checks
  FROM la LEFT JOIN rn ON la.run_id = rn.run_id)
SELECT *, failed_checks = '' AS passed FROM ch""",
)
def registry_audit(spark, sf):
    runs = hpo_runs(spark, sf).where(F.col("run_id").cast("bigint") % 5 != 0)
    return B.registry_audit(B.registry_view(registry_events(spark, sf)), runs)


# -------------------------------------------------------------------- summaries
@query(
    "batch_summary",
    f"""WITH e AS (SELECT *, {BATCH_SQL} AS b FROM events),
m AS (SELECT b, user_id % 3 AS pattern, count(*) AS batch_size, 1 - avg((event_type = 'error')::INT) AS q, sum(value) AS secs FROM e GROUP BY ALL)
SELECT pattern, count(*) AS batches, round(avg(batch_size), 6) AS average_batch_size, round(avg(q), 6) AS average_quality_score,
  round(sum(secs), 4) AS total_processing_time FROM m GROUP BY pattern""",
)
def batch_summary(spark, sf):
    manifest = (
        with_batch(table(spark, sf, "events"))
        .groupBy("batch_number", (F.col("user_id") % 3).alias("pattern"))
        .agg(
            F.count(F.lit(1)).alias("batch_size"),
            (F.lit(1.0) - F.avg((F.col("event_type") == "error").cast("double"))).alias("data_quality_score"),
            F.sum("value").alias("processing_seconds"),
        )
    )
    t = B.batch_run_summary(manifest, ["pattern"])
    return rounded(
        rounded(t, ["average_batch_size", "average_quality_score"]), ["total_processing_time"], 4
    )


@query(
    "outcome_rates",
    """WITH s AS (SELECT user_id % 4 AS suite, event_id % 2 = 0 AS d, event_id % 3 = 0 AS r, event_id % 6 = 0 AS m, event_id % 5 <> 0 AS p,
  event_type IN ('click', 'view') AS expected, value FROM events)
SELECT suite, round(avg(d::INT), 6) AS drift_detection_accuracy, round(count(*) FILTER (r) / count(*) FILTER (expected)::DOUBLE, 6) AS retraining_trigger_success,
  round(count(*) FILTER (m) / count(*) FILTER (r)::DOUBLE, 6) AS deployment_success_rate, round(avg(p::INT), 6) AS performance_maintenance_rate,
  round(avg(value), 6) AS average_duration FROM s GROUP BY suite""",
)
def outcome_rates(spark, sf):
    i = F.col("event_id")
    results = table(spark, sf, "events").select(
        (F.col("user_id") % 4).alias("suite"),
        F.when(F.col("event_type") == "click", "moderate_covariate")
        .when(F.col("event_type") == "view", "major_concept").otherwise("no_drift").alias("scenario_name"),
        (i % 2 == 0).alias("drift_detected"), (i % 3 == 0).alias("retraining_triggered"),
        (i % 6 == 0).alias("model_deployed"), (i % 5 != 0).alias("performance_maintained"),
        F.col("value").alias("duration_seconds"),
    )
    t = B.outcome_rates(results, ["suite"])
    return rounded(t, [c for c in t.columns if c != "suite"])


# -------------------------------------------------------------------- error log
_TYPES = ["NoSuchKey", "TimeoutError", "MemoryError", "ConnectionError", "ValueError", "OSError", "AccessDenied", "RestException"]
_WORDS = ["fatal crash", "disk quota reached", "bad credential", "Connection reset", "plain failure"]
_ERR = f"""SELECT event_id::VARCHAR AS error_id, ts, ([{', '.join(f"'{t}'" for t in _TYPES)}])[event_id % {len(_TYPES)} + 1] AS error_type,
  'component_' || (user_id % 4) AS component, ([{', '.join(f"'{w}'" for w in _WORDS)}])[user_id % {len(_WORDS)} + 1] || ' in step ' || (user_id % 6) AS message
FROM events WHERE event_type = 'error'"""
_RULES = " ".join(f"WHEN '{t}' THEN ['{s}', '{c}', '{a}']" for t, (s, c, a) in X.RULES.items())
_ADVICE = " ".join(f"WHEN '{t}' THEN '{a}'" for t, a in X.ADVICE.items())
_CLS = f"""WITH er AS ({_ERR}), ru AS (SELECT *, coalesce(CASE error_type {_RULES} END, ['medium', 'unknown', 'retry_with_backoff']) AS rule,
  CASE WHEN regexp_matches(lower(message), 'critical|fatal|emergency') THEN 1 WHEN regexp_matches(lower(message), 'memory|disk|timeout|quota') THEN 2
    WHEN regexp_matches(lower(message), 'config|permission|auth|credential') THEN 3 ELSE 0 END AS kw FROM er),
cl AS (SELECT error_id, ts, error_type, component, message, CASE WHEN kw = 1 THEN 'critical' WHEN kw = 2 AND rule[1] = 'low' THEN 'medium' ELSE rule[1] END AS severity,
  CASE WHEN kw = 2 AND rule[2] = 'unknown' THEN 'resource' WHEN kw = 3 THEN 'configuration' ELSE rule[2] END AS category,
  CASE WHEN kw IN (1, 3) THEN 'escalate' ELSE rule[3] END AS recovery,
  coalesce(CASE error_type {_ADVICE} END, CASE WHEN lower(message) LIKE '%connection%' THEN '{X.CONNECTION_ADVICE}' ELSE '{X.DEFAULT_ADVICE}' END) AS advice FROM ru)"""


def error_log(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'error'")
    types = F.array(*[F.lit(t) for t in _TYPES])
    words = F.array(*[F.lit(w) for w in _WORDS])
    return e.select(
        F.col("event_id").cast("string").alias("error_id"), "ts",
        F.get(types, (F.col("event_id") % len(_TYPES)).cast("int")).alias("error_type"),
        F.concat(F.lit("component_"), (F.col("user_id") % 4).cast("string")).alias("component"),
        F.concat(
            F.get(words, (F.col("user_id") % len(_WORDS)).cast("int")), F.lit(" in step "),
            (F.col("user_id") % 6).cast("string"),
        ).alias("message"),
    )


@query("error_classify", f"{_CLS} SELECT * FROM cl")
def error_classify(spark, sf):
    return X.classify_errors(error_log(spark, sf))


_RECENT = f"{_CLS}, rc AS (SELECT * FROM cl WHERE ts > TIMESTAMP '2024-01-20' - INTERVAL 240 HOUR AND ts <= TIMESTAMP '2024-01-20')"


def _recent(spark, sf):
    until = moment("2024-01-20")
    return X.recent(
        X.classify_errors(error_log(spark, sf)).where(F.col("ts") <= until), until, 240
    )


@query(
    "error_report",
    f"""{_RECENT} SELECT 'severity' AS dimension, severity AS key, count(*) AS n FROM rc GROUP BY 2 UNION ALL
SELECT 'category', category, count(*) FROM rc GROUP BY 2 UNION ALL SELECT 'component', component, count(*) FROM rc GROUP BY 2 UNION ALL
SELECT 'message', message, count(*) FROM rc GROUP BY 2 UNION ALL SELECT 'total', 'all', count(*) FROM rc""",
)
def error_report(spark, sf):
    return X.error_report(_recent(spark, sf))


@query(
    "severe_errors",
    f"{_RECENT} SELECT error_id, ts, severity, message FROM rc WHERE severity IN ('high', 'critical') ORDER BY ts, error_id LIMIT 10",
)
def severe_errors(spark, sf):
    return X.first_severe(_recent(spark, sf), 10).select("error_id", "ts", "severity", "message")


_CHECKS = """SELECT 'service_' || (user_id % 5) AS component, ts,
  CASE WHEN event_id % 17 = 0 THEN 'degraded' WHEN event_id % 23 = 0 THEN 'critical' ELSE 'healthy' END AS status, value AS response_time_ms FROM events"""


def _checks(spark, sf):
    i = F.col("event_id")
    return table(spark, sf, "events").select(
        F.concat(F.lit("service_"), (F.col("user_id") % 5).cast("string")).alias("component"), "ts",
        F.when(i % 17 == 0, "degraded").when(i % 23 == 0, "critical").otherwise("healthy").alias("status"),
        F.col("value").alias("response_time_ms"),
    )


@query(
    "component_health",
    f"SELECT component, status, response_time_ms, ts AS last_check FROM ({_CHECKS}) QUALIFY row_number() OVER (PARTITION BY component ORDER BY ts DESC) = 1",
)
def component_health(spark, sf):
    return X.component_health(_checks(spark, sf))


@query(
    "overall_health",
    f"SELECT count(*) AS components, CASE WHEN bool_and(status = 'healthy') THEN 'healthy' ELSE 'degraded' END AS overall FROM "
    f"(SELECT * FROM ({_CHECKS}) QUALIFY row_number() OVER (PARTITION BY component ORDER BY ts DESC) = 1)",
)
def overall_health(spark, sf):
    return X.overall_health(X.component_health(_checks(spark, sf)))


# --------------------------------------------------------------------- manifest
_MAN = f"""SELECT 'batch_' || b || '_' || (user_id % 20) AS batch_id, max(ts) AS modified, count(*) * 100 AS size_bytes
FROM (SELECT *, {BATCH_SQL} AS b FROM events) GROUP BY b, user_id % 20"""


def _manifest(spark, sf):
    e = with_batch(table(spark, sf, "events"))
    return (
        e.groupBy("batch_number", (F.col("user_id") % 20).alias("part"))
        .agg(F.max("ts").alias("modified"), (F.count(F.lit(1)) * 100).alias("size_bytes"))
        .select(
            F.concat_ws("_", F.lit("batch"), F.col("batch_number").cast("string"), F.col("part").cast("string"))
            .alias("batch_id"),
            "modified", "size_bytes",
        )
    )


@query(
    "backlog_status",
    f"""WITH m AS ({_MAN}), t AS (SELECT count(*) AS c, max((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(modified)) / 3.6e9) AS h, sum(size_bytes)::BIGINT AS s FROM m)
SELECT c AS backlog_count, round(h, 6) AS oldest_batch_age_hours, s AS total_backlog_size_bytes,
  CASE WHEN c > 10 THEN 'catch_up_mode' WHEN h > 24 THEN 'urgent_processing' WHEN c < 3 THEN 'normal_processing' ELSE 'elevated_processing' END AS priority_adjustment,
  CASE WHEN c > 10 THEN 'reduce_by_50_percent' WHEN h > 24 THEN 'reduce_by_30_percent' WHEN c < 3 THEN 'standard' ELSE 'reduce_by_20_percent' END AS recommended_interval,
  CASE WHEN c > 10 THEN 'backlog_alert' ELSE 'healthy' END AS status FROM t""",
)
def backlog_status(spark, sf):
    return rounded(BT.backlog_status(_manifest(spark, sf), moment("2024-02-01")), ["oldest_batch_age_hours"])


@query(
    "retention",
    f"SELECT count(*) AS batches_expired, coalesce(sum(size_bytes), 0)::BIGINT AS bytes_expired FROM ({_MAN}) WHERE modified < TIMESTAMP '2024-01-25' - INTERVAL 7 DAY",
)
def retention(spark, sf):
    return BT.retention_report(_manifest(spark, sf), moment("2024-01-25"), 7)


@query("oldest_batches", f"SELECT batch_id, modified, size_bytes FROM ({_MAN}) ORDER BY modified, batch_id LIMIT 3")
def oldest_batches(spark, sf):
    return BT.oldest_first(_manifest(spark, sf), 3).select("batch_id", "modified", "size_bytes")
