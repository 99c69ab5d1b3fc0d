"""Classifier evaluation and gate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import decide as R
from tidemark.operators import evaluate as E
from tidemark.operators import report as B
from tidemark.sources import artifacts as A

from .common import LABELLED_SQL, TWO_MODELS_SQL, labelled, query, rounded, table, two_models
from .drift import EV_CONSENSUS, batch_consensus

_CM = f"""WITH s AS ({TWO_MODELS_SQL}), c AS (SELECT model, count(*) FILTER (label = 0 AND score <= 0.5) AS tn,
  count(*) FILTER (label = 0 AND score > 0.5) AS fp, count(*) FILTER (label = 1 AND score <= 0.5) AS fn,
  count(*) FILTER (label = 1 AND score > 0.5) AS tp FROM s GROUP BY model)"""

_AUC = """a AS (SELECT p.model, sum(CASE WHEN p.score > n.score THEN 1.0::DOUBLE WHEN p.score = n.score THEN 0.5 ELSE 0 END) / count(*) AS auc
  FROM s p JOIN s n ON p.model = n.model AND p.label = 1 AND n.label = 0 GROUP BY p.model)"""


def _predicted(spark, sf):
    return two_models(spark, sf).withColumn("pred", E.predicted("score"))


@query("confusion", f"{_CM} SELECT * FROM c")
def confusion(spark, sf):
    return E.confusion(_predicted(spark, sf), "label", "pred", ["model"])


_M = f"""{_CM}, m AS (SELECT model, tn + fp + fn + tp AS support, (tp + tn) / (tn + fp + fn + tp)::DOUBLE AS accuracy,
  coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1 FROM c)"""


@query(
    "binary_metrics",
    f"{_M} SELECT model, support, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, "
    "round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m",
)
def binary_metrics(spark, sf):
    t = E.binary_metrics(_predicted(spark, sf), "label", "pred", ["model"])
    return rounded(t, ["accuracy", "precision", "recall", "f1"])


_REPORT = f"""{_CM}, p AS (SELECT *, tn + fp AS n0, fn + tp AS n1, tn + fp + fn + tp AS n, (tp + tn) / (tn + fp + fn + tp)::DOUBLE AS acc,
  coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS p0, coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS r0,
  coalesce(2 * tn / nullif(2 * tn + fp + fn, 0)::DOUBLE, 0) AS f0,
  coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS p1, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS r1,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1 FROM c),
x AS (SELECT model, '0' AS "class", p0 AS precision, r0 AS recall, f0 AS f1, n0 AS support FROM p
  UNION ALL SELECT model, '1', p1, r1, f1, n1 FROM p
  UNION ALL SELECT model, 'accuracy', acc, acc, acc, n FROM p
  UNION ALL SELECT model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM p
  UNION ALL SELECT model, 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n FROM p)
SELECT model, "class", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM x"""


@query("classification_report", _REPORT)
def classification_report(spark, sf):
    t = E.classification_report(_predicted(spark, sf), "label", "pred", ["model"])
    return rounded(t, ["precision", "recall", "f1"])


@query(
    "auc",
    f"WITH s AS ({TWO_MODELS_SQL}), {_AUC} SELECT a.model, round(auc, 6) AS auc, "
    "count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives FROM a JOIN s USING (model) GROUP BY ALL",
)
def auc(spark, sf):
    return rounded(E.auc(two_models(spark, sf), "label", "score", ["model"]), ["auc"])


@query(
    "auc_lineitem",
    """WITH d AS (SELECT l_extendedprice AS v, count(*) FILTER (l_returnflag = 'R') AS p, count(*) FILTER (l_returnflag <> 'R') AS n
  FROM lineitem GROUP BY 1), r AS (SELECT *, sum(n) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) - n AS below FROM d)
SELECT round(sum(p * (below + n / 2.0::DOUBLE)) / (sum(p)::DOUBLE * sum(n)), 6) AS auc, sum(p)::BIGINT AS positives, sum(n)::BIGINT AS negatives FROM r""",
)
def auc_lineitem(spark, sf):
    """Many distinct scores, through the multi-lane plan."""
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), "l_extendedprice"
    )
    return rounded(E.auc(rows, "label", "l_extendedprice"), ["auc"])


_ROC = f"""WITH s AS ({TWO_MODELS_SQL}), d AS (SELECT model, score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n
  FROM s GROUP BY ALL), c AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, lead(p) OVER w AS np, lead(n) OVER w AS nn,
  row_number() OVER w AS rn, sum(p) OVER (PARTITION BY model) AS tot_p, sum(n) OVER (PARTITION BY model) AS tot_n
  FROM d WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
pts AS (SELECT model, score AS threshold, fp / tot_n::DOUBLE AS fpr, tp / tot_p::DOUBLE AS tpr FROM c
  WHERE rn = 1 OR np IS NULL OR np <> p OR nn <> n
  UNION ALL SELECT DISTINCT model, 'inf'::DOUBLE, 0.0, 0.0 FROM d)"""


@query(
    "roc_points",
    f"{_ROC} SELECT model, CASE WHEN isinf(threshold) THEN 2.0 ELSE round(threshold, 6) END::DOUBLE AS threshold, "
    "round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM pts",
)
def roc_points(spark, sf):
    """The starting point's infinite threshold is shown as 2."""
    t = E.roc_points(two_models(spark, sf), "label", "score", ["model"])
    shown = F.when(F.col("threshold") == F.lit(float("inf")), F.lit(2.0)).otherwise(F.col("threshold"))
    return rounded(t.withColumn("threshold", shown), ["threshold", "fpr", "tpr"])


@query(
    "roc_json",
    f"{_ROC}, {_AUC} SELECT pts.model, count(*) AS points, round(sum(fpr), 6) AS sum_fpr, round(sum(tpr), 6) AS sum_tpr, "
    "round(max(auc), 6) AS auc FROM pts JOIN a ON pts.model = a.model GROUP BY pts.model",
)
def roc_json(spark, sf):
    """Curve and area as one JSON document per model, parsed back."""
    scores = two_models(spark, sf)
    doc = A.to_json_rows(
        A.roc_arrays(
            E.roc_points(scores, "label", "score", ["model"]), E.auc(scores, "label", "score", ["model"])
        ),
        ["model"],
    )
    back = A.from_json_rows(doc, A.ROC_SCHEMA, ["model"])
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return rounded(
        back.select(
            "model", F.size("fpr").cast("bigint").alias("points"), total("fpr").alias("sum_fpr"),
            total("tpr").alias("sum_tpr"), "auc",
        ),
        ["sum_fpr", "sum_tpr", "auc"],
    )


@query(
    "pair_scores",
    f"WITH l AS ({LABELLED_SQL}) SELECT doc_id, label, 'champion' AS model, round(score_champion, 6) AS score FROM l "
    "WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, label, 'challenger', round(score_challenger, 6) FROM l WHERE doc_id % 3 <> 0",
)
def pair_scores(spark, sf):
    rows = labelled(spark, sf)
    champion = rows.select("doc_id", "label", F.col("score_champion").alias("score"))
    challenger = rows.where("doc_id % 3 <> 0").select("doc_id", F.col("score_challenger").alias("score"))
    return rounded(E.pair_scores(champion, challenger, ["doc_id"]), ["score"])


_SCORES = f"""{_M}, {_AUC}, g AS (SELECT max(auc) FILTER (model = 'champion') AS prod_auc, max(auc) FILTER (model = 'challenger') AS new_auc,
  max(f1) FILTER (model = 'champion') AS prod_f1, max(f1) FILTER (model = 'challenger') AS new_f1, max(support) AS test_rows
  FROM m JOIN a USING (model))"""


def _signed_reason(metric: str) -> str:
    d = f"(new_{metric} - prod_{metric})"
    name = metric.upper()
    return (
        f"CASE WHEN {d} >= 0.02 THEN '{name} improved by ' || printf('%.3f', {d}) || ' (>= 0.020 threshold)' "
        f"WHEN {d} >= 0 THEN 'Minor {name} improvement: ' || printf('%.3f', {d}) "
        f"ELSE '{name} regression: ' || printf('%.3f', {d}) END"
    )


@query(
    "gate_quality",
    f"{_SCORES} "
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, round(prod_{m}, 6) AS prod_score, round(new_{m}, 6) AS new_score, "
        f"round(new_{m} - prod_{m}, 6) AS improvement, new_{m} - prod_{m} >= 0 AS approve, {_signed_reason(m)} AS reason FROM g"
        for m in ("auc", "f1")
    ),
)
def gate_quality(spark, sf):
    scores = R.model_scores(two_models(spark, sf))
    out = None
    for m in ("auc", "f1"):
        t = R.quality_gate(scores, m).select(
            "metric", F.col(f"prod_{m}").alias("prod_score"), F.col(f"new_{m}").alias("new_score"),
            "improvement", "approve", "reason",
        )
        out = t if out is None else out.unionByName(t)
    return rounded(out, ["prod_score", "new_score", "improvement"])


def _regression(new: str, prod: str, where: str) -> str:
    d = f"({new} - {prod})"
    return (
        f"SELECT '{where}' AS pairing, round({new}, 6) AS new_auc, round({d}, 6) AS auc_improvement, "
        f"CASE WHEN {d} >= 0 THEN 'DEPLOY' WHEN {d} >= -0.02 THEN 'DEPLOY_REFRESH' ELSE 'SKIP' END AS decision, "
        f"CASE WHEN {d} >= 0 THEN 'AUC maintained/improved by ' || printf('%.3f', {d}) "
        f"WHEN {d} >= -0.02 THEN 'Minor AUC regression (' || printf('%.3f', {d}) || ') within threshold (-0.02)' "
        f"ELSE 'AUC regression ' || printf('%.3f', {d}) || ' exceeds threshold (-0.02)' END AS reason FROM g"
    )


@query(
    "gate_regression",
    f"{_SCORES} {_regression('new_auc', 'prod_auc', 'challenger')} UNION ALL "
    f"{_regression('prod_auc', 'new_auc', 'swapped')} UNION ALL "
    f"{_regression('(prod_auc - 0.015)', 'prod_auc', 'slightly worse')} UNION ALL "
    "SELECT 'no champion', round(new_auc, 6), round(new_auc, 6), 'DEPLOY', 'No production model - deploying first model' FROM g",
)
def gate_regression(spark, sf):
    scores = R.model_scores(two_models(spark, sf)).select("prod_auc", "new_auc")
    pairs = F.array(
        F.struct(F.lit("challenger").alias("pairing"), F.col("new_auc"), F.col("prod_auc")),
        F.struct(
            F.lit("swapped").alias("pairing"), F.col("prod_auc").alias("new_auc"),
            F.col("new_auc").alias("prod_auc"),
        ),
        F.struct(
            F.lit("slightly worse").alias("pairing"), (F.col("prod_auc") - 0.015).alias("new_auc"),
            F.col("prod_auc"),
        ),
        F.struct(
            F.lit("no champion").alias("pairing"), F.col("new_auc"),
            F.lit(None).cast("double").alias("prod_auc"),
        ),
    )
    t = R.regression_gate(scores.select(F.inline(pairs)))
    return rounded(
        t.select("pairing", "new_auc", "auc_improvement", "decision", "reason"),
        ["new_auc", "auc_improvement"],
    )


@query(
    "gate_three_way",
    f"{_SCORES} SELECT round(new_auc - prod_auc, 6) AS change, CASE WHEN new_auc - prod_auc >= 0.02 THEN 'DEPLOY' "
    "WHEN new_auc - prod_auc >= 0 THEN 'DEPLOY_REFRESH' ELSE 'SKIP' END AS decision FROM g",
)
def gate_three_way(spark, sf):
    t = R.three_way_gate(R.model_scores(two_models(spark, sf)))
    return t.select(F.round(F.col("new_auc") - F.col("prod_auc"), 6).alias("change"), "decision")


@query(
    "production_only",
    f"""WITH s AS (SELECT 'b' || (doc_id % 3) AS model, label, score_champion AS score FROM ({LABELLED_SQL})),
c AS (SELECT model, count(*) FILTER (label = 0 AND score > 0.5) AS fp, count(*) FILTER (label = 1 AND score <= 0.5) AS fn,
  count(*) FILTER (label = 1 AND score > 0.5) AS tp FROM s GROUP BY model), {_AUC}
SELECT model AS batch, round(auc, 6) AS prod_auc_test, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS prod_f1_test,
  0.0::DOUBLE AS auc_improvement, 'SKIP_NO_DRIFT' AS decision FROM c JOIN a USING (model)""",
)
def production_only(spark, sf):
    rows = labelled(spark, sf).select(
        F.concat(F.lit("b"), (F.col("doc_id") % 3).cast("string")).alias("batch"), "label",
        F.col("score_champion").alias("score"),
    )
    t = R.production_only(rows, ["batch"])
    return rounded(
        t.select("batch", "prod_auc_test", "prod_f1_test", "auc_improvement", "decision"),
        ["prod_auc_test", "prod_f1_test"],
    )


@query(
    "gate_drift",
    f"""{EV_CONSENSUS} SELECT grp AS batch_number, round(drift_share, 6) AS drift_share,
  dataset_drift OR drift_share > 0.3 AS drift_detected,
  CASE WHEN dataset_drift OR drift_share > 0.3 OR grp = 5 THEN 'RETRAIN' ELSE 'EVALUATE_ONLY' END AS gate,
  CASE WHEN dataset_drift OR drift_share > 0.3 THEN 'drift_share=' || printf('%.3f', drift_share) || ' exceeds threshold'
    WHEN grp = 5 THEN 'force_retrain=True' ELSE 'no drift, drift_share=' || printf('%.3f', drift_share) END AS gate_reason FROM cs1""",
)
def gate_drift(spark, sf):
    runs = batch_consensus(spark, sf).withColumn("force", F.col("batch_number") == 5)
    t = R.drift_gate(runs, force="force")
    return rounded(
        t.select("batch_number", "drift_share", "drift_detected", "gate", "gate_reason"), ["drift_share"]
    )


@query(
    "metric_comparison",
    f"""WITH e AS (SELECT value, event_type, CAST(floor((epoch_us(ts) - 1704067200000000) / (5 * 86400 * 1000000.0)) AS INTEGER) AS b FROM events),
m AS (SELECT b, 'mean_value' AS metric, avg(value) AS v FROM e GROUP BY b UNION ALL
  SELECT b, 'purchase_rate', avg((event_type = 'purchase')::INT) FROM e GROUP BY b)
SELECT n.b AS batch_number, n.metric, round(o.v, 6) AS baseline, round(n.v, 6) AS new_value, round(n.v - o.v, 6) AS change,
  round((n.v - o.v) / o.v * 100, 6) AS change_percent, (n.v - o.v) / o.v * 100 >= -5 AS maintained,
  CASE WHEN bool_and((n.v - o.v) / o.v * 100 >= -5) OVER (PARTITION BY n.b) THEN 'maintained' ELSE 'degraded' END AS assessment
FROM m n JOIN m o ON o.b = 0 AND n.b > 0 AND n.metric = o.metric""",
)
def metric_comparison(spark, sf):
    from .common import with_batch

    per_batch = with_batch(table(spark, sf, "events")).groupBy("batch_number").agg(
        F.avg("value").alias("mean_value"),
        F.avg((F.col("event_type") == "purchase").cast("double")).alias("purchase_rate"),
    )
    long = per_batch.unpivot(["batch_number"], ["mean_value", "purchase_rate"], "metric", "value")
    compared = R.compare_metrics(
        long.where("batch_number = 0"), long.where("batch_number > 0"), ["batch_number"]
    )
    verdict = R.overall_assessment(compared, ["batch_number"])
    return rounded(
        compared.join(verdict, "batch_number"), ["baseline", "new_value", "change", "change_percent"]
    )


@query(
    "summary_kv",
    f"{_SCORES} SELECT 'decision' AS key, CASE WHEN new_auc - prod_auc >= 0.02 THEN 'DEPLOY' WHEN new_auc - prod_auc >= 0 "
    "THEN 'DEPLOY_REFRESH' ELSE 'SKIP' END AS value FROM g UNION ALL SELECT 'test_rows', test_rows::VARCHAR FROM g",
)
def summary_kv(spark, sf):
    row = R.three_way_gate(R.model_scores(two_models(spark, sf)))
    return B.as_key_values(row, ["decision", "test_rows"])
