"""Streaming queries: each runs over everything available and reads its sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators import errors as X
from tidemark.operators import train as T
from tidemark.operators.encode import fit_encoder
from tidemark.operators.sides import long_form
from tidemark.session import join_small, shared_dir
from tidemark.sources import runlog
from tidemark.streaming import cooldown, monitor, whole, windows

from .common import events_by_batch, query, r, rounded, table, with_batch
from .drift import EV_CONSENSUS, EV_KINDS


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query(
    "stream_drift",
    f"{EV_CONSENSUS} SELECT grp::VARCHAR AS batch_number, round(drift_share, 6) AS drift_share, "
    "n_drifted_columns::DOUBLE AS n_drifted_columns, status, drift_indicators AS indicators FROM cs1",
)
def stream_drift(spark, sf):
    reference = with_batch(table(spark, sf, "events")).where("batch_number = 0")
    stream = with_batch(_event_stream(spark, sf)).where("batch_number <> 0")
    log = shared_dir(spark, "stream-log")
    monitor.drift_monitor(
        stream, reference, "batch_number", EV_KINDS, log, shared_dir(spark, "stream-state"), threshold=0.3
    ).awaitTermination()
    runs = runlog.read(spark, log)
    return runs.select(
        F.col("params")["batch_number"].alias("batch_number"),
        r(F.col("metrics")["drift_share"]).alias("drift_share"),
        F.col("metrics")["n_drifted_columns"].alias("n_drifted_columns"),
        F.col("tags")["status"].alias("status"), F.col("tags")["indicators"].alias("indicators"),
    )


@query(
    "stream_drift_split",
    f"{EV_CONSENSUS} SELECT grp::VARCHAR AS batch_number, round(drift_share, 6) AS drift_share, "
    "n_drifted_columns::DOUBLE AS n_drifted_columns, status, drift_indicators AS indicators FROM cs1",
)
def stream_drift_split(spark, sf):
    """Every batch arrives in four files, one per trigger; each is judged once, when complete."""
    events = with_batch(table(spark, sf, "events")).where("batch_number IS NOT NULL")
    source, markers = shared_dir(spark, "split-source"), shared_dir(spark, "split-markers")
    current = events.where("batch_number <> 0")
    current.drop("batch_number").repartition(4).write.parquet(source)
    current.groupBy(F.col("batch_number").alias("batch")).agg(F.count(F.lit(1)).alias("n_rows")).write.parquet(markers)
    stream = with_batch(
        spark.readStream.schema(table(spark, sf, "events").schema).option("maxFilesPerTrigger", 1).parquet(source)
    )
    log = shared_dir(spark, "split-log")
    whole.whole_batch_monitor(
        stream, events.where("batch_number = 0"), "batch_number", EV_KINDS, markers,
        shared_dir(spark, "split-state"), log, shared_dir(spark, "split-checkpoint"), threshold=0.3,
    ).awaitTermination()
    runs = whole.read_log(spark, log)
    return runs.select(
        F.col("params")["batch_number"].alias("batch_number"),
        r(F.col("metrics")["drift_share"]).alias("drift_share"),
        F.col("metrics")["n_drifted_columns"].alias("n_drifted_columns"),
        F.col("tags")["status"].alias("status"), F.col("tags")["indicators"].alias("indicators"),
    )


_WINDOWS = """WITH e AS (SELECT value, CAST(floor((epoch_us(ts) - 1704067200000000) / (5 * 86400 * 1000000.0)) AS INTEGER) AS b FROM events),
mx AS (SELECT max(epoch_us(ts)) - 3600 * 1000000::BIGINT AS wm FROM events),
g AS (SELECT min(value) AS lo, max(value) AS hi FROM e WHERE b = 0),
c AS (SELECT b, CASE WHEN value < lo OR value > hi THEN -1 ELSE len(list_filter(range(1, 10), lambda i: value >= i * ((hi - lo) / 10.0::DOUBLE) + lo)) END AS bin,
  count(*) AS n FROM e, g GROUP BY ALL)"""
_CLOSED = "1704067200000000 + (b + 1) * 5 * 86400 * 1000000::BIGINT <= wm"


def _window_counts(spark, sf):
    edges = D.with_edges(D.paired_moments(events_by_batch(spark, sf), ["value"])).select(
        "feature", *D._EDGES
    )
    counts = windows.window_bin_counts(
        _event_stream(spark, sf), ["value"], edges, "5 days", "3 days"
    )
    out = shared_dir(spark, "windows")
    windows.append_to(counts, out, shared_dir(spark, "windows-state")).awaitTermination()
    return spark.read.parquet(out), edges


@query(
    "stream_window_counts",
    f"{_WINDOWS} SELECT TIMESTAMP '2024-01-01' + to_days(5 * b) AS window_start, 'value' AS feature, bin::INTEGER AS psi_bin, n AS n_cur "
    f"FROM c, mx WHERE {_CLOSED}",
)
def stream_window_counts(spark, sf):
    counts, _ = _window_counts(spark, sf)
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "stream_window_psi",
    f"""{_WINDOWS}, t AS (SELECT b, sum(n) AS tot FROM c WHERE bin >= 0 GROUP BY b), k AS (SELECT unnest(range(0, 10)) AS bin),
p AS (SELECT t.b, k.bin, greatest(coalesce(x.n, 0) / t.tot::DOUBLE, 1e-6) AS q,
  greatest(coalesce(z.n, 0) / (SELECT tot FROM t WHERE b = 0)::DOUBLE, 1e-6) AS p FROM t CROSS JOIN k
  LEFT JOIN c x ON x.b = t.b AND x.bin = k.bin LEFT JOIN c z ON z.b = 0 AND z.bin = k.bin)
SELECT TIMESTAMP '2024-01-01' + to_days(5 * b) AS window_start, 'value' AS feature, round(sum((q - p) * ln(q / p)), 6) AS psi
FROM p, mx WHERE {_CLOSED} GROUP BY b""",
)
def stream_window_psi(spark, sf):
    counts, edges = _window_counts(spark, sf)
    reference = events_by_batch(spark, sf).where("is_ref").select("value", "is_ref")
    cells = long_form(reference, ["value"], "numeric")
    per_bin = (
        join_small(cells, edges, ["feature"])
        .select("feature", "n_ref", D._bin("psi", D.PSI_BINS))
        .groupBy("feature", "psi_bin")
        .agg(F.sum("n_ref").alias("n_ref"))
    )
    t = windows.window_psi(counts, per_bin)
    return rounded(t.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), ["psi"])


@query(
    "stream_error_counts",
    """WITH e AS (SELECT epoch_us(ts) AS us, CASE WHEN user_id % 3 = 0 THEN 'medium' WHEN user_id % 3 = 1 THEN 'high' ELSE 'low' END AS severity
  FROM events WHERE event_type = 'error'), mx AS (SELECT max(us) - 3600 * 1000000::BIGINT AS wm FROM e),
w AS (SELECT severity, (us // 900000000 - k) * 900000000 AS st FROM e, (SELECT unnest(range(0, 4)) AS k))
SELECT make_timestamp(st::BIGINT) AS window_start, severity, count(*) AS n FROM w, mx WHERE st + 3600000000 <= wm GROUP BY ALL""",
)
def stream_error_counts(spark, sf):
    kind = (
        F.when(F.col("user_id") % 3 == 0, "TimeoutError")
        .when(F.col("user_id") % 3 == 1, "AccessDenied").otherwise("ValueError")
    )
    errors = _event_stream(spark, sf).where("event_type = 'error'").select(
        "ts", kind.alias("error_type"), F.lit("plain").alias("message")
    )
    counts = windows.sliding_error_counts(X.classify_errors(errors))
    out = shared_dir(spark, "error-windows")
    windows.append_to(counts, out, shared_dir(spark, "error-windows-state")).awaitTermination()
    return spark.read.parquet(out).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


@query("stream_score", "SELECT count(*) AS scored, 0::BIGINT AS mismatches FROM events")
def stream_score(spark, sf):
    """Streaming scores equal batch scores."""
    rows = table(spark, sf, "events").select(
        "event_id", "value", "user_id", (F.col("event_type") == "purchase").cast("double").alias("label")
    )
    encoder = fit_encoder(rows, ["value", "user_id"], [])
    train = T.with_class_weights(encoder.transform(rows))
    model = T.logistic_regression(rows.count(), maxIter=5).fit(train)
    out = shared_dir(spark, "scores")
    monitor.score_stream(
        _event_stream(spark, sf), encoder, model, ["event_id"], out, shared_dir(spark, "scores-state")
    ).awaitTermination()
    batch = T.score(encoder.transform(rows), model, ["event_id"])
    both = spark.read.parquet(out).join(
        batch.select("event_id", F.col("prediction").alias("p"), F.col("probability_score").alias("s")),
        "event_id",
    )
    different = (F.col("prediction") != F.col("p")) | (F.abs(F.col("probability_score") - F.col("s")) > 1e-12)
    return both.agg(F.count(F.lit(1)).alias("scored"), F.count_if(different).alias("mismatches"))


@query(
    "stream_cooldown",
    """WITH RECURSIVE a AS (SELECT (user_id % 20)::VARCHAR AS monitor, ts FROM events WHERE event_type = 'error'),
c AS (SELECT monitor, min(ts) AS ts FROM a GROUP BY monitor
  UNION ALL SELECT monitor, n AS ts FROM (SELECT c.monitor, (SELECT min(a.ts) FROM a WHERE a.monitor = c.monitor AND a.ts >= c.ts + INTERVAL 6 HOUR) AS n FROM c) WHERE n IS NOT NULL)
SELECT monitor, ts FROM c""",
)
def stream_cooldown(spark, sf):
    alerts = _event_stream(spark, sf).where("event_type = 'error'").select(
        (F.col("user_id") % 20).cast("string").alias("monitor"), "ts"
    )
    out = shared_dir(spark, "alerts")
    windows.append_to(
        cooldown.with_cooldown(alerts), out, shared_dir(spark, "alerts-state")
    ).awaitTermination()
    return spark.read.parquet(out).select("monitor", F.col("ts").cast("timestamp_ntz").alias("ts"))
