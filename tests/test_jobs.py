import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import encode as M
from tidemark.operators import train as T
from tidemark.operators.decide import model_scores, regression_gate
from tidemark.operators.evaluate import pair_scores
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import batches, runlog, tables
from tidemark.streaming import cooldown, monitor


def frame(spark, seed, lo, spread, rate):
    rng = random.Random(seed)
    rows = [
        (i + seed * 1000, rng.randint(lo, lo + 8), rng.randint(5 * lo, 5 * lo + spread), int(rng.random() < rate))
        for i in range(100)
    ]
    return spark.createDataFrame(
        rows, "id long, time_in_hospital int, num_medications int, readmitted_binary int"
    )


def test_retraining_flow(spark, tmp_path):
    """Initial data, a shifted batch, cumulative training data, two models, a decision."""
    initial, shifted = frame(spark, 1, 1, 14, 0.3), frame(spark, 2, 3, 20, 0.4)
    log = str(tmp_path / "runs")
    features = {"time_in_hospital": "numeric", "num_medications": "numeric"}
    run = jobs.drift_run(initial, shifted, 1, log, features).first()
    assert run.dataset_drift and run.drift_share == 1.0

    earlier = frame(spark, 3, 1, 14, 0.3).withColumn("batch_number", F.lit(0))
    data = jobs.retraining_data([initial], earlier, shifted, 1, ["id"])
    assert data.count() == 100 + 100 + 70
    assert data.where("part = 'validation'").count() == 54
    test = tables.get_or_create_test_set(
        shifted.withColumn("batch_number", F.lit(1)), str(tmp_path / "tests"), 1, ["id"], "readmitted_binary"
    )
    assert test.join(data, "id").count() == 0

    def fit(rows):
        encoder = M.fit_encoder(rows, list(features), [])
        ready = T.with_class_weights(encoder.transform(rows.withColumn("label", F.col("readmitted_binary").cast("double"))))
        model = T.logistic_regression(rows.count(), maxIter=10).fit(ready)
        return T.score_raw(test, encoder, model, ["id", "readmitted_binary"]).select(
            "id", F.col("readmitted_binary").alias("label"), F.col("probability_score").alias("score")
        )

    pairs = pair_scores(fit(initial), fit(data.where("part = 'train'")), ["id"])
    decided = jobs.gate_and_log(pairs, 1, "run", F.current_timestamp(), log).first()
    assert decided.decision in {"DEPLOY", "DEPLOY_REFRESH", "SKIP"} and decided.test_rows == 30
    report = jobs.experiment_report(spark, log).first()
    assert report.batch == 1 and report.decision == decided.decision


def test_identical_models_have_no_difference(spark):
    rows = spark.range(100).selectExpr("id", "CAST(id % 2 AS INT) AS label", "rand(3) AS score")
    out = regression_gate(model_scores(pair_scores(rows, rows.select("id", "score"), ["id"]))).first()
    assert abs(out.auc_improvement) < 0.001 and out.decision == "DEPLOY"


def test_failure_assumes_drift(spark):
    bad = spark.range(3).selectExpr("CAST(raise_error('broken') AS DOUBLE) AS x")
    ref = spark.range(3).selectExpr("CAST(id AS DOUBLE) AS x")
    row = jobs.drift_run(ref, bad, 1, on_error="assume_drift").first()
    assert row.dataset_drift and row.drift_share == 1.0 and row.status == "ERROR_ASSUMED_DRIFT"
    with pytest.raises(Exception, match="broken"):
        jobs.drift_run(ref, bad, 1).collect()


def test_encoder_unknown_and_missing(spark, tmp_path):
    fit = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (5.0, None)], "x double, c string")
    model = M.fit_encoder(fit, ["x"], ["c"])
    assert M.encoded_names(model) == ["num__x", "cat__c___null__", "cat__c_a", "cat__c_b"]
    new = spark.createDataFrame([(3.0, "zzz"), (3.0, "b"), (3.0, None)], "x double, c string")
    got = [list(r.features.toArray()) for r in M.encode(new, model).collect()]
    assert got == [[0, 0, 0, 0], [0, 0, 0, 1], [0, 1, 0, 0]]
    M.save_encoder(model, str(tmp_path / "m"))
    again = M.encode(new, M.load_encoder(str(tmp_path / "m"))).collect()
    assert [list(r.features.toArray()) for r in again] == got
    with pytest.raises(FileNotFoundError):
        M.load_encoder(str(tmp_path / "nothing"))
    hashed = M.encode(new, M.fit_encoder(fit, ["x"], ["c"], hashed=16)).first()
    assert len(hashed.features) == 17


def test_sources(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_csv(spark, "no-scheme")
    path = str(tmp_path / "b")
    df = spark.range(30).selectExpr("id", "CAST(id % 3 AS INT) AS batch_number")
    tables.write_splits(df.where("batch_number <> 1"), path, "batch_number", fmt="parquet")
    assert tables.read_batches_before(spark, path, 2).count() == 10  # the gap is fine
    assert tables.stored_partition(spark, path, 1) is None
    assert tables.stored_partition(spark, str(tmp_path / "none"), 1) is None
    plan = tables.read_batch(spark, path, 2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(batch_number" in plan
    found = batches.list_batches(spark, path, "*.parquet")
    assert found.where("size_bytes > 0").count() == found.count() > 0


def test_backlog_priorities(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")

    def status(count, hours):
        m = spark.range(count).select(
            (now - F.expr(f"INTERVAL {hours} HOURS")).alias("modified"), F.lit(10).alias("size_bytes")
        )
        return batches.backlog_status(m, now).first()

    assert status(11, 1).priority_adjustment == "catch_up_mode"
    assert status(5, 25).priority_adjustment == "urgent_processing"
    assert status(2, 1).priority_adjustment == "normal_processing"
    assert status(4, 1).priority_adjustment == "elevated_processing"
    assert status(0, 1).oldest_batch_age_hours == 0.0


# ------------------------------------------------------------------- streaming
def test_stream_monitor_by_files_and_replay(spark, tmp_path):
    rng = np.random.default_rng(2)
    reference = spark.createDataFrame([(float(v),) for v in rng.normal(0, 1, 200)], "x double")
    for i in range(1, 6):
        rows = [(i, float(v)) for v in rng.normal(0 if i < 4 else 3, 1, 80)]
        spark.createDataFrame(rows, "batch_number int, x double").coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in")
        )
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    log = str(tmp_path / "log")
    for _ in range(2):  # a second start finds nothing new
        stream = monitor.batch_stream(spark, str(tmp_path / "in"), schema, files_per_trigger=3)
        monitor.drift_monitor(
            stream, reference, "batch_number", {"x": "numeric"}, log, str(tmp_path / "state")
        ).awaitTermination()
    runs = {r.params["batch_number"]: r.metrics["dataset_drift"] for r in runlog.read(spark, log).collect()}
    assert runlog.read(spark, log).count() == 5
    assert runs["4"] == runs["5"] == 1.0 and runs["1"] == runs["2"] == 0.0


def test_cooldown_choice():
    hour = 3600
    times = np.array([0, 1, 5, 6, 7, 11, 12, 13, 40]) * hour
    assert cooldown.first_after_pause(times, None, 6 * hour) == [t * hour for t in (0, 6, 12, 40)]
    assert cooldown.first_after_pause(times, 2 * hour, 6 * hour) == [t * hour for t in (11, 40)]


def test_cooldown_state_lasts_between_batches(spark, tmp_path):
    schema = "monitor string, ts timestamp"
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(*hours):
        rows = spark.createDataFrame([("m", h) for h in hours], "monitor string, h int").selectExpr(
            "monitor", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, h) AS ts"
        )
        rows.coalesce(1).write.mode("append").parquet(inbox)
        stream = cooldown.with_cooldown(spark.readStream.schema(schema).parquet(inbox))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(
            availableNow=True
        ).start().awaitTermination()
        return sorted(r.ts.hour for r in spark.read.parquet(out).collect())

    assert arrive(0, 2, 4) == [0]
    assert arrive(5, 7, 9) == [0, 7]


def test_shared_dir_follows_the_cluster_setting():
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.checkpoint.dir": "hdfs://shared/scratch/"}.get(key, default)

    assert shared_dir(Session, "x").startswith("hdfs://shared/scratch/x-")


def test_score_requests(spark):
    """Requests are checked, cleaned, encoded and scored; bad ones come back."""
    from tidemark import schema as S
    from tidemark.operators import cleaning as K

    columns = [
        *[f"CAST(id % 9 + 1 AS INT) AS `{c}`" for c in S.INTEGER_FIELDS],
        *[f"'No' AS `{c}`" for c in S.DRUG_FIELDS],
        "IF(id % 2 = 0, 'Female', 'Male') AS gender", "'[50-60)' AS age", "'Ch' AS change",
        "'Yes' AS diabetesMed", "IF(id % 5 = 0, '?', 'Asian') AS race", "'250' AS diag_1",
        "CAST(NULL AS STRING) AS diag_2", "'401' AS diag_3", "CAST(NULL AS STRING) AS max_glu_serum",
        "'Norm' AS A1Cresult",
    ]
    requests = spark.range(60).selectExpr("id", *columns)
    ready = K.rename_to_stored(K.featurise(K.clean(requests))).drop("age", "id")
    numeric, categorical = M.default_features(ready)
    assert "glyburide-metformin" in categorical and "age_ordinal" in numeric
    encoder = M.fit_encoder(ready, numeric, categorical)
    train = T.with_class_weights(
        encoder.transform(ready.withColumn("label", (F.col("num_medications") > 4).cast("double")))
    )
    model = T.logistic_regression(60, maxIter=5).fit(train)
    bad = requests.where("id < 3").withColumn("gender", F.lit(None).cast("string"))
    scored, rejected = jobs.score_requests(
        requests.where("id >= 3").unionByName(bad), encoder, model, ["id"]
    )
    rows = scored.collect()
    assert scored.columns == ["id", "prediction", "probability_score"]
    assert len(rows) == 57 and all(0 < r.probability_score < 1 for r in rows)
    assert {r.id for r in rejected.collect()} == {0, 1, 2}
