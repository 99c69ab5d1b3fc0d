import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning as K
from tidemark.operators import combine as U
from tidemark.operators import decide as R
from tidemark.operators import errors as X
from tidemark.operators import evaluate as E
from tidemark.operators import perturb as G
from tidemark.operators import report as B
from tidemark.operators import sampling as W
from tidemark.operators.contract import encounter_contract, split_by_contract


@pytest.fixture(scope="module")
def six(spark):
    rows = [
        (1, 11, "Caucasian", "[70-80)", "?", 1, "250.83", "<30"),
        (2, 12, "AfricanAmerican", "[50-60)", "?", 1, "428", "NO"),
        (3, 13, "?", "[70-80)", "[75-100)", 11, "?", ">30"),
        (4, 14, "Caucasian", "[80-90)", "?", 1, "786", "<30"),
        (5, 15, "Asian", "[40-50)", "?", 1, "401", "NO"),
        (6, 16, "Hispanic", "[60-70)", "?", 13, "250", "NO"),
        (7, 17, "?", "old", "?", None, "?", None),
    ]
    return spark.createDataFrame(
        rows,
        "encounter_id long, patient_nbr long, race string, age string, weight string, "
        "discharge_disposition_id int, diag_1 string, readmitted string",
    )


# -------------------------------------------------------------------- cleaning
def test_clean_and_featurise(six):
    out = K.featurise(K.clean(six))
    assert "weight" not in out.columns and "encounter_id" not in out.columns
    rows = out.collect()
    assert len(rows) == 5  # two excluded dispositions, the missing one stays
    last = next(r for r in rows if r.age == "old")
    assert (last.race, last.diag_1, last.readmitted_binary, last.age_ordinal) == ("Unknown", "Unknown", 1, None)
    assert sorted((r.age, r.readmitted_binary, r.age_ordinal) for r in rows if r.age != "old") == [
        ("[40-50)", 0, 4), ("[50-60)", 0, 5), ("[70-80)", 1, 7), ("[80-90)", 1, 8),
    ]


def test_target_rules(six):
    within = K.derive_target(six, "within30").groupBy("readmitted").agg(F.max("readmitted_binary").alias("t"))
    assert {r.readmitted: r.t for r in within.collect()} == {"<30": 1, "NO": 0, ">30": 0, None: 0}
    kept = six.withColumn("readmitted_binary", F.lit(9))
    assert K.derive_target(kept).first().readmitted_binary == 9
    assert K.derive_target(kept, overwrite=True).select(F.max("readmitted_binary")).first()[0] == 1
    with pytest.raises(ValueError):
        K.derive_target(six, "other")


def test_alignment_and_names(spark):
    df = spark.range(1).selectExpr("1 AS a", "2 AS b", "3 AS glyburide_metformin")
    assert K.align_expected(df, ["b", "zz", "a"]).first().asDict() == {"b": 2, "zz": 0, "a": 1}
    assert K.rename_to_stored(df).columns[-1] == "glyburide-metformin"
    with pytest.raises(ValueError):
        K.align_shared(df.select("a"), df.select("b"))


def test_contract(spark):
    fields = encounter_contract()
    assert len(fields) == 44 and sum(f.nullable for f in fields) == 6
    good = {f.name: ("3" if f.type == "int" else "No") for f in fields}
    rows = [
        {**good, "id": "ok"},
        {**good, "id": "type", "num_medications": "many"},
        {**good, "id": "missing", "gender": None},
        {**good, "id": "nullable", "race": None, "age": "[190-200)"},
    ]
    schema = ", ".join(f"`{c}` string" for c in ["id", *good])
    accepted, rejected = split_by_contract(
        spark.createDataFrame([[r[c] for c in ["id", *good]] for r in rows], schema), fields
    )
    assert {r.id for r in accepted.collect()} == {"ok", "nullable"}
    assert {r.id: r.violations for r in rejected.collect()} == {
        "type": ["num_medications:type"], "missing": ["gender:missing"],
    }
    no_column, bad = split_by_contract(
        spark.createDataFrame([["x"]], "id string"), fields
    )
    assert no_column.count() == 0 and len(bad.first().violations) == 38


# ------------------------------------------------------------------- splitting
@pytest.fixture(scope="module")
def batch(spark):
    return spark.range(100).selectExpr("id AS feature1", "id * 0.5 AS feature2", "CAST(id % 2 AS INT) AS readmitted_binary")


@pytest.mark.parametrize(("share", "test_rows"), [(0.5, 50), (0.3, 30)])
def test_batch_split(batch, share, test_rows):
    train, test = W.split_batch(batch, ["feature1"], test_size=share)
    assert test.count() == test_rows and train.count() == 100 - test_rows
    assert U.overlap(train, test, ["feature1"]).count() == 0
    assert test.where("readmitted_binary = 1").count() == test_rows // 2


def test_batch_split_seeds(batch):
    def members(seed):
        return {r.feature1 for r in W.split_batch(batch, ["feature1"], seed=seed)[1].collect()}

    assert members(42) == members(42) and members(42) != members(7)


def test_batch_split_needs_two_rows(batch):
    with pytest.raises(ValueError):
        W.split_batch(batch.limit(1), ["feature1"])


def test_chronological_split(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id / 10 AS INT) AS day")
    counts = {r.split: r["count"] for r in W.chronological_split(df, ["day", "id"]).groupBy("split").count().collect()}
    # 200 initial: 30 test, then the validation share of the remaining 170, rounded up
    held = math.ceil(170 * (0.15 / (1.0 - 0.15)))
    assert counts == {
        "initial_train": 170 - held, "initial_validation": held, "initial_test": 30, "future": 800
    }
    for bad in ({"initial_fraction": 0}, {"test_size": 1.0}, {"test_size": 0.5, "validation_size": 0.5}):
        with pytest.raises(ValueError):
            W.chronological_split(df, ["id"], **bad)


def test_oversample_repeats_the_short_side(spark):
    df = spark.range(20).selectExpr("id", "id < 15 AS old")
    out = W.oversample(df, ["id"], F.col("old"), 40, 0.5)
    counts = {r.stratum: r["count"] for r in out.groupBy("stratum").count().collect()}
    assert counts == {"high": 15, "low": 25}
    assert out.where("stratum = 'low'").select("id").distinct().count() == 5
    assert out.select("id", "copy").distinct().count() == 40


def test_swap_keeps_the_size(spark):
    population = spark.range(500).selectExpr("id", "CAST(id % 10 AS INT) AS d")
    batch = population.where("id < 200")
    out = W.swap_rows(batch, population, ["id"], F.col("d") >= 8, 200, 0.15)
    assert out.count() == 200
    assert out.where("d >= 8").count() == 40 + 30


def test_concatenate(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "id long, val long")
    b = spark.createDataFrame([(3, 30), (4, 40)], "id long, val long")
    assert U.concatenate([a, b]).count() == 4
    assert U.concatenate([a, b, b.selectExpr("id + 10 AS id", "val")]).count() == 6
    doubled = spark.createDataFrame([(1, 10), (1, 10), (2, 20)], "id long, val long")
    assert U.concatenate([doubled]).count() == 2
    assert U.concatenate([doubled], remove_duplicates=False).count() == 3
    assert U.duplicate_count(doubled).first().removed == 1
    with pytest.raises(ValueError):
        U.concatenate([])


# ---------------------------------------------------------------- perturbation
def test_covariate_drift_kinds(spark):
    df = spark.range(11).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(3 AS DOUBLE) AS k", "'t' AS s")
    stats = lambda d: d.agg(F.avg("x").alias("m"), F.stddev("x").alias("s"), F.avg("k").alias("k")).first()
    before = stats(df)
    shifted = stats(G.covariate_drift(df, ["x", "k", "s", "none"], 0.5))
    assert shifted.m == pytest.approx(before.m + 0.5 * before.s) and shifted.k == 3.0
    scaled = stats(G.covariate_drift(df, ["x"], 0.5, "scale"))
    assert scaled.m == pytest.approx(before.m) and scaled.s == pytest.approx(1.5 * before.s)
    with pytest.raises(ValueError):
        G.covariate_drift(df, ["x"], kind="twist")


def test_flip_is_exact_and_local(spark):
    df = spark.range(100).selectExpr("id", "0 AS y", "id < 30 AS sub")
    out = G.flip_labels(df, ["id"], F.col("sub"), 0.4, "y")
    assert out.where("y = 1").count() == 12 and out.where("y = 1 AND NOT sub").count() == 0


def test_quality_issues(spark):
    df = spark.range(2000).selectExpr("id", "'abc' AS s", "1D AS v")
    dirty = G.inject_nulls(df, ["id"], ["s", "v"], 0.2, 0.5)
    rate = G.quality_score(dirty, ["s", "v"]).first()
    assert 0.80 < rate.quality_score < 0.90
    bad = G.corrupt_strings(df, ["id"], ["s"], 0.3).where("s <> 'abc'")
    assert 500 < bad.count() < 700 and bad.where("length(s) = 3 AND s LIKE '%X%'").count() == bad.count()
    assert 60 < G.inject_outliers(df, ["id"], ["v"], 0.05).where("v = 999999").count() < 140


def test_nulls_hit_the_drawn_columns_only(spark):
    columns = ["a", "b", "c", "d", "e"]
    df = spark.range(3000).select("id", *[F.lit(1.0).alias(c) for c in columns])
    rates = {c: G.inject_nulls(df, ["id"], columns, 0.5, 0.5, seed=s).where(F.col(c).isNull()).count() for s in (1,) for c in columns}
    assert sum(n > 0 for n in rates.values()) == 3
    assert all(650 < n < 850 for n in rates.values() if n)


def test_one_issue_per_row_whatever_the_number_of_columns(spark):
    columns = ["a", "b", "c", "d", "e"]
    df = spark.range(4000).select("id", *[F.lit("abc").alias(c) for c in columns])
    bad = G.corrupt_strings(df, ["id"], columns, 0.3)
    per_row = sum((F.col(c) != "abc").cast("int") for c in columns)
    counts = {r.n: r["count"] for r in bad.groupBy(per_row.alias("n")).count().collect()}
    assert set(counts) == {0, 1} and 1080 < counts[1] < 1320
    numbers = spark.range(4000).select("id", *[F.lit(1.0).alias(c) for c in columns])
    out = G.inject_outliers(numbers, ["id"], columns, 0.1)
    hit = [out.where(F.col(c) == 999999).count() for c in columns]
    assert 320 < sum(hit) < 480 and all(40 < h for h in hit)


def test_nan_is_missing(spark):
    from tidemark.operators import cleaning as K

    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None), (None, "b")], "x double, s string")
    assert {r.column: r.missing for r in K.missing_rates(df).collect()} == {"x": 2, "s": 1}
    assert K.drop_sparse(df, 0.5).columns == ["s"]
    assert K.low_cardinality_columns(df, 3) == ["s"]


# ------------------------------------------------------------------ evaluation
@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(
        list(zip([0, 0, 1, 1, 0, 1], [0.1, 0.4, 0.4, 0.8, 0.8, 0.9])), "label int, score double"
    )


def test_classifier_fixture(scored):
    assert E.auc(scored, "label", "score").first().auc == pytest.approx(7 / 9)
    points = E.roc_points(scored, "label", "score").orderBy(F.desc("threshold")).collect()
    assert [(p.threshold, p.fpr, p.tpr) for p in points] == [
        (float("inf"), 0.0, 0.0), (0.9, 0.0, pytest.approx(1 / 3)), (0.4, pytest.approx(2 / 3), 1.0), (0.1, 1.0, 1.0),
    ]


def test_binary_metrics(spark, scored):
    marked = scored.withColumn("p", E.predicted("score"))
    c = E.confusion(marked, "label", "p").first()
    assert (c.tn, c.fp, c.fn, c.tp) == (2, 1, 1, 2)
    m = E.binary_metrics(marked, "label", "p").first()
    assert [m.accuracy, m.precision, m.recall, m.f1] == [pytest.approx(2 / 3)] * 4
    none = E.binary_metrics(spark.sql("SELECT 1 AS label, 0 AS p"), "label", "p").first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_auc_of_a_single_class_is_zero(spark):
    assert E.auc(spark.sql("SELECT 1 AS label, 0.3D AS score"), "label", "score").first().auc == 0.0


def test_binary_scores_are_not_cut(spark):
    rows = [(True, 1, 1.0), (True, 0, 0.0), (False, 1, 0.0), (False, 0, 0.0)]
    sided = spark.createDataFrame(rows, "is_ref boolean, label int, score double")
    out = E.performance_drift(sided, "label", "score").first()
    assert out.ref_data_accuracy == 1.0 and out.new_data_accuracy == 0.5
    assert out.auc_drift is None and out.performance_concept_drift


# ------------------------------------------------------------------- decisions
def monitor(spark, score=0.0, count=0, concept=None, perf=None, hours=None, total=12):
    return spark.createDataFrame(
        [("m", score, count, total, concept, 0.0, perf, hours)],
        "monitor string, dataset_drift_score double, feature_drift_count int, total_features int, "
        "concept_drift_score double, prediction_drift_score double, performance_degradation double, "
        "hours_since_retrain double",
    )


@pytest.mark.parametrize(
    ("given", "severity", "confidence"),
    [
        ({"score": 0.30}, "major", 0.9),
        ({"score": 0.15}, "moderate", 0.8),
        ({"score": 0.05}, "minor", 0.7),
        ({"score": 0.049}, "none", 0.9),
        ({"score": 0.9, "concept": 0.20}, "concept", 0.9),
        ({"score": 0.16, "count": 3}, "moderate", 0.8),
        ({"score": 0.0, "count": 6}, "major", 0.8),
        ({"score": 0.0, "perf": 0.10}, "major", 0.9),
        ({"score": 0.0, "count": 5, "total": 0}, "none", 0.9),
    ],
)
def test_severity_ladder(spark, given, severity, confidence):
    row = R.with_severity(monitor(spark, **given)).first()
    assert (row.severity, row.severity_confidence) == (severity, confidence)


@pytest.mark.parametrize(
    ("given", "limits", "action"),
    [
        ({"score": 0.0}, {}, "continue_monitoring"),
        ({"score": 0.05}, {}, "log_and_monitor"),
        ({"score": 0.2}, {}, "incremental_retrain"),
        ({"score": 0.2, "hours": 5.9}, {}, "log_and_monitor"),
        ({"score": 0.4, "hours": 6.0}, {}, "full_retrain"),
        ({"score": 0.4}, {"automatic_retraining": False}, "architecture_review"),
        ({"score": 0.2}, {"automatic_retraining": False}, "log_and_monitor"),
        ({"concept": 0.5, "hours": 1.0}, {}, "architecture_review"),
    ],
)
def test_actions(spark, given, limits, action):
    limits = R.DEFAULTS.override(**limits)
    assert R.with_action(R.with_severity(monitor(spark, **given), limits), limits).first().action == action


@pytest.mark.parametrize(
    ("new", "prod", "decision"),
    [
        (0.7, 0.7, "DEPLOY"), (0.685, 0.7, "DEPLOY_REFRESH"), (0.67, 0.7, "SKIP"),
        (0.50, 0.52, "SKIP"), (0.6, None, "DEPLOY"),
    ],
)
def test_regression_gate(spark, new, prod, decision):
    df = spark.createDataFrame([(new, prod)], "new_auc double, prod_auc double")
    assert R.regression_gate(df).first().decision == decision


def test_quality_gate_rejects_unknown_metrics(spark):
    with pytest.raises(ValueError):
        R.quality_gate(spark.range(1), "accuracy")


def test_drift_gate_is_strict(spark):
    runs = spark.createDataFrame([(0.30, False), (0.31, False), (0.1, True)], "drift_share double, dataset_drift boolean")
    got = {r.drift_share: r.gate for r in R.drift_gate(runs).collect()}
    assert got == {0.30: "EVALUATE_ONLY", 0.31: "RETRAIN", 0.1: "RETRAIN"}
    forced = R.drift_gate(runs.limit(1), force=True).first()
    assert (forced.gate, forced.gate_reason) == ("RETRAIN", "force_retrain=True")


# ----------------------------------------------------------- errors and reports
def test_error_keywords_override_in_order(spark):
    rows = [
        ("ValueError", "fatal memory"), ("ValueError", "disk full"), ("OSError", "quota"), ("OSError", "auth failed"),
        ("NoSuchKey", None),
    ]
    out = {(r.error_type, r.message): (r.severity, r.category, r.recovery)
           for r in X.classify_errors(spark.createDataFrame(rows, "error_type string, message string")).collect()}
    assert out == {
        ("ValueError", "fatal memory"): ("critical", "validation", "escalate"),
        ("ValueError", "disk full"): ("medium", "validation", "fail_fast"),
        ("OSError", "quota"): ("medium", "resource", "retry_with_backoff"),
        ("OSError", "auth failed"): ("medium", "configuration", "escalate"),
        ("NoSuchKey", None): ("medium", "data_access", "retry_with_backoff"),
    }


def test_decision_inference(spark):
    rows = [("SKIP", 0.5, 0.6, 0.1), (None, 0.6, 0.5, -0.01), (None, 0.6, 0.5, 0.0), (None, 0.5, 0.5, 0.0005)]
    df = spark.createDataFrame(rows, "decision string, new_auc double, prod_auc double, auc_improvement double")
    assert [r.decision for r in B.infer_decision(df).collect()] == ["SKIP", "DEPLOY_REFRESH", "DEPLOY", None]


def test_registry_promotion_archives(spark):
    events = spark.sql(
        "SELECT * FROM VALUES ('m', 1, 'r1', 'Production', 1), ('m', 2, 'r2', 'Staging', 2), ('m', 2, 'r2', 'Production', 3) "
        "AS t(model, version, run_id, stage, ts)"
    )
    assert {r.version: r.stage for r in B.registry_view(events).collect()} == {1: "Archived", 2: "Production"}


def test_auc_needs_probabilities_on_its_side(spark):
    """Hard scores on one side leave out what the rule leaves out."""
    soft = [(i % 2, i / 10) for i in range(10)]
    hard = [(i % 2, float(i % 3 == 0)) for i in range(10)]

    def sides(ref, new):
        rows = [(True, *r) for r in ref] + [(False, *r) for r in new]
        return E.performance_drift(spark.createDataFrame(rows, "is_ref boolean, label int, score double"), "label", "score").first()

    one = sides(soft, hard)
    assert one.new_data_auc is None and one.auc_drift is None and one.ref_data_auc is None
    two = sides(hard, soft)
    assert two.new_data_auc is not None and two.ref_data_auc is None and two.auc_drift is None
    both = sides(soft, soft)
    assert both.auc_drift == 0 and both.ref_data_auc == both.new_data_auc
    single = sides(soft, [(1, s) for _, s in soft])
    assert single.new_data_auc is None
