import numpy as np
import pytest

from tidemark.operators import consensus as C
from tidemark.operators import drift as D
from tidemark.operators.sides import feature_kinds, flag_sides, stack_sides

REF = [float(i) for i in range(11)]
NEW = [5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 10.0, 10.0, 12.0]


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def letters(spark, **counts):
    return spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "c string")


@pytest.mark.parametrize("rows_per_lane", [3, 1000])
def test_numeric_fixture(spark, rows_per_lane):
    row = D.feature_table(
        stack_sides(numbers(spark, REF), numbers(spark, NEW)), rows_per_lane=rows_per_lane
    ).first()
    expected = {
        "psi": 5.555066567685574,
        "ks_statistic": 0.45454545454545453,
        "ks_pvalue": 0.18701855223717942,
        "wasserstein": 3.5555555555555554,
        "wasserstein_normed": 1.1243653902820903,
        "js_divergence": 0.2353884133268846,
        "mean_shift": 1.0720403362764928,
        "std_ratio": 0.676070045979488,
    }
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, abs=1e-12), name
    assert (row.n_ref, row.n_cur, row.ks_drift, row.psi_drift) == (11, 9, False, True)


def test_out_of_range_is_counted(spark):
    sided = stack_sides(numbers(spark, REF), numbers(spark, NEW))
    cells = D.long_form(sided, ["x"], "numeric")
    assert D.psi(cells, D.paired_moments(sided, ["x"])).first().out_of_range == 1


def test_categorical_fixture(spark):
    ref = letters(spark, a=5, b=3, c=2)
    row = D.feature_table(stack_sides(ref, letters(spark, a=2, b=6, c=2))).first()
    assert row.chi2_statistic == pytest.approx(4.8)
    assert row.chi2_pvalue == pytest.approx(0.09071795328941279)
    assert row.js_distance == pytest.approx(0.24226434469490243)
    doubled = D.feature_table(stack_sides(ref, letters(spark, a=4, b=12, c=4))).first()
    assert doubled.chi2_statistic == pytest.approx(9.6)
    raw = D.feature_table(stack_sides(ref, letters(spark, a=4, b=12, c=4)), expected="raw").first()
    assert raw.chi2_statistic is None and raw.chi2_pvalue is None and raw.chi2_drift is None


def test_new_category_makes_the_statistic_infinite(spark):
    row = D.feature_table(stack_sides(letters(spark, a=5, b=5), letters(spark, a=5, z=5))).first()
    assert row.chi2_statistic == float("inf") and row.chi2_pvalue == 0.0 and row.chi2_drift


def test_two_category_z_test(spark):
    row = D.feature_table(stack_sides(letters(spark, a=50, b=50), letters(spark, a=70, b=30))).first()
    # pooled share 0.6: z = -0.2 / sqrt(0.24 * 0.02)
    assert row.z_statistic == pytest.approx(-2.886751345948129)
    assert row.z_pvalue == pytest.approx(0.003892417122778637, abs=1e-9)


def test_identical_sides_do_not_drift(spark):
    df = spark.range(200).selectExpr("CAST(id % 17 AS DOUBLE) AS x", "CAST(id % 4 AS STRING) AS c")
    for row in D.feature_table(stack_sides(df, df)).collect():
        for name in ("psi", "ks_statistic", "wasserstein", "js_divergence", "chi2_statistic", "js_distance"):
            assert row[name] is None or row[name] == pytest.approx(0.0, abs=1e-9), name


def test_shift_moves_wasserstein_and_monotone_maps_keep_ks(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 400), rng.normal(0.3, 1.2, 300)
    shifted = D.feature_table(stack_sides(numbers(spark, map(float, a)), numbers(spark, map(float, a + 2.5)))).first()
    assert shifted.wasserstein == pytest.approx(2.5)
    plain = D.feature_table(stack_sides(numbers(spark, map(float, a)), numbers(spark, map(float, b)))).first()
    cubed = D.feature_table(stack_sides(numbers(spark, map(float, a**3)), numbers(spark, map(float, b**3)))).first()
    assert plain.ks_statistic == pytest.approx(cubed.ks_statistic)


@pytest.mark.parametrize("offset", [0.0, 1.7e9])
def test_against_numpy(spark, offset):
    rng = np.random.default_rng(7)
    a = np.round(rng.gamma(2.0, 3.0, 700), 1) + offset
    b = np.round(rng.gamma(2.5, 3.0, 500), 1) + offset
    row = D.feature_table(stack_sides(numbers(spark, map(float, a)), numbers(spark, map(float, b)))).first()
    grid = np.sort(np.concatenate([a, b]))
    f = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    g = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert row.ks_statistic == pytest.approx(np.max(np.abs(f - g)))
    assert row.wasserstein == pytest.approx(np.sum(np.abs(f - g)[:-1] * np.diff(grid)), abs=1e-6)
    edges = np.histogram(a, bins=10)[1]
    p = np.maximum(np.histogram(a, edges)[0] / len(a), 1e-6)
    inside = np.histogram(b, edges)[0]
    q = np.maximum(inside / inside.sum(), 1e-6)
    assert row.psi == pytest.approx(np.sum((q - p) * np.log(q / p)))


def test_constant_feature(spark):
    row = D.feature_table(stack_sides(numbers(spark, [3.0] * 5), numbers(spark, [3.0] * 4))).first()
    assert row.psi == pytest.approx(0.0) and row.js_divergence is None
    assert (row.mean_shift, row.std_ratio) == (0.0, 1.0)


def test_missing_and_empty_features(spark):
    ref = spark.sql("SELECT * FROM VALUES (1D, CAST('NaN' AS DOUBLE)), (2D, 5D), (CAST(NULL AS DOUBLE), 6D) AS t(x, y)")
    cur = spark.sql("SELECT * FROM VALUES (1D, CAST(NULL AS DOUBLE)), (4D, CAST('NaN' AS DOUBLE)) AS t(x, y)")
    rows = {r.feature: r for r in D.feature_table(stack_sides(ref, cur)).collect()}
    assert set(rows) == {"x"}  # y has nothing on the current side
    assert (rows["x"].n_ref, rows["x"].n_cur) == (2, 2)


def test_batches_against_one_reference(spark):
    df = spark.range(600).selectExpr(
        "CAST(id % 3 AS INT) AS batch", "CAST(id % 23 + IF(id % 3 = 2, 9, 0) AS DOUBLE) AS x"
    )
    sided = flag_sides(df, df["batch"] == 0)
    together = {r.batch: r for r in D.feature_table(sided, {"x": "numeric"}, by=["batch"]).collect()}
    assert set(together) == {1, 2}
    for batch, row in together.items():
        alone = D.feature_table(
            stack_sides(df.where("batch = 0").select("x"), df.where(f"batch = {batch}").select("x"))
        ).first()
        for name in ("ks_statistic", "wasserstein", "psi", "js_divergence", "mean_shift"):
            assert row[name] == pytest.approx(alone[name]), (batch, name)


def test_kind_overrides_and_light_variant(spark):
    df = spark.range(50).selectExpr("CAST(id % 3 AS INT) AS code", "CAST(id AS DOUBLE) AS x", "CAST(id AS DOUBLE) AS y")
    sided = flag_sides(df, df["x"] % 2 == 0)
    kinds = feature_kinds(sided, kind_overrides={"code": "categorical"})
    assert kinds == {"code": "categorical", "x": "numeric", "y": "numeric"}
    kinds = {c: kinds[c] for c in ("code", "x")}
    rows = D.feature_table(sided, kinds, metrics=("psi",)).collect()
    assert {r.feature for r in rows} == {"code", "x"}
    light = next(r for r in rows if r.feature == "x")
    assert light.psi is not None and light.ks_statistic is None and light.wasserstein is None


def test_awkward_feature_names(spark):
    df = spark.range(20).selectExpr("CAST(id AS DOUBLE) AS `it's a-name`", "id")
    row = D.feature_table(flag_sides(df, df["id"] < 10), {"it's a-name": "numeric"}).first()
    assert row.feature == "it's a-name"


def test_consensus_confidence_can_exceed_one(spark):
    row = dict(
        n_drifted_columns=6, n_columns=6, ks_drift_count=6, psi_drift_count=6, chi2_drift_count=6,
        avg_ks_statistic=0.9, avg_psi=2.0, avg_wasserstein=1.0, avg_js_divergence=0.5, drift_share=1.0,
        dataset_drift=True, statistical_drift_share=1.0,
    )
    summary = spark.createDataFrame([row])
    concept = spark.sql("SELECT TRUE AS concept_drift_detected")
    out = C.consensus(summary, concept=concept).first()
    assert len(out.drift_indicators) == 6
    assert out.confidence_score == pytest.approx(1.2) and out.confidence_capped == 1.0
    assert out.status == "DRIFT_DETECTED"
    alone = C.consensus(spark.createDataFrame([{**row, "dataset_drift": False, "avg_psi": 0.0, "avg_ks_statistic": 0.0,
                                                "avg_js_divergence": 0.0}])).first()
    assert alone.drift_indicators == ["statistical_share"] and not alone.consensus_drift


@pytest.mark.parametrize(
    ("drifted", "status"), [(0, "no_drift"), (1, "minor_drift"), (3, "moderate_drift"), (7, "major_drift")]
)
def test_batch_set_verdict(spark, drifted, status):
    df = spark.range(10).selectExpr(f"id < {drifted} AS consensus_drift")
    assert C.batch_set_verdict(df).first().overall_status == status
