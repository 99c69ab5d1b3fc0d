import math

import pytest

from tidemark.functions.tails import (
    chi2_tail, erfc, kolmogorov_tail, normal_two_sided,
)


def test_erfc_matches_the_library_function(spark):
    points = [0.0, 1e-6, 0.1, 0.5, 1.0, 1.9, 1.999999, 2.0, 2.5, 4.0, 8.0, 20.0]
    rows = spark.createDataFrame([(p,) for p in points], "z double").select("z", erfc("z").alias("e"))
    for r in rows.collect():
        assert r.e == pytest.approx(math.erfc(r.z), rel=1e-9, abs=1e-300)


@pytest.mark.parametrize(
    ("stat", "dof", "expected"),
    [
        (4.8, 2, 0.09071795328941251),
        (9.6, 2, 0.008229747049020023),
        (3.841458820694124, 1, 0.05),
        (7.814727903251179, 3, 0.05),
        (18.307038053275146, 10, 0.05),
        (124.34211340400407, 100, 0.05),
        (1074.6794, 1000, 0.05),
        (0.0, 5, 1.0),
        (math.inf, 4, 0.0),
        (1e5, 3, 0.0),
    ],
)
def test_chi2_tail(spark, stat, dof, expected):
    row = spark.createDataFrame([(stat, dof)], "s double, d int").select(chi2_tail("s", "d").alias("p"))
    assert row.first().p == pytest.approx(expected, abs=1e-6)


def test_chi2_tail_of_null_is_null(spark):
    row = spark.sql("SELECT CAST(NULL AS DOUBLE) AS s, 2 AS d").select(chi2_tail("s", "d").alias("p"))
    assert row.first().p is None


def test_normal_two_sided(spark):
    row = spark.sql("SELECT -1.959963984540054D AS z").select(normal_two_sided("z").alias("p"))
    assert row.first().p == pytest.approx(0.05, abs=1e-12)


def test_kolmogorov_tail_limits(spark):
    df = spark.createDataFrame([(0.0, 11, 9), (0.45454545454545453, 11, 9), (1.0, 500, 500)], "d double, n long, m long")
    zero, middle, one = [r.p for r in df.select("d", kolmogorov_tail("d", "n", "m").alias("p")).orderBy("d").collect()]
    assert zero == 1.0
    assert middle == pytest.approx(0.18701855223717942, abs=1e-12)
    assert one == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("dof", [1, 2, 3, 7, 50, 1001, 200_000])
def test_chi2_tail_at_any_dof(spark, dof):
    """Against the finite sum for even dof, and the limit of Wilson and Hilferty for a huge one."""
    root = math.sqrt(2 / (9 * dof))
    stats = [dof * max(1 - 2 / (9 * dof) + z * root, 0.0) ** 3 for z in (-2.0, -0.5, 0.0, 1.0, 2.5)]
    df = spark.createDataFrame([(s, dof) for s in stats], "s double, d long")
    got = [r.p for r in df.select(chi2_tail("s", "d").alias("p")).collect()]
    limit = [0.5 * math.erfc(z / math.sqrt(2)) for z in (-2.0, -0.5, 0.0, 1.0, 2.5)]
    if dof > 10_000:
        assert got == pytest.approx(limit, abs=1e-6)
    elif dof % 2 == 0:
        terms = [[math.exp(k * math.log(s / 2) - s / 2 - math.lgamma(k + 1)) for k in range(dof // 2)] for s in stats]
        assert got == pytest.approx([math.fsum(t) for t in terms], abs=1e-12)
    assert all(a > b for a, b in zip(got, got[1:]))
    if dof == 2:
        assert got == pytest.approx([math.exp(-s / 2) for s in stats], abs=1e-12)
    if dof == 1:
        assert got == pytest.approx([math.erfc(math.sqrt(s / 2)) for s in stats], abs=1e-12)
