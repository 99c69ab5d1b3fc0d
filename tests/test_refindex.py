"""KS of many groups against one reference through the reference's rank index."""

import random

from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators.refindex import ks_by_reference_index
from tidemark.operators.sides import flag_sides


def _tables(spark):
    rng = random.Random(7)
    ref = [("x", float(rng.randint(0, 40))) for _ in range(400)] + [("x", None), ("y", 1.0), ("y", 2.0)]
    cur = []
    for g in range(6):
        for _ in range(rng.randint(1, 120)):
            cur.append((g, "x", float(rng.randint(g, 45)) if rng.random() > 0.05 else None))
        cur.append((g, "y", float(g)))
    cur.append((9, "z", 1.0))  # a feature the reference lacks: no row
    return (
        spark.createDataFrame(ref, "feature string, value double"),
        spark.createDataFrame(cur, "g int, feature string, value double"),
    )


def _joint_sort(spark, ref, cur):
    """The same statistic by the library's joint sort with the reference copied to every group."""
    out = {}
    for feature in ("x", "y"):
        r = ref.where(F.col("feature") == feature).select(F.lit(None).cast("int").alias("g"), F.col("value").alias(feature))
        c = cur.where(F.col("feature") == feature).select("g", F.col("value").alias(feature))
        sided = flag_sides(r.unionByName(c), F.col("g").isNull())
        t = D.feature_table(sided, {feature: "numeric"}, by=["g"], metrics=("ks",))
        for row in t.collect():
            out[(row.g, feature)] = (row.ks_statistic, row.ks_pvalue)
    return out


def test_index_equals_joint_sort_with_one_and_many_lanes(spark):
    ref, cur = _tables(spark)
    want = _joint_sort(spark, ref, cur)
    for lane in (4_000_000, 5):
        got = {(r.g, r.feature): (r.ks_statistic, r.ks_pvalue) for r in ks_by_reference_index(ref, cur, ["g"], rows_per_lane=lane).collect()}
        assert set(got) == set(want)
        for k, (ks, p) in want.items():
            assert abs(got[k][0] - ks) < 1e-12 and abs(got[k][1] - p) < 1e-9


def test_empty_current_gives_no_rows(spark):
    ref, cur = _tables(spark)
    assert ks_by_reference_index(ref, cur.limit(0), ["g"]).count() == 0
