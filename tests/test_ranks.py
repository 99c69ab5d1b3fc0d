import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ranks import cut_tuples, first_rows, hash_split


def test_hot_leading_value_is_resolved_by_the_next_column(spark):
    # two thirds of the rows share the leading value
    df = spark.range(900).selectExpr("IF(id % 3 = 0, id, 5L) AS a", "id")
    expected = sorted((r.a, r.id) for r in df.collect())[:400]
    got = first_rows(df, ["a", "id"], 400).collect()
    assert sorted((r.a, r.id) for r in got) == expected


def test_cuts_at_the_ends(spark):
    df = spark.range(10).selectExpr("id AS v")
    cuts = cut_tuples(
        df, ["v"], {"zero": lambda n: F.lit(0), "one": lambda n: F.lit(1), "all": lambda n: F.lit(99)}
    )
    assert {r.cut: r.v for r in cuts.collect()} == {"one": 0, "all": 9}


def test_ambiguous_cut_is_an_error(spark):
    df = spark.createDataFrame([(1,), (1,), (1,)], "v int")
    with pytest.raises(Exception, match="not unique"):
        first_rows(df, ["v"], 2).collect()


def test_null_stratum_is_a_stratum(spark):
    df = spark.range(60).selectExpr("id", "IF(id % 3 = 0, NULL, CAST(id % 3 AS STRING)) AS s")
    got = first_rows(df, ["id"], 4, ["s"]).groupBy("s").count().collect()
    assert {r.s: r["count"] for r in got} == {None: 4, "1": 4, "2": 4}


def test_hash_split_follows_the_md5_order(spark):
    df = spark.range(500)
    marked = hash_split(df, ["id"], 9, {"in": lambda n: F.lit(77)}, ["in"], "out")
    order = sorted(range(500), key=lambda i: hashlib.md5(f"9:{i}".encode()).hexdigest())
    assert {r.id for r in marked.where("split = 'in'").collect()} == set(order[:77])
    assert marked.count() == 500


def test_hash_split_does_not_depend_on_partitioning(spark):
    df = spark.range(300)
    one = hash_split(df.coalesce(1), ["id"], 1, {"in": lambda n: F.lit(50)}, ["in"], "out")
    many = hash_split(df.repartition(13), ["id"], 1, {"in": lambda n: F.lit(50)}, ["in"], "out")
    assert one.where("split = 'in'").exceptAll(many.where("split = 'in'")).count() == 0


def test_more_strata_than_any_limit(spark):
    """20,000 strata, one of them with a third of all rows."""
    df = spark.range(60_000).selectExpr("id", "IF(id % 3 = 0, 0L, id % 20000) AS s")
    sizes = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    picked = hash_split(df, ["id"], 4, {"in": lambda n: F.lit(2)}, ["in"], None, strata=["s"])
    got = {r.s: r["count"] for r in picked.where("split = 'in'").groupBy("s").count().collect()}
    assert got == {s: min(2, n) for s, n in sizes.items()}


def test_sample_of_any_size_follows_one_order(spark):
    from tidemark.operators.sampling import sample_rows

    df = spark.range(400)
    order = sorted(range(400), key=lambda i: hashlib.md5(f"3:{i}".encode()).hexdigest())
    for n in (0, 1, 150, 1000):
        assert {r.id for r in sample_rows(df, ["id"], n, 3).collect()} == set(order[:n])
    repeated = spark.createDataFrame([(1,), (1,), (1,)], "id long")
    with pytest.raises(Exception, match="not unique"):
        sample_rows(repeated, ["id"], 2).collect()


def test_quotas_of_many_classes(spark):
    from tidemark.operators.sampling import stratified_quotas

    df = spark.range(9000).selectExpr("IF(id % 10 = 0, NULL, CAST(id % 700 AS STRING)) AS c")
    sizes = {r.c: r["count"] for r in df.groupBy("c").count().collect()}
    draw = 9000 - -(-9000 * 37 // 100)
    share = {c: n / 9000 * draw for c, n in sizes.items()}
    quotas = {r.c: r.k for r in stratified_quotas(df, "c", 0.37).collect()}
    assert sum(quotas.values()) == draw and set(quotas) == set(sizes)
    assert all(k - int(share[c]) in (0, 1) for c, k in quotas.items())
    more = [share[c] % 1 for c, k in quotas.items() if k > int(share[c])]
    less = [share[c] % 1 for c, k in quotas.items() if k == int(share[c])]
    assert min(more) >= max(less) - 1e-9
