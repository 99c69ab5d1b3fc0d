"""Rows of a fit: dealt by cores and row counts, joined once, released after the fit."""

import pytest
from pyspark.sql import functions as F

from suite import encoding
from tidemark.functions.keys import hash_fraction
from tidemark.operators import train as T


@pytest.fixture
def many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_partitions_follow_cores_and_rows(spark, many_partitions, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000).select((F.col("id") % 900).alias("id"))
    few = T.spread_for_training(rows)
    assert few.rdd.getNumPartitions() == cores
    monkeypatch.setattr(T, "ROWS_PER_TASK", 1000 // (cores * 2))
    more = T.spread_for_training(rows)
    assert more.rdd.getNumPartitions() in (2 * cores, 3 * cores)
    for spread in (few, more):
        assert sorted(r.id for r in spread.collect()) == sorted(r.id for r in rows.collect())
    assert T.spread_for_training(rows.limit(0)).rdd.getNumPartitions() == cores


@pytest.fixture
def tables(spark, tmp_path):
    lines = [(k, float(q), 10.0 * q + k, 0.01 * (q % 7), "OF"[q % 2], "RAN"[(q + k) % 3]) for k in range(40) for q in range(1, 5)]
    orders = [(k, 100.0 + k, ["1-URGENT", "5-LOW", None][k % 3]) for k in range(40)]
    orders.append(orders[3])  # a key that comes twice
    spark.createDataFrame(
        lines, "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, l_linestatus string, l_returnflag string"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_tables_are_joined_once(spark, tables):
    train, test = encoding._training(spark, tables)
    assert not [f for f in test.inputFiles() if "lineitem.parquet" in f or "orders.parquet" in f]
    assert train.is_cached
    keys = spark.range(40).select("id", (hash_fraction(42, "id") < 0.3).alias("held"))
    held = {r.id for r in keys.collect() if r.held}
    expected = sorted(k for k in [*range(40), 3] for _ in range(4))
    found = [sorted(r.l_orderkey for r in part.collect()) for part in (train, test)]
    assert found == [[k for k in expected if k not in held], [k for k in expected if k in held]]
    # balanced weights sum to half of the rows for each class
    total = {r.label: r.w for r in train.groupBy("label").agg(F.sum("class_weight").alias("w")).collect()}
    assert total == pytest.approx(dict.fromkeys((0.0, 1.0), len(found[0]) / 2))
    train.unpersist()


def test_fit_releases_its_rows(spark):
    class Estimator:
        def fit(self, rows):
            assert rows.is_cached
            return "model"

    rows = spark.range(10).persist()
    assert T.fitted(Estimator(), rows) == "model" and not rows.is_cached
