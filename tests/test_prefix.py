import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.prefix import collapse, count_below, exact_quantiles, running_totals


@pytest.fixture(scope="module")
def weighted(spark):
    rng = random.Random(5)
    rows = [("a", float(int(rng.gauss(0, 30))), rng.randint(0, 3), 1) for _ in range(900)]
    # one hot value, and a key that is far out of the range of the others
    rows += [("a", 7.0, 1, 2)] * 300 + [("b", 1e9 + i / 7, 1, 0) for i in range(40)]
    return spark.createDataFrame(rows, "k string, value double, x long, y long")


def brute(rows):
    out = {}
    by_key = {}
    for k, v, x, y in rows:
        cell = by_key.setdefault(k, {}).setdefault(v, [0, 0])
        cell[0] += x
        cell[1] += y
    for k, cells in by_key.items():
        cx = cy = 0
        values = sorted(cells)
        for i, v in enumerate(values):
            cx += cells[v][0]
            cy += cells[v][1]
            out[(k, v)] = (cx, cy, values[i + 1] if i + 1 < len(values) else None)
    return out


@pytest.mark.parametrize("options", [{"lanes": False}, {}, {"rows_per_lane": 5}])
def test_running_totals_match_brute_force(weighted, options):
    expected = brute([tuple(r) for r in weighted.collect()])
    distinct = collapse(weighted, ["k"], "value", ["x", "y"])
    run = running_totals(distinct, ["k"], "value", ["x", "y"], ["value"], **options).collect()
    assert len(run) == len(expected)
    for r in run:
        assert (r.cum_x, r.cum_y, r.next_value) == expected[(r.k, r.value)]
        assert r.total_y == (1500 if r.k == "a" else 0)


def test_lanes_actually_split(spark, weighted):
    distinct = collapse(weighted, ["k"], "value", ["x"])
    plan = running_totals(distinct, ["k"], "value", ["x"], lanes=True, rows_per_lane=5)
    assert "_lane" in plan._jdf.queryExecution().toString()


def test_running_totals_without_keys(spark):
    df = spark.range(10).selectExpr("CAST(id AS DOUBLE) AS value", "1L AS n")
    for lanes in (False, True):
        run = running_totals(df, [], "value", ["n"], lanes=lanes, rows_per_lane=3).orderBy("value").collect()
        assert [r.cum_n for r in run] == list(range(1, 11))


def test_count_below(spark):
    df = spark.createDataFrame([([1.0, 2.0, 2.0, 5.0], v) for v in (0.0, 1.0, 1.5, 2.0, 3.0, 9.0)], "b array<double>, v double")
    got = [r.c for r in df.select(count_below(F.col("b"), F.col("v")).alias("c")).collect()]
    assert got == [0, 0, 1, 1, 3, 4]


@pytest.mark.parametrize("lanes", [False, True])
def test_exact_quantiles(spark, lanes):
    rng = np.random.default_rng(3)
    values = np.round(rng.exponential(10, 501), 2)
    df = spark.createDataFrame([("f", float(v), 1) for v in values], "k string, value double, n long")
    run = running_totals(collapse(df, ["k"], "value", ["n"]), ["k"], "value", ["n"], lanes=lanes, rows_per_lane=20)
    probs = {"p0": 0.0, "p1": 0.01, "q1": 0.25, "q2": 0.5, "p99": 0.99, "p100": 1.0}
    row = exact_quantiles(run, ["k"], "value", "n", probs).first()
    for name, q in probs.items():
        assert row[name] == pytest.approx(np.quantile(values, q), abs=1e-9)
