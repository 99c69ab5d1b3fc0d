"""Scans over time lanes against windows over whole monitors."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators import decide as R
from tidemark.operators import segments as S

SCHEMA = "monitor string, ts timestamp, severity string, retrained boolean"


@pytest.fixture(scope="module")
def hot(spark):
    """One monitor with nine tenths of the rows, a null monitor, null times and flags, a single row."""
    rng = random.Random(11)
    start = datetime.datetime(2025, 3, 1)
    rows = []
    for name, n in [("hot", 1200), ("warm", 70), (None, 25), ("lone", 1)]:
        for i in range(n):
            severity = rng.choice(["major", "major", "major", "moderate", "none"])
            flag = None if i % 23 == 5 else rng.random() < 0.15
            rows.append((name, start + datetime.timedelta(minutes=7 * i + rng.random()), severity, flag))
    rows += [("warm", None, "major", True), ("lone", None, "none", False)]
    return spark.createDataFrame(rows, SCHEMA)


def whole_monitor(df):
    """The plain plan: windows partitioned by monitor alone."""
    order = Window.partitionBy("monitor").orderBy("ts")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    major = F.coalesce(F.col("severity") == "major", F.lit(False))
    breaks = df.withColumn("_b", F.sum((~major).cast("int")).over(upto))
    island = Window.partitionBy("monitor", "_b").orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return breaks.select(
        "monitor", "ts", "severity",
        F.sum(major.cast("bigint")).over(island).alias("run"),
        F.last(F.when(F.col("retrained"), F.col("ts")), ignorenulls=True)
        .over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("last"),
    )


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(map(str, t)))


@pytest.mark.parametrize("per_lane", [5, 64, 10_000])
def test_lane_scans_equal_whole_monitor_windows(spark, hot, per_lane):
    out = S.run_length(hot, ["monitor"], "ts", F.col("severity") == "major", "run", per_lane)
    out = S.latest_before(out, ["monitor"], "ts", F.col("retrained"), "last", per_lane)
    assert out.columns == [*hot.columns, "run", "last"]
    assert rows_of(out, "monitor", "ts", "severity", "run", "last") == rows_of(
        whole_monitor(hot), "monitor", "ts", "severity", "run", "last"
    )


def test_hot_monitor_spreads_over_lanes(spark, hot):
    lanes = S.laned(hot, ["monitor"], "ts", 100)
    sizes = {(r.monitor, r._lane): r["count"] for r in lanes.groupBy("monitor", "_lane").count().collect()}
    assert max(sizes.values()) < 400
    assert len([k for k in sizes if k[0] == "hot"]) >= 6
    assert sizes[("lone", 0)] == 2


def test_escalation_and_hours_by_lanes(spark, hot):
    small = R.with_escalation(R.with_hours_since_retrain(hot, rows_per_lane=9), rows_per_lane=9)
    large = R.with_escalation(R.with_hours_since_retrain(hot))
    cols = ("monitor", "ts", "severity", "hours_since_retrain", "consecutive_major", "escalate")
    assert rows_of(small, *cols) == rows_of(large, *cols)
    plain = {(r.monitor, r.ts, r.severity): r.run for r in whole_monitor(hot).collect()}
    for r in small.collect():
        assert r.consecutive_major == plain[(r.monitor, r.ts, r.severity)]
        assert r.escalate == (r.consecutive_major >= 3)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert R.with_escalation(R.with_hours_since_retrain(empty)).count() == 0
