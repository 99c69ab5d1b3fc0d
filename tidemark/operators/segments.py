"""Scans along time per monitor without giving a monitor to one task.

A window partitioned by monitor alone sends every row of a monitor to one
task; one monitor that holds most rows then is the whole job.  Here the rows of
each monitor are cut into *lanes*, contiguous time ranges of about
``rows_per_lane`` rows whose bounds are order statistics of a hash-chosen sample
of the times (a pure function of the data).  Each scan is an associative
summary per lane, combined over the few lanes of a monitor by a small window,
and the in-lane window then starts from that carry.

Rows with equal times fall into one lane; their order among themselves is the
window's, as with a window over the whole monitor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.keys import value_fraction
from ..session import join_keyed
from .prefix import count_below

ROWS_PER_LANE = 2_000_000
SAMPLES_PER_LANE = 64


def laned(rows: DataFrame, keys: Sequence[str], ts: str, rows_per_lane: int = ROWS_PER_LANE) -> DataFrame:
    """``rows`` with ``_lane``: the number of the time range of its key that holds it.

    A key with at most ``rows_per_lane`` rows has the one lane 0.  Rows with a
    null time take lane 0, where an ascending window puts them first.  Keys with
    more than one lane and their bounds are broadcast: both hold at most
    (rows of the table) / ``rows_per_lane`` entries, so the rows of a hot key
    are never shuffled by key.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_lanes", F.ceil(F.col("_n") / F.lit(float(rows_per_lane))).cast("int")
    )
    many = counted.where("_lanes > 1")
    seconds = F.unix_micros(F.col(ts).cast("timestamp"))
    sample = join_keyed(rows.select(*keys, ts), F.broadcast(many), keys).where(
        value_fraction(seconds) < F.lit(float(SAMPLES_PER_LANE)) * F.col("_lanes") / F.col("_n")
    )
    bounds = (
        sample.groupBy(*keys, "_lanes")
        .agg(F.sort_array(F.collect_list(seconds)).alias("_sample"))
        .select(
            *keys,
            F.transform(
                F.sequence(F.lit(1), F.col("_lanes") - 1),
                lambda i: F.get(F.col("_sample"), F.floor(i * F.size("_sample") / F.col("_lanes")).cast("int")),
            ).alias("_bounds"),
        )
    )
    placed = join_keyed(rows, F.broadcast(bounds), keys, "left")
    lane = F.when(
        F.col("_bounds").isNull() | F.col(ts).isNull(), F.lit(0)
    ).otherwise(count_below(F.col("_bounds"), seconds + F.lit(1)))
    return placed.withColumn("_lane", lane).drop("_bounds")


def _lane_windows(keys: Sequence[str], ts: str) -> tuple[Window, Window]:
    inside = Window.partitionBy(*keys, "_lane").orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    return inside, before


def latest_before(
    rows: DataFrame, keys: Sequence[str], ts: str, when: Column, name: str,
    rows_per_lane: int = ROWS_PER_LANE,
) -> DataFrame:
    """Add ``name``: the latest ``ts`` of an earlier row of the key where ``when`` holds (else null).

    "Earlier" is the window's order by ``ts``; rows with equal times see each
    other's times, which are equal, so the result does not depend on that order.
    """
    lanes = laned(rows, keys, ts, rows_per_lane)
    hit = F.when(when, F.col(ts))
    per_lane = lanes.groupBy(*keys, "_lane").agg(F.max(hit).alias("_lane_last"))
    _, before = _lane_windows(keys, ts)
    carry = per_lane.select(*keys, "_lane", F.max("_lane_last").over(before).alias("_carry"))
    earlier = Window.partitionBy(*keys, "_lane").orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    joined = join_keyed(lanes, carry, [*keys, "_lane"])
    inner = F.max(hit).over(earlier)
    return joined.withColumn(name, F.greatest(inner, F.col("_carry"))).drop("_lane", "_carry")


def run_length(
    rows: DataFrame, keys: Sequence[str], ts: str, member: Column, name: str,
    rows_per_lane: int = ROWS_PER_LANE,
) -> DataFrame:
    """Add ``name``: how many rows up to this one, in ``ts`` order, ``member`` held without a break.

    Zero on a row that is not a member; a null ``member`` breaks the run.  Per
    lane the summary is (rows, members after the last break, whether it has a
    break); the carry into a lane is the members after the last break before it.
    """
    lanes = laned(rows, keys, ts, rows_per_lane).withColumn("_in", F.coalesce(member, F.lit(False)))
    inside, before = _lane_windows(keys, ts)
    scanned = lanes.withColumn("_breaks", F.sum((~F.col("_in")).cast("bigint")).over(inside))
    island = Window.partitionBy(*keys, "_lane", "_breaks").orderBy(ts).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    scanned = scanned.withColumn("_run", F.sum(F.col("_in").cast("bigint")).over(island))

    per_lane = lanes.groupBy(*keys, "_lane").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max((~F.col("_in")).cast("int")).alias("_broken"),
    )
    # members after the lane's last break: the lane's rows after its last non-member
    tail = scanned.groupBy(*keys, "_lane").agg(
        F.max_by("_run", F.struct("_breaks", "_run")).alias("_tail")
    )
    summary = join_keyed(per_lane, tail, [*keys, "_lane"])
    ordered = Window.partitionBy(*keys).orderBy("_lane")
    summary = summary.withColumn(
        "_upto", F.sum("_rows").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    carry = summary.select(
        *keys, "_lane",
        (
            F.coalesce(F.sum("_rows").over(before), F.lit(0))
            - F.coalesce(F.last(F.when(F.col("_broken") == 1, F.col("_upto")), ignorenulls=True).over(before), F.lit(0))
            + F.coalesce(F.last(F.when(F.col("_broken") == 1, F.col("_tail")), ignorenulls=True).over(before), F.lit(0))
        ).alias("_carry"),
    )
    joined = join_keyed(scanned, carry, [*keys, "_lane"])
    value = F.when(~F.col("_in"), F.lit(0)).when(F.col("_breaks") == 0, F.col("_carry") + F.col("_run")).otherwise(
        F.col("_run")
    )
    return joined.withColumn(name, value.cast("bigint")).drop("_lane", "_in", "_breaks", "_run", "_carry")
