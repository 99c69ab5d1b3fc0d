"""Running totals over a global order without a single-task window.

Two-sample distances, AUC, ROC points, exact quantiles and positional cuts all
need cumulative counts along the sorted values of a feature.  A window that is
partitioned by feature alone gives each feature to one task, which fails for a
high-cardinality column.  The plan used here:

1. the caller collapses rows to distinct ``(keys, value)`` with summed weights
   (map-side combining absorbs hot values);
2. keys with many distinct values are cut into *lanes*, contiguous value ranges
   of about ``rows_per_lane`` distinct values.  Lane bounds are order statistics
   of a hash-chosen sample of the distinct values, so they are a pure function
   of the data: any recomputation yields the same lanes;
3. per-lane totals give every lane its starting offset;
4. the window runs inside ``(keys, lane)``.

Results are exact whatever the quality of the bounds; only balance depends on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.keys import value_fraction
from ..session import join_keyed, join_small

ROWS_PER_LANE = 4_000_000
SAMPLES_PER_LANE = 64
#: Jumps of the binary search over lane bounds; 2 ** 24 lanes hold any table.
_JUMPS = 24
#: Keys whose number of values is fixed by the table's columns.
_FEW = {"feature", "_one"}


def collapse(df: DataFrame, keys: Sequence[str], value: str, sums: Sequence[str]) -> DataFrame:
    """Distinct ``(keys, value)`` with the weight columns summed; null values go."""
    grouped = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[F.sum(s).alias(s) for s in sums])
    )
    # Weights are never negative.  The filter keeps every weight column alive in
    # every branch below, so that all branches share one shuffle.
    alive = F.lit(0)
    for s in sums:
        alive = alive + F.col(s)
    return grouped.where(alive > 0)


def count_below(bounds: Column, value: Column) -> Column:
    """How many entries of a sorted array are below ``value`` (binary search)."""
    jumps = F.filter(
        F.array(*[F.lit(1 << i) for i in reversed(range(_JUMPS))]), lambda j: j <= F.size(bounds)
    )
    search = F.aggregate(
        jumps,
        F.lit(0),
        lambda pos, jump: F.when(
            (pos + jump <= F.size(bounds)) & (F.get(bounds, pos + jump - 1) < value), pos + jump
        ).otherwise(pos),
    )
    return F.when(F.size(bounds) == 0, F.lit(0)).otherwise(search)


def running_totals(
    collapsed: DataFrame,
    keys: Sequence[str],
    value: str,
    sums: Sequence[str],
    following: Sequence[str] = (),
    lanes: bool = True,
    totals: bool = True,
    rows_per_lane: int = ROWS_PER_LANE,
) -> DataFrame:
    """Add ``cum_<s>`` (inclusive), ``total_<s>`` and, on request, ``next_<c>``.

    ``collapsed`` holds one row per ``(keys, value)``.  ``following`` names
    columns whose value in the next row of the same key is wanted.  The number
    of lanes follows the data inside the plan; a key with few values has one.
    ``lanes=False`` is for values of a fixed small domain (histogram bins, hash
    digits).  ``totals=False`` leaves the totals out where the caller has them.
    """
    if not keys:
        out = running_totals(
            collapsed.withColumn("_one", F.lit(0)),
            ["_one"], value, sums, following, lanes, totals, rows_per_lane,
        )
        return out.drop("_one")

    if not lanes:
        ordered = Window.partitionBy(*keys).orderBy(value)
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(*keys)
        return collapsed.select(
            "*",
            *[F.sum(s).over(upto).alias(f"cum_{s}") for s in sums],
            *[F.sum(s).over(whole).alias(f"total_{s}") for s in (sums if totals else ())],
            *[F.lead(c).over(ordered).alias(f"next_{c}") for c in following],
        )

    # one row per feature is broadcast; keys that grow with the data are joined without a hint
    attach = join_small if set(keys) <= _FEW else join_keyed
    per_key = (
        collapsed.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_distinct"),
            *[F.sum(s).alias(f"total_{s}") for s in sums],
        )
        .withColumn(
            "_lanes", F.ceil(F.col("_distinct") / F.lit(float(rows_per_lane))).cast("int")
        )
    )
    many = per_key.where("_lanes > 1").select(*keys, "_lanes", "_distinct")
    sample = attach(collapsed, many, keys, null_safe=True).where(
        value_fraction(F.col(value))
        < F.lit(float(SAMPLES_PER_LANE)) * F.col("_lanes") / F.col("_distinct")
    )
    bounds = (
        sample.groupBy(*keys, "_lanes")
        .agg(F.sort_array(F.collect_list(value)).alias("_sample"))
        .select(
            *keys,
            F.transform(
                F.sequence(F.lit(1), F.col("_lanes") - 1),
                lambda i: F.get(
                    F.col("_sample"),
                    F.floor(i * F.size("_sample") / F.col("_lanes")).cast("int"),
                ),
            ).alias("_bounds"),
        )
    )
    value_type = collapsed.schema[value].dataType
    shape = attach(per_key, bounds, keys, "left", null_safe=True).select(
        *keys,
        *[f"total_{s}" for s in sums],
        F.coalesce("_bounds", F.array().cast(f"array<{value_type.simpleString()}>")).alias(
            "_bounds"
        ),
    )
    laned = (
        attach(collapsed, shape, keys, null_safe=True)
        .withColumn("_lane", count_below(F.col("_bounds"), F.col(value)))
        .drop("_bounds")
    )

    lane_keys = [*keys, "_lane"]
    lane_rows = laned.groupBy(*lane_keys).agg(
        *[F.sum(s).alias(f"_sum_{s}") for s in sums],
        *[
            (F.min(c) if c == value else F.min_by(c, value)).alias(f"_first_{c}")
            for c in following
        ],
    )
    by_lane = Window.partitionBy(*keys).orderBy("_lane")
    before = by_lane.rowsBetween(Window.unboundedPreceding, -1)
    offsets = lane_rows.select(
        *lane_keys,
        *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.lead(f"_first_{c}").over(by_lane).alias(f"_head_{c}") for c in following],
    )
    inside = Window.partitionBy(*lane_keys).orderBy(value)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = join_keyed(laned, offsets, lane_keys)
    out = placed.select(
        *collapsed.columns,
        *[(F.sum(s).over(upto) + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"total_{s}" for s in (sums if totals else ())],
        *[
            F.coalesce(F.lead(c).over(inside), F.col(f"_head_{c}")).alias(f"next_{c}")
            for c in following
        ],
    )
    return out


def exact_quantiles(
    running: DataFrame, keys: Sequence[str], value: str, weight: str, probs: dict[str, float]
) -> DataFrame:
    """Linearly interpolated quantiles from running totals, one row per key.

    Each requested position falls between two ranks; the values at those ranks
    are picked by a conditional aggregate, so no list of values is ever built.
    """
    total = F.col(f"total_{weight}")
    last = F.col(f"cum_{weight}")
    first = last - F.col(weight)

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < last), F.col(value)))

    picks = []
    for name, q in probs.items():
        position = F.lit(float(q)) * (total - 1)
        picks += [
            at(F.floor(position)).alias(f"_lo_{name}"),
            at(F.ceil(position)).alias(f"_hi_{name}"),
            F.max(position - F.floor(position)).alias(f"_w_{name}"),
        ]
    grouped = running.groupBy(*keys).agg(*picks)
    return grouped.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
            for n in probs
        ],
    )
