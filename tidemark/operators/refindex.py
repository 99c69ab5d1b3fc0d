"""Many batches against one reference through a rank index of the reference.

Comparing every batch with the reference by a joint sort copies the
reference's distinct values into each batch.  Here the reference is collapsed
and ranked once: its distinct values per feature with the count at or below
each.  A batch only needs, at each of its own distinct values ``v``, how many
reference values lie below ``v`` and at or below ``v``: between two neighbouring
batch values the batch's distribution function is flat and the reference's
rises, so the largest gap of the two sample distributions is reached next to a
batch value.  These counts come from merging batch values into the reference
by value range: reference values are cut into lanes of about ``rows_per_lane``
distinct values (bounds from a hash-chosen sample, a pure function of the
data), every batch value goes to its lane, and a window inside the lane adds the
reference counts up to it.  The reference is read once, whatever the number of
batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.keys import value_fraction
from ..functions.tails import kolmogorov_tail
from ..session import join_keyed, join_small
from .prefix import ROWS_PER_LANE, SAMPLES_PER_LANE, collapse, count_below, running_totals


def _lanes(reference: DataFrame, rows_per_lane: int) -> DataFrame:
    """Per feature: sorted lane bounds of the reference values and the reference total."""
    per_feature = reference.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_distinct"), F.sum("n").alias("n_ref")
    ).withColumn("_lanes", F.ceil(F.col("_distinct") / F.lit(float(rows_per_lane))).cast("int"))
    sample = join_small(reference, per_feature, ["feature"]).where(
        (F.col("_lanes") > 1)
        & (value_fraction(F.col("value")) < F.lit(float(SAMPLES_PER_LANE)) * F.col("_lanes") / F.col("_distinct"))
    )
    bounds = sample.groupBy("feature", "_lanes").agg(F.sort_array(F.collect_list("value")).alias("_s")).select(
        "feature",
        F.transform(
            F.sequence(F.lit(1), F.col("_lanes") - 1),
            lambda i: F.get(F.col("_s"), F.floor(i * F.size("_s") / F.col("_lanes")).cast("int")),
        ).alias("_bounds"),
    )
    return join_small(per_feature, bounds, ["feature"], "left").select(
        "feature", "n_ref", F.coalesce("_bounds", F.array().cast("array<double>")).alias("_bounds")
    )


def ks_by_reference_index(
    reference: DataFrame, current: DataFrame, by: Sequence[str], rows_per_lane: int = ROWS_PER_LANE,
    corrected: bool = True,
) -> DataFrame:
    """Kolmogorov-Smirnov distance and p-value of every group of ``current`` against ``reference``.

    ``reference`` holds ``(feature, value)`` cells, ``current`` ``(by..., feature,
    value)``; null values are left out.  One row per group and feature that has
    values on both sides: ``(by..., feature, n_ref, n_cur, ks_statistic, ks_pvalue)``.
    """
    keys = [*by, "feature"]
    ref = collapse(reference.withColumn("n", F.lit(1)), ["feature"], "value", ["n"])
    cur = collapse(current.withColumn("c", F.lit(1)), keys, "value", ["c"])
    shape = _lanes(ref, rows_per_lane)

    def laned(df):
        return join_small(df, shape, ["feature"]).withColumn("_lane", count_below(F.col("_bounds"), F.col("value")))

    ref_laned = laned(ref)
    offsets = ref_laned.groupBy("feature", "_lane").agg(F.sum("n").alias("_in_lane")).select(
        "feature", "_lane",
        F.coalesce(
            F.sum("_in_lane").over(Window.partitionBy("feature").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_offset"),
    )
    # batch values carry their own cumulative counts; reference values carry their counts
    cur_run = running_totals(cur, keys, "value", ["c"], rows_per_lane=rows_per_lane)
    group_type = {c: cur_run.schema[c].dataType for c in by}
    merged = ref_laned.select(
        *[F.lit(None).cast(group_type[c]).alias(c) for c in by], "feature", "_lane", "value",
        F.col("n").alias("_r"), F.lit(None).cast("long").alias("_cum_c"), F.lit(None).cast("long").alias("_c"),
        F.lit(None).cast("long").alias("_n_cur"), F.lit(True).alias("_is_ref"),
    ).unionByName(
        laned(cur_run).select(
            *by, "feature", "_lane", "value", F.lit(0).cast("long").alias("_r"),
            F.col("cum_c").cast("long").alias("_cum_c"), F.col("c").cast("long").alias("_c"),
            F.col("total_c").cast("long").alias("_n_cur"), F.lit(False).alias("_is_ref"),
        )
    )
    upto = Window.partitionBy("feature", "_lane").orderBy("value").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    here = Window.partitionBy("feature", "_lane", "value")
    ranked = merged.select(
        "*", F.sum("_r").over(upto).alias("_r_upto"), F.sum("_r").over(here).alias("_r_here")
    ).where(~F.col("_is_ref"))
    placed = join_keyed(join_small(ranked, shape.select("feature", "n_ref"), ["feature"]), offsets, ["feature", "_lane"], "left")
    at_or_below = F.coalesce(F.col("_offset"), F.lit(0)) + F.col("_r_upto")
    below = at_or_below - F.col("_r_here")
    nr, nc = F.col("n_ref").cast("double"), F.col("_n_cur").cast("double")
    gap = F.greatest(
        F.abs(at_or_below / nr - F.col("_cum_c") / nc),
        F.abs(below / nr - (F.col("_cum_c") - F.col("_c")) / nc),
    )
    stats = placed.where("n_ref > 0").groupBy(*keys).agg(
        F.max(gap).alias("ks"), F.max("n_ref").alias("ref_n"), F.max("_n_cur").alias("cur_n")
    )
    return stats.select(
        *keys, F.col("ref_n").alias("n_ref"), F.col("cur_n").alias("n_cur"),
        F.col("ks").alias("ks_statistic"),
        kolmogorov_tail("ks", "ref_n", "cur_n", corrected).alias("ks_pvalue"),
    )
