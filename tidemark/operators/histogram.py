"""Equal-width histograms on weighted long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import join_small

WEIGHTS = ("n_ref", "n_cur")


def bin_sql(value: str, lo: str, hi: str, width: str, bins: int) -> str:
    """Bin of ``value`` among ``bins`` equal bins of ``[lo, hi]``; NULL outside.

    Bins are closed on the left, the last one on both sides.  The arithmetic
    guess is corrected against the edges ``lo + i * width`` themselves, so a
    value equal to an edge lands where comparing with the edges puts it.
    """
    guess = f"floor(({value} - {lo}) / {width})"
    settled = (
        f"{guess} + CAST({value} >= ({guess} + 1) * {width} + {lo} AS INT)"
        f" - CAST({value} < {guess} * {width} + {lo} AS INT)"
    )
    return (
        f"CASE WHEN {value} >= {lo} AND {value} <= {hi} "
        f"THEN CAST(least(greatest({settled}, 0), {bins - 1}) AS INT) END"
    )


def widened(lo: Column, hi: Column) -> tuple[Column, Column]:
    """A constant range becomes one unit wide, centred on the constant."""
    return (
        F.when(lo == hi, lo - 0.5).otherwise(lo),
        F.when(lo == hi, hi + 0.5).otherwise(hi),
    )


def bin_counts(
    weighted: DataFrame,
    edges: DataFrame,
    keys: Sequence[str],
    bins: int,
    weights: Sequence[str] = WEIGHTS,
) -> DataFrame:
    """Dense weights per ``(keys, bin)``; out-of-range weight sits in bin -1.

    ``edges`` has one row ``(keys, lo, hi)`` per key, so joining it turns the
    range lookup into an equality join against a table as small as the schema.
    """
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    placed = join_small(weighted, edges.select(*keys, "lo", "hi", width.alias("_width")), keys)
    index = bin_sql("value", "lo", "hi", "_width", bins)
    binned = placed.withColumn("bin", F.expr(f"coalesce({index}, -1)"))
    counts = binned.groupBy(*keys, "bin").agg(*[F.sum(w).alias(w) for w in weights])
    grid = edges.select(
        *keys, "lo", "hi", F.explode(F.sequence(F.lit(-1), F.lit(bins - 1))).alias("bin")
    )
    return grid.join(counts, [*keys, "bin"], "left").fillna(0, list(weights))


def histogram(long: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """Histogram of one population on its own range.

    ``long`` is ``(keys, value)``; the result lists every bin with its edges,
    including empty ones.
    """
    values = long.where(F.col("value").isNotNull()).select(
        *keys, "value", F.lit(1).cast("bigint").alias("n")
    )
    span = values.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    lo, hi = widened(F.col("lo"), F.col("hi"))
    edges = span.select(*keys, lo.alias("lo"), hi.alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (
        bin_counts(values, edges, keys, bins, ["n"])
        .where("bin >= 0")
        .select(
            *keys,
            "bin",
            (F.col("lo") + F.col("bin") * width).alias("bin_start"),
            F.when(F.col("bin") == bins - 1, F.col("hi"))
            .otherwise(F.col("lo") + (F.col("bin") + 1) * width)
            .alias("bin_end"),
            F.col("n"),
        )
    )
