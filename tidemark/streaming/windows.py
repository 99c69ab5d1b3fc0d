"""Event-time windows: histogram counts for PSI, and error counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.drift import _EDGES, PSI_BINS, _bin, psi_of_cells
from ..session import join_small


def on_event_time(stream: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Zone-less timestamps cannot carry a watermark; cast before setting it."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def window_bin_counts(
    stream: DataFrame, features: Sequence[str], edges: DataFrame, length: str,
    start: str = "0 seconds", ts: str = "ts", delay: str = "1 hour",
) -> DataFrame:
    """Counts per tumbling window, feature and bin of the frozen reference edges.

    ``edges`` is the per-feature table of :func:`drift.with_edges`.  Bin -1 holds
    what lies outside the reference range.
    """
    timed = on_event_time(stream, ts, delay)
    cells = timed.select(
        ts,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
                    for f in features
                ]
            )
        ),
    ).where(F.col("value").isNotNull())
    binned = join_small(cells, edges.select("feature", *_EDGES), ["feature"]).select(
        ts, "feature", _bin("psi", PSI_BINS)
    )
    return (
        binned.groupBy(F.window(ts, length, startTime=start).alias("w"), "feature", "psi_bin")
        .agg(F.count(F.lit(1)).alias("n_cur"))
        .select(
            F.col("w.start").alias("window_start"), "feature", "psi_bin", "n_cur"
        )
    )


def window_psi(counts: DataFrame, reference_counts: DataFrame) -> DataFrame:
    """PSI per window from finished counts and the reference counts per bin."""
    windows = counts.select("window_start", "feature").distinct()
    zero = F.lit(0).cast("bigint")
    reference = join_small(windows, reference_counts, ["feature"]).select(
        "window_start", "feature", "psi_bin", "n_ref", zero.alias("n_cur")
    )
    both = reference.unionByName(
        counts.select("window_start", "feature", "psi_bin", zero.alias("n_ref"), "n_cur")
    )
    cells = both.groupBy("window_start", "feature").agg(
        F.collect_list(F.struct("psi_bin", "n_ref", "n_cur")).alias("_cells")
    )
    return cells.select("window_start", "feature", psi_of_cells("_cells").alias("psi"))


def sliding_error_counts(
    stream: DataFrame, by: str = "severity", length: str = "1 hour", slide: str = "15 minutes",
    ts: str = "ts", delay: str = "1 hour",
) -> DataFrame:
    """Errors of the last hour by severity, every quarter of an hour."""
    return (
        on_event_time(stream, ts, delay)
        .groupBy(F.window(ts, length, slide).alias("w"), by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), by, "n")
    )


def append_to(result: DataFrame, path: str, checkpoint: str):
    """Run a windowed stream over everything available, into Parquet."""
    return (
        result.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
