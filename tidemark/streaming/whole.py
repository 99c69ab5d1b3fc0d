"""Drift verdicts for whole batches whose rows arrive in several files and triggers.

A micro-batch holds an arbitrary part of one or more batches, so it is never
judged by itself.  Each trigger folds its rows into a mergeable state, the
counts of every ``(batch, feature, value)``, written per epoch and partitioned
by batch.  A batch is complete when the rows counted for it reach the number
that its marker declares (markers are a small table written by the producer).
Complete batches that have no verdict yet are judged once, from their counts,
against the reference counts that were collapsed once at start; the verdict
goes to the batch's own partition of the log.

Replaying an epoch rewrites that epoch's state, and a batch with a verdict is
never judged again, so a restart repeats nothing.  Rows beyond a declared count
are kept in the state but do not reopen a verdict.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..operators.sides import NUMERIC
from .monitor import verdict, verdict_runs

#: Longest array made when counts become rows again; bounds the memory of one row.
CHUNK = 1 << 16


def cells(rows: DataFrame, batch: str | None, kinds: Mapping[str, str]) -> DataFrame:
    """Counts of ``(batch, feature, num, cat)``; null and NaN cells are left out, as the drift tests do."""
    keys = [F.col(batch).alias("batch")] if batch else []
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            (F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) if kind == NUMERIC
             else F.lit(None).cast("double")).alias("num"),
            (F.col(f).cast("string") if kind != NUMERIC else F.lit(None).cast("string")).alias("cat"),
        )
        for f, kind in kinds.items()
    ]
    names = ["batch"] if batch else []
    melted = rows.select(*keys, F.explode(F.array(*entries)).alias("c")).select(*names, "c.*")
    present = F.col("num").isNotNull() | F.col("cat").isNotNull()
    return melted.where(present).groupBy(*names, "feature", "num", "cat").agg(
        F.count(F.lit(1)).alias("n")
    )


def expand(counts: DataFrame, kinds: Mapping[str, str], keys: list[str]) -> DataFrame:
    """Counts back to rows: one row per counted cell, the other features null.

    Every drift test drops null cells per feature, so these rows give the same
    result as the original ones.  Large counts unfold in chunks of ``CHUNK``.
    """
    chunks = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / CHUNK).cast("int"))).alias("k")
    unfolded = counts.select(*keys, "feature", "num", "cat", "n", chunks).select(
        *keys, "feature", "num", "cat",
        F.explode(F.array_repeat(F.lit(1), F.least(F.lit(CHUNK), F.col("n") - F.col("k") * CHUNK).cast("int"))).alias("_"),
    )
    return unfolded.select(
        *keys,
        *[
            F.when(F.col("feature") == f, F.col("num" if kind == NUMERIC else "cat")).alias(f)
            for f, kind in kinds.items()
        ],
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def whole_batch_monitor(
    stream: DataFrame, reference: DataFrame, batch: str, kinds: Mapping[str, str], markers: str,
    state: str, log_path: str, checkpoint: str, experiment: str = "drift_monitoring",
    threshold: float = 0.5, files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Judge each batch once, when all its declared rows have arrived.

    ``markers`` is a Parquet folder of ``(batch, n_rows)``; ``state`` holds the
    reference counts, the per-epoch counts and row tallies; ``log_path`` gets
    one run-log partition per batch (``batch=<n>``).
    """
    spark = stream.sparkSession
    ref_path = f"{state}/reference"
    if not _exists(spark, ref_path):
        cells(reference, None, kinds).write.parquet(ref_path)

    def handle(rows: DataFrame, epoch: int) -> None:
        part = rows.select(batch, *kinds).where(F.col(batch).isNotNull())
        cells(part, batch, kinds).write.mode("overwrite").partitionBy("batch").parquet(f"{state}/cells/epoch={epoch}")
        part.groupBy(F.col(batch).alias("batch")).count().write.mode("overwrite").parquet(f"{state}/rows/epoch={epoch}")
        arrived = spark.read.parquet(f"{state}/rows").groupBy("batch").agg(F.sum("count").alias("arrived"))
        declared = spark.read.parquet(markers).select(F.col("batch").cast(part.schema[batch].dataType), "n_rows")
        complete = declared.join(arrived, "batch").where("arrived >= n_rows").select("batch")
        if _exists(spark, log_path):
            decided = spark.read.parquet(log_path).select("batch").distinct()
            complete = complete.join(decided, "batch", "left_anti")
        todo = [r.batch for r in complete.collect()]  # batches that completed in this trigger: few
        if not todo:
            return
        counts = spark.read.parquet(f"{state}/cells").where(F.col("batch").isin(todo))
        counts = counts.groupBy("batch", "feature", "num", "cat").agg(F.sum("n").alias("n"))
        current = expand(counts, kinds, ["batch"]).withColumnRenamed("batch", batch)
        ref_rows = expand(spark.read.parquet(ref_path), kinds, [])
        decided_now = verdict(ref_rows, current, [batch], kinds, threshold)
        runs = verdict_runs(decided_now, batch, experiment, "stream").withColumn(
            "batch", F.col("params")[batch]
        )
        runs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(log_path)

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The verdicts written so far, one run per batch."""
    if not _exists(spark, log_path):
        return spark.createDataFrame([], S.RUN_LOG)
    return spark.read.parquet(log_path).drop("batch")
