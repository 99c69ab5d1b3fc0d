"""Drift monitor over arriving batches, and streaming scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.consensus import column_drift, consensus, drift_summary
from ..operators.drift import feature_table
from ..operators.sides import IS_REF
from ..operators.train import score
from ..sources import runlog



def batch_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files picked up as they arrive, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def verdict(
    reference: DataFrame, current: DataFrame, by: Sequence[str], kinds: Mapping[str, str],
    threshold: float = 0.5,
) -> DataFrame:
    """Consensus per group of ``current`` against one reference."""
    columns = [*by, *kinds]
    empty_keys = [F.lit(None).cast(current.schema[c].dataType).alias(c) for c in by]
    sided = reference.select(*empty_keys, *kinds, F.lit(True).alias(IS_REF)).unionByName(
        current.select(*columns, F.lit(False).alias(IS_REF))
    )
    table = feature_table(sided, kinds, by=by)
    return consensus(drift_summary(column_drift(table), by, threshold), by)


def verdict_runs(decided: DataFrame, batch: str, experiment: str, source: str) -> DataFrame:
    """Verdict rows as run-log rows; the run id is a function of source and batch."""
    return runlog.run_rows(
        decided,
        F.concat_ws("_", F.lit(source), F.col(batch).cast("string")),
        experiment,
        F.current_timestamp(),
        params={"batch_number": F.col(batch)},
        metrics={
            "drift_share": F.col("drift_share"),
            "n_drifted_columns": F.col("n_drifted_columns"),
            "n_total_columns": F.col("n_columns"),
            "dataset_drift": F.col("dataset_drift").cast("int"),
            "confidence_score": F.col("confidence_score"),
        },
        tags={
            "status": F.col("status"),
            "indicators": F.array_join("drift_indicators", ","),
        },
    )


def drift_monitor(
    stream: DataFrame, reference: DataFrame, batch: str, kinds: Mapping[str, str], log_path: str,
    checkpoint: str, experiment: str = "drift_monitoring", threshold: float = 0.5,
) -> StreamingQuery:
    """Compare every micro-batch with the fixed reference and log the verdicts.

    Each epoch is written to its own directory and overwritten when replayed, so
    a restart after a failure does not duplicate runs.
    """

    def handle(rows: DataFrame, epoch: int) -> None:
        current = rows.persist()
        try:
            decided = verdict(reference, current, [batch], kinds, threshold)
            runlog.write_epoch(verdict_runs(decided, batch, experiment, "stream"), log_path, epoch)
        finally:
            current.unpersist()

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(
    stream: DataFrame, encoder: PipelineModel, model, keep: Sequence[str], path: str, checkpoint: str
) -> StreamingQuery:
    """Score arriving rows with a fitted encoder and model, appending to Parquet."""
    return (
        score(encoder.transform(stream), model, keep)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
