"""Batch files: discovery, backlog and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import hours_between

BACKLOG_LIMIT = 10
PARALLEL_LIMIT = 3


def list_batches(spark: SparkSession, path: str, pattern: str = "batch_*.csv") -> DataFrame:
    """Manifest of batch files.  Only file metadata is read, never the content."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))
    )
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return files.select(name.alias("batch_id"), "path", "size_bytes", "modified")


def oldest_first(manifest: DataFrame, limit: int) -> DataFrame:
    """The batches to process next; sorted before the limit is applied."""
    return manifest.orderBy("modified", "batch_id").limit(limit)


def backlog_status(manifest: DataFrame, now: Column, limit: int = BACKLOG_LIMIT) -> DataFrame:
    """Size and age of the backlog with the priority that follows from them."""
    totals = manifest.agg(
        F.count(F.lit(1)).alias("backlog_count"),
        F.coalesce(F.max(hours_between(now, F.col("modified"))), F.lit(0.0))
        .alias("oldest_batch_age_hours"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_backlog_size_bytes"),
    )
    over = F.col("backlog_count") > limit
    old = F.col("oldest_batch_age_hours") > 24
    few = F.col("backlog_count") < 3
    return totals.select(
        "*",
        F.when(over, "catch_up_mode").when(old, "urgent_processing").when(few, "normal_processing")
        .otherwise("elevated_processing").alias("priority_adjustment"),
        F.when(over, "reduce_by_50_percent").when(old, "reduce_by_30_percent")
        .when(few, "standard").otherwise("reduce_by_20_percent").alias("recommended_interval"),
        F.when(over, "backlog_alert").otherwise("healthy").alias("status"),
    )


def expired(manifest: DataFrame, now: Column, keep_days: int = 7) -> DataFrame:
    """Batches older than ``keep_days``; deleting them is up to the caller."""
    return manifest.where(F.col("modified") < now - F.expr(f"INTERVAL {keep_days} DAYS"))


def retention_report(manifest: DataFrame, now: Column, keep_days: int = 7) -> DataFrame:
    return expired(manifest, now, keep_days).agg(
        F.count(F.lit(1)).alias("batches_expired"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes_expired"),
    )
