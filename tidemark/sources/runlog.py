"""Append-only run log on Parquet: parameters, metrics and tags as maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.report import search_runs


def _map(entries: Mapping[str, Column], value_type: str) -> Column:
    if not entries:
        return F.create_map().cast(f"map<string,{value_type}>")
    flat = [x for k, v in entries.items() for x in (F.lit(k), v.cast(value_type))]
    return F.create_map(*flat)


def run_rows(
    df: DataFrame, run_id: Column, experiment: str | Column, start_time: Column,
    params: Mapping[str, Column] | None = None, metrics: Mapping[str, Column] | None = None,
    tags: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Shape result rows as run-log rows."""
    name = F.lit(experiment) if isinstance(experiment, str) else experiment
    return df.select(
        run_id.cast("string").alias("run_id"),
        name.alias("experiment"),
        start_time.cast("timestamp").alias("start_time"),
        _map(params or {}, "string").alias("params"),
        _map(metrics or {}, "double").alias("metrics"),
        _map(tags or {}, "string").alias("tags"),
    )


def append(runs: DataFrame, path: str) -> None:
    runs.select(*S.RUN_LOG.fieldNames()).write.mode("append").parquet(path)


def write_epoch(runs: DataFrame, path: str, epoch: int) -> None:
    """Write one stream epoch so that repeating it replaces, not duplicates."""
    runs.select(*S.RUN_LOG.fieldNames()).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.RUN_LOG).parquet(path)


def search(
    spark: SparkSession, path: str, where: Column | str | None = None,
    experiment: str | None = None, limit: int | None = None,
) -> DataFrame:
    return search_runs(read(spark, path), where, experiment, limit)
