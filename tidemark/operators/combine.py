"""Set operations on datasets: union, duplicates, overlap, lineage."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concatenate(datasets: Sequence[DataFrame], remove_duplicates: bool = True) -> DataFrame:
    """Union by column name; a column absent from one dataset is NULL there."""
    if not datasets:
        raise ValueError("at least one dataset is required")
    merged = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), datasets)
    return merged.dropDuplicates() if remove_duplicates else merged


def duplicate_count(df: DataFrame) -> DataFrame:
    """``(rows, distinct_rows, removed)`` without materialising the deduplicated table."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("removed", F.col("rows") - F.col("distinct_rows"))


def overlap(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key also occurs in ``right`` (empty = disjoint)."""
    return left.join(right.select(*on), list(on), "left_semi")


def held_out_rest(batch: DataFrame, held_out: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` that are not in the held-out part."""
    return batch.join(held_out.select(*on), list(on), "left_anti")


def category_changes(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Every category with its presence: ``new``, ``vanished`` or ``kept``."""
    tagged = reference.select(F.col(column).alias("value"), F.lit(1).alias("_r"), F.lit(0).alias("_c"))
    tagged = tagged.unionAll(
        current.select(F.col(column).alias("value"), F.lit(0).alias("_r"), F.lit(1).alias("_c"))
    )
    seen = tagged.where(F.col("value").isNotNull()).groupBy("value").agg(
        F.max("_r").alias("_r"), F.max("_c").alias("_c")
    )
    return seen.select(
        "value",
        F.when(F.col("_r") == 0, "new").when(F.col("_c") == 0, "vanished").otherwise("kept")
        .alias("presence"),
    )


def cumulative_training_set(
    initial: Sequence[DataFrame], batches: DataFrame, batch_number: int, current_train: DataFrame,
    batch_column: str = "batch_number",
) -> DataFrame:
    """Initial sets, all batches before ``batch_number`` and the current training part.

    Earlier batches are one partition-pruned read; missing batch numbers simply
    contribute nothing.
    """
    earlier = batches.where(F.col(batch_column) < batch_number).drop(batch_column)
    return concatenate([*initial, earlier, current_train.drop(batch_column)])


def tag_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Union of named sources with a ``source`` column."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return concatenate(tagged, remove_duplicates=False)


def lineage_counts(tagged: DataFrame) -> DataFrame:
    """Rows per source, plus the total as ``combined``."""
    return tagged.rollup("source").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("source").alias("_all")
    ).select(
        F.when(F.col("_all") == 1, "combined").otherwise(F.col("source")).alias("source"), "n"
    )


def set_differences(left: Sequence[str], right: Sequence[str]) -> dict[str, list[str]]:
    """Column lists in common, only left and only right, keeping order."""
    return {
        "shared": [c for c in left if c in right],
        "only_left": [c for c in left if c not in right],
        "only_right": [c for c in right if c not in left],
    }
