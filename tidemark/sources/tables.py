"""Tables and batch-partitioned datasets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.cleaning import markers_to_null
from ..operators.sampling import stratified_split

BATCH = "batch_number"
_URI = re.compile(r"^[a-z][a-z0-9+.-]*://[^/]*/.+|^/.+")


def read_csv(
    spark: SparkSession, uri: str, schema: StructType | str | None = None,
    null_markers: Sequence[str] = (),
) -> DataFrame:
    """Headed CSV by URI.  Pass a schema: inferring one reads the data twice.

    A URI without a path is an error.
    """
    if not _URI.match(uri):
        raise ValueError(f"not a table URI: {uri!r}")
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(uri)
    return markers_to_null(df, null_markers) if null_markers else df


def read_csv_at(
    spark: SparkSession, bucket: str, key: str, schema: StructType | str | None = None,
    scheme: str = "s3a",
) -> DataFrame:
    """Headed CSV by bucket and key."""
    if not bucket or not key:
        raise ValueError("bucket and key are required")
    return read_csv(spark, f"{scheme}://{bucket}/{key.lstrip('/')}", schema)


def write_splits(
    df: DataFrame, path: str, column: str = "split", fmt: str = "parquet", mode: str = "overwrite",
    sort_by: Sequence[str] = (),
) -> None:
    """One directory per split or batch; an empty split simply has no directory.

    Rows are not gathered per split: a split that holds most of the data keeps
    being written by all tasks.
    """
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = out.write.mode(mode).partitionBy(column)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def read_batches(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_batch(spark: SparkSession, path: str, number: int) -> DataFrame:
    """One batch; other batch directories are pruned."""
    return read_batches(spark, path).where(F.col(BATCH) == number)


def read_batches_before(spark: SparkSession, path: str, number: int) -> DataFrame:
    """All batches before ``number``; gaps in the numbering do not matter."""
    return read_batches(spark, path).where(F.col(BATCH) < number)


def stored_partition(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    """A stored batch partition, or None when there is no such partition yet."""
    try:
        found = read_batch(spark, path, number)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return found if found.take(1) else None


def get_or_create_test_set(
    batch: DataFrame, path: str, number: int, key: Sequence[str], label: str | None,
    test_size: float = 0.3, seed: int = 42,
) -> DataFrame:
    """The stored test set of a batch; split off and stored on first use."""
    spark = batch.sparkSession
    stored = stored_partition(spark, path, number)
    if stored is None:
        held_out = stratified_split(batch, key, label, test_size, seed).where("split = 'test'")
        # only this batch's directory is replaced, so a repeated attempt adds nothing
        held_out.drop("split", BATCH).withColumn(BATCH, F.lit(number)).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)
        stored = read_batch(spark, path, number)
    return stored

