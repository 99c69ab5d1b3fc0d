"""Session helpers: where shared scratch data goes, and how small sides are joined."""

from __future__ import annotations

import functools
import operator
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the cluster's ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves a session on one
    machine; on a cluster that is an error, as executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def importable(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package from where it lies."""
    root = str(Path(__file__).resolve().parents[1])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a folder when the cluster named none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoint"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise an intermediate result that several later passes read.

    Uses the reliable checkpoint folder, so the result survives the loss of
    executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def join_small(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Broadcast join for a side whose row count is bounded by construction.

    Callers pass tables with one row per feature, side or rule.  With no key
    columns the small side is a single row and is attached to all.  Sides that
    grow with the data go through :func:`join_keyed`.
    """
    if not on:
        return big.crossJoin(F.broadcast(small))
    return join_keyed(big, F.broadcast(small), on, how, null_safe)


def join_keyed(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", null_safe: bool = True
) -> DataFrame:
    """Equi-join without a hint of its own: adaptive execution sees the real sizes and decides.

    ``null_safe`` lets NULL keys meet.
    """
    if not null_safe:
        return left.join(right, list(on), how)
    renamed = right.select(
        *[F.col(c).alias(f"_j_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    cond = functools.reduce(operator.and_, [left[c].eqNullSafe(F.col(f"_j_{c}")) for c in on])
    return left.join(renamed, cond, how).drop(*[f"_j_{c}" for c in on])
