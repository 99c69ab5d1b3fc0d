"""JSON artifacts: ROC curves and decision responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROC_SCHEMA = "struct<fpr:array<double>,tpr:array<double>,thresholds:array<double>,auc:double>"


def roc_arrays(points: DataFrame, areas: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Curve points gathered into parallel arrays, one row per model.

    The artifact is one document, so a curve has to fit in a row.  A very long
    one stays in point rows, or is thinned by the caller.
    """
    point = F.struct((-F.col("threshold")).alias("o"), "fpr", "tpr", "threshold")
    curve = points.groupBy(*by).agg(F.array_sort(F.collect_list(point)).alias("_p"))
    return curve.join(areas.select(*by, "auc"), list(by)).select(
        *by,
        F.transform("_p", lambda p: p["fpr"]).alias("fpr"),
        F.transform("_p", lambda p: p["tpr"]).alias("tpr"),
        F.transform("_p", lambda p: p["threshold"]).alias("thresholds"),
        "auc",
    )


def to_json_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``(key..., json)`` with all other columns in one JSON document."""
    rest = [c for c in df.columns if c not in key]
    return df.select(*key, F.to_json(F.struct(*rest)).alias("json"))


def from_json_rows(df: DataFrame, schema: str, key: Sequence[str]) -> DataFrame:
    return df.select(*key, F.from_json("json", schema).alias("_doc")).select(*key, "_doc.*")


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
