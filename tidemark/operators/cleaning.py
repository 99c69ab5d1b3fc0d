"""Cleaning, target derivation, encoding and column alignment of a wide table.

All functions are projections and filters over declared columns; none of them
starts a job except the two that must look at the data to choose columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.scalar import lookup, to_number
from .sides import CATEGORICAL, NUMERIC, _melt, feature_kinds


def markers_to_null(df: DataFrame, markers: Sequence[str] = (S.MISSING_MARKER,)) -> DataFrame:
    """Turn missing-value markers into NULL in string columns only."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            c = (
                F.nullif(c, F.lit(markers[0]))
                if len(markers) == 1
                else F.when(~c.isin(*markers), c)
            )
        out.append(c.alias(field.name))
    return df.select(*out)


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def fill_missing(df: DataFrame, fills: Mapping[str, str]) -> DataFrame:
    present = {c: v for c, v in fills.items() if c in df.columns}
    return df.fillna(present) if present else df


def exclude_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """NOT IN that keeps rows whose value is NULL."""
    return df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def is_missing(df: DataFrame, column: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    cell = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return cell.isNull() | F.isnan(cell)
    return cell.isNull()


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing, missing_pct)`` for every column, in one pass."""
    columns = list(columns or df.columns)
    counts = df.select(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select("_rows", F.inline(entries)).select(
        "column",
        "missing",
        F.coalesce(F.try_divide(F.col("missing") * 100.0, F.col("_rows")), F.lit(0.0))
        .alias("missing_pct"),
    )


def drop_sparse(df: DataFrame, max_missing: float) -> DataFrame:
    """Drop columns whose missing rate exceeds ``max_missing`` (a share).

    Choosing columns needs the data: one aggregation returns a single row.
    """
    rates = df.select(
        *[F.avg(is_missing(df, c).cast("double")).alias(c) for c in df.columns]
    ).first()
    return df.drop(*[c for c in df.columns if (rates[c] or 0.0) > max_missing])


def low_cardinality_columns(df: DataFrame, limit: int = 25) -> list[str]:
    """String columns with fewer than ``limit`` distinct values.

    Cells are counted in two levels, value and column, with one row per column
    coming back.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return []
    cells = _melt(df, [], names, "string").where("value IS NOT NULL")
    few = (
        cells.groupBy("feature", "value").agg(F.lit(1).alias("one"))
        .groupBy("feature").agg(F.count("one").alias("n"))
    )
    counts = {r["feature"]: r["n"] for r in few.collect()}
    return [c for c in names if counts.get(c, 0) < limit]


def derive_target(
    df: DataFrame,
    rule: str = "any",
    source: str = S.TARGET_SOURCE,
    target: str = S.TARGET,
    overwrite: bool = False,
) -> DataFrame:
    """Binary target.  ``'any'``: everything but ``NO`` (missing included) is 1;
    ``'within30'``: only ``<30`` is 1.  An existing target is kept unless
    ``overwrite``, so deliberately changed labels survive."""
    if source not in df.columns or (target in df.columns and not overwrite):
        return df
    if rule == "any":
        value = F.when(F.col(source) == "NO", 0).otherwise(1)
    elif rule == "within30":
        value = F.when(F.col(source) == "<30", 1).otherwise(0)
    else:
        raise ValueError(f"unknown target rule {rule!r}")
    return df.withColumn(target, value)


def map_ordinal(
    df: DataFrame, column: str, output: str, levels: Mapping[str, int] = S.AGE_BRACKETS
) -> DataFrame:
    """Ordered labels to integers; unknown labels become NULL."""
    if column not in df.columns:
        return df
    return df.withColumn(output, lookup(F.col(column), dict(levels)))


def clean(df: DataFrame) -> DataFrame:
    """The encounter cleaning steps: markers, dropped columns, fills, exclusions."""
    out = markers_to_null(df)
    out = drop_present(out, S.DROPPED_COLUMNS)
    out = fill_missing(out, S.FILLED_COLUMNS)
    if "discharge_disposition_id" in out.columns:
        out = exclude_values(out, "discharge_disposition_id", S.EXCLUDED_DISPOSITIONS)
    return out


def featurise(df: DataFrame, rule: str = "any", overwrite: bool = False) -> DataFrame:
    return map_ordinal(derive_target(df, rule, overwrite=overwrite), "age", "age_ordinal")


def prepare_for_drift(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Clean and featurise, then drop the target and the raw forms of features."""
    return featurise(clean(df)).drop(target, S.TARGET_SOURCE, "age")


def drift_columns(
    reference: DataFrame,
    current: DataFrame,
    exclude: Sequence[str] = S.DRIFT_EXCLUDED,
    fill: str = "Unknown",
) -> tuple[DataFrame, DataFrame]:
    """Shared feature columns of both tables, strings filled, reference order."""
    kept = [c for c in reference.columns if c not in exclude and c in current.columns]
    text = [
        f.name
        for f in reference.schema.fields
        if f.name in kept and isinstance(f.dataType, (T.StringType, T.BooleanType))
    ]

    def shape(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(fill)).alias(c)
                if c in text
                else F.col(f"`{c}`")
                for c in kept
            ]
        )

    return shape(reference), shape(current)


def align_shared(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no column in common")
    return left.select(*shared), right.select(*shared)


def align_expected(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Exactly the expected columns in the expected order, absent ones as 0."""
    return df.select(
        *[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in expected]
    )


def rename_to_stored(df: DataFrame, stored: Sequence[str] = S.HYPHENATED) -> DataFrame:
    """Underscored request names to the stored hyphenated names."""
    return df.withColumnsRenamed({c.replace("-", "_"): c for c in stored})


def numeric_only(df: DataFrame) -> DataFrame:
    kinds = feature_kinds(df)
    return df.select(*[c for c, k in kinds.items() if k == NUMERIC])


def categorical_only(df: DataFrame) -> DataFrame:
    kinds = feature_kinds(df)
    return df.select(*[c for c, k in kinds.items() if k == CATEGORICAL])


def select_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named features, in the given order."""
    return df.select(*[F.col(f"`{c}`") for c in names])


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in columns})
