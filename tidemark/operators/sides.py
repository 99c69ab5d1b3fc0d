"""Two populations as one table, and its long form.

Every comparison runs on rows tagged with a boolean ``is_ref``.  The long form
is ``(by..., feature, value, n_ref, n_cur)``: one row per cell at first, later
one row per distinct value - the same operators accept both, because the two
weights simply add up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


IS_REF = "is_ref"
WEIGHTS = ["n_ref", "n_cur"]

NUMERIC = "numeric"
CATEGORICAL = "categorical"


def flag_sides(df: DataFrame, reference_when: Column) -> DataFrame:
    """Both populations out of one table: a single scan."""
    return df.withColumn(IS_REF, F.coalesce(reference_when, F.lit(False)))


def stack_sides(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Two tables as one, restricted to the columns they share (reference order)."""
    shared = [c for c in reference.columns if c in current.columns]
    if not shared:
        raise ValueError("reference and current have no column in common")
    return (
        reference.select(*shared, F.lit(True).alias(IS_REF))
        .unionByName(current.select(*shared, F.lit(False).alias(IS_REF)))
    )


def feature_kinds(
    df: DataFrame,
    exclude: Sequence[str] = (),
    kind_overrides: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Feature kind by column type, read from the schema without a job.

    Numbers are numeric; strings and booleans categorical; everything else is
    skipped.  ``kind_overrides`` declares coded integers categorical.
    """
    overrides = dict(kind_overrides or {})
    unknown = set(overrides) - set(df.columns)
    if unknown:
        raise ValueError(f"kind_overrides names unknown columns: {sorted(unknown)}")
    kinds: dict[str, str] = {}
    for field in df.schema.fields:
        if field.name in exclude or field.name == IS_REF:
            continue
        if field.name in overrides:
            kinds[field.name] = overrides[field.name]
        elif isinstance(field.dataType, T.NumericType):
            kinds[field.name] = NUMERIC
        elif isinstance(field.dataType, (T.StringType, T.BooleanType)):
            kinds[field.name] = CATEGORICAL
    return kinds


def split_kinds(kinds: Mapping[str, str]) -> tuple[list[str], list[str]]:
    return (
        [f for f, k in kinds.items() if k == NUMERIC],
        [f for f, k in kinds.items() if k == CATEGORICAL],
    )


def _melt(df: DataFrame, keep: Sequence[str], features: Sequence[str], cast: str) -> DataFrame:
    cell = "nanvl(CAST(`{0}` AS DOUBLE), NULL) AS `{0}`" if cast == "double" else "CAST(`{0}` AS STRING) AS `{0}`"
    return df.selectExpr(
        *[f"`{k}`" for k in keep], *[cell.format(f) for f in features]
    ).unpivot(list(keep), list(features), "feature", "value")


def _melt_coded(df: DataFrame, keep: Sequence[str], features: Sequence[str], cast: str) -> DataFrame:
    """Like :func:`_melt`, with the position of the feature instead of its name."""
    cell = "nanvl(CAST(`{0}` AS DOUBLE), NULL)" if cast == "double" else "CAST(`{0}` AS STRING)"
    cells = ", ".join(cell.format(f) for f in features)
    return df.selectExpr(*[f"`{k}`" for k in keep], f"posexplode(array({cells})) AS (feature, value)")


def long_form(
    sided: DataFrame, features: Sequence[str], kind: str, by: Sequence[str] = (),
    coded: bool = False,
) -> DataFrame:
    """Cells of the chosen features with side weights; missing cells are dropped.

    With ``by`` the current rows belong to several groups (batches) that are all
    compared with the same reference.  The reference is first collapsed to
    distinct values and only then copied to each group.  ``coded`` identifies a
    feature by its position, which keeps names out of every shuffle.
    """
    cast = "double" if kind == NUMERIC else "string"
    melt = _melt_coded if coded else _melt
    cells = melt(sided, [*by, IS_REF], features, cast).where("value IS NOT NULL")
    if not by:
        ref = f"CAST({IS_REF} AS BIGINT)"
        return cells.selectExpr("feature", "value", f"{ref} AS n_ref", f"1 - {ref} AS n_cur")
    current = cells.where(f"NOT {IS_REF}").selectExpr(
        *by, "feature", "value", "0L AS n_ref", "1L AS n_cur"
    )
    groups = sided.where(~F.col(IS_REF)).select(*by).distinct()
    reference = (
        cells.where(IS_REF).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n_ref"))
        .crossJoin(groups)
        .selectExpr(*by, "feature", "value", "n_ref", "0L AS n_cur")
    )
    return current.unionByName(reference)
