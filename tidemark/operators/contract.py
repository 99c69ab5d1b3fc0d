"""Row-level contract check: required fields, types, nullability."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S


@dataclass(frozen=True)
class Field:
    """One contract field; ``type`` is a Spark SQL type name."""

    name: str
    type: str
    nullable: bool = False


def encounter_contract() -> list[Field]:
    """The 44 request fields in order of type: integers, text, nullable text."""
    return (
        [Field(c, "int") for c in S.INTEGER_FIELDS]
        + [Field(c, "string") for c in S.TEXT_FIELDS]
        + [Field(c, "string", True) for c in S.NULLABLE_TEXT_FIELDS]
    )


def check_contract(df: DataFrame, contract: Sequence[Field]) -> DataFrame:
    """Add ``violations``, an array of ``field:reason`` strings.

    Reasons are ``missing`` (required field absent or NULL) and ``type`` (present
    but not convertible).  The whole check is one projection.
    """
    problems = []
    for f in contract:
        if f.name not in df.columns:
            if not f.nullable:
                problems.append(F.lit(f"{f.name}:missing"))
            continue
        value = F.col(f"`{f.name}`")
        bad_type = value.isNotNull() & value.try_cast(f.type).isNull()
        reason = F.when(bad_type, F.lit(f"{f.name}:type"))
        if not f.nullable:
            reason = F.when(value.isNull(), F.lit(f"{f.name}:missing")).otherwise(reason)
        problems.append(reason)
    return df.withColumn("violations", F.array_compact(F.array(*problems)))


def split_by_contract(
    df: DataFrame, contract: Sequence[Field]
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows cast to the contract types, and rejected rows with reasons."""
    checked = check_contract(df, contract)
    typed = [
        F.col(f"`{f.name}`").try_cast(f.type).alias(f.name)
        if f.name in df.columns
        else F.lit(None).cast(f.type).alias(f.name)
        for f in contract
    ]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in {f.name for f in contract}]
    accepted = checked.where(F.size("violations") == 0).select(*rest, *typed)
    return accepted, checked.where(F.size("violations") > 0)
