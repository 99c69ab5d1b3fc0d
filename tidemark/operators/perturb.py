"""Controlled perturbation of tables, for building drifted test batches.

Random choices hash the row key with the seed, so a perturbed table is a pure
function of its input.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_fraction
from ..session import cut_lineage, join_small
from .ranks import cut_tuples, side_of_cuts, with_hash_order
from .sampling import oversample, sample_rows, swap_rows
from .sides import NUMERIC, feature_kinds

OUTLIER = 999999
IDENTIFIERS = ("patient_nbr", "encounter_id", "readmitted", "readmitted_binary")


def _numeric_present(df: DataFrame, features: Sequence[str]) -> list[str]:
    kinds = feature_kinds(df)
    return [f for f in features if kinds.get(f) == NUMERIC]


def _with_moments(df: DataFrame, population: DataFrame, features: Sequence[str]) -> DataFrame:
    """Attach the one-row (mean, deviation) table of ``population``."""
    stats = population.agg(
        *[F.avg(F.col(f).cast("double")).alias(f"_mean_{f}") for f in features],
        *[F.stddev_samp(F.col(f).cast("double")).alias(f"_std_{f}") for f in features],
    )
    return join_small(df, stats, [])


def covariate_drift(
    df: DataFrame,
    features: Sequence[str],
    intensity: float | Mapping[str, float] = 0.3,
    kind: str = "shift",
    population: DataFrame | None = None,
) -> DataFrame:
    """Shift, scale, or half of each, by ``intensity`` (one number or per feature).

    Moments come from ``population`` (the table itself by default).  Absent and
    non-numeric features are left alone, and so are constant ones when shifting.
    """
    if kind not in ("shift", "scale", "both"):
        raise ValueError(f"unknown drift kind {kind!r}")
    used = _numeric_present(df, features)
    if not used:
        return df
    ready = _with_moments(df, population if population is not None else df, used)
    changed = {}
    for f in used:
        amount = intensity[f] if isinstance(intensity, Mapping) else intensity
        x = F.col(f).cast("double")
        mean, std = F.col(f"_mean_{f}"), F.col(f"_std_{f}")
        if kind == "shift":
            value = F.when(std > 0, x + F.lit(float(amount)) * std).otherwise(x)
        elif kind == "scale":
            value = (x - mean) * F.lit(1.0 + amount) + mean
        else:
            half = amount * 0.5
            value = F.when(
                std > 0, (x - mean) * F.lit(1.0 + half) + mean + F.lit(half) * std
            ).otherwise(x)
        changed[f] = value
    return ready.withColumns(changed).select(*df.columns)


def random_shift(
    df: DataFrame, features: Sequence[str], intensity: float = 0.3, seed: int | None = None
) -> tuple[DataFrame, dict[str, float]]:
    """Shift each feature by a seeded normal multiple of ``intensity`` deviations."""
    rng = random.Random(seed)
    amounts = {f: intensity * rng.gauss(0.0, 1.0) for f in _numeric_present(df, features)}
    return covariate_drift(df, list(amounts), amounts), amounts


def drift_scenario(
    df: DataFrame, scenario: str, target: str = "readmitted_binary", seed: int | None = None
) -> tuple[DataFrame, dict]:
    """Named scenario with its metadata; an unknown name changes nothing."""
    meta = {
        "scenario_name": scenario, "drift_types": [], "affected_features": [],
        "intensity_levels": {}, "target_column": target,
    }
    if scenario == "mild_covariate":
        features = [f for f in ("age_ordinal", "time_in_hospital") if f in df.columns]
        df, _ = random_shift(df, features, 0.15, seed)
        meta.update(
            drift_types=["covariate_shift"], affected_features=features,
            intensity_levels={"covariate": 0.15},
        )
    return df, meta


def shift_all_numeric(
    df: DataFrame, intensity: float = 0.40, exclude: Sequence[str] = IDENTIFIERS
) -> DataFrame:
    kinds = feature_kinds(df, exclude=exclude)
    return covariate_drift(df, [f for f, k in kinds.items() if k == NUMERIC], intensity)


def mixed_drift(
    df: DataFrame, intensity: float, ordinal: str = "age_ordinal", drift_type: str = "mixed",
    seed: int = 42, columns: Sequence[str] | None = None,
) -> DataFrame:
    """Covariate part (weight 0.6) and concept part (0.4), or one of them alone.

    The covariate part shifts each of ``columns`` (default: all numeric ones) with
    probability 0.7; the concept part moves the ordinal column.
    """
    weights = {
        "none": (0.0, 0.0), "covariate": (1.0, 0.0), "concept": (0.0, 1.0), "mixed": (0.6, 0.4),
    }
    covariate, concept = weights[drift_type]
    if covariate:
        rng = random.Random(seed)
        numeric = [f for f, k in feature_kinds(df).items() if k == NUMERIC]
        chosen = [f for f in (columns if columns is not None else numeric) if rng.random() < 0.7]
        df = covariate_drift(df, chosen, intensity * covariate)
    if concept and ordinal in df.columns:
        df = df.withColumn(ordinal, F.col(ordinal) + F.lit(intensity * concept * 10))
    return df


def flip_labels(
    df: DataFrame, key: Sequence[str], where: Column, share: float, label: str, seed: int = 42
) -> DataFrame:
    """Invert a 0/1 label for exactly ``floor(share * matching)`` matching rows."""
    match = F.coalesce(where, F.lit(False))
    hashed, order = with_hash_order(df, seed, key)
    hashed = hashed.withColumn("_match", match)
    cuts = cut_tuples(
        hashed.where("_match"), order, {"flip": lambda n: F.floor(n * F.lit(share))}, bounded=order
    )
    marked = side_of_cuts(hashed, order, cuts, ["flip"], None, "_side")
    flipped = F.when(
        F.col("_match") & (F.col("_side") == "flip"), F.lit(1) - F.col(label)
    ).otherwise(F.col(label))
    return marked.withColumn(label, flipped).select(*df.columns)


# ------------------------------------------------------------- drifted batches
# A batch is a bounded sample of the population that the following steps scan
# several times, so it is materialised once.
def no_drift_batch(df: DataFrame, key: Sequence[str], size: int = 2000, seed: int = 42) -> DataFrame:
    return sample_rows(df, key, size, seed)


def gradual_drift_batch(
    df: DataFrame, key: Sequence[str], old: Column, high: Column, size: int = 2000, seed: int = 42
) -> DataFrame:
    """Half the batch satisfies ``old``; up to 15 % low rows swapped for ``high`` ones."""
    batch = cut_lineage(oversample(df, key, old, size, 0.50, seed).drop("stratum", "copy"))
    return swap_rows(batch, df, key, high, size, 0.15, seed)


def strong_drift_batch(
    df: DataFrame, key: Sequence[str], very_old: Column, high: Column, shifted: Sequence[str],
    size: int = 2000, seed: int = 42,
) -> DataFrame:
    """40 % very old, up to 20 % swapped, and a shift of 0.3 population deviations."""
    batch = cut_lineage(oversample(df, key, very_old, size, 0.40, seed).drop("stratum", "copy"))
    swapped = swap_rows(batch, df, key, high, size, 0.20, seed)
    return covariate_drift(swapped, shifted, 0.3, population=df)


def concept_drift_batch(
    df: DataFrame, key: Sequence[str], emergency: Column, flip_where: Column, label: str,
    shifted: Sequence[str], size: int = 2000, seed: int = 42,
) -> DataFrame:
    """35 % emergencies, 40 % of labels flipped where asked, a 0.2-deviation shift."""
    batch = cut_lineage(oversample(df, key, emergency, size, 0.35, seed))
    flipped = flip_labels(batch, [*key, "copy"], flip_where, 0.40, label, seed)
    return covariate_drift(flipped.drop("stratum", "copy"), shifted, 0.2, population=df)


# --------------------------------------------------------------- quality issues
def inject_nulls(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], row_fraction: float,
    cell_probability: float = 0.4, seed: int = 42, affected: int = 3,
) -> DataFrame:
    """Blank cells in a fraction of the rows.

    ``affected`` of the ``columns`` are hit, those with the smallest hashes of
    seed and name; if there are fewer, all are.
    """
    hit = sorted(columns, key=lambda c: hashlib.md5(f"{seed}:{c}".encode()).hexdigest())[:affected]
    chosen = hash_fraction(f"{seed}-row", *key) < row_fraction
    return df.withColumns(
        {
            c: F.when(~(chosen & (hash_fraction(f"{seed}-{c}", *key) < cell_probability)), F.col(c))
            for c in hit
        }
    )


def _one_of(columns: Sequence[str], key: Sequence[str], seed: int | str) -> Column:
    """The position of the column that is hit in a row, drawn by hash."""
    return F.floor(hash_fraction(f"{seed}-column", *key) * len(columns))


def corrupt_strings(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], fraction: float, seed: int = 42
) -> DataFrame:
    """Overwrite one character with ``X`` in a fraction of the rows, in one column of each."""
    column = _one_of(columns, key, seed)
    struck = hash_fraction(f"{seed}-hit", *key) < fraction
    changed = {}
    for i, c in enumerate(columns):
        spot = F.floor(hash_fraction(f"{seed}-pos", *key) * F.length(c)) + 1
        changed[c] = F.when(
            struck & (column == i) & (F.length(c) > 1),
            F.overlay(F.col(c), F.lit("X"), spot.cast("int")),
        ).otherwise(F.col(c))
    return df.withColumns(changed)


def inject_outliers(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], fraction: float, seed: int = 42
) -> DataFrame:
    """An outlier in a fraction of the rows, in one column of each."""
    column = _one_of(columns, key, f"{seed}-out")
    struck = hash_fraction(f"{seed}-out", *key) < fraction
    return df.withColumns(
        {
            c: F.when(struck & (column == i), F.lit(OUTLIER)).otherwise(F.col(c)).cast(df.schema[c].dataType)
            for i, c in enumerate(columns)
        }
    )


def multiple_issues(
    df: DataFrame, key: Sequence[str], intensity: float, text: Sequence[str],
    numeric: Sequence[str], seed: int = 42,
) -> DataFrame:
    """Missing cells, corrupted strings and outliers together, scaled by intensity."""
    out = inject_nulls(df, key, [*text, *numeric], intensity * 0.6, 0.4, seed)
    out = corrupt_strings(out, key, text, intensity * 0.4 * 0.5 * 0.3, seed)
    return inject_outliers(out, key, numeric, intensity * 0.1 * 0.2, seed)


def quality_score(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One minus the share of rows with any missing cell, measured."""
    affected = F.lit(False)
    for c in columns:
        affected = affected | F.col(c).isNull()
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(affected).alias("affected_rows"),
        F.greatest(F.lit(1.0) - F.avg(affected.cast("double")), F.lit(0.0)).alias("quality_score"),
    )
