"""Descriptive profiles.  Quantiles are exact and distributed (see ``prefix``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ratio
from ..session import join_keyed, join_small
from .cleaning import is_missing, missing_rates
from .prefix import collapse, exact_quantiles, running_totals
from .sides import CATEGORICAL, IS_REF, NUMERIC, _melt, feature_kinds, split_kinds

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _numeric_cells(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _melt(df, by, columns, "double").withColumn("n", F.lit(1).cast("bigint"))


def quantile_table(
    df: DataFrame, columns: Sequence[str], probs: dict[str, float] = QUARTILES,
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact linear-interpolated quantiles per column."""
    keys = [*by, "feature"]
    distinct = collapse(_numeric_cells(df, columns, by), keys, "value", ["n"])
    run = running_totals(distinct, keys, "value", ["n"])
    return exact_quantiles(run, keys, "value", "n", probs)


def describe_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles, max per column."""
    keys = [*by, "feature"]
    basics = _numeric_cells(df, columns, by).groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return basics.join(quantile_table(df, columns, by=by), keys, "left").select(
        *keys, "count", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def category_frequencies(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return (
        _melt(df, by, columns, "string")
        .groupBy(*by, "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def describe_categorical(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Count, distinct values, most frequent value (ties: smallest) per column."""
    known = category_frequencies(df, columns, by).where(F.col("value").isNotNull())
    return known.groupBy(*by, "feature").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, worst first."""
    return (
        missing_rates(df)
        .where("missing > 0")
        .orderBy(F.desc("missing_pct"), "column")
    )


def value_counts(
    df: DataFrame, column: str, normalize: bool = False, keep_null: bool = False
) -> DataFrame:
    """Frequency of each value; optionally as a share, optionally counting NULL."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    counts = rows.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if not normalize:
        return counts
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        "value", "n", (F.col("n") / F.col("_total")).alias("share")
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whisker ends (furthest values within 1.5 IQR) and outlier counts."""
    keys = [*by, "feature"]
    quartiles = quantile_table(df, columns, by=by)
    iqr = F.col("q3") - F.col("q1")
    fences = quartiles.select(
        *keys, "q1", "median", "q3",
        (F.col("q1") - iqr * 1.5).alias("_low"), (F.col("q3") + iqr * 1.5).alias("_high"),
    )
    cells = _numeric_cells(df, columns, by).where(F.col("value").isNotNull())
    inside = (F.col("value") >= F.col("_low")) & (F.col("value") <= F.col("_high"))
    attach = join_keyed if by else join_small
    return attach(cells, fences, keys).groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, via a two-level count over cells."""
    return describe_categorical(df, columns).select("feature", F.col("unique").alias("n_distinct"))


def percent_where(df: DataFrame, conditions: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Percentage of rows satisfying each condition (NULL counts as no)."""
    return df.groupBy(*by).agg(
        *[
            (F.avg(F.coalesce(c, F.lit(False)).cast("double")) * 100).alias(name)
            for name, c in conditions.items()
        ]
    )


def correlations(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every pair of columns, all in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = df.groupBy(*by).agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
          for i, (a, b) in enumerate(pairs)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(*by, F.inline(rows))


def quality_profile(sided: DataFrame) -> DataFrame:
    """Per side and feature: missing, distinct, constant flag, top value, range."""
    kinds = feature_kinds(sided)
    numeric, categorical = split_kinds(kinds)
    features = numeric + categorical
    # NaN counts as missing
    cells = sided.select(
        IS_REF, *[F.when(~is_missing(sided, c), F.col(f"`{c}`")).alias(c) for c in features]
    )
    freq = (
        category_frequencies(cells, features, [IS_REF])
        .groupBy(IS_REF, "feature")
        .agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
            .alias("missing"),
            F.count("value").alias("n_distinct"),
            F.min(
                F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("neg"), "value"))
            ).alias("_top"),
            F.min(F.col("value").try_cast("double")).alias("_lo"),
            F.max(F.col("value").try_cast("double")).alias("_hi"),
        )
    )
    out = freq.select(
        F.when(F.col(IS_REF), "reference").otherwise("current").alias("side"),
        "feature",
        F.when(F.col("feature").isin(*numeric), NUMERIC).otherwise(CATEGORICAL).alias("kind")
        if numeric
        else F.lit(CATEGORICAL).alias("kind"),
        "rows",
        "missing",
        ratio(F.col("missing") * 100.0, F.col("rows"), 0.0).alias("missing_pct"),
        "n_distinct",
        (F.col("n_distinct") <= 1).alias("is_constant"),
        F.col("_top.value").alias("top_value"),
        ratio(F.col("_top.neg") * -100.0, F.col("rows")).alias("top_pct"),
        F.col("_lo").alias("min"),
        F.col("_hi").alias("max"),
    )
    text = F.col("kind") == CATEGORICAL
    return out.withColumns(
        {"min": F.when(~text, F.col("min")), "max": F.when(~text, F.col("max"))}
    )
