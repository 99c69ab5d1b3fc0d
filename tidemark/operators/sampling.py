"""Splits and samples with exact counts and reproducible membership.

Rows are ordered by an explicit unique order or by an MD5 key; positions are
located with :mod:`ranks`, so no operator here sorts the table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import join_small
from .ranks import cut_tuples, first_rows, hash_split, side_of_cuts, with_hash_order


def chronological_split(
    df: DataFrame,
    order_by: Sequence[str],
    initial_fraction: float = 0.2,
    test_size: float = 0.15,
    validation_size: float = 0.15,
) -> DataFrame:
    """Label rows ``initial_train``, ``initial_validation``, ``initial_test``, ``future``.

    The first ``initial_fraction`` of the order is the initial part; inside it
    test takes the last ``ceil`` share and validation the last share before it.
    At least one row is left for the future unless the fraction is 1.
    """
    if not 0 < initial_fraction <= 1:
        raise ValueError("initial_fraction must be in (0, 1]")
    if not 0 < test_size < 1 or not 0 < validation_size < 1:
        raise ValueError("test_size and validation_size must be in (0, 1)")
    if test_size + validation_size >= 1:
        raise ValueError("test_size + validation_size must be below 1")

    def initial(total: Column) -> Column:
        n = F.floor(total * F.lit(initial_fraction))
        return n if initial_fraction == 1 else F.least(n, F.greatest(total - 1, F.lit(0)))

    def train_validation(total: Column) -> Column:
        n = initial(total)
        return n - F.ceil(n * F.lit(test_size))

    def train(total: Column) -> Column:
        n = train_validation(total)
        return n - F.ceil(n * F.lit(validation_size / (1.0 - test_size)))

    names = ["initial_train", "initial_validation", "initial_test"]
    cuts = cut_tuples(df, order_by, dict(zip(names, [train, train_validation, initial])))
    return side_of_cuts(df, order_by, cuts, names, "future", "split")


def row_window(df: DataFrame, order_by: Sequence[str], start: int, count: int) -> DataFrame:
    """Rows at positions ``start .. start + count - 1`` (0-based) of the order."""
    names = ["before", "inside"]
    cuts = cut_tuples(
        df, order_by, {"before": lambda n: F.lit(start), "inside": lambda n: F.lit(start + count)}
    )
    marked = side_of_cuts(df, order_by, cuts, names, "after", "_side")
    return marked.where("_side = 'inside'").drop("_side")


def stratified_quotas(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """Training quota per class: proportional shares, largest remainders first.

    The test part has ``ceil(n * test_size)`` rows in total.
    """
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    total = per_class.agg(F.sum("_c").alias("_total"))
    draw = F.col("_total") - F.ceil(F.col("_total") * F.lit(test_size))
    share = F.col("_c") / F.col("_total") * draw
    shares = join_small(per_class, total, []).select(
        label, F.floor(share).alias("_floor"), (F.floor(share) - share).alias("_behind"),
        draw.alias("_draw"),
    )
    # A remainder is a function of the class size, so there are about as many as
    # different sizes: the root of twice the row count at most.
    everything = Window.partitionBy(F.lit(0))
    earlier = everything.orderBy("_behind").rowsBetween(Window.unboundedPreceding, -1)
    more = (
        shares.groupBy("_behind")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_floor").alias("_floors"), F.max("_draw").alias("_draw"))
        .select(
            F.col("_behind").alias("_rest"),
            (F.col("_draw") - F.sum("_floors").over(everything)
             - F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_more"),
        )
    )
    same = Window.partitionBy("_behind").orderBy(label)
    return shares.join(more, F.col("_behind") == F.col("_rest")).select(
        label,
        F.lit("train").alias("cut"),
        (F.col("_floor") + (F.row_number().over(same) <= F.col("_more")).cast("bigint")).alias("k"),
    )


def stratified_split(
    df: DataFrame, key: Sequence[str], label: str | None, test_size: float = 0.5, seed: int = 42
) -> DataFrame:
    """Add ``split`` (train/test) with exact per-class counts.

    Without a label the whole table is one stratum.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must be in (0, 1)")
    if label is None or label not in df.columns:
        return hash_split(
            df, key, seed, {"train": lambda n: n - F.ceil(n * F.lit(test_size))}, ["train"], "test"
        )
    quotas = stratified_quotas(df, label, test_size)
    return hash_split(df, key, seed, quotas, ["train"], "test", strata=[label])


def split_batch(
    batch: DataFrame, key: Sequence[str], label: str = "readmitted_binary",
    test_size: float = 0.5, seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Training and held-out parts of a batch; a batch below two rows is an error."""
    if len(batch.take(2)) < 2:
        raise ValueError("a batch needs at least 2 rows to be split")
    marked = stratified_split(batch, key, label, test_size, seed)
    return (
        marked.where("split = 'train'").drop("split"),
        marked.where("split = 'test'").drop("split"),
    )


def sample_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, without replacement, cut by position along the hash order."""
    return (
        hash_split(df, key, seed, {"in": lambda total: F.lit(n)}, ["in"], None, "_side")
        .where("_side = 'in'")
        .drop("_side")
    )


def sample_per_stratum(
    df: DataFrame, key: Sequence[str], strata: Sequence[str], n: int, seed: int = 42
) -> DataFrame:
    """``min(n, size)`` rows of each stratum."""
    marked = hash_split(
        df, key, seed, {"in": lambda total: F.lit(n)}, ["in"], None, "_side", strata
    )
    return marked.where("_side = 'in'").drop("_side")


def oversample(
    df: DataFrame, key: Sequence[str], high: Column, size: int, high_share: float, seed: int = 42
) -> DataFrame:
    """``size`` rows of which ``high_share`` satisfy ``high`` (fewer if too rare).

    The other side fills the rest; when it is too small its rows are repeated,
    every copy drawing its own hash key.  Adds ``stratum`` (high/low) and ``copy``.
    """
    flagged = df.withColumn(
        "stratum", F.when(F.coalesce(high, F.lit(False)), "high").otherwise("low")
    )
    counts = flagged.agg(
        F.count_if(F.col("stratum") == "high").alias("_high"),
        F.count_if(F.col("stratum") == "low").alias("_low"),
    )
    n_high = F.least(F.lit(int(size * high_share)), F.col("_high"))
    n_low = F.lit(size) - n_high
    plan = counts.select(
        F.inline(
            F.array(
                F.struct(F.lit("high").alias("stratum"), n_high.cast("bigint").alias("k"),
                         F.lit(1).cast("bigint").alias("_copies")),
                F.struct(F.lit("low").alias("stratum"), n_low.cast("bigint").alias("k"),
                         F.coalesce(F.ceil(F.try_divide(n_low, F.col("_low"))), F.lit(1))
                         .cast("bigint").alias("_copies")),
            )
        )
    )
    repeated = (
        join_small(flagged, plan.select("stratum", "_copies"), ["stratum"])
        .withColumn(
            "copy",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest("_copies", F.lit(1)) - 1)),
        )
        .drop("_copies")
    )
    quotas = plan.select("stratum", F.lit("in").alias("cut"), "k")
    marked = hash_split(
        repeated, [*key, "copy"], seed, quotas, ["in"], None, "_side", ["stratum"]
    )
    return marked.where("_side = 'in'").drop("_side")


def priority_fill(
    df: DataFrame, key: Sequence[str], preferred: Column, size: int, seed: int = 42
) -> DataFrame:
    """Rows satisfying ``preferred`` first, topped up from the rest."""
    hashed, parts = with_hash_order(df, seed, key)
    ranked = hashed.withColumn(
        "_rank", F.when(F.coalesce(preferred, F.lit(False)), 0).otherwise(1)
    )
    order = ["_rank", *parts]
    cuts = cut_tuples(ranked, order, {"in": lambda n: F.lit(size)}, bounded=order)
    marked = side_of_cuts(ranked, order, cuts, ["in"], None, "_side")
    return marked.where("_side = 'in'").drop("_side", *order)


def swap_rows(
    batch: DataFrame,
    population: DataFrame,
    key: Sequence[str],
    high: Column,
    batch_size: int,
    max_share: float,
    seed: int = 42,
) -> DataFrame:
    """Replace some low rows of ``batch`` by high rows of ``population``.

    At most ``max_share * batch_size`` rows change, and no more than there are
    low rows in the batch or high rows in the population.
    """
    is_high = F.coalesce(high, F.lit(False))
    low_rows = batch.where(~is_high)
    high_rows = population.where(is_high).select(*batch.columns)
    quota = (
        low_rows.agg(F.count(F.lit(1)).alias("_low"))
        .crossJoin(F.broadcast(high_rows.agg(F.count(F.lit(1)).alias("_high"))))
        .select(
            F.lit("swap").alias("cut"),
            F.least(F.lit(math.floor(batch_size * max_share)), "_low", "_high")
            .cast("bigint").alias("k"),
        )
    )
    kept_low = hash_split(low_rows, key, f"{seed}-out", quota, ["swap"], "keep", "_side").where(
        "_side = 'keep'"
    )
    added = hash_split(high_rows, key, f"{seed}-in", quota, ["swap"], None, "_side").where(
        "_side = 'swap'"
    )
    return (
        batch.where(is_high)
        .unionByName(kept_low.drop("_side"))
        .unionByName(added.drop("_side"))
    )


def first_per_entity(df: DataFrame, entity: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each entity in the given order.

    An aggregate with map-side combining: an entity with a large part of all
    rows is reduced on every task before the shuffle.
    """
    rest = [c for c in df.columns if c not in entity]
    picked = df.groupBy(*entity).agg(
        F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_row")
    )
    return picked.select(*entity, "_row.*").select(*df.columns)


__all__ = [
    "chronological_split", "first_per_entity", "first_rows", "oversample",
    "priority_fill", "row_window", "sample_per_stratum", "sample_rows", "split_batch",
    "stratified_quotas", "stratified_split", "swap_rows",
]
