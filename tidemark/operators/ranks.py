"""Exact positional selection: the k-th row of an order, per stratum.

Sorting a whole table to take its first 20 % sends every row through a shuffle
and ranks them in one task.  Selection does not need that.  For an order
``(c1, c2, ...)`` the cut position is located column by column: counts per
``c1`` value give the value holding the k-th row, then only the rows tied on it
are counted by ``c2``, and so on.  The result is one small *cut tuple* per
stratum and cut; assigning rows to a side is then a row-wise comparison with no
shuffle of the table at all.  Ties on a hot leading value only narrow the next
pass, they never gather in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import row_key
from ..session import cut_lineage, join_keyed, join_small
from .prefix import running_totals

CutSpec = Mapping[str, Callable[[Column], Column]]


def cut_tuples(
    df: DataFrame,
    order_by: Sequence[str],
    cuts: CutSpec | DataFrame,
    strata: Sequence[str] = (),
    bounded: Sequence[str] = (),
) -> DataFrame:
    """Locate the k-th row for each named cut.

    ``cuts`` maps a name to ``k`` as a function of the stratum's row count, or
    is a table ``(strata..., cut, k)``.  Cuts with ``k < 1`` produce no row and
    ``k`` beyond the stratum selects all of it.  ``bounded`` names order columns
    with a fixed small domain.  The whole order must be unique; a cut that would
    fall inside a group of equal rows is an error.

    Returns ``(strata..., cut, <order_by columns at the cut>)``.
    """
    attach = join_keyed if strata else join_small
    found: list[str] = []
    level = None
    for depth, key in enumerate(order_by):
        if depth == 0:
            group = list(strata)
            counted = df.groupBy(*group, key).agg(F.count(F.lit(1)).alias("_n"))
        else:
            group = [*strata, "cut", "_k", *[f"_at_{c}" for c in found]]
            # every pair shares the stratum and all columns fixed so far
            renamed = level.select(
                *[F.col(c).alias(f"_s_{c}") for c in strata], "cut", "_k",
                *[f"_at_{c}" for c in found],
            )
            same = F.lit(True)
            for c in strata:
                same = same & df[c].eqNullSafe(F.col(f"_s_{c}"))
            for c in found:
                same = same & (df[c] == F.col(f"_at_{c}"))
            # without strata there is one row per cut
            counted = (
                df.join(renamed if strata else F.broadcast(renamed), same)
                .groupBy(*group, key)
                .agg(F.count(F.lit(1)).alias("_n"))
            )
        run = running_totals(counted, group, key, ["_n"], lanes=key not in bounded)
        first = F.col("cum__n") - F.col("_n")
        if depth == 0 and not isinstance(cuts, DataFrame):
            options = F.array(
                *[
                    F.struct(
                        F.lit(name).alias("cut"),
                        F.least(k(F.col("total__n")).cast("bigint"), F.col("total__n")).alias("k"),
                    )
                    for name, k in cuts.items()
                ]
            )
            inside = F.filter(options, lambda o: (o["k"] > first) & (o["k"] <= F.col("cum__n")))
            level = run.withColumn("_cut", F.explode(inside)).select(
                *strata, F.col("_cut.cut").alias("cut"),
                (F.col("_cut.k") - first).alias("_k"), F.col(key).alias(f"_at_{key}"), "_n",
            )
        else:
            if depth == 0:
                wanted = cuts.withColumnRenamed("k", "_k")
                run = attach(run, wanted, strata, null_safe=True).withColumn(
                    "_k", F.least("_k", "total__n")
                )
            level = run.where((F.col("_k") > first) & (F.col("_k") <= F.col("cum__n"))).select(
                *strata, "cut", (F.col("_k") - first).alias("_k"),
                *[f"_at_{c}" for c in found], F.col(key).alias(f"_at_{key}"), "_n",
            )
        # one row per cut: written, the next column's plan does not nest this one
        level = cut_lineage(level)
        found.append(key)
    settled = F.when(
        F.col("_k") < F.col("_n"),
        F.raise_error(F.lit(f"order by {', '.join(order_by)} is not unique at the cut")),
    ).otherwise(F.lit(True))
    return (
        level.where(settled)
        .select(*strata, "cut", *[F.col(f"_at_{c}").alias(c) for c in order_by])
    )


def side_of_cuts(
    df: DataFrame,
    order_by: Sequence[str],
    cuts: DataFrame,
    names: Sequence[str],
    rest: str | None,
    column: str,
    strata: Sequence[str] = (),
) -> DataFrame:
    """Label each row with the first cut whose position covers it, else ``rest``."""
    at_cut = F.struct(*order_by)
    wide = cuts.groupBy(*strata).agg(
        *[F.max(F.when(F.col("cut") == n, at_cut)).alias(f"_cut_{n}") for n in names]
    )
    attach = join_keyed if strata else join_small
    placed = attach(df, wide, strata, "left", null_safe=True)
    label = F.lit(rest).cast("string")
    for n in reversed(list(names)):
        covered = F.col(f"_cut_{n}").isNotNull() & (F.struct(*order_by) <= F.col(f"_cut_{n}"))
        label = F.when(covered, F.lit(n)).otherwise(label)
    return placed.withColumn(column, label).drop(*[f"_cut_{n}" for n in names])


HASH_PARTS = ["_h1", "_h2", "_h3"]


def with_hash_order(
    df: DataFrame, seed: int | str, key: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Add the MD5 order of ``key`` and name the columns that hold it.

    There are three columns, two of 4096 values each and the tail: the first two
    passes of a selection count at most 4096 values each and the third sees one
    row in sixteen million.
    """
    digest = row_key(seed, *key)
    parts = df.withColumn("_h", digest).withColumns(
        {
            "_h1": F.substring("_h", 1, 3),
            "_h2": F.substring("_h", 4, 3),
            "_h3": F.substring("_h", 7, 26),
        }
    )
    return parts.drop("_h"), HASH_PARTS


def hash_split(
    df: DataFrame,
    key: Sequence[str],
    seed: int | str,
    cuts: CutSpec | DataFrame,
    names: Sequence[str],
    rest: str | None,
    column: str = "split",
    strata: Sequence[str] = (),
) -> DataFrame:
    """Split rows at exact counts along the pseudo-random MD5 order of ``key``."""
    hashed, order = with_hash_order(df, seed, key)
    found = cut_tuples(hashed, order, cuts, strata, bounded=order)
    return side_of_cuts(hashed, order, found, names, rest, column, strata).drop(*order)


def first_rows(
    df: DataFrame, order_by: Sequence[str], n: int | Callable[[Column], Column],
    strata: Sequence[str] = (),
) -> DataFrame:
    """The first ``n`` rows per stratum in a unique order."""
    k = n if callable(n) else (lambda total: F.lit(n))
    found = cut_tuples(df, order_by, {"in": k}, strata)
    marked = side_of_cuts(df, order_by, found, ["in"], None, "_side", strata)
    return marked.where("_side = 'in'").drop("_side")
