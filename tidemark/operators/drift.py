"""Per-feature drift statistics between a reference and a current population.

Each statistic is its own DataFrame operator keyed by ``(by..., feature)``.
:func:`feature_table` combines them: one collapse of the numeric cells to
distinct values feeds the rank statistics and both histograms, one aggregation
of category counts feeds the categorical tests, one wide aggregation gives the
moments.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import (
    chi2_tail, kolmogorov_tail, normal_two_sided,
)
from ..session import join_small
from .histogram import bin_sql
from .prefix import ROWS_PER_LANE, collapse, running_totals
from .sides import CATEGORICAL, IS_REF, NUMERIC, WEIGHTS, feature_kinds, long_form, split_kinds

PSI_BINS = 10
PSI_FLOOR = 1e-6
PSI_LIMIT = 0.1
JS_BINS = 19
JS_FLOOR = 1e-10
P_LIMIT = 0.05
STD_FLOOR = 0.001


def _quoted(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name_of(features: Sequence[str]) -> str:
    """SQL that turns the position of a feature back into its name."""
    return f"get(array({', '.join(_quoted(f) for f in features)}), feature) AS feature"


# --------------------------------------------------------------------- moments
def side_moments(
    sided: DataFrame, features: Sequence[str], by: Sequence[str] = (), coded: bool = False
) -> DataFrame:
    """``(by..., is_ref, feature, n, mean, std_samp, std_pop, lo, hi)``.

    One aggregation with all features side by side: cells are not melted, and
    each task ships a single row per group.
    """
    keys = [*by, IS_REF]
    clean = sided.select(
        *keys, *[F.expr(f"nanvl(CAST(`{f}` AS DOUBLE), NULL) AS x{i}") for i, f in enumerate(features)]
    )
    wide = clean.groupBy(*keys).agg(
        *[
            F.expr(sql).alias(f"{name}{i}")
            for i in range(len(features))
            for name, sql in [
                ("n", f"count(x{i})"), ("mean", f"avg(x{i})"), ("sp", f"stddev_pop(x{i})"),
                ("lo", f"min(x{i})"), ("hi", f"max(x{i})"),
            ]
        ]
    )
    # the sample deviation is undefined for a single value
    rows = ", ".join(
        f"named_struct('feature', {i if coded else _quoted(f)}, 'n', n{i}, 'mean', mean{i}, "
        f"'std_samp', IF(n{i} > 1, sp{i} * sqrt(n{i} / (n{i} - 1D)), NULL), 'std_pop', sp{i}, "
        f"'lo', lo{i}, 'hi', hi{i})"
        for i, f in enumerate(features)
    )
    return wide.select(*keys, F.expr(f"inline(array({rows}))"))


_MOMENTS = ["n", "mean", "std_samp", "std_pop", "lo", "hi"]
PAIR_COLUMNS = [f"{side}_{m}" for side in ("ref", "cur") for m in _MOMENTS]


def paired_moments(
    sided: DataFrame, features: Sequence[str], by: Sequence[str] = (), coded: bool = False
) -> DataFrame:
    """Reference and current moments on one row; features empty on a side drop out."""
    both = side_moments(sided, features, by, coded)
    if not by:
        pairs = both.groupBy("feature").agg(
            *[
                F.expr(f"max({m}) FILTER (WHERE {side}) AS {name}_{m}")
                for name, side in (("ref", IS_REF), ("cur", f"NOT {IS_REF}"))
                for m in _MOMENTS
            ]
        )
    else:
        # every group of current rows meets the one reference
        reference = side_moments(sided.where(IS_REF), features, coded=coded)
        ref = reference.selectExpr("feature", *[f"{m} AS ref_{m}" for m in _MOMENTS])
        cur = both.where(f"NOT {IS_REF}").selectExpr(
            *by, "feature", *[f"{m} AS cur_{m}" for m in _MOMENTS]
        )
        pairs = cur.join(F.broadcast(ref), "feature")
    return pairs.where("ref_n > 0 AND cur_n > 0").select(*by, "feature", *PAIR_COLUMNS)


MEAN_SHIFT = "IF(ref_std_samp > 0, abs(cur_mean - ref_mean) / ref_std_samp, 0D)"
STD_RATIO = "IF(ref_std_samp > 0, cur_std_samp / ref_std_samp, 1D)"


def moment_shift(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Absolute mean shift in reference standard deviations (0 for a constant)."""
    return pairs.selectExpr(
        *by, "feature", f"{MEAN_SHIFT} AS mean_shift", f"{STD_RATIO} AS std_ratio"
    )


# ------------------------------------------------------------- rank statistics
def distinct_values(weighted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return collapse(weighted, [*by, "feature"], "value", WEIGHTS)


def _rank_sums(n_ref: str, n_cur: str, origin: str) -> list[Column]:
    """Per-group aggregates of the running totals: largest gap, area, row count.

    The area between the two distribution functions, sum of ``gap_i * (v_{i+1} -
    v_i)``, is summed by parts as ``v_i * (gap_{i-1} - gap_i)``: the gap before a
    value follows from its own weights, so no neighbouring row is needed.
    ``origin`` is any constant near the values; it keeps the products small.
    """
    gap = f"abs(cum_n_ref / {n_ref} - cum_n_cur / {n_cur})"
    before = f"abs((cum_n_ref - n_ref) / {n_ref} - (cum_n_cur - n_cur) / {n_cur})"
    return [
        F.expr(f"max({gap}) AS ks"),
        F.expr(f"sum((value - {origin}) * ({before} - {gap})) AS area"),
        F.expr("count(1) AS n_values"),
    ]


def rank_statistics(
    distinct: DataFrame, by: Sequence[str] = (), corrected: bool = True, **lanes
) -> DataFrame:
    """Kolmogorov-Smirnov distance with its p-value, and Wasserstein-1 distance."""
    keys = [*by, "feature"]
    run = running_totals(distinct, keys, "value", WEIGHTS, **lanes)
    stats = run.where("total_n_ref > 0 AND total_n_cur > 0").groupBy(*keys).agg(
        *_rank_sums("total_n_ref", "total_n_cur", "0"),
        F.expr("max(total_n_ref) AS n_ref"),
        F.expr("max(total_n_cur) AS n_cur"),
    )
    return stats.select(
        *keys,
        F.col("ks").alias("ks_statistic"),
        kolmogorov_tail("ks", "n_ref", "n_cur", corrected).alias("ks_pvalue"),
        F.col("area").alias("wasserstein"),
        "n_ref",
        "n_cur",
        F.col("n_values").alias("n_distinct"),
    )


# ------------------------------------------------------------------ histograms
def with_edges(pairs: DataFrame, psi_bins: int = PSI_BINS, js_bins: int = JS_BINS) -> DataFrame:
    """Add the histogram ranges: reference range for PSI, joint range for JS.

    A constant reference range is widened to one unit; a constant joint range
    stays NULL.
    """
    lo = "IF(ref_lo = ref_hi, ref_lo - 0.5D, ref_lo)"
    hi = "IF(ref_lo = ref_hi, ref_hi + 0.5D, ref_hi)"
    joint_lo, joint_hi = "least(ref_lo, cur_lo)", "greatest(ref_hi, cur_hi)"
    usable = f"{joint_lo} < {joint_hi}"
    return pairs.selectExpr(
        "*",
        f"{lo} AS psi_lo", f"{hi} AS psi_hi", f"({hi} - {lo}) / {psi_bins}D AS psi_width",
        f"IF({usable}, {joint_lo}, NULL) AS js_lo", f"IF({usable}, {joint_hi}, NULL) AS js_hi",
        f"IF({usable}, ({joint_hi} - {joint_lo}) / {js_bins}D, NULL) AS js_width",
    )


_EDGES = ["psi_lo", "psi_hi", "psi_width", "js_lo", "js_hi", "js_width"]


def _bin(prefix: str, bins: int) -> Column:
    """Bin of ``value`` on a range of :func:`with_edges`; -1 outside."""
    lo, hi, width = (f"{prefix}_{e}" for e in ("lo", "hi", "width"))
    return F.expr(f"coalesce({bin_sql('value', lo, hi, width, bins)}, -1) AS {prefix}_bin")


def _attach(rows: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach a table with one row per ``(by..., feature)``.

    Without groups its size is the number of features.  With groups it grows
    with their number, and adaptive execution chooses the join.
    """
    keys = [*by, "feature"]
    return rows.join(small, keys) if by else join_small(rows, small, keys)


def _over_bins(cells: str, bin_field: str, bins: int, term: str) -> Column:
    """Sum ``term`` over the bins of an array of partial cells.

    ``term`` sees ``c.ref`` and ``c.cur`` (the sums of one bin) and ``y.ref``,
    ``y.cur`` (the in-range totals).  NULL when a side has nothing in range.
    """
    binned = (
        f"transform(sequence(0, {bins - 1}), i -> aggregate("
        f"filter({cells}, c -> c.{bin_field} = i), named_struct('ref', 0D, 'cur', 0D), "
        f"(t, c) -> named_struct('ref', t.ref + c.n_ref, 'cur', t.cur + c.n_cur)))"
    )
    totals = (
        "named_struct('bins', x, 'ref', aggregate(x, 0D, (t, c) -> t + c.ref), "
        "'cur', aggregate(x, 0D, (t, c) -> t + c.cur))"
    )
    return F.expr(
        f"transform(transform(array({binned}), x -> {totals}), y -> IF(y.ref > 0 AND y.cur > 0, "
        f"aggregate(y.bins, 0D, (t, c) -> t + {term}), NULL))[0]"
    )


def psi_of_cells(cells: str, bins: int = PSI_BINS, floor: float = PSI_FLOOR) -> Column:
    """Population stability index from at most a few dozen partial bin sums.

    Shares are taken over the in-range counts of each side and floored before
    the logarithm.
    """
    p, q = f"greatest(c.ref / y.ref, {floor!r}D)", f"greatest(c.cur / y.cur, {floor!r}D)"
    return _over_bins(cells, "psi_bin", bins, f"({q} - {p}) * ln({q} / {p})")


def js_of_cells(cells: str, bins: int = JS_BINS, floor: float = JS_FLOOR) -> Column:
    """Jensen-Shannon divergence in nats; ``floor`` is added to every share first."""
    scale = 1.0 + floor * bins
    p = f"((c.ref / y.ref + {floor!r}D) / {scale!r}D)"
    q = f"((c.cur / y.cur + {floor!r}D) / {scale!r}D)"
    mid = f"(({p} + {q}) / 2)"
    return _over_bins(
        cells, "js_bin", bins, f"({p} * ln({p} / {mid}) + {q} * ln({q} / {mid})) / 2"
    )


def _binned(
    weighted: DataFrame, pairs: DataFrame, by: Sequence[str], prefix: str, bins: int
) -> DataFrame:
    """One row per feature with its (at most ``bins + 1``) partial bin sums."""
    keys = [*by, "feature"]
    name = f"{prefix}_bin"
    edges = with_edges(pairs, bins, bins).select(*keys, *_EDGES)
    cells = (
        _attach(weighted, edges, by)
        .select(*keys, *WEIGHTS, _bin(prefix, bins))
        .groupBy(*keys, name)
        .agg(*[F.sum(w).alias(w) for w in WEIGHTS])
    )
    return cells.groupBy(*keys).agg(F.collect_list(F.struct(name, *WEIGHTS)).alias("_cells"))


def psi(
    weighted: DataFrame, pairs: DataFrame, by: Sequence[str] = (), bins: int = PSI_BINS,
    floor: float = PSI_FLOOR,
) -> DataFrame:
    """PSI on equal bins of the reference range; rows are binned before any shuffle."""
    outside = F.aggregate(
        F.filter("_cells", lambda c: c["psi_bin"] < 0),
        F.lit(0).cast("bigint"),
        lambda acc, c: acc + c["n_cur"],
    )
    return _binned(weighted, pairs, by, "psi", bins).select(
        *by, "feature", psi_of_cells("_cells", bins, floor).alias("psi"),
        outside.alias("out_of_range"),
    )


def js_numeric(
    weighted: DataFrame, pairs: DataFrame, by: Sequence[str] = (), bins: int = JS_BINS
) -> DataFrame:
    """Jensen-Shannon divergence on equal bins of the joint range.

    NULL for a feature that is constant over both sides: it has no usable bins.
    """
    return _binned(weighted, pairs, by, "js", bins).select(
        *by, "feature", js_of_cells("_cells", bins).alias("js_divergence")
    )


# ---------------------------------------------------------------- categoricals
def category_counts(weighted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of each category on both sides, missing ones as 0.

    The two sides are aligned by one aggregation instead of an outer join.
    """
    return weighted.groupBy(*by, "feature", "value").agg(*[F.sum(w).alias(w) for w in WEIGHTS])


def _kl(p: str, m: str) -> str:
    return f"IF({p} > 0, {p} * ln({p} / {m}), 0D)"


def category_statistics(
    counts: DataFrame, by: Sequence[str] = (), expected: str = "scaled"
) -> DataFrame:
    """Chi-squared fit, Jensen-Shannon distance and two-proportion z-test.

    All three come out of one aggregation over the aligned counts.

    * chi-squared: current counts against the reference.  ``expected='scaled'``
      brings the reference counts to the current total; ``'raw'`` takes them as
      they are and gives NULL when the totals differ.  A category absent from
      the reference makes the statistic infinite.
    * Jensen-Shannon: natural logarithm, no floor; the distance is its root.
    * z-test: features with exactly two categories; the proportion compared is
      that of the smallest category in text order.
    """
    if expected not in ("scaled", "raw"):
        raise ValueError(f"expected must be 'scaled' or 'raw', not {expected!r}")
    keys = [*by, "feature"]
    totals = counts.groupBy(*keys).agg(F.sum("n_ref").alias("_ref"), F.sum("n_cur").alias("_cur"))
    joined = _attach(counts, totals, by).where("_ref > 0 AND _cur > 0")
    e = "CAST(n_ref AS DOUBLE)"
    if expected == "scaled":
        e = f"({e} * _cur / _ref)"
    p, q = "(n_ref / _ref)", "(n_cur / _cur)"
    mid = f"(({p} + {q}) / 2)"
    stats = joined.groupBy(*keys).agg(
        F.expr(f"sum(IF({e} > 0, (n_cur - {e}) * (n_cur - {e}) / {e}, NULL)) AS chi2"),
        F.expr("count_if(n_ref = 0) AS new_categories"),
        F.expr("count_if(n_cur = 0) AS vanished_categories"),
        F.expr("count(1) AS n_distinct"),
        F.expr("count(1) - 1 AS chi2_dof"),
        F.expr("max(_ref) AS total_ref"),
        F.expr("max(_cur) AS total_cur"),
        F.expr(f"sum(({_kl(p, mid)} + {_kl(q, mid)}) / 2) AS js_divergence"),
        F.expr("min_by(n_ref, value) AS x_ref"),
        F.expr("min_by(n_cur, value) AS x_cur"),
    )
    stat = "IF(new_categories > 0, double('infinity'), chi2)"
    if expected == "raw":
        stat = f"IF(total_ref = total_cur, {stat}, NULL)"
    pooled = "((x_ref + x_cur) / (total_ref + total_cur))"
    spread = f"sqrt({pooled} * (1 - {pooled}) * (1 / total_ref + 1 / total_cur))"
    z = f"IF(n_distinct = 2, try_divide(x_ref / total_ref - x_cur / total_cur, {spread}), NULL)"
    return stats.selectExpr("*", f"{stat} AS chi2_statistic", f"{z} AS z_statistic").select(
        *keys,
        F.expr("total_ref AS n_ref"),
        F.expr("total_cur AS n_cur"),
        "n_distinct", "new_categories", "vanished_categories", "chi2_statistic", "chi2_dof",
        # a feature with a single category on both sides cannot deviate
        F.expr("chi2_dof = 0 AND chi2_statistic IS NOT NULL AS _single"),
        chi2_tail("chi2_statistic", "chi2_dof").alias("_tail"),
        "js_divergence",
        F.expr("sqrt(greatest(js_divergence, 0D)) AS js_distance"),
        "z_statistic",
        normal_two_sided("z_statistic").alias("z_pvalue"),
    ).selectExpr(
        *keys, "n_ref", "n_cur", "n_distinct", "new_categories", "vanished_categories",
        "chi2_statistic", "chi2_dof", "IF(_single, 1D, _tail) AS chi2_pvalue", "js_divergence",
        "js_distance", "z_statistic", "z_pvalue",
    )


# --------------------------------------------------------------- feature table
NUMERIC_METRICS = ("ks", "wasserstein", "psi", "moments", "js")


def numeric_table(
    sided: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (),
    metrics: Sequence[str] = NUMERIC_METRICS,
    corrected: bool = True,
    rows_per_lane: int = ROWS_PER_LANE,
) -> DataFrame:
    """All numeric metrics per feature in one chain.

    Moments come from a wide aggregation and are attached to the cells once.
    Rank metrics need the distinct values in order; histogram metrics only need
    the cells, so without rank metrics nothing is sorted or shuffled by value.
    The last two aggregations first reduce to one row per pair of bins, then to
    one row per feature.
    """
    unknown = set(metrics) - set(NUMERIC_METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    keys = [*by, "feature"]
    ranked = "ks" in metrics or "wasserstein" in metrics
    pairs = paired_moments(sided, features, by, coded=True)
    cells = long_form(sided, features, NUMERIC, by, coded=True)
    if ranked:
        cells = distinct_values(cells, by)
    # bins are a function of (feature, value): found before the ordered window,
    # where the distinct values are still spread over all tasks
    edges = with_edges(pairs).select(*keys, "ref_n", "cur_n", "ref_lo", *_EDGES)
    placed = _attach(cells, edges, by).select(
        *keys, "value", *WEIGHTS, "ref_n", "cur_n", "ref_lo",
        _bin("psi", PSI_BINS) if "psi" in metrics else F.expr("0 AS psi_bin"),
        _bin("js", JS_BINS) if "js" in metrics else F.expr("0 AS js_bin"),
    )
    if ranked:
        placed = running_totals(
            placed, keys, "value", WEIGHTS, totals=False, rows_per_lane=rows_per_lane
        )
        sums = _rank_sums("ref_n", "cur_n", "ref_lo")
    else:
        sums = [F.expr("CAST(NULL AS DOUBLE) AS ks"), F.expr("CAST(NULL AS DOUBLE) AS area"),
                F.expr("CAST(NULL AS BIGINT) AS n_values")]
    by_bin = placed.groupBy(*keys, "psi_bin", "js_bin").agg(
        *sums, *[F.expr(f"sum({w}) AS {w}") for w in WEIGHTS]
    )
    table = by_bin.groupBy(*keys).agg(
        F.expr("max(ks) AS ks"),
        F.expr("sum(area) AS area"),
        F.expr("sum(n_values) AS n_distinct"),
        F.expr("collect_list(struct(psi_bin, js_bin, n_ref, n_cur)) AS _cells"),
    )
    table = _attach(table, pairs, by)

    p_value = kolmogorov_tail("ks", "ref_n", "cur_n", corrected)

    def shown(metric: str, column: Column | str, name: str) -> Column:
        if metric not in metrics:
            return F.expr(f"CAST(NULL AS DOUBLE) AS {name}")
        return (F.expr(column) if isinstance(column, str) else column).alias(name)

    return table.select(
        *by,
        F.expr(_name_of(features)),
        F.expr("ref_n AS n_ref"),
        F.expr("cur_n AS n_cur"),
        "n_distinct",
        shown("ks", "ks", "ks_statistic"),
        shown("ks", p_value, "ks_pvalue"),
        shown("wasserstein", "area", "wasserstein"),
        shown("wasserstein", f"area / greatest(ref_std_pop, {STD_FLOOR}D)", "wasserstein_normed"),
        shown("psi", psi_of_cells("_cells"), "psi"),
        shown("moments", MEAN_SHIFT, "mean_shift"),
        shown("moments", STD_RATIO, "std_ratio"),
        shown("js", js_of_cells("_cells"), "js_divergence"),
    )


_NUMERIC_OUT = [
    "ks_statistic", "ks_pvalue", "wasserstein", "wasserstein_normed", "psi", "mean_shift",
    "std_ratio", "js_divergence",
]
_CATEGORICAL_OUT = [
    "chi2_statistic", "chi2_pvalue", "js_distance", "z_statistic", "z_pvalue",
]


def feature_table(
    sided: DataFrame,
    features: Mapping[str, str] | None = None,
    by: Sequence[str] = (),
    metrics: Sequence[str] = NUMERIC_METRICS,
    expected: str = "scaled",
    corrected: bool = True,
    rows_per_lane: int = ROWS_PER_LANE,
) -> DataFrame:
    """One row per feature with every drift metric and the per-test flags.

    Fewer ``metrics`` give the light variant, ``features`` names the columns.  A
    metric that was not asked for, or does not apply to the kind, is NULL.  KS
    p-values are asymptotic at every size.
    """
    kinds = dict(features) if features is not None else feature_kinds(sided, exclude=list(by))
    numeric, categorical = split_kinds(kinds)
    if not numeric and not categorical:
        raise ValueError("no usable feature")
    keys = [*by, "feature"]
    parts = []
    if numeric:
        parts.append(
            numeric_table(
                sided, numeric, by, metrics, corrected, rows_per_lane
            ).selectExpr(
                *keys, f"'{NUMERIC}' AS kind", "n_ref", "n_cur", "n_distinct", *_NUMERIC_OUT,
                *[f"CAST(NULL AS DOUBLE) AS {c}" for c in _CATEGORICAL_OUT],
            )
        )
    if categorical:
        cells = long_form(sided, categorical, CATEGORICAL, by, coded=True)
        parts.append(
            category_statistics(category_counts(cells, by), by, expected).selectExpr(
                *by, _name_of(categorical), f"'{CATEGORICAL}' AS kind", "n_ref", "n_cur", "n_distinct",
                *[f"CAST(NULL AS DOUBLE) AS {c}" for c in _NUMERIC_OUT], *_CATEGORICAL_OUT,
            )
        )
    table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return table.selectExpr(
        "*",
        f"ks_pvalue < {P_LIMIT}D AS ks_drift",
        f"psi > {PSI_LIMIT}D AS psi_drift",
        f"chi2_pvalue < {P_LIMIT}D AS chi2_drift",
    )


def melt_metrics(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Wide metric table to ``(by..., feature, kind, metric, value)``."""
    metrics = [*_NUMERIC_OUT, *_CATEGORICAL_OUT]
    flags = ["ks_drift", "psi_drift", "chi2_drift"]
    ready = table.select(
        *by, "feature", "kind", *metrics, *[F.col(f).cast("double").alias(f) for f in flags]
    )
    return ready.unpivot(
        [*by, "feature", "kind"], [*metrics, *flags], "metric", "value"
    ).where(F.col("value").isNotNull())


def metric_maps(long_metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Long metrics to one ``map<metric, value>`` per feature."""
    entry = F.struct("metric", "value")
    return long_metrics.groupBy(*by, "feature", "kind").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("metrics")
    )
