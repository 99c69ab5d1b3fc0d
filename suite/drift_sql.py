"""SQL text for the drift statistics, written independently of the operators."""

from __future__ import annotations

from collections.abc import Sequence

# Upper regularised incomplete gamma Q(a, x) from the series of the lower one.
def gamma_tail(a: str, x: str) -> str:
    return (
        f"CASE WHEN {x} <= 0 THEN 1.0 ELSE 1.0 - exp({a} * ln({x}) - {x} - lgamma({a} + 1)) * "
        f"list_sum(list_transform(range(0, 400), lambda n: exp(n * ln({x}) + lgamma({a} + 1) "
        f"- lgamma({a} + n + 1)))) END"
    )


def kolmogorov(stat: str, n: str, m: str) -> str:
    e = f"sqrt({n}::DOUBLE * {m} / ({n} + {m}))"
    lam = f"(({e} + 0.12 + 0.11 / {e}) * {stat})"
    return (
        f"CASE WHEN {lam} < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform("
        f"range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) "
        f"* exp(-2.0::DOUBLE * k * k * {lam} * {lam}))), 0.0), 1.0) END"
    )


def bin_of(value: str, lo: str, hi: str, bins: int) -> str:
    return (
        f"len(list_filter(range(1, {bins}), lambda i: {value} >= i * (({hi} - {lo}) / {bins}.0::DOUBLE) + {lo}))"
    )


def base_ctes(src: str, numeric: Sequence[str], categorical: Sequence[str]) -> str:
    """CTEs from the flagged source up to one table per family of statistics.

    The source has the features, ``is_ref`` and ``grp``; reference rows are
    compared with every group.
    """
    def cells(features, cast):
        parts = []
        for f in features:
            parts.append(
                f"SELECT grp, '{f}' AS feature, CAST({f} AS {cast}) AS value, 0 AS n_ref, 1 AS n_cur "
                f"FROM src WHERE NOT is_ref AND {f} IS NOT NULL"
            )
            parts.append(
                f"SELECT g.grp, '{f}' AS feature, CAST(s.{f} AS {cast}) AS value, 1 AS n_ref, 0 AS n_cur "
                f"FROM src s, grps g WHERE s.is_ref AND s.{f} IS NOT NULL"
            )
        if not parts:
            parts = [f"SELECT 0 AS grp, '' AS feature, CAST(NULL AS {cast}) AS value, 0 AS n_ref, 0 AS n_cur WHERE FALSE"]
        return " UNION ALL ".join(parts)

    gap = "abs(cr / nr::DOUBLE - cc / nc::DOUBLE)"
    return f"""
src AS ({src}),
grps AS (SELECT DISTINCT grp FROM src WHERE NOT is_ref),
num AS ({cells(numeric, 'DOUBLE')}),
cat AS ({cells(categorical, 'VARCHAR')}),
mom AS (SELECT grp, feature, sum(n_ref) AS nr, sum(n_cur) AS nc,
  avg(value) FILTER (n_ref = 1) AS rm, avg(value) FILTER (n_cur = 1) AS cm,
  stddev_samp(value) FILTER (n_ref = 1) AS rs, stddev_samp(value) FILTER (n_cur = 1) AS cs,
  stddev_pop(value) FILTER (n_ref = 1) AS rp, stddev_pop(value) FILTER (n_cur = 1) AS cp,
  min(value) FILTER (n_ref = 1) AS rlo, max(value) FILTER (n_ref = 1) AS rhi,
  min(value) AS ulo, max(value) AS uhi FROM num GROUP BY grp, feature),
dv AS (SELECT grp, feature, value, sum(n_ref) AS r, sum(n_cur) AS c FROM num GROUP BY grp, feature, value),
run AS (SELECT *, sum(r) OVER w AS cr, sum(c) OVER w AS cc, lead(value) OVER w AS nv FROM dv
  WINDOW w AS (PARTITION BY grp, feature ORDER BY value)),
rk AS (SELECT grp, feature, count(*) AS nd, max({gap}) AS ks,
  sum(coalesce({gap} * (nv - value), 0)) AS wd FROM run JOIN mom USING (grp, feature)
  GROUP BY grp, feature),
pe AS (SELECT grp, feature, CASE WHEN rlo = rhi THEN rlo - 0.5 ELSE rlo END AS lo,
  CASE WHEN rlo = rhi THEN rhi + 0.5 ELSE rhi END AS hi FROM mom),
pb AS (SELECT grp, feature, CASE WHEN value < lo OR value > hi THEN -1 ELSE {bin_of('value', 'lo', 'hi', 10)} END AS bin,
  sum(r) AS r, sum(c) AS c FROM dv JOIN pe USING (grp, feature) GROUP BY ALL),
pt AS (SELECT grp, feature, sum(r) FILTER (bin >= 0) AS tr, sum(c) FILTER (bin >= 0) AS tc,
  coalesce(sum(c) FILTER (bin < 0), 0) AS outside FROM pb GROUP BY grp, feature),
pg AS (SELECT grp, feature, tr, tc, outside, unnest(range(0, 10)) AS bin FROM pt),
ps AS (SELECT grp, feature, max(outside) AS outside,
  sum((greatest(coalesce(c, 0) / tc::DOUBLE, 1e-6) - greatest(coalesce(r, 0) / tr::DOUBLE, 1e-6))
    * ln(greatest(coalesce(c, 0) / tc::DOUBLE, 1e-6) / greatest(coalesce(r, 0) / tr::DOUBLE, 1e-6))) AS psi
  FROM pg LEFT JOIN pb USING (grp, feature, bin) GROUP BY grp, feature),
jb AS (SELECT grp, feature, {bin_of('value', 'ulo', 'uhi', 19)} AS bin, sum(r) AS r, sum(c) AS c
  FROM dv JOIN mom USING (grp, feature) WHERE ulo < uhi GROUP BY ALL),
jt AS (SELECT grp, feature, sum(r) AS tr, sum(c) AS tc FROM jb GROUP BY grp, feature),
jg AS (SELECT grp, feature, tr, tc, unnest(range(0, 19)) AS bin FROM jt),
jp AS (SELECT grp, feature, (coalesce(r, 0) / tr::DOUBLE + 1e-10) / (1 + 19 * 1e-10) AS p,
  (coalesce(c, 0) / tc::DOUBLE + 1e-10) / (1 + 19 * 1e-10) AS q
  FROM jg LEFT JOIN jb USING (grp, feature, bin)),
js AS (SELECT grp, feature, sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2 AS js
  FROM jp GROUP BY grp, feature),
cc0 AS (SELECT grp, feature, value, sum(n_ref) AS r, sum(n_cur) AS c FROM cat GROUP BY grp, feature, value),
ct AS (SELECT grp, feature, sum(r) AS tr, sum(c) AS tc FROM cc0 GROUP BY grp, feature),
cstat AS (SELECT grp, feature, max(tr) AS tr, max(tc) AS tc, count(*) AS nd, count(*) - 1 AS dof,
  count(*) FILTER (r = 0) AS fresh, count(*) FILTER (c = 0) AS gone,
  sum(CASE WHEN r > 0 THEN power(c - r * tc / tr::DOUBLE, 2) / (r * tc / tr::DOUBLE) END) AS chi,
  sum((CASE WHEN r > 0 THEN r / tr::DOUBLE * ln(r / tr::DOUBLE / ((r / tr::DOUBLE + c / tc::DOUBLE) / 2)) ELSE 0 END)
    + (CASE WHEN c > 0 THEN c / tc::DOUBLE * ln(c / tc::DOUBLE / ((r / tr::DOUBLE + c / tc::DOUBLE) / 2)) ELSE 0 END)) / 2 AS jsd,
  arg_min(r, value) AS xr, arg_min(c, value) AS xc
  FROM cc0 JOIN ct USING (grp, feature) GROUP BY grp, feature),
cz AS (SELECT *, (xr + xc) / (tr + tc)::DOUBLE AS pool FROM cstat),
cst AS (SELECT *, {gamma_tail('(dof / 2.0::DOUBLE)', '(chi / 2.0::DOUBLE)')} AS chip,
  CASE WHEN nd = 2 THEN (xr / tr::DOUBLE - xc / tc::DOUBLE)
    / sqrt(pool * (1 - pool) * (1.0::DOUBLE / tr + 1.0::DOUBLE / tc)) END AS z FROM cz),
czz AS (SELECT *, CASE WHEN z IS NOT NULL THEN {gamma_tail('0.5::DOUBLE', '(z * z / 2.0::DOUBLE)')} END AS zp FROM cst),
ft AS (
  SELECT m.grp, m.feature, 'numeric' AS kind, m.nr::BIGINT AS n_ref, m.nc::BIGINT AS n_cur, rk.nd AS n_distinct,
    ks AS ks_statistic, {kolmogorov('ks', 'm.nr', 'm.nc')} AS ks_pvalue, wd AS wasserstein,
    wd / greatest(rp, 0.001) AS wasserstein_normed, psi,
    CASE WHEN rs > 0 THEN abs(cm - rm) / rs ELSE 0.0 END AS mean_shift,
    CASE WHEN rs > 0 THEN cs / rs ELSE 1.0 END AS std_ratio, js AS js_divergence,
    NULL::DOUBLE AS chi2_statistic, NULL::DOUBLE AS chi2_pvalue, NULL::DOUBLE AS js_distance,
    NULL::DOUBLE AS z_statistic, NULL::DOUBLE AS z_pvalue
  FROM mom m JOIN rk USING (grp, feature) JOIN ps USING (grp, feature) LEFT JOIN js USING (grp, feature)
  UNION ALL
  SELECT grp, feature, 'categorical', tr::BIGINT, tc::BIGINT, nd, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    CASE WHEN fresh > 0 THEN 'inf'::DOUBLE ELSE chi END, CASE WHEN fresh > 0 THEN 0.0 ELSE chip END,
    sqrt(greatest(jsd, 0)), z, zp FROM czz),
fts AS (SELECT *, ks_pvalue < 0.05 AS ks_drift, psi > 0.1 AS psi_drift, chi2_pvalue < 0.05 AS chi2_drift FROM ft)
"""


METRICS = [
    "ks_statistic", "ks_pvalue", "wasserstein", "wasserstein_normed", "psi", "mean_shift",
    "std_ratio", "js_divergence", "chi2_statistic", "chi2_pvalue", "js_distance", "z_statistic",
    "z_pvalue",
]


def summary_ctes(score: str, drifted: str, threshold: float = 0.5, indicators: str | None = None,
                 divisor: int = 5, concept: str = "FALSE") -> str:
    """CTEs ``cd`` (column verdicts), ``sm`` (summary) and ``cs1`` (consensus)."""
    names = indicators or (
        "CASE WHEN dataset_drift THEN 'dataset' END, "
        "CASE WHEN statistical_drift_share > 0.25 THEN 'statistical_share' END, "
        "CASE WHEN avg_psi > 0.1 THEN 'psi' END, CASE WHEN avg_ks_statistic > 0.3 THEN 'ks' END, "
        "CASE WHEN avg_js_divergence > 0.1 THEN 'js_divergence' END, "
        f"CASE WHEN {concept} THEN 'concept_drift' END"
    )
    return f"""
cd AS (SELECT *, {score} AS drift_score, coalesce({drifted}, FALSE) AS drifted FROM fts),
sm0 AS (SELECT grp, count(*) FILTER (drifted) AS n_drifted_columns,
  count(*) FILTER (coalesce(ks_drift, FALSE)) AS ks_drift_count,
  count(*) FILTER (coalesce(psi_drift, FALSE)) AS psi_drift_count,
  count(*) FILTER (coalesce(chi2_drift, FALSE)) AS chi2_drift_count,
  count(*) AS n_columns,
  avg(CASE WHEN kind = 'numeric' THEN ks_statistic ELSE 0 END) AS avg_ks_statistic,
  avg(CASE WHEN kind = 'numeric' THEN psi ELSE 0 END) AS avg_psi,
  avg(CASE WHEN kind = 'numeric' THEN wasserstein ELSE 0 END) AS avg_wasserstein,
  avg(CASE WHEN kind = 'numeric' THEN js_divergence ELSE 0 END) AS avg_js_divergence
  FROM cd GROUP BY grp),
sm AS (SELECT *, n_drifted_columns / n_columns::DOUBLE AS drift_share,
  n_drifted_columns / n_columns::DOUBLE >= {threshold} AS dataset_drift,
  (ks_drift_count + psi_drift_count + chi2_drift_count) / (3.0::DOUBLE * n_columns) AS statistical_drift_share FROM sm0),
cs0 AS (SELECT *, list_filter([{names}], lambda x: x IS NOT NULL) AS ind FROM sm),
cs1 AS (SELECT *, array_to_string(ind, ',') AS drift_indicators, len(ind) >= 2 AS consensus_drift,
  len(ind) / {divisor}.0::DOUBLE AS confidence_score, least(len(ind) / {divisor}.0::DOUBLE, 1.0) AS confidence_capped,
  CASE WHEN len(ind) >= 2 THEN 'DRIFT_DETECTED' ELSE 'NO_DRIFT' END AS status FROM cs0)
"""


def rounded_select(metrics: Sequence[str]) -> str:
    return ", ".join(f"round({m}, 6) AS {m}" for m in metrics)
