"""Descriptive profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as X
from tidemark.operators import cleaning as K
from tidemark.operators import profile as P
from tidemark.operators.drift import paired_moments
from tidemark.operators.histogram import histogram
from tidemark.operators.report import drift_characteristics
from tidemark.operators.sides import _melt, flag_sides

from .common import NUMERIC, lineitem_sides, query, rounded, table
from .encounters import SQL as ENC
from .encounters import encounters

_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM lineitem" for c in NUMERIC)


@query(
    "profile_numeric",
    f"""SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS max FROM ({_LONG}) GROUP BY feature""",
)
def profile_numeric(spark, sf):
    t = P.describe_numeric(table(spark, sf, "lineitem"), NUMERIC)
    return rounded(t, ["mean", "std", "q1", "median", "q3"])


@query(
    "quantiles_by_group",
    "SELECT event_type, 'value' AS feature, round(quantile_cont(value, 0.1), 6) AS p10, "
    "round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type",
)
def quantiles_by_group(spark, sf):
    t = P.quantile_table(
        table(spark, sf, "events"), ["value"], {"p10": 0.1, "p90": 0.9, "p99": 0.99},
        by=["event_type"],
    )
    return rounded(t, ["p10", "p90", "p99"])


_CATS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value FROM orders" for c in ("o_orderstatus", "o_orderpriority")
)


@query(
    "profile_categorical",
    f"""WITH c AS (SELECT feature, value, count(*) AS n FROM ({_CATS}) GROUP BY ALL)
SELECT feature, sum(n)::BIGINT AS count, count(*) AS unique, arg_min(value, (-n, value)) AS top, max(n) AS freq
FROM c GROUP BY feature""".replace("AS unique", 'AS "unique"'),
)
def profile_categorical(spark, sf):
    return P.describe_categorical(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


_MISSING_COLS = ["race", "weight", "payer_code", "medical_specialty", "discharge_disposition_id",
                 "diag_1", "readmitted"]
_MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (x IS NULL) AS missing, count(*) AS n FROM "
    f"(SELECT nullif(CAST({c} AS VARCHAR), '?') AS x FROM enc)"
    for c in _MISSING_COLS
)


@query(
    "missing_report",
    f"WITH enc AS ({ENC}) SELECT \"column\", missing, round(missing * 100.0::DOUBLE / n, 6) AS missing_pct "
    f"FROM ({_MISSING_SQL}) WHERE missing > 0",
)
def missing_report(spark, sf):
    return rounded(P.missing_report(K.markers_to_null(encounters(spark, sf))), ["missing_pct"])


@query(
    "value_counts",
    "SELECT nullif(event_type, 'error') AS value, count(*) AS n, "
    "round(count(*) / (SELECT count(*)::DOUBLE FROM events), 6) AS share FROM events GROUP BY 1",
)
def value_counts(spark, sf):
    df = table(spark, sf, "events").select(F.nullif("event_type", F.lit("error")).alias("event_type"))
    return rounded(P.value_counts(df, "event_type", normalize=True, keep_null=True), ["share"])


@query(
    "boxplot",
    f"""WITH c AS ({_LONG}), q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM c GROUP BY feature),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT feature, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  min(value) FILTER (value BETWEEN lo AND hi) AS whisker_low, max(value) FILTER (value BETWEEN lo AND hi) AS whisker_high,
  count(*) FILTER (value < lo OR value > hi) AS outliers FROM c JOIN f USING (feature) GROUP BY feature, q1, median, q3""",
)
def boxplot(spark, sf):
    return rounded(P.box_stats(table(spark, sf, "lineitem"), NUMERIC), ["q1", "median", "q3"])


@query(
    "histogram",
    f"""WITH c AS ({_LONG}), e AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM c GROUP BY feature),
b AS (SELECT feature, len(list_filter(range(1, 30), lambda i: value >= i * ((hi - lo) / 30.0::DOUBLE) + lo)) AS bin,
  count(*) AS n FROM c JOIN e USING (feature) GROUP BY ALL),
g AS (SELECT feature, lo, hi, (hi - lo) / 30.0::DOUBLE AS w, unnest(range(0, 30)) AS bin FROM e)
SELECT feature, bin::INTEGER AS bin, round(lo + bin * w, 6) AS bin_start,
  round(CASE WHEN bin = 29 THEN hi ELSE lo + (bin + 1) * w END, 6) AS bin_end, coalesce(n, 0) AS n
FROM g LEFT JOIN b USING (feature, bin)""",
)
def histogram_query(spark, sf):
    cells = _melt(table(spark, sf, "lineitem"), [], NUMERIC, "double")
    return rounded(histogram(cells, ["feature"], 30), ["bin_start", "bin_end"])


@query(
    "distinct_counts",
    "SELECT 'o_orderstatus' AS feature, count(DISTINCT o_orderstatus) AS n_distinct FROM orders UNION ALL "
    "SELECT 'o_custkey', count(DISTINCT o_custkey) FROM orders UNION ALL "
    "SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders",
)
def distinct_counts(spark, sf):
    return P.distinct_counts(
        table(spark, sf, "orders"), ["o_orderstatus", "o_custkey", "o_orderpriority"]
    )


@query(
    "drift_characteristics",
    "WITH s AS (SELECT *, l_shipdate < TIMESTAMP '1999-01-01' AS is_ref FROM lineitem), m AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) FILTER (is_ref) AS rm, avg({c}) FILTER (NOT is_ref) AS bm, "
        f"stddev_samp({c}) FILTER (is_ref) AS rs FROM s"
        for c in NUMERIC
    )
    + ") SELECT feature, round(rm, 6) AS ref_mean, round(bm, 6) AS batch_mean, round((bm - rm) / rs, 6) AS shift, "
    "CASE WHEN (bm - rm) / rs > 0.1 THEN '^' WHEN (bm - rm) / rs < -0.1 THEN 'v' ELSE '=' END AS arrow FROM m",
)
def characteristics(spark, sf):
    t = drift_characteristics(paired_moments(lineitem_sides(spark, sf), NUMERIC))
    return rounded(t, ["ref_mean", "batch_mean", "shift"])


@query(
    "percent_where",
    f"""SELECT encounter_id % 2 = 0 AS is_ref,
  round(avg((age IN ('[70-80)', '[80-90)', '[90-100)'))::INT) * 100, 6) AS old_pct,
  round(avg((readmitted IS NULL OR readmitted <> 'NO')::INT) * 100, 6) AS readmission_pct FROM ({ENC}) GROUP BY 1""",
)
def percent_where(spark, sf):
    df = K.derive_target(encounters(spark, sf))
    t = P.percent_where(
        flag_sides(df, F.col("encounter_id") % 2 == 0),
        {
            "old_pct": F.col("age").isin("[70-80)", "[80-90)", "[90-100)"),
            "readmission_pct": F.col("readmitted_binary") == 1,
        },
        ["is_ref"],
    )
    return rounded(t, ["old_pct", "readmission_pct"])


@query(
    "scalar_parity",
    """SELECT event_id, round(abs(value - 50), 6) AS abs_value, greatest(value - 40, 0.0) AS clamped,
  floor(value)::BIGINT AS whole, CAST(trunc(value * -1) AS BIGINT) AS truncated,
  round(CASE WHEN user_id % 5 = 0 THEN -1.0 ELSE value / (user_id % 5) END, 6) AS guarded,
  printf('%+.3f', value - 50) AS signed, printf('%.1f%%', value / 100 * 100) AS pct,
  hour(ts)::INTEGER AS hour, (isodow(ts) - 1)::INTEGER AS weekday,
  round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 3.6e9, 6) AS hours,
  upper(event_type) LIKE '%UR%' OR upper(event_type) LIKE '%RR%' AS has_word,
  substr(event_type, 1, 3) AS head, left(event_type, 1) || 'X' || substr(event_type, 3) AS corrupted,
  (event_type = 'error')::INTEGER AS flag,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
  array_to_string(list_filter([CASE WHEN value > 50 THEN 'big' END, CASE WHEN user_id < 50 THEN 'low' END],
    lambda x: x IS NOT NULL), ',') AS indicators
FROM events""",
)
def scalar_parity(spark, sf):
    v, u, ts = F.col("value"), F.col("user_id"), F.col("ts")
    props = F.from_json("props", "map<string,int>")
    return table(spark, sf, "events").select(
        "event_id",
        F.round(F.abs(v - 50), 6).alias("abs_value"),
        X.clamp_low(v - 40).alias("clamped"),
        F.floor(v).alias("whole"),
        X.truncated_int(v * -1).alias("truncated"),
        F.round(X.ratio(v, u % 5, -1.0), 6).alias("guarded"),
        X.signed(v - 50).alias("signed"),
        X.percent(v / 100, 1).alias("pct"),
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("weekday"),
        F.round(X.hours_between(ts, F.lit("2024-01-01").cast("timestamp")), 6).alias("hours"),
        X.contains_any(F.col("event_type"), ["ur", "rr"]).alias("has_word"),
        F.substring("event_type", 1, 3).alias("head"),
        X.replace_char(F.col("event_type"), F.lit(2)).alias("corrupted"),
        (F.col("event_type") == "error").cast("int").alias("flag"),
        X.map_get(props, "k", F.lit(-1)).alias("k"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        F.array_join(X.flag_list([("big", v > 50), ("low", u < 50)]), ",").alias("indicators"),
    )
