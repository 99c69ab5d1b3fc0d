"""Perturbation queries."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from tidemark.operators import perturb as G

from .common import NUMERIC, labelled, LABELLED_SQL, query, rounded, table
from .encounters import SQL as ENC
from .encounters import encounters

_LI = "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(NUMERIC) + " FROM lineitem"


def _lineitem(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *NUMERIC)


def _changed(expr: dict[str, str]) -> str:
    picks = ", ".join(f"round({expr.get(c, c)}, 6) AS {c}" for c in NUMERIC)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in NUMERIC)
    return (
        f"SELECT l_orderkey, l_linenumber, l_partkey, {picks} FROM ({_LI}), (SELECT {stats} FROM lineitem)"
    )


@query("shift", _changed({c: f"{c} + 0.3 * s_{c}" for c in ("l_quantity", "l_tax")}))
def shift(spark, sf):
    return rounded(G.covariate_drift(_lineitem(spark, sf), ["l_quantity", "l_tax", "absent"]), NUMERIC)


@query("scale", _changed({c: f"({c} - m_{c}) * 1.3 + m_{c}" for c in ("l_quantity", "l_tax")}))
def scale(spark, sf):
    return rounded(
        G.covariate_drift(_lineitem(spark, sf), ["l_quantity", "l_tax"], kind="scale"), NUMERIC
    )


@query(
    "shift_and_scale",
    _changed({c: f"({c} - m_{c}) * 1.15 + m_{c} + 0.15 * s_{c}" for c in ("l_quantity", "l_tax")}),
)
def shift_and_scale(spark, sf):
    return rounded(
        G.covariate_drift(_lineitem(spark, sf), ["l_quantity", "l_tax"], kind="both"), NUMERIC
    )


_RNG = random.Random(42)
_RANDOM = {c: 0.3 * _RNG.gauss(0.0, 1.0) for c in ("l_quantity", "l_discount")}


@query("random_shift", _changed({c: f"{c} + {a!r}::DOUBLE * s_{c}" for c, a in _RANDOM.items()}))
def random_shift(spark, sf):
    out, _ = G.random_shift(_lineitem(spark, sf), ["l_quantity", "l_discount"], 0.3, 42)
    return rounded(out, NUMERIC)


_SCENARIO = 0.15 * random.Random(7).gauss(0.0, 1.0)


@query(
    "drift_scenario",
    f"SELECT encounter_id, round(time_in_hospital + {_SCENARIO!r}::DOUBLE * s, 6) AS time_in_hospital, 1 AS affected "
    f"FROM ({ENC}), (SELECT stddev_samp(time_in_hospital) AS s FROM ({ENC}))",
)
def drift_scenario(spark, sf):
    out, meta = G.drift_scenario(
        encounters(spark, sf).select("encounter_id", "time_in_hospital"), "mild_covariate", seed=7
    )
    return rounded(out, ["time_in_hospital"]).withColumn(
        "affected", F.lit(len(meta["affected_features"]))
    )


@query(
    "shift_all_numeric",
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"round({c} + 0.4 * s_{c}, 6) AS {c}" for c in NUMERIC)
    + " FROM lineitem, (SELECT " + ", ".join(f"stddev_samp({c}) AS s_{c}" for c in NUMERIC) + " FROM lineitem)",
)
def shift_all_numeric(spark, sf):
    df = _lineitem(spark, sf).drop("l_partkey")
    return rounded(G.shift_all_numeric(df, 0.4, exclude=["l_orderkey", "l_linenumber"]), NUMERIC)


def _mixed_choice(seed: int = 42) -> list[str]:
    rng = random.Random(seed)
    return [c for c in NUMERIC if rng.random() < 0.7]


@query(
    "mixed_drift",
    "SELECT l_returnflag, " + ", ".join(
        f"round({c} + {0.2 * 0.6!r}::DOUBLE * s_{c} {'+ ' + repr(0.2 * 0.4 * 10) + '::DOUBLE' if c == 'l_quantity' else ''}, 6) AS {c}"
        if c in _mixed_choice()
        else f"round({c} {'+ ' + repr(0.2 * 0.4 * 10) + '::DOUBLE' if c == 'l_quantity' else ''}, 6) AS {c}"
        for c in NUMERIC
    ) + " FROM lineitem, (SELECT " + ", ".join(f"stddev_samp({c}) AS s_{c}" for c in NUMERIC) + " FROM lineitem)",
)
def mixed_drift(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", *NUMERIC)
    return rounded(G.mixed_drift(df, 0.2, ordinal="l_quantity"), NUMERIC)


@query(
    "flip_labels",
    f"""WITH l AS (SELECT doc_id, label, toxic, n_chars FROM ({LABELLED_SQL})),
m AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id)) AS rn, count(*) OVER () AS n FROM l WHERE n_chars > 300)
SELECT doc_id, CASE WHEN rn <= floor(n * 0.4) THEN 1 - label ELSE label END AS label FROM m
UNION ALL SELECT doc_id, label FROM l WHERE NOT n_chars > 300""",
)
def flip_labels(spark, sf):
    df = labelled(spark, sf).select("doc_id", "label", "n_chars")
    return G.flip_labels(df, ["doc_id"], F.col("n_chars") > 300, 0.4, "label").select(
        "doc_id", "label"
    )


def _frac(seed: str, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::UBIGINT / 4294967296.0::DOUBLE)"


_FOUR = ["value", "event_type", "user_id", "ts"]
_HIT = sorted(_FOUR, key=lambda c: hashlib.md5(f"42:{c}".encode()).hexdigest())[:3]


@query(
    "inject_nulls",
    "SELECT event_id, " + ", ".join(
        f"CASE WHEN {_frac('42-row', 'event_id')} < 0.1 AND {_frac('42-' + c, 'event_id')} < 0.4 THEN NULL ELSE {c} END AS {c}"
        if c in _HIT else c
        for c in _FOUR
    ) + " FROM events",
)
def inject_nulls(spark, sf):
    """Three of four columns are hit, whichever the seed chooses."""
    return G.inject_nulls(table(spark, sf, "events").select("event_id", *_FOUR), ["event_id"], _FOUR, 0.1)


def _struck(column: int, of: int, seed: str, share: float, drawn: str) -> str:
    """Rows that are hit, in the column with this position among ``of``."""
    return f"({_frac(seed, 'event_id')} < {share} AND floor({_frac(drawn, 'event_id')} * {of}) = {column})"


def _corrupted(c: str, where: str) -> str:
    p = f"(floor({_frac('42-pos', 'event_id')} * length({c}))::INTEGER + 1)"
    return (
        f"CASE WHEN {where} AND length({c}) > 1 THEN substr({c}, 1, {p} - 1) || 'X' || substr({c}, {p} + 1) ELSE {c} END"
    )


@query(
    "corrupt_strings",
    "SELECT event_id, " + ", ".join(
        f"{_corrupted(c, _struck(i, 2, '42-hit', 0.2, '42-column'))} AS {c}"
        for i, c in enumerate(["event_type", "visitor"])
    ) + " FROM (SELECT event_id, event_type, 'user ' || user_id AS visitor FROM events)",
)
def corrupt_strings(spark, sf):
    """One of two text columns per row, so that the share of rows stays as asked."""
    df = table(spark, sf, "events").select(
        "event_id", "event_type", F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("visitor")
    )
    return G.corrupt_strings(df, ["event_id"], ["event_type", "visitor"], 0.2)


@query(
    "inject_outliers",
    f"SELECT event_id, CASE WHEN {_struck(0, 2, '42-out', 0.05, '42-out-column')} THEN 999999.0 ELSE value END::DOUBLE AS value, "
    f"CASE WHEN {_struck(1, 2, '42-out', 0.05, '42-out-column')} THEN 999999 ELSE user_id END::BIGINT AS user_id FROM events",
)
def inject_outliers(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value", F.col("user_id").cast("bigint").alias("user_id"))
    return G.inject_outliers(df, ["event_id"], ["value", "user_id"], 0.05)


@query(
    "multiple_issues",
    f"""WITH a AS (SELECT event_id,
  CASE WHEN {_frac('42-row', 'event_id')} < 0.3 AND {_frac('42-event_type', 'event_id')} < 0.4 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN {_frac('42-row', 'event_id')} < 0.3 AND {_frac('42-value', 'event_id')} < 0.4 THEN NULL ELSE value END AS value FROM events)
SELECT event_id, {_corrupted('event_type', _struck(0, 1, '42-hit', 0.03, '42-column'))} AS event_type,
  CASE WHEN {_struck(0, 1, '42-out', 0.01, '42-out-column')} THEN 999999.0 ELSE value END::DOUBLE AS value FROM a""",
)
def multiple_issues(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type", "value")
    return G.multiple_issues(df, ["event_id"], 0.5, ["event_type"], ["value"])


@query(
    "quality_score",
    f"""WITH i AS (SELECT user_id % 10 AS site,
  CASE WHEN {_frac('42-row', 'event_id')} < 0.1 AND {_frac('42-value', 'event_id')} < 0.4 THEN NULL ELSE value END AS value,
  CASE WHEN {_frac('42-row', 'event_id')} < 0.1 AND {_frac('42-event_type', 'event_id')} < 0.4 THEN NULL ELSE event_type END AS event_type FROM events)
SELECT site, count(*) AS rows, count(*) FILTER (value IS NULL OR event_type IS NULL) AS affected_rows,
  round(1 - avg((value IS NULL OR event_type IS NULL)::INT), 6) AS quality_score FROM i GROUP BY site""",
)
def quality_score(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", (F.col("user_id") % 10).alias("site"), "value", "event_type"
    )
    dirty = G.inject_nulls(df, ["event_id"], ["value", "event_type"], 0.1)
    return rounded(G.quality_score(dirty, ["value", "event_type"], ["site"]), ["quality_score"])


# ----------------------------------------------------------- drifted batches
_OLD = "age IN ('[70-80)', '[80-90)', '[90-100)')"
_ENC_KEYED = f"SELECT encounter_id, age, number_diagnoses, time_in_hospital, num_medications, number_emergency FROM ({ENC})"


def _oversampled(condition: str, share: float, size: int = 2000) -> str:
    """CTEs ``pop`` and ``ov``: the oversampled batch."""
    return f"""pop AS ({_ENC_KEYED}), st AS (SELECT *, CASE WHEN {condition} THEN 'high' ELSE 'low' END AS stratum FROM pop),
nn AS (SELECT least(floor({size} * {share}), count(*) FILTER (stratum = 'high')) AS nh, count(*) FILTER (stratum = 'low') AS cl FROM st),
cp AS (SELECT st.*, CASE WHEN stratum = 'high' THEN nh ELSE {size} - nh END AS k,
  unnest(range(0, CASE WHEN stratum = 'high' THEN 1 ELSE greatest(ceil(({size} - nh) / cl)::BIGINT, 1) END)) AS copy FROM st, nn),
ov AS (SELECT * EXCLUDE (k) FROM cp
  QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || encounter_id || '|' || copy)) <= k)"""


def _swapped(high: str, share: float, size: int = 2000) -> str:
    cols = "encounter_id, age, number_diagnoses, time_in_hospital, num_medications, number_emergency"
    return f"""sq AS (SELECT least(floor({size} * {share}), (SELECT count(*) FROM ov WHERE NOT ({high})),
  (SELECT count(*) FROM pop WHERE {high})) AS k),
sw AS (SELECT {cols} FROM ov WHERE {high}
UNION ALL SELECT {cols} FROM (SELECT *, row_number() OVER (ORDER BY md5('42-out:' || encounter_id)) AS rn FROM ov WHERE NOT ({high})), sq WHERE rn > k
UNION ALL SELECT {cols} FROM (SELECT *, row_number() OVER (ORDER BY md5('42-in:' || encounter_id)) AS rn FROM pop WHERE {high}), sq WHERE rn <= k)"""


_ENC_COLS = ["encounter_id", "age", "number_diagnoses", "time_in_hospital", "num_medications",
             "number_emergency"]


def _population(spark, sf):
    return encounters(spark, sf).select(*_ENC_COLS)


@query("no_drift_batch", f"SELECT encounter_id, age FROM ({_ENC_KEYED}) ORDER BY md5('42:' || encounter_id) LIMIT 2000")
def no_drift_batch(spark, sf):
    return G.no_drift_batch(_population(spark, sf), ["encounter_id"]).select("encounter_id", "age")


@query(
    "gradual_drift_batch",
    f"WITH {_oversampled(_OLD, 0.5)}, {_swapped('number_diagnoses >= 8', 0.15)} SELECT encounter_id, age, number_diagnoses FROM sw",
)
def gradual_drift_batch(spark, sf):
    old = F.col("age").isin("[70-80)", "[80-90)", "[90-100)")
    out = G.gradual_drift_batch(
        _population(spark, sf), ["encounter_id"], old, F.col("number_diagnoses") >= 8
    )
    return out.select("encounter_id", "age", "number_diagnoses")


_VERY_OLD = "age IN ('[80-90)', '[90-100)')"


@query(
    "strong_drift_batch",
    f"""WITH {_oversampled(_VERY_OLD, 0.4)}, {_swapped('number_diagnoses >= 9', 0.2)},
s AS (SELECT stddev_samp(time_in_hospital) AS st, stddev_samp(num_medications) AS sm FROM pop)
SELECT encounter_id, round(time_in_hospital + 0.3 * st, 6) AS time_in_hospital, round(num_medications + 0.3 * sm, 6) AS num_medications FROM sw, s""",
)
def strong_drift_batch(spark, sf):
    out = G.strong_drift_batch(
        _population(spark, sf), ["encounter_id"], F.col("age").isin("[80-90)", "[90-100)"),
        F.col("number_diagnoses") >= 9, ["time_in_hospital", "num_medications"],
    )
    return rounded(
        out.select("encounter_id", "time_in_hospital", "num_medications"),
        ["time_in_hospital", "num_medications"],
    )


@query(
    "concept_drift_batch",
    f"""WITH {_oversampled('number_emergency > 0', 0.35)},
lb AS (SELECT *, CASE WHEN encounter_id % 3 = 0 THEN 1 ELSE 0 END AS label, num_medications > 15 AND time_in_hospital > 5 AS m FROM ov),
fl AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY md5('42:' || encounter_id || '|' || copy)) AS rn,
  count(*) OVER (PARTITION BY m) AS n FROM lb),
s AS (SELECT stddev_samp(num_medications) AS sm FROM pop)
SELECT encounter_id, CASE WHEN m AND rn <= floor(n * 0.4) THEN 1 - label ELSE label END AS label,
  round(num_medications + 0.2 * sm, 6) AS num_medications FROM fl, s""",
)
def concept_drift_batch(spark, sf):
    df = _population(spark, sf).withColumn(
        "label", F.when(F.col("encounter_id") % 3 == 0, 1).otherwise(0)
    )
    out = G.concept_drift_batch(
        df, ["encounter_id"], F.col("number_emergency") > 0,
        (F.col("num_medications") > 15) & (F.col("time_in_hospital") > 5), "label",
        ["num_medications"],
    )
    return rounded(out.select("encounter_id", "label", "num_medications"), ["num_medications"])
