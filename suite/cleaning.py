"""Cleaning, target, alignment and contract queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cleaning as K
from tidemark.operators.contract import Field, check_contract, split_by_contract
from tidemark.operators.sides import feature_kinds

from .common import query, table
from .encounters import SQL as ENC
from .encounters import encounters


@query(
    "clean_markers",
    f"SELECT encounter_id, nullif(race, '?') AS race, nullif(weight, '?') AS weight, "
    f"nullif(payer_code, '?') AS payer_code, time_in_hospital FROM ({ENC})",
)
def clean_markers(spark, sf):
    return K.markers_to_null(encounters(spark, sf)).select(
        "encounter_id", "race", "weight", "payer_code", "time_in_hospital"
    )


@query(
    "fill_missing",
    f"SELECT coalesce(nullif(race, '?'), 'Unknown') AS race, coalesce(nullif(diag_1, '?'), 'Missing') AS diag_1, "
    f"count(*) AS n FROM ({ENC}) GROUP BY ALL",
)
def fill_missing(spark, sf):
    marked = K.markers_to_null(encounters(spark, sf))
    filled = K.fill_missing(marked, {"race": "Unknown", "diag_1": "Missing"})
    return filled.groupBy("race", "diag_1").agg(F.count(F.lit(1)).alias("n"))


@query(
    "null_safe_exclude",
    f"SELECT encounter_id, discharge_disposition_id FROM ({ENC}) "
    "WHERE discharge_disposition_id IS NULL OR discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)",
)
def null_safe_exclude(spark, sf):
    return K.exclude_values(
        encounters(spark, sf), "discharge_disposition_id", [11, 13, 14, 19, 20, 21]
    ).select("encounter_id", "discharge_disposition_id")


@query(
    "target_rule",
    f"SELECT readmitted, CASE WHEN readmitted = 'NO' THEN 0 ELSE 1 END AS target_any, "
    f"CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS target_within30, count(*) AS n FROM ({ENC}) GROUP BY ALL",
)
def target_rule(spark, sf):
    df = encounters(spark, sf)
    df = K.derive_target(df, "any", target="target_any")
    df = K.derive_target(df, "within30", target="target_within30")
    return df.groupBy("readmitted", "target_any", "target_within30").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "ordinal_map",
    f"SELECT age, TRY_CAST(regexp_extract(age, '^\\[(\\d+)-', 1) AS INTEGER) // 10 AS age_ordinal, count(*) AS n "
    f"FROM ({ENC}) GROUP BY ALL",
)
def ordinal_map(spark, sf):
    df = K.map_ordinal(encounters(spark, sf), "age", "age_ordinal")
    return df.groupBy("age", "age_ordinal").agg(F.count(F.lit(1)).alias("n"))


@query(
    "clean_and_featurise",
    f"""SELECT coalesce(nullif(race, '?'), 'Unknown') AS race, gender, age, discharge_disposition_id, time_in_hospital,
  num_medications, number_emergency, number_diagnoses, coalesce(nullif(diag_1, '?'), 'Unknown') AS diag_1, insulin,
  readmitted, CASE WHEN readmitted = 'NO' THEN 0 ELSE 1 END AS readmitted_binary,
  TRY_CAST(regexp_extract(age, '^\\[(\\d+)-', 1) AS INTEGER) // 10 AS age_ordinal FROM ({ENC})
WHERE discharge_disposition_id IS NULL OR discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)""",
)
def clean_and_featurise(spark, sf):
    return K.featurise(K.clean(encounters(spark, sf)))


@query(
    "drift_prepare",
    f"""SELECT coalesce(nullif(race, '?'), 'Unknown') AS race, gender, discharge_disposition_id, time_in_hospital,
  num_medications, number_emergency, number_diagnoses, coalesce(nullif(diag_1, '?'), 'Unknown') AS diag_1, insulin,
  TRY_CAST(regexp_extract(age, '^\\[(\\d+)-', 1) AS INTEGER) // 10 AS age_ordinal FROM ({ENC})
WHERE discharge_disposition_id IS NULL OR discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)""",
)
def drift_prepare(spark, sf):
    return K.prepare_for_drift(encounters(spark, sf))


@query(
    "drift_column_selection",
    f"SELECT race, gender, age, weight, payer_code, medical_specialty, discharge_disposition_id, time_in_hospital, "
    f"num_medications, number_emergency, number_diagnoses, insulin FROM ({ENC}) WHERE encounter_id % 2 = 1",
)
def drift_column_selection(spark, sf):
    rows = encounters(spark, sf)
    _, current = K.drift_columns(
        rows.where("encounter_id % 2 = 0"), rows.where("encounter_id % 2 = 1")
    )
    return current


@query(
    "align_shared",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def align_shared(spark, sf):
    orders = table(spark, sf, "orders")
    left = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    right = orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus"
    )
    return K.align_shared(left, right)[1]


@query(
    "align_expected",
    "SELECT o_totalprice, 0 AS absent_feature, o_custkey, 0 AS other_absent FROM orders",
)
def align_expected(spark, sf):
    return K.align_expected(
        table(spark, sf, "orders"), ["o_totalprice", "absent_feature", "o_custkey", "other_absent"]
    )


@query("rename_stored", 'SELECT o_orderkey AS "glyburide-metformin", o_custkey AS other FROM orders')
def rename_stored(spark, sf):
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("glyburide_metformin"), F.col("o_custkey").alias("other")
    )
    return K.rename_to_stored(df)


@query(
    "drop_sparse",
    f"SELECT encounter_id, nullif(payer_code, '?') AS payer_code FROM ({ENC})",
)
def drop_sparse(spark, sf):
    marked = K.markers_to_null(encounters(spark, sf)).select("encounter_id", "weight", "payer_code")
    return K.drop_sparse(marked, 0.9)


@query(
    "low_cardinality_columns",
    "SELECT unnest(['o_orderstatus', 'o_orderpriority']) AS \"column\"",
)
def low_cardinality_columns(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_comment", F.col("o_orderkey").cast("string"))
    names = K.low_cardinality_columns(orders, 25)
    flags = orders.agg(*[F.count(c).alias(c) for c in names])
    return flags.unpivot([], names, "column", "n").select("column")


@query(
    "feature_kinds",
    "SELECT 'numeric' AS kind, 3 AS n_columns, round(avg(l_quantity), 6) AS mean_quantity FROM lineitem",
)
def feature_kinds_query(spark, sf):
    """Kinds come from the schema; a coded integer is declared categorical."""
    rows = table(spark, sf, "lineitem").select(
        "l_quantity", "l_tax", "l_discount", "l_linenumber", "l_returnflag", "l_shipdate"
    )
    kinds = feature_kinds(rows, kind_overrides={"l_linenumber": "categorical"})
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    return rows.agg(
        F.lit("numeric").alias("kind"), F.lit(len(numeric)).alias("n_columns"),
        F.round(F.avg("l_quantity"), 6).alias("mean_quantity"),
    )


@query("numeric_only", "SELECT event_id, user_id, value FROM events")
def numeric_only(spark, sf):
    return K.numeric_only(table(spark, sf, "events"))


@query("select_features", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def select_features(spark, sf):
    return K.select_features(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"])


@query(
    "subpopulations",
    f"""SELECT age IN ('[70-80)', '[80-90)', '[90-100)') AS old, number_diagnoses >= 8 AS many_diagnoses,
  number_emergency > 0 AS emergency, count(*) AS n FROM ({ENC}) GROUP BY ALL""",
)
def subpopulations(spark, sf):
    return (
        encounters(spark, sf)
        .select(
            F.col("age").isin("[70-80)", "[80-90)", "[90-100)").alias("old"),
            (F.col("number_diagnoses") >= 8).alias("many_diagnoses"),
            (F.col("number_emergency") > 0).alias("emergency"),
        )
        .groupBy("old", "many_diagnoses", "emergency")
        .agg(F.count(F.lit(1)).alias("n"))
    )


_K = "CAST(json_extract_string(props, '$.k') AS VARCHAR)"


@query(
    "coerce_numbers",
    f"""SELECT event_id, TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'bad' ELSE {_K} END AS DOUBLE) AS k FROM events""",
)
def coerce_numbers(spark, sf):
    k = F.get_json_object("props", "$.k")
    df = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, "bad").otherwise(k).alias("k")
    )
    return K.coerce_numbers(df, ["k"])


CONTRACT = [
    Field("k", "int"), Field("event_type", "string"), Field("value", "double"),
    Field("note", "string", True), Field("level", "int", True),
]
_CONTRACT_SRC = f"""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'x' || {_K} ELSE {_K} END AS k,
  nullif(event_type, 'error') AS event_type, value, CASE WHEN event_id % 3 = 0 THEN 'high' END AS level FROM events"""


def _contract_rows(spark, sf):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.lit(None))
        .when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), k))
        .otherwise(k)
        .alias("k"),
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        "value",
        F.when(F.col("event_id") % 3 == 0, "high").alias("level"),
    )


_VIOLATIONS = """array_to_string(list_filter([
  CASE WHEN k IS NULL THEN 'k:missing' WHEN TRY_CAST(k AS INTEGER) IS NULL THEN 'k:type' END,
  CASE WHEN event_type IS NULL THEN 'event_type:missing' END,
  CASE WHEN level IS NOT NULL THEN 'level:type' END], lambda x: x IS NOT NULL), ',')"""


@query("contract_check", f"SELECT event_id, {_VIOLATIONS} AS violations FROM ({_CONTRACT_SRC})")
def contract_check(spark, sf):
    checked = check_contract(_contract_rows(spark, sf), CONTRACT)
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))


@query(
    "contract_split",
    f"""SELECT TRY_CAST(k AS INTEGER) IS NOT NULL AND event_type IS NOT NULL AND level IS NULL AS accepted, count(*) AS n,
  coalesce(sum(CASE WHEN event_type IS NOT NULL AND level IS NULL THEN TRY_CAST(k AS INTEGER) END)
    FILTER (TRY_CAST(k AS INTEGER) IS NOT NULL AND event_type IS NOT NULL AND level IS NULL), 0)::BIGINT AS sum_k
FROM ({_CONTRACT_SRC}) GROUP BY 1""",
)
def contract_split(spark, sf):
    good, bad = split_by_contract(_contract_rows(spark, sf), CONTRACT)
    return good.agg(
        F.lit(True).alias("accepted"), F.count(F.lit(1)).alias("n"), F.sum("k").alias("sum_k")
    ).unionByName(
        bad.agg(
            F.lit(False).alias("accepted"), F.count(F.lit(1)).alias("n"),
            F.lit(0).cast("bigint").alias("sum_k"),
        )
    )
