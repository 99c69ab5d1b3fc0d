"""An encounter-shaped table derived from orders and customers.

Orders supply the key and every encounter column is a fixed function of the
order, so the domain operators run over the whole driver tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import table

DRUGS = "CASE o_orderkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Steady' WHEN 2 THEN 'Up' ELSE 'Down' END"

# column -> SQL valid on both engines
COLUMNS = {
    "encounter_id": "o_orderkey",
    "patient_nbr": "o_custkey",
    "race": "CASE WHEN o_orderkey % 11 = 0 THEN '?' WHEN o_orderkey % 3 = 0 THEN 'Asian' ELSE 'Caucasian' END",
    "gender": "CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "age": "CASE WHEN o_orderkey % 101 = 0 THEN 'unknown' ELSE concat('[', CAST(o_custkey % 10 * 10 AS VARCHAR(5)), '-', CAST(o_custkey % 10 * 10 + 10 AS VARCHAR(5)), ')') END",
    "weight": "CASE WHEN o_orderkey % 40 = 0 THEN '[75-100)' ELSE '?' END",
    "payer_code": "CASE WHEN o_orderkey % 5 < 2 THEN '?' ELSE 'MC' END",
    "medical_specialty": "CASE WHEN o_orderkey % 2 = 0 THEN '?' ELSE 'Surgery' END",
    "discharge_disposition_id": "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_orderkey % 26 AS INTEGER) END",
    "time_in_hospital": "CAST(o_orderkey % 14 + 1 AS INTEGER)",
    "num_medications": "CAST(o_custkey % 40 + 1 AS INTEGER)",
    "number_emergency": "CAST(CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 4 + 1 ELSE 0 END AS INTEGER)",
    "number_diagnoses": "CAST(o_orderkey % 9 + 1 AS INTEGER)",
    "diag_1": "CASE WHEN o_orderkey % 50 = 0 THEN '?' ELSE CAST(o_custkey AS VARCHAR(20)) END",
    "insulin": DRUGS,
    "readmitted": "CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'NO' WHEN o_orderstatus = 'O' THEN '>30' ELSE '<30' END",
}

SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in COLUMNS.items()) + " FROM orders"


def encounters(spark, sf):
    return table(spark, sf, "orders").select(*[F.expr(e).alias(c) for c, e in COLUMNS.items()])
