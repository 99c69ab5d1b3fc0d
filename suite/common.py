"""Registration and shared inputs of the query suite."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sides import flag_sides

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its DuckDB equivalent."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def r(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)


def moment(text: str) -> Column:
    """A literal of the tables' zone-less timestamp type."""
    return F.lit(text).cast("timestamp_ntz")


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]
KINDS = {**{c: "numeric" for c in NUMERIC}, **{c: "categorical" for c in CATEGORICAL}}


def lineitem_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems shipped before 1999 (reference) against the rest, in one scan."""
    rows = table(spark, sf_dir, "lineitem").select(*NUMERIC, *CATEGORICAL, "l_shipdate")
    return flag_sides(rows, F.col("l_shipdate") < moment("1999-01-01")).drop("l_shipdate")


LINEITEM_SRC = (
    "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
    "l_shipdate < TIMESTAMP '1999-01-01' AS is_ref, 0 AS grp FROM lineitem"
)


def with_batch(events: DataFrame) -> DataFrame:
    """Five-day batches counted from 2024-01-01."""
    days = (F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(1704067200000000)) / F.lit(
        5 * 86400 * 1000000
    )
    return events.withColumn("batch_number", F.floor(days).cast("int"))


BATCH_SQL = "CAST(floor((epoch_us(ts) - 1704067200000000) / (5 * 86400 * 1000000.0)) AS INTEGER)"
EVENTS_SRC = (
    "SELECT value, user_id, event_type, b = 0 AS is_ref, b AS grp "
    f"FROM (SELECT *, {BATCH_SQL} AS b FROM events) WHERE b IS NOT NULL"
)


def events_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 0 is the reference, all others are compared with it."""
    rows = with_batch(table(spark, sf_dir, "events")).where("batch_number IS NOT NULL")
    return flag_sides(
        rows.select("value", "user_id", "event_type", "batch_number"), F.col("batch_number") == 0
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with the scores of two models."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return (
        table(spark, sf_dir, "labels")
        .join(docs, "doc_id")
        .select(
            "doc_id", "source", "n_chars", F.col("quality").alias("label"), "toxic",
            (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("score_champion"),
            (F.col("doc_id") % 97 / 97.0).alias("score_challenger"),
        )
    )


LABELLED_SQL = (
    "SELECT l.doc_id, d.source, d.n_chars, l.quality AS label, l.toxic, "
    "d.n_chars / (d.n_chars + 1000.0::DOUBLE) AS score_champion, "
    "(l.doc_id % 97) / 97.0::DOUBLE AS score_challenger "
    "FROM labels l JOIN documents d USING (doc_id)"
)


def two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label, model, score)`` for champion and challenger."""
    return labelled(spark, sf_dir).select(
        "doc_id", "label",
        F.inline(
            F.array(
                F.struct(F.lit("champion").alias("model"), F.col("score_champion").alias("score")),
                F.struct(
                    F.lit("challenger").alias("model"), F.col("score_challenger").alias("score")
                ),
            )
        ),
    )


TWO_MODELS_SQL = (
    f"SELECT doc_id, label, 'champion' AS model, score_champion AS score FROM ({LABELLED_SQL}) "
    f"UNION ALL SELECT doc_id, label, 'challenger', score_challenger FROM ({LABELLED_SQL})"
)
