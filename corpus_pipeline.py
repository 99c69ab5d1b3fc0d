"""From raw documents to packed training sequences.

Every stage works on all rows that its predecessor kept.  All but the last
return the columns of the documents; rows are dropped whole, and the personal
data stage replaces spans in ``text`` and renews ``n_chars``.  A null text
counts as empty.  The near-duplicate and decontamination stages number rows and
drop rows, so a ``doc_id`` that repeats with other texts loses nothing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import neardup, packing, pii, quality, tiling
from tidemark.llm.common import saved, without


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose quality score is below 0.3."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    found = saved(quality.features(docs), "statistics")
    return quality.accepted(docs, quality.fit(found, labels), least=0.3)


def _fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column of ``columns`` has it."""
    while name in columns:
        name = "_" + name
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Rows with a number of their own, written so that it is stable, and the number's column.

    Stages decide on rows, not on ids: two texts under one ``doc_id`` are two rows.
    """
    row = _fresh(docs.columns, "_row")
    return saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _keyed(rows: DataFrame, row: str) -> DataFrame:
    """The numbered rows as ``doc_id`` (the number), ``text`` and ``_id`` (the document's id)."""
    return rows.select(F.col(row).alias("doc_id"), "text", F.col("doc_id").alias("_id"))


def _drop_rows(rows: DataFrame, row: str, gone: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` without those whose number is in ``gone (doc_id)``, as ``columns``."""
    ident = _fresh(rows.columns, "_id")
    renamed = rows.withColumnRenamed("doc_id", ident).withColumnRenamed(row, "doc_id")
    left = without(renamed, gone.select("doc_id"))
    return left.drop("doc_id").withColumnRenamed(ident, "doc_id").select(*columns)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: the smallest ``doc_id``, then the first row.

    Rows without an id stay only where no row of their group has one.  The choice
    is a partial aggregation per group; the rows to drop are found by an anti join
    on the row number, so a group that holds a third of all rows is not one task.
    """
    rows, row = _numbered(docs)
    keyed = _keyed(rows, row)
    found = neardup.near_duplicates(keyed.select("doc_id", "text"), width=5, percent=80)
    ranked = found.select("doc_id", "component_id").join(keyed.select("doc_id", "_id"), "doc_id")
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "doc_id")).alias("_first")
    chosen = ranked.groupBy("component_id").agg(first).select(F.col("_first.doc_id").alias("doc_id"))
    gone = ranked.select("doc_id").join(chosen, "doc_id", "left_anti")
    return _drop_rows(rows, row, gone, docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that contain a benchmark item, in one piece or reordered."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, row = _numbered(docs)
    gone = tiling.contaminated(_keyed(rows, row).select("doc_id", "text"), benchmark).select("doc_id")
    return _drop_rows(rows, row, gone, docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind."""
    clean = pii.masked(docs, pii.fit(docs))
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
    )


#: Words whose ids a worker of the packing stage keeps, beside the memory that earlier stages took.
PACKING_WORDS = 200_000


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    cut = packing.pieces(docs, path, end_id=0, capacity=2048, cached=PACKING_WORDS)
    return packing.pack(cut.drop("ids"), 2048)


STAGES = [
    ("quality", quality_stage),
    ("neardup", neardup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither trained scores nor token ids; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    from tidemark.llm.queries import importable

    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
