"""Registered queries of this subpackage over the driver tables."""

from __future__ import annotations

import functools
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.llm.common import ORACLE, QUERIES, table

_ROOT = str(Path(__file__).resolve().parents[2])
__all__ = ["ORACLE", "QUERIES"]


def importable(spark) -> None:
    """Let the Python workers of a local session import this package from where it lies."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_simple8b")
def op1(spark, sf_dir):
    """Token ids of all documents through Simple-8b files and back."""
    from tidemark.llm import simple8b

    docs = table(spark, sf_dir, "documents")
    folder, listed = simple8b.write_ids(docs, vocabulary("word_bpe_49k.json"), end_id=2)
    return simple8b.read_ids(spark, folder, listed).drop("ids")


@query("op4_packing")
def op4(spark, sf_dir):
    """Sequences of at most 2048 tokens."""
    from tidemark.llm import packing

    docs = table(spark, sf_dir, "documents")
    cut = packing.pieces(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)
    return packing.pack(cut.drop("ids"), 2048)


_BASE32 = (
    "array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "((('0x' || substr(sha1(h), (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1) "
    "FOR i IN range(0, 32)], '')"
)


@query(
    "op9_warc",
    f"WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS f FROM pages) "
    f"SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest, "
    "CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, "
    "CASE WHEN page_id <> f THEN f END AS refers_to FROM p",
)
def op9(spark, sf_dir):
    """All pages through archives with revisit records and back."""
    from tidemark.llm import warc

    folder, listed = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, folder, listed).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op10_quality")
def op10(spark, sf_dir):
    """Quality scores of all documents, learnt outside the held-out fold."""
    from tidemark.llm import quality

    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = quality.classify(table(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id", (quality.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


_NEARDUP = r"""WITH RECURSIVE w AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + 3], ' ') END AS sh
  FROM w, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS t(i) WHERE len(words) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 80 * (na.n + nb.n - common)),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id WHERE r.root < e.b)
SELECT *, doc_id = component_id AS kept FROM (SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id
FROM documents d JOIN r ON r.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id)"""


@query("op3_neardup", _NEARDUP)
def op3(spark, sf_dir):
    """Components of documents that share four fifths of their four-word shingles."""
    from tidemark.llm import neardup

    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@query("op6_tiling")
def op6(spark, sf_dir):
    """Documents that contain benchmark items, with the share of the item that is covered."""
    from tidemark.llm import tiling

    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_pii")
def op7(spark, sf_dir):
    """Personal data in all documents."""
    from tidemark.llm import pii

    docs = table(spark, sf_dir, "documents")
    return pii.spans(docs, pii.fit(docs))


@query("op8_hnsw")
def op8(spark, sf_dir):
    """The ten nearest rows of every hundredth embedding."""
    from tidemark.llm import hnsw

    return hnsw.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op5_wrapper")
def op5(spark, sf_dir):
    """Main text of all pages."""
    from tidemark.llm import wrapper

    return wrapper.main_texts(table(spark, sf_dir, "pages"))


@query("op2_sharding")
def op2(spark, sf_dir):
    """All documents in sixteen shards of even counts, copies together."""
    from tidemark.llm import sharding

    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=16)


@query("op11_repair")
def op11(spark, sf_dir):
    """Damaged conversations repaired by the lightest derivation."""
    from tidemark.llm import repair

    return repair.repaired(table(spark, sf_dir, "conversations"))


@query("op12_runs")
def op12(spark, sf_dir):
    """Periodic runs of words in all documents."""
    from tidemark.llm import runs

    return runs.periodic_runs(table(spark, sf_dir, "documents"))


def _licenses_sql():
    from tidemark.llm import licenses

    return licenses.oracle_sql()


@query("op13_licenses", _licenses_sql())
def op13(spark, sf_dir):
    """License phrases and templates in all documents."""
    from tidemark.llm import licenses

    return licenses.scan(table(spark, sf_dir, "documents"))
