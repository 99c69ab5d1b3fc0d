"""Source and sink queries: written under a fresh shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluate as E
from tidemark.operators import sampling as W
from tidemark.session import shared_dir
from tidemark.sources import artifacts as A
from tidemark.sources import batches as BT
from tidemark.sources import runlog as L
from tidemark.sources import tables as S

from .common import BATCH_SQL, query, r, rounded, table, two_models, with_batch
from .evaluating import _AUC, _ROC
from .reporting import _HPO, hpo_runs

_CSV_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, split STRING"


@query(
    "io_csv_roundtrip",
    "SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, "
    "CASE WHEN o_orderkey % 3 = 0 THEN 'test' ELSE 'train' END AS split FROM orders",
)
def io_csv_roundtrip(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "P", "?").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, "test").otherwise("train").alias("split"),
    )
    path = shared_dir(spark, "splits")
    S.write_splits(orders, path, fmt="csv")
    return S.read_csv(spark, path, _CSV_SCHEMA, null_markers=("", "?", "None", "NA"))


@query(
    "io_prune_batches",
    f"SELECT event_id, value, {BATCH_SQL} AS batch_number FROM events WHERE {BATCH_SQL} < 3",
)
def io_prune_batches(spark, sf):
    path = shared_dir(spark, "batches")
    rows = with_batch(table(spark, sf, "events")).select("event_id", "value", "batch_number")
    S.write_splits(rows, path, "batch_number")
    return S.read_batches_before(spark, path, 3)


@query("io_read_batch", f"SELECT event_id, value, {BATCH_SQL} AS batch_number FROM events WHERE {BATCH_SQL} = 2")
def io_read_batch(spark, sf):
    path = shared_dir(spark, "batches")
    rows = with_batch(table(spark, sf, "events")).select("event_id", "value", "batch_number")
    S.write_splits(rows, path, "batch_number")
    return S.read_batch(spark, path, 2)


@query(
    "test_set_get_or_create",
    f"""WITH b AS (SELECT event_id, event_type, md5('42:' || event_id) AS h FROM events WHERE {BATCH_SQL} = 1),
c AS (SELECT event_type, count(*) AS c FROM b GROUP BY 1), t AS (SELECT *, sum(c) OVER () - ceil(sum(c) OVER () * 0.3::DOUBLE) AS draw, sum(c) OVER () AS n FROM c),
s AS (SELECT *, c / n::DOUBLE * draw AS share FROM t),
q AS (SELECT event_type, floor(share) + (row_number() OVER (ORDER BY share - floor(share) DESC, event_type) <= draw - sum(floor(share)) OVER ())::INT AS k FROM s)
SELECT event_id, event_type, 1 AS batch_number FROM b JOIN q USING (event_type) QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY h) > max(k) OVER (PARTITION BY event_type)""",
)
def test_set_get_or_create(spark, sf):
    """Created on first use, read unchanged on the second, even for other input."""
    events = with_batch(table(spark, sf, "events")).where("batch_number = 1").select(
        "event_id", "event_type", "batch_number"
    )
    path = shared_dir(spark, "test-sets")
    S.get_or_create_test_set(events, path, 1, ["event_id"], "event_type", 0.3)
    return S.get_or_create_test_set(
        events.where("event_id % 2 = 0"), path, 1, ["event_id"], "event_type", 0.3
    ).select("event_id", "event_type", "batch_number")


@query(
    "batch_discovery",
    f"SELECT {BATCH_SQL}::BIGINT AS batch_number, 1::BIGINT AS files, TRUE AS has_bytes FROM events GROUP BY 1",
)
def batch_discovery(spark, sf):
    """Discovered files per batch directory, as a scheduler would count them."""
    path = shared_dir(spark, "arrivals")
    rows = with_batch(table(spark, sf, "events")).select("event_id", "value", "batch_number")
    S.write_splits(rows.repartition("batch_number"), path, "batch_number", fmt="csv")
    found = BT.list_batches(spark, path, "part-*.csv")
    number = F.regexp_extract("path", r"batch_number=(-?\d+)", 1).cast("bigint")
    return found.groupBy(number.alias("batch_number")).agg(
        F.count(F.lit(1)).alias("files"), (F.sum("size_bytes") > 0).alias("has_bytes")
    )


@query(
    "runlog_append",
    f"SELECT run_id, model_name, round(val_f1_score, 6) AS val_f1_score FROM ({_HPO}) WHERE val_f1_score > 200 ORDER BY start_time DESC, run_id LIMIT 200",
)
def runlog_append(spark, sf):
    path = shared_dir(spark, "runs")
    runs = hpo_runs(spark, sf)
    L.append(runs.where("CAST(run_id AS BIGINT) % 2 = 0"), path)
    L.append(runs.where("CAST(run_id AS BIGINT) % 2 = 1"), path)
    t = L.search(spark, path, F.col("metrics")["val_f1_score"] > 200, "training")
    return t.select(
        "run_id", F.col("tags")["model_name"].alias("model_name"),
        r(F.col("metrics")["val_f1_score"]).alias("val_f1_score"),
    )


@query(
    "io_json_artifact",
    f"{_ROC}, {_AUC} SELECT pts.model, count(*) AS points, round(max(auc), 6) AS auc FROM pts JOIN a ON pts.model = a.model GROUP BY pts.model",
)
def io_json_artifact(spark, sf):
    scores = two_models(spark, sf)
    docs = A.roc_arrays(
        E.roc_points(scores, "label", "score", ["model"]), E.auc(scores, "label", "score", ["model"])
    )
    path = shared_dir(spark, "roc")
    A.write_json(docs, path)
    back = A.read_json(
        spark, path, "model string, fpr array<double>, tpr array<double>, auc double"
    )
    return rounded(
        back.select("model", F.size("fpr").cast("bigint").alias("points"), "auc"), ["auc"]
    )


@query(
    "io_split_write",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n FROM orders),
i AS (SELECT *, floor(n * 0.2)::BIGINT AS i FROM r), m AS (SELECT *, i - ceil(i * 0.15::DOUBLE)::BIGINT AS tv FROM i),
k AS (SELECT *, tv - ceil(tv * (0.15::DOUBLE / (1.0::DOUBLE - 0.15::DOUBLE)))::BIGINT AS t FROM m)
SELECT CASE WHEN rn <= t THEN 'initial_train' WHEN rn <= tv THEN 'initial_validation' WHEN rn <= i THEN 'initial_test' ELSE 'future' END AS split,
  count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM k GROUP BY 1""",
)
def io_split_write(spark, sf):
    """The chronological split written as one directory per part."""
    orders = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    path = shared_dir(spark, "chronological")
    S.write_splits(W.chronological_split(orders, ["o_orderdate", "o_orderkey"]), path)
    return spark.read.parquet(path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )
