"""Set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import combine as U
from tidemark.operators.sampling import stratified_split

from .common import BATCH_SQL, query, table, with_batch


@query(
    "concat_union",
    "SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS extra FROM orders WHERE o_orderkey % 2 = 0 "
    "UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderkey % 3 = 0",
)
def concat_union(spark, sf):
    orders = table(spark, sf, "orders")
    a = orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus")
    b = orders.where("o_orderkey % 3 = 0").select(
        "o_orderkey", F.col("o_orderpriority").alias("extra")
    )
    return U.concatenate([a, b], remove_duplicates=False)


@query(
    "cumulative_dedup",
    "SELECT DISTINCT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0",
)
def cumulative_dedup(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return U.concatenate([orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 3 = 0")])


@query(
    "duplicate_count",
    "WITH g AS (SELECT l_returnflag, l_linestatus, l_quantity, l_discount, count(*) AS n FROM lineitem GROUP BY ALL) "
    "SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_rows, (sum(n) - count(*))::BIGINT AS removed FROM g",
)
def duplicate_count(spark, sf):
    return U.duplicate_count(
        table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    )


@query(
    "overlap_check",
    "SELECT count(*) AS shared FROM orders WHERE o_orderkey % 10 = 0",
)
def overlap_check(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return U.overlap(
        orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 5 = 0"), ["o_orderkey"]
    ).agg(F.count(F.lit(1)).alias("shared"))


@query("split_is_disjoint", "SELECT 0::BIGINT AS shared, count(*) AS n FROM orders")
def split_is_disjoint(spark, sf):
    marked = stratified_split(
        table(spark, sf, "orders"), ["o_orderkey"], "o_orderstatus", 0.3
    )
    shared = U.overlap(
        marked.where("split = 'train'"), marked.where("split = 'test'"), ["o_orderkey"]
    ).agg(F.count(F.lit(1)).alias("shared"))
    return shared.crossJoin(F.broadcast(marked.agg(F.count(F.lit(1)).alias("n"))))


@query(
    "held_out_rest",
    "SELECT event_id, event_type FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE user_id % 4 = 0)",
)
def held_out_rest(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return U.held_out_rest(events, events.where("user_id % 4 = 0"), ["event_id"]).select(
        "event_id", "event_type"
    )


@query(
    "new_categories",
    f"""WITH e AS (SELECT *, {BATCH_SQL} AS b, event_type || CAST(user_id % 60 AS VARCHAR) AS v FROM events),
x AS (SELECT v AS value, bool_or(b = 0 AND user_id < 100) AS r, bool_or(b > 0 AND user_id >= 50) AS c FROM e GROUP BY v)
SELECT value, CASE WHEN NOT r THEN 'new' WHEN NOT c THEN 'vanished' ELSE 'kept' END AS presence FROM x WHERE r OR c""",
)
def new_categories(spark, sf):
    events = with_batch(table(spark, sf, "events")).withColumn(
        "v", F.concat("event_type", (F.col("user_id") % 60).cast("string"))
    )
    return U.category_changes(
        events.where("batch_number = 0 AND user_id < 100"),
        events.where("batch_number > 0 AND user_id >= 50"), "v",
    )


_CUM_COLS = "event_id, user_id, event_type"


@query(
    "cumulative_training_set",
    f"""WITH e AS (SELECT {_CUM_COLS}, {BATCH_SQL} AS b FROM events)
SELECT DISTINCT {_CUM_COLS} FROM e WHERE b < 3 OR (b = 3 AND user_id % 10 < 7)""",
)
def cumulative_training_set(spark, sf):
    events = with_batch(table(spark, sf, "events")).select(
        "event_id", "user_id", "event_type", "batch_number"
    )
    initial = events.where("batch_number = 0").drop("batch_number")
    train_part = events.where("batch_number = 3 AND user_id % 10 < 7")
    return U.cumulative_training_set([initial], events.where("batch_number > 0"), 3, train_part)


@query(
    "lineage_counts",
    f"""WITH e AS (SELECT {BATCH_SQL} AS b FROM events)
SELECT CASE WHEN b = 0 THEN 'base' WHEN b < 3 THEN 'additional' ELSE 'batch' END AS source, count(*) AS n FROM e WHERE b <= 3 GROUP BY 1
UNION ALL SELECT 'combined', count(*) FROM e WHERE b <= 3""",
)
def lineage_counts(spark, sf):
    events = with_batch(table(spark, sf, "events")).select("event_id", "batch_number")
    tagged = U.tag_sources(
        {
            "base": events.where("batch_number = 0"),
            "additional": events.where("batch_number IN (1, 2)"),
            "batch": events.where("batch_number = 3"),
        }
    )
    return U.lineage_counts(tagged)
