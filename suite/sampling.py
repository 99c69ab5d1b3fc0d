"""Split and sample queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import sampling as W
from tidemark.operators.ranks import hash_split

from .common import query, table

_O = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, md5('42:' || o_orderkey) AS h FROM orders"


@query(
    "split_chronological",
    """WITH n AS (SELECT count(*) AS n, floor(count(*) * 0.2)::BIGINT AS i FROM orders),
m AS (SELECT *, i - ceil(i * 0.15::DOUBLE)::BIGINT AS tv FROM n),
k AS (SELECT *, tv - ceil(tv * (0.15::DOUBLE / (1.0::DOUBLE - 0.15::DOUBLE)))::BIGINT AS t FROM m),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, CASE WHEN rn <= t THEN 'initial_train' WHEN rn <= tv THEN 'initial_validation'
  WHEN rn <= i THEN 'initial_test' ELSE 'future' END AS split FROM r, k""",
)
def split_chronological(spark, sf):
    df = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return W.chronological_split(df, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "split")


@query(
    "split_stratified",
    f"""WITH o AS ({_O}), c AS (SELECT o_orderstatus, count(*) AS c FROM o GROUP BY 1),
t AS (SELECT *, sum(c) OVER () - ceil(sum(c) OVER () * 0.3::DOUBLE) AS draw, sum(c) OVER () AS n FROM c),
s AS (SELECT *, c / n::DOUBLE * draw AS share FROM t),
q AS (SELECT o_orderstatus, floor(share) + (row_number() OVER (ORDER BY share - floor(share) DESC, o_orderstatus)
  <= draw - sum(floor(share)) OVER ())::INT AS k FROM s)
SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY h) <= k
  THEN 'train' ELSE 'test' END AS split FROM o JOIN q USING (o_orderstatus)""",
)
def split_stratified(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return W.stratified_split(df, ["o_orderkey"], "o_orderstatus", 0.3)


@query(
    "sample_per_stratum_deep",
    f"SELECT o_orderkey, o_orderstatus FROM ({_O}) QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY h) "
    "<= floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.25)",
)
def sample_per_stratum_deep(spark, sf):
    """A quarter of each status through the three-pass selection for large tables."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    marked = hash_split(
        df, ["o_orderkey"], 42, {"in": lambda n: F.floor(n * F.lit(0.25))}, ["in"], None, "side",
        ["o_orderstatus"],
    )
    return marked.where("side = 'in'").drop("side")


@query(
    "split_plain",
    f"SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY h) <= (SELECT count(*) - ceil(count(*) * 0.5) FROM orders) "
    f"THEN 'train' ELSE 'test' END AS split FROM ({_O})",
)
def split_plain(spark, sf):
    return W.stratified_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], None)


@query("sample_cap", f"SELECT o_orderkey, o_custkey FROM ({_O}) ORDER BY h LIMIT 5000")
def sample_cap(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return W.sample_rows(df, ["o_orderkey"], 5000)


@query(
    "sample_per_stratum",
    f"SELECT o_orderkey, o_orderpriority FROM ({_O}) QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY h) <= 700",
)
def sample_per_stratum(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return W.sample_per_stratum(df, ["o_orderkey"], ["o_orderpriority"], 700)


_OVER = """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'high' ELSE 'low' END AS stratum FROM orders),
n AS (SELECT least(floor({size} * 0.5), count(*) FILTER (stratum = 'high')) AS nh, count(*) FILTER (stratum = 'low') AS cl FROM o),
c AS (SELECT o_orderkey, stratum, CASE WHEN stratum = 'high' THEN nh ELSE {size} - nh END AS k,
  unnest(range(0, CASE WHEN stratum = 'high' THEN 1 ELSE ceil(({size} - nh) / cl)::BIGINT END)) AS copy FROM o, n)
SELECT o_orderkey, stratum, copy FROM c
QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || o_orderkey || '|' || copy)) <= k"""


@query("oversample", _OVER.format(size=2000))
def oversample(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    out = W.oversample(df, ["o_orderkey"], F.col("o_orderpriority") == "1-URGENT", 2000, 0.5)
    return out.select("o_orderkey", "stratum", "copy")


@query("oversample_repeated", _OVER.format(size=40000))
def oversample_repeated(spark, sf):
    """More rows than the low stratum has: its rows are repeated."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    out = W.oversample(df, ["o_orderkey"], F.col("o_orderpriority") == "1-URGENT", 40000, 0.5)
    return out.select("o_orderkey", "stratum", "copy")


@query(
    "priority_fill",
    f"SELECT o_orderkey, o_orderpriority FROM ({_O}) "
    "ORDER BY CASE WHEN o_orderpriority = '2-HIGH' THEN 0 ELSE 1 END, h LIMIT 4000",
)
def priority_fill(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return W.priority_fill(df, ["o_orderkey"], F.col("o_orderpriority") == "2-HIGH", 4000)


@query(
    "row_window",
    "SELECT o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (ORDER BY o_orderdate, o_orderkey) BETWEEN 501 AND 1500",
)
def row_window(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return W.row_window(df, ["o_orderdate", "o_orderkey"], 500, 1000)


_HI = "o_orderpriority IN ('1-URGENT', '2-HIGH')"


@query(
    "swap_rows",
    f"""WITH b AS (SELECT * FROM ({_O}) WHERE o_orderkey % 4 = 0), hi AS (SELECT * FROM ({_O}) WHERE {_HI}),
q AS (SELECT least(floor(2000 * 0.15), (SELECT count(*) FROM b WHERE NOT ({_HI})), (SELECT count(*) FROM hi)) AS k)
SELECT o_orderkey, o_orderpriority FROM b WHERE {_HI}
UNION ALL SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (ORDER BY md5('42-out:' || o_orderkey)) AS rn
  FROM b WHERE NOT ({_HI})), q WHERE rn > k
UNION ALL SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (ORDER BY md5('42-in:' || o_orderkey)) AS rn
  FROM hi), q WHERE rn <= k""",
)
def swap_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    high = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return W.swap_rows(orders.where("o_orderkey % 4 = 0"), orders, ["o_orderkey"], high, 2000, 0.15)


@query(
    "first_per_entity",
    "SELECT o_custkey, o_orderkey, o_orderdate FROM orders "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
)
def first_per_entity(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return W.first_per_entity(df, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "first_rows_by_price",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders "
    "QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) "
    "<= floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.1)",
)
def first_rows_by_price(spark, sf):
    """The cheapest tenth of each status by exact rank."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return W.first_rows(
        df, ["o_totalprice", "o_orderkey"], lambda n: F.floor(n * F.lit(0.1)), ["o_orderstatus"]
    )
