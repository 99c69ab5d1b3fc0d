"""Feature encoding, training and scoring queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.keys import hash_fraction
from tidemark.operators import encode as M
from tidemark.operators import train as T
from tidemark.plans.jobs import baseline_runs
from tidemark.session import ensure_checkpoint_dir, shared_dir

from .common import moment, query, r, rounded, table

_STATUS = ["F", "O", "P"]
_KNOWN = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _encoder(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    seen = orders.where("o_orderpriority <> '1-URGENT'")
    return orders, M.fit_encoder(seen, ["o_totalprice"], ["o_orderstatus", "o_orderpriority"])


@query(
    "onehot_scaled",
    "WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders WHERE o_orderpriority <> '1-URGENT') "
    "SELECT o_orderkey, 'num__o_totalprice' AS feature, round((o_totalprice - m) / d, 6) AS value FROM orders, s "
    + "".join(
        f" UNION ALL SELECT o_orderkey, 'cat__{c}_{v}', ({c} = '{v}')::INT::DOUBLE FROM orders"
        for c, values in (("o_orderstatus", _STATUS), ("o_orderpriority", _KNOWN))
        for v in values
    ),
)
def onehot_scaled(spark, sf):
    """The fitted vector, unpivoted by name; the priority left out of fitting is unknown."""
    orders, model = _encoder(spark, sf)
    names = F.array(*[F.lit(n) for n in M.encoded_names(model)])
    pairs = F.arrays_zip(names.alias("feature"), vector_to_array("features").alias("value"))
    out = M.encode(orders, model).select("o_orderkey", F.explode(pairs).alias("p"))
    return out.select("o_orderkey", F.col("p.feature").alias("feature"), r(F.col("p.value")).alias("value"))


@query(
    "scaled_long",
    "WITH s AS (SELECT avg(value) AS mv, stddev_pop(value) AS sv, avg(user_id) AS mu, stddev_pop(user_id) AS su FROM events) "
    "SELECT event_id, 'value' AS feature, round((value - mv) / sv, 6) AS value FROM events, s UNION ALL "
    "SELECT event_id, 'user_id', round((user_id - mu) / su, 6) FROM events, s",
)
def scaled_long(spark, sf):
    return rounded(M.scaled_long(table(spark, sf, "events"), ["event_id"], ["value", "user_id"]), ["value"])


@query(
    "dummies_drop_first",
    "SELECT o_orderkey, "
    + ", ".join(f"(o_orderstatus = '{v}')::INT AS \"o_orderstatus_{v}\"" for v in _STATUS[1:])
    + ", "
    + ", ".join(f"(o_orderpriority = '{v}')::INT AS \"o_orderpriority_{v}\"" for v in _KNOWN)
    + " FROM orders",
)
def dummies_drop_first(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return M.dummies(df, ["o_orderstatus", "o_orderpriority"])


@query("encoder_save_load", "SELECT count(*) AS rows, 0::BIGINT AS mismatches FROM orders")
def encoder_save_load(spark, sf):
    """A saved and reloaded encoder yields the same vectors."""
    orders, model = _encoder(spark, sf)
    path = shared_dir(spark, "encoder")
    M.save_encoder(model, path)
    both = M.load_encoder(path).transform(
        M.encode(orders, model, "features").withColumnRenamed("features", "first")
    )
    return both.select(
        (vector_to_array("features") != vector_to_array("first")).alias("bad")
    ).agg(F.count(F.lit(1)).alias("rows"), F.count_if("bad").alias("mismatches"))


# the published sizes: default iterations and trees of the libraries, trials of the search's usage line
ITERATIONS = 100
TREES = 100
ROUNDS = 100
TRIALS = 4

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "o_totalprice"]
TEXT = ["l_linestatus", "o_orderpriority"]


def _training(spark, sf):
    """Returned lineitems with order features; 30 % of the orders are held out.

    The joined rows are written once: encoder, class counts, fit and scoring all read them.
    """
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_linestatus",
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority",
        (hash_fraction(42, "o_orderkey") < 0.3).alias("_held"),
    )
    rows = T.written(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), "training")
    mine = rows.where("NOT _held").drop("_held")
    model = M.fit_encoder(mine, NUMERIC, TEXT)
    # the weights know the training rows only
    train = T.with_class_weights(T.spread_for_training(mine))
    keep = ["l_orderkey", "label", "features"]
    return (
        model.transform(train).select(*keep, T.WEIGHT).persist(),
        model.transform(rows.where("_held")).select(*keep),
    )


@query("train_score_lr")
def train_score_lr(spark, sf):
    train, test = _training(spark, sf)
    estimator = T.logistic_regression(train.count(), maxIter=ITERATIONS)
    return T.evaluate(test, T.fitted(estimator, train))


@query("train_score_forest")
def train_score_forest(spark, sf):
    train, test = _training(spark, sf)
    return T.evaluate(test, T.fitted(T.random_forest(numTrees=TREES, maxDepth=5), train))


@query("train_score_gbt")
def train_score_gbt(spark, sf):
    train, test = _training(spark, sf)
    estimator = T.boosted_trees(maxIter=ROUNDS, maxDepth=6, stepSize=0.3)
    ensure_checkpoint_dir(spark)
    return T.evaluate(test, T.fitted(estimator, train))


@query("hpo_random")
def hpo_random(spark, sf):
    """Random search, the winner refitted on the whole training part and evaluated."""
    train, test = _training(spark, sf)
    found, draws = T.random_search(train, trials=TRIALS)
    return T.evaluate(test, found.bestModel).withColumn("trials", F.lit(len(draws)))


@query("batch_scoring")
def batch_scoring(spark, sf):
    train, test = _training(spark, sf)
    model = T.fitted(T.logistic_regression(train.count(), maxIter=ITERATIONS), train)
    return T.score(test, model, ["l_orderkey", "label"])


@query("baseline_row")
def baseline_row(spark, sf):
    train, test = _training(spark, sf)
    model = T.fitted(T.logistic_regression(train.count(), maxIter=ITERATIONS), train)
    scored = T.score(test, model, ["label"]).select(
        F.col("label").cast("int").alias("label"), F.col("probability_score").alias("score")
    )
    runs = baseline_runs(T.written(scored, "scores"), moment("2024-01-01"))
    return runs.select(
        "run_id", "experiment", F.try_element_at("tags", F.lit("decision")).alias("decision"),
        F.explode("metrics").alias("metric", "value"),
    )
