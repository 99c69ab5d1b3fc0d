"""Sharding by balanced label propagation.

Documents start in shards dealt by hash.  In each round linked documents look
at the shards of their neighbours and ask to move to the one where most links
lead; a shard admits movers up to its capacity, those with the largest gain
first.  Admission needs counts per shard and class of gain only, never a list
of documents.  At the end the shards are made exactly even: surplus documents,
those without links first, fill the shards that lack some.

The graph may be any table of links; :func:`copy_links` gives the one between
documents with equal texts, a star per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import saved

#: Buckets in which the documents of a shard are counted and numbered.
BUCKETS = 256
_TURNS = 64


def _coin(node: Column, round_: int) -> Column:
    """0 .. :data:`_TURNS` - 1, anew in every round."""
    return F.pmod(F.xxhash64(node, F.lit(round_)), F.lit(_TURNS)).cast("int")


def copy_links(docs: DataFrame) -> DataFrame:
    """``(a, b)`` from each document of a repeated text to the first one; null is a text of its own.

    ``docs`` has ``node, digest``.  Counting is combined before the shuffle and
    only repeated texts are joined back.
    """
    first = (
        docs.groupBy("digest").agg(F.min("node").alias("b"), F.max("node").alias("last"))
        .where("b < last").select("digest", "b")
    )
    return docs.join(first, "digest").where("node <> b").select(F.col("node").alias("a"), "b")


def propagate(
    nodes: DataFrame, links: DataFrame, shards: int, rounds: int = 4
) -> DataFrame:
    """``(node, shard, degree)`` of the linked documents after ``rounds`` of moves.

    ``nodes (node)`` are all documents, ``links (a, b)`` the edges.  A move must
    gain links.  In even rounds documents follow a neighbour with more links
    (ties go by hash), so that of two neighbours one stays; in odd rounds every
    document may move with a chance of one half.
    """
    both = saved(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select(F.col("b").alias("node"), F.col("a").alias("other"))),
        "links",
    )
    dealt = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    state = saved(
        both.groupBy("node").agg(F.count("*").alias("degree")).withColumn("shard", dealt), "shards"
    )
    capacity = nodes.count() // shards
    for round_ in range(rounds):
        seen = both.join(
            state.select(
                F.col("node").alias("other"), "shard",
                F.struct("degree", F.xxhash64("node").alias("h")).alias("reach"),
            ),
            "other",
        )
        votes = seen.groupBy("node", "shard").agg(
            F.count("*").alias("votes"), F.max("reach").alias("reach")
        )
        # most links first, then the shard of the best linked neighbour, then the smaller number
        wish = votes.groupBy("node").agg(
            F.max(F.struct("votes", "reach", (-F.col("shard")).alias("s"))).alias("top"),
            F.map_from_entries(F.collect_list(F.struct("shard", "votes"))).alias("by"),  # at most one entry per shard
        )
        asked = state.join(wish, "node").select(
            "node", "degree", "shard", (-F.col("top.s")).alias("to"),
            (F.col("top.votes") - F.coalesce(F.col("by")[F.col("shard")], F.lit(0))).alias("gain"),
            (F.col("top.reach") > F.struct("degree", F.xxhash64("node").alias("h"))).alias("follows"),
        )
        free = F.col("follows") if round_ % 2 == 0 else _coin(F.col("node"), round_) < _TURNS // 2
        rank = F.least(F.lit(63), F.col("gain")) * _TURNS + _coin(F.col("node"), -1 - round_)
        asked = saved(
            asked.withColumn("rank", F.when(free & (F.col("to") != F.col("shard")) & (F.col("gain") > 0), rank)),
            "wishes",
        )
        # a table of shards times ranks, at most 4096 ranks each
        cells = asked.where("rank IS NOT NULL").groupBy("to", "rank").agg(F.count("*").alias("n"))
        ahead = Window.partitionBy("to").orderBy(F.desc("rank"))
        used = state.groupBy(F.col("shard").alias("to")).agg(F.count("*").alias("used"))
        admitted = (
            cells.withColumn("upto", F.sum("n").over(ahead))
            .join(used, "to", "left")
            .where(F.col("upto") <= capacity - F.coalesce("used", F.lit(0)))
            .groupBy("to").agg(F.min("rank").alias("least"))
        )
        # one row per shard
        moved = asked.join(F.broadcast(admitted), "to", "left")
        go = F.col("rank").isNotNull() & (F.col("rank") >= F.col("least"))
        state = saved(
            moved.select("node", "degree", F.when(go, F.col("to")).otherwise(F.col("shard")).alias("shard")),
            "shards",
        )
    return state


def even_shards(docs: DataFrame, links: DataFrame, shards: int, rounds: int = 4) -> DataFrame:
    """Add ``shard`` and ``slot`` to ``docs``; the counts of the shards differ by one at most.

    ``docs`` has a unique ``node`` and any other columns.  ``slot`` numbers the
    documents of a shard from 0.
    """
    docs = saved(docs, "sized")
    state = propagate(docs.select("node"), links, shards, rounds)
    placed = docs.join(state.select("node", "shard", "degree"), "node", "left").select(
        *docs.columns,
        F.coalesce("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")).alias("at"),
        # what stays longest: linked documents before single ones
        (F.coalesce("degree", F.lit(0)) == 0).cast("int").alias("single"),
        F.pmod(F.xxhash64("node", F.lit(11)), F.lit(BUCKETS)).cast("int").alias("bucket"),
    )
    placed = saved(placed, "placed")
    cell = Window.partitionBy("at", "single", "bucket").orderBy("node")
    # counts of shards x 2 x BUCKETS cells; everything below them is arithmetic
    counts = placed.groupBy("at", "single", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("at").orderBy("single", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    totals = {r["at"]: r["n"] for r in counts.groupBy("at").agg(F.sum("n").alias("n")).collect()}
    size, extra = divmod(sum(totals.values()), shards)
    # the larger shards are those that hold more already
    order = sorted(range(shards), key=lambda s: (-totals.get(s, 0), s))
    target = {s: size + (i < extra) for i, s in enumerate(order)}
    surplus, lack, low, spare = [], [], 0, 0
    for s in range(shards):
        have = totals.get(s, 0)
        surplus.append((s, target[s], low))
        low += max(0, have - target[s])
        if have < target[s]:
            lack.append((s, have, spare, spare + target[s] - have))
            spare += target[s] - have
    spark = docs.sparkSession
    # one row per shard each
    limits = spark.createDataFrame(surplus, "at int, target long, low long")
    gaps = spark.createDataFrame(lack, "gap int, have long, first long, past long")
    numbered = (
        placed.withColumn("place", F.row_number().over(cell) - 1)
        .join(F.broadcast(offsets), ["at", "single", "bucket"])
        .withColumn("place", F.col("place") + F.col("ahead"))
        .join(F.broadcast(limits), "at")
        .withColumn("over", F.when(F.col("place") >= F.col("target"), F.col("low") + F.col("place") - F.col("target")))
    )
    filled = numbered.join(
        F.broadcast(gaps), (F.col("over") >= F.col("first")) & (F.col("over") < F.col("past")), "left"
    )
    return filled.select(
        *docs.columns, F.coalesce("gap", "at").alias("shard"),
        F.when(F.col("gap").isNull(), F.col("place"))
        .otherwise(F.col("have") + F.col("over") - F.col("first")).alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = 16, rounds: int = 4) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of each row of ``docs``.

    Documents with equal texts are linked and kept together as far as even
    shards allow; the law is ``rows``, so counts differ by one at most.  Size
    and checksum are of the UTF-8 text, null counting as empty.  Rows that
    repeat a ``doc_id``, or have none, are documents of their own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
    )
    # a number per row; rows that look alike are numbered within their id
    same = Window.partitionBy("doc_id").orderBy("digest", "size")
    named = saved(
        sized.withColumn("copy", F.row_number().over(same)).withColumn(
            "node",
            F.when(F.col("copy") > 1, F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "copy"))
            .otherwise(F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))),
        ).drop("copy"),
        "documents",
    )
    out = even_shards(
        named.drop("digest"), copy_links(named.select("node", "digest")), shards, rounds
    )
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
