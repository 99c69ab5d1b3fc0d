"""Nearest neighbours by one hierarchical navigable small-world graph per shard.

Equal vectors are one class, so that copies cannot cut a graph into islands,
and classes are dealt to shards of about :data:`SHARD_ROWS`.  A shard's graph
is stored as flat arrays in a row of a table.  A task takes a group of graphs,
each once, and all queries stream past them; each group answers with its
nearest classes, and the answers are merged and opened into rows.  Scores are
exact distances of the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import parallelism, saved

SHARD_ROWS = 4096
#: Queries that walk through a graph together.
QUERIES_PER_BLOCK = 512
#: Bytes of graphs that one task of the search holds, about.
GRAPH_BYTES = 32 << 20
#: Links of a node on upper layers; the lowest layer has twice as many.
LINKS = 16
EF_BUILD = 80
EF_SEARCH = 160
#: Nodes that a walk of :meth:`Graph.search_many` opens in one step.
OPENED = 8


class Graph:
    """A small-world graph over the rows of ``vectors``.

    ``low`` holds the neighbours of each row on layer 0, padded with -1;
    ``high`` those on layers 1 and up, ``LINKS`` to a layer, where the rows of
    node ``i`` begin at ``offset[i]``.  The graph works in float32 on the
    vectors centred on their mean and divided by their largest deviation, both
    taken in double: far from the origin, or very small or very large, their
    differences would otherwise cancel, underflow or overflow in float32.
    Centre and scale follow from the vectors alone, so a graph read again
    from its arrays searches as the one built.
    """

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, low=None, high=None, entry=-1) -> None:
        exact = np.asarray(vectors, dtype=np.float64)
        self.centre = exact.mean(axis=0) if len(exact) else np.zeros(exact.shape[1:])
        spread = float(np.abs(exact - self.centre).max()) if exact.size else 0.0
        self.scale = spread if spread > 0 and np.isfinite(spread) else 1.0
        self.vectors = np.ascontiguousarray((exact - self.centre) / self.scale, dtype=np.float32)
        self.norms = (self.vectors**2).sum(axis=1)
        self.levels = levels.astype(np.int8)
        n = len(levels)
        self.offset = np.concatenate(([0], np.cumsum(self.levels, dtype=np.int64)))
        self.low = np.full((n, 2 * LINKS), -1, np.int32) if low is None else low.reshape(n, 2 * LINKS)
        rows = int(self.offset[-1])
        self.high = np.full((rows, LINKS), -1, np.int32) if high is None else high.reshape(rows, LINKS)
        self.entry = entry
        self.stamp = np.zeros(n, dtype=np.int64)
        self.now = 0

    def links(self, node: int, layer: int) -> np.ndarray:
        return self.low[node] if layer == 0 else self.high[self.offset[node] + layer - 1]

    def near(self, q: np.ndarray, start: list[tuple[float, int]], ef: int, layer: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest nodes found on a layer, ``(squared distance less |q|^2, node)`` sorted."""
        self.now += 1
        stamp, now = self.stamp, self.now
        for _, i in start:
            stamp[i] = now
        todo = list(start)
        heapq.heapify(todo)
        best = [(-d, i) for d, i in start]
        heapq.heapify(best)
        while todo:
            d, i = heapq.heappop(todo)
            if len(best) >= ef and d > -best[0][0]:
                break
            others = self.links(i, layer)
            others = others[others >= 0]
            others = others[stamp[others] != now]
            if not len(others):
                continue
            stamp[others] = now
            far = self.norms[others] - 2 * (self.vectors[others] @ q)
            for dj, j in zip(far.tolist(), others.tolist(), strict=True):
                if len(best) < ef:
                    heapq.heappush(best, (-dj, j))
                    heapq.heappush(todo, (dj, j))
                elif dj < -best[0][0]:
                    heapq.heapreplace(best, (-dj, j))
                    heapq.heappush(todo, (dj, j))
        return sorted((-d, i) for d, i in best)

    def _chosen(self, found: list[tuple[float, int]], norm: float, most: int) -> list[int]:
        """Neighbours in different directions first: one that is closer to a chosen one waits."""
        nodes = np.array([i for _, i in found])
        own = np.array([d for d, _ in found]) + norm
        v = self.vectors[nodes]
        apart = self.norms[nodes][:, None] + self.norms[nodes][None, :] - 2 * (v @ v.T)
        closest = np.full(len(nodes), np.inf)
        keep, wait = [], []
        for k in range(len(nodes)):
            if len(keep) == most:
                break
            if own[k] <= closest[k]:
                keep.append(k)
                np.minimum(closest, apart[k], out=closest)
            else:
                wait.append(k)
        return nodes[keep + wait[: most - len(keep)]].tolist()

    def _connect(self, node: int, other: int, layer: int) -> None:
        """Add ``other`` to the links of ``node``; a full list is chosen anew."""
        own = self.links(node, layer)
        free = np.flatnonzero(own < 0)
        if len(free):
            own[free[0]] = other
            return
        every = np.append(own, other)
        far = self.norms[every] - 2 * (self.vectors[every] @ self.vectors[node])
        order = np.argsort(far, kind="stable")
        found = [(float(far[k]), int(every[k])) for k in order]
        own[:] = self._chosen(found, float(self.norms[node]), len(own))

    def insert(self, i: int) -> None:
        level = int(self.levels[i])
        if self.entry < 0:
            self.entry = i
            return
        q = self.vectors[i]
        top = int(self.levels[self.entry])
        at = [(float(self.norms[self.entry] - 2 * (self.vectors[self.entry] @ q)), self.entry)]
        for layer in range(top, level, -1):
            at = self.near(q, at, 1, layer)
        for layer in range(min(level, top), -1, -1):
            at = self.near(q, at, EF_BUILD, layer)
            chosen = self._chosen(at, float(self.norms[i]), LINKS)
            self.links(i, layer)[: len(chosen)] = chosen
            for j in chosen:
                self._connect(j, i, layer)
        if level > top:
            self.entry = i

    def search(self, q: np.ndarray, k: int, ef: int = EF_SEARCH) -> np.ndarray:
        q = ((np.asarray(q, dtype=np.float64) - self.centre) / self.scale).astype(np.float32)
        at = [(float(self.norms[self.entry] - 2 * (self.vectors[self.entry] @ q)), self.entry)]
        for layer in range(int(self.levels[self.entry]), 0, -1):
            at = self.near(q, at, 1, layer)
        return np.array([i for _, i in self.near(q, at, max(ef, k), 0)])

    def search_many(self, wanted: np.ndarray, k: int, ef: int = EF_SEARCH) -> np.ndarray:
        """:meth:`search` for many queries at once: a row of nodes each, nearest first, padded with -1.

        The walks run side by side.  A step opens the :data:`OPENED` nearest
        unopened nodes of each walk, so that no walk opens less than alone.
        """
        ef = max(ef, k)
        q = ((np.asarray(wanted, dtype=np.float64) - self.centre) / self.scale).astype(np.float32)
        m, n = len(q), len(self.levels)
        far = self.norms - 2 * (q @ self.vectors.T)
        walk = np.arange(m)
        at = np.full(m, self.entry)
        for layer in range(int(self.levels[self.entry]), 0, -1):
            moving = walk
            while len(moving):
                others = self.high[self.offset[at[moving]] + layer - 1]
                d = np.where(others >= 0, far[moving[:, None], others], np.inf)
                nearest = d.argmin(axis=1)
                row = np.arange(len(moving))
                closer = d[row, nearest] < far[moving, at[moving]]
                at[moving[closer]] = others[row, nearest][closer]
                moving = moving[closer]
        node = np.full((m, ef), -1, np.int64)
        dist = np.full((m, ef), np.inf, np.float32)
        opened = np.ones((m, ef), bool)
        node[:, 0], dist[:, 0], opened[:, 0] = at, far[walk, at], False
        met = np.full(m * n, -1, np.int32)  # the place of a met node among those of its step
        met[walk * n + at] = 0
        flat = far.ravel()
        take = min(OPENED, ef)
        while len(walk):
            nodes, dists, done = node[walk], dist[walk], opened[walk]
            waiting = np.where(done, np.inf, dists)
            pick = np.argpartition(waiting, take - 1, axis=1)[:, :take]
            row = np.arange(len(walk))[:, None]
            some = np.isfinite(waiting[row, pick])
            done[row, pick] = True
            others = np.where(some[:, :, None], self.low[nodes[row, pick]], -1).reshape(len(walk), -1)
            key = walk[:, None] * n + others
            fresh = np.flatnonzero((others >= 0) & (met[key] < 0))
            place = np.arange(len(fresh), dtype=np.int32)
            met[key.ravel()[fresh]] = place
            fresh = fresh[met[key.ravel()[fresh]] == place]  # each node of a step once
            d = np.full(others.size, np.inf, np.float32)
            d[fresh] = flat[key.ravel()[fresh]]
            dists = np.concatenate((dists, d.reshape(others.shape)), axis=1)
            keep = np.argpartition(dists, ef - 1, axis=1)[:, :ef]
            node[walk] = np.concatenate((nodes, others), axis=1)[row, keep]
            dist[walk] = dists[row, keep]
            opened[walk] = np.concatenate((done, np.zeros(others.shape, bool)), axis=1)[row, keep] | ~np.isfinite(dist[walk])
            walk = walk[~opened[walk].all(axis=1)]
        node[~np.isfinite(dist)] = -1
        return np.take_along_axis(node, dist.argsort(axis=1, kind="stable"), axis=1)


def build(vectors: np.ndarray, seed: int = 0) -> Graph:
    rng = np.random.default_rng(seed)
    levels = np.minimum(-np.log(1 - rng.random(len(vectors))) / np.log(LINKS), 12).astype(int)
    graph = Graph(vectors, levels)
    for i in range(len(vectors)):
        graph.insert(i)
    return graph


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """``(vec_id, v)`` of rows that take part.

    Left out are null ids, vectors that are null, empty, zero or hold a null or
    non-finite component, and those whose length is not the commonest one.
    Vectors of floats stay floats, which take half the space.
    """
    kind = vectors.select(column).schema[0].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(column).cast("array<float>" if narrow else "array<double>").alias("v"),
    ).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    size = (
        rows.groupBy(F.size("v").alias("size")).count()
        .orderBy(F.desc("count"), F.desc("size")).limit(1).select("size")
    )
    return rows.join(F.broadcast(size), F.size("v") == F.col("size")).drop("size")  # one row


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """One row per shard of ``rows (vec_id, v)``: ids, vectors and the flat neighbour arrays."""

    def graph_of(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id").combine_chunks()
        ids = table.column("vec_id").to_numpy()
        lists = table.column("v").combine_chunks()
        vectors = lists.flatten().to_numpy().reshape(len(ids), -1)
        shard = table.column("shard")[0].as_py()
        g = build(vectors, seed=shard)
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
                "entry": pa.array([g.entry], pa.int32()), "ids": [ids.tobytes()],
                "vectors": [vectors.tobytes()], "levels": [g.levels.tobytes()],
                "low": [g.low.tobytes()], "high": [g.high.tobytes()],
            }
        )

    dealt = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "v"
    )
    # a graph is much work on few bytes: a task for each, which adaptive execution does not merge
    return dealt.repartitionById(shards, "shard").groupBy("shard").applyInArrow(
        graph_of,
        "shard int, n int, entry int, ids binary, vectors binary, levels binary, low binary, high binary",
    )


def search(index: DataFrame, queries: DataFrame, shards: int, k: int) -> DataFrame:
    """``(query, found, score)``: the ``k`` nearest of every group of shards for ``queries (vec_id, v)``.

    A partition holds the graphs of one group, each once, and then all queries:
    a graph is never repeated for the queries it meets, and what a task holds
    does not grow with their number.
    """
    kind = queries.schema["v"].dataType.elementType
    dtype = np.float32 if isinstance(kind, T.FloatType) else np.float64
    first = queries.select(F.size("v")).first()
    width = first[0] if first else 1
    each = SHARD_ROWS * (width * np.dtype(dtype).itemsize + 8 * LINKS + 8)
    groups = min(shards, max(parallelism(queries.sparkSession), -(-shards // max(1, GRAPH_BYTES // each))))

    graphs = index.select(
        F.pmod("shard", F.lit(groups)).alias("group"), F.lit(0).alias("kind"), "n", "entry", "ids", "vectors",
        "levels", "low", "high", F.lit(None).cast("long").alias("query"),
        F.lit(None).cast(queries.schema["v"].dataType).alias("wanted"),
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("kind"),
        F.col("vec_id").alias("query"), F.col("v").alias("wanted"),
    )
    met = (
        graphs.unionByName(asked, allowMissingColumns=True)
        .repartitionById(groups, "group")
        .sortWithinPartitions("kind")
        .drop("group")
    )

    def graph_of(row: dict) -> tuple[np.ndarray, np.ndarray, Graph]:
        exact = np.frombuffer(row["vectors"], dtype).reshape(row["n"], -1)
        arrays = [np.frombuffer(row[c], np.int32) for c in ("low", "high")]
        graph = Graph(exact, np.frombuffer(row["levels"], np.int8), *arrays, row["entry"])
        return np.frombuffer(row["ids"], np.int64), exact, graph

    def nearest(held, names: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        every = []
        for ids, exact, graph in held:
            at = graph.search_many(wanted, k)
            score = np.array([np.sqrt(((exact[near] - q) ** 2).sum(axis=1)) for near, q in zip(at, wanted, strict=True)])
            every.append((ids[at], score, at < 0))
        found, score, none = (np.concatenate(x, axis=1) for x in zip(*every, strict=True))
        order = np.lexsort((found, score, none), axis=1)[:, :k]
        found, score, none = (np.take_along_axis(x, order, axis=1) for x in (found, score, none))
        return [np.repeat(names, (~none).sum(axis=1)), found[~none], score[~none]]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            graphs = batch.filter(pa.compute.equal(batch.column("kind"), 0))
            held += [graph_of(row) for row in graphs.drop_columns(["query", "wanted"]).to_pylist()]
            batch = batch.select(["kind", "query", "wanted"]).slice(graphs.num_rows)
            for start in range(0, batch.num_rows if held else 0, QUERIES_PER_BLOCK):
                block = batch.slice(start, QUERIES_PER_BLOCK)
                wanted = block.column("wanted").flatten().to_numpy().astype(np.float64)
                names = block.column("query").to_numpy()
                out = nearest(held, names, wanted.reshape(len(names), -1))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["query", "found", "score"])

    return met.mapInArrow(answer, "query long, found long, score double")


def neighbours(
    vectors: DataFrame, is_query, k: int = 10, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each query row.

    ``is_query`` is a condition on ``vec_id``.  Nearness is the Euclidean
    distance, ties go to the smaller id, and a query is not its own neighbour.
    Rows that repeat an id count once.  See :func:`usable` for rows left out.
    """
    rows = saved(usable(vectors, id_column, column).dropDuplicates(["vec_id"]), "vectors")
    # the smallest ids of each class of equal vectors are all that k answers can need
    order = Window.partitionBy("v").orderBy("vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    members = saved(
        ranked.withColumn("class", F.min("vec_id").over(Window.partitionBy("v"))), "classes"
    )
    reps = members.where("rank = 1").select("vec_id", "v")
    count = reps.count()
    shards = max(1, -(-count // SHARD_ROWS))
    index = saved(build_index(reps, shards), "graphs")
    # equal queries are asked once
    asked = rows.where(is_query).join(reps.withColumnRenamed("vec_id", "class"), "v")
    asked = saved(asked.select(F.col("vec_id").alias("query_id"), "class", "v"), "queries")
    wanted = asked.select(F.col("class").alias("vec_id"), "v").dropDuplicates(["vec_id"])
    found = search(index, saved(wanted, "wanted"), shards, k + 1)
    nearest = Window.partitionBy("query").orderBy("score", "found")
    found = found.withColumn("at", F.row_number().over(nearest)).where(F.col("at") <= k + 1)
    opened = (
        asked.select("query_id", F.col("class").alias("query"))
        .join(found, "query")
        .join(members.select(F.col("class").alias("found"), "vec_id"), "found")
        .where("vec_id <> query_id")
    )
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        opened.withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
