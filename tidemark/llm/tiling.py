"""Benchmark decontamination by greedy string tiling.

Documents are scanned once.  Their five-word shingles are looked up in a filter
of fixed size over the shingles of all benchmark items, and what remains - a
few word hashes around the hits - is joined with the items on shared seeds.
Each pair of document and item is then tiled: the longest common run of words
that no earlier tile covers is marked, again and again, and the share of the
item's words under tiles decides.  Tiles may lie in any order, so a reordered
passage is found like a verbatim one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, filter_of, in_filter, saved, shingles, text_slices

MIN_MATCH = 5
#: Share of an item's words that tiles must cover.
COVERAGE = 0.5


def greedy_tiles(
    place: np.ndarray, words: np.ndarray, item: np.ndarray, min_match: int = MIN_MATCH
) -> list[tuple[int, int, int]]:
    """Tiles ``(place in the document, place in the item, length)``, longest first.

    ``words`` are the hashes of the document's words at ``place``; words that
    are left out there end a run.  Equal windows of ``min_match`` words are
    found by their Karp-Rabin hashes and joined to maximal runs; a run that a
    longer tile partly covers comes back with what is left of it.  Ties go to
    the earlier place in the document, then in the item.
    """
    n, m = len(words) - min_match + 1, len(item) - min_match + 1
    if n <= 0 or m <= 0:
        return []
    mine, other = shingles(words, min_match), shingles(item, min_match)
    whole = place[min_match - 1 :] - place[:n] == min_match - 1
    order = np.argsort(other, kind="stable")
    lo = np.searchsorted(other[order], mine, side="left")
    hi = np.where(whole, np.searchsorted(other[order], mine, side="right"), lo)
    count = np.maximum(hi - lo, 0)
    if not count.sum():
        return []
    i = np.repeat(np.arange(n), count)
    j = order[np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())]
    start = place[i]
    # points on one diagonal with consecutive places form a run
    by = np.lexsort((start, start - j))
    start, j, i = start[by], j[by], i[by]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] - j[1:] != start[:-1] - j[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(start))) + min_match - 1
    heap = [
        (-int(k), int(p), int(q)) for k, p, q in zip(length, start[at], j[at], strict=True)
    ]
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item = np.zeros(len(item), dtype=bool)
    tiles = []
    while heap:
        k, p, q = heapq.heappop(heap)
        free = ~in_item[q : q - k] & np.array([x not in in_doc for x in range(p, p - k)])
        if free.all():
            tiles.append((p, q, -k))
            in_doc.update(range(p, p - k))
            in_item[q : q - k] = True
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
        for a, b in zip(edge[0::2], edge[1::2], strict=True):
            if b - a >= min_match:
                heapq.heappush(heap, (-int(b - a), p + int(a), q + int(a)))
    return tiles


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """``(item_id, n_words, words)`` of items with at least :data:`MIN_MATCH` words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Words(batch.column("text").to_pylist())
            found = [w.hash[w.first[d] : w.first[d + 1]].tobytes() for d in range(len(w.count))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(w.count, pa.int64()), pa.array(found, pa.binary())],
                names=["item_id", "n_words", "words"],
            )

    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(read, "item_id long, n_words long, words binary").where(
        F.col("n_words") >= MIN_MATCH
    )


def seeds(items: DataFrame) -> DataFrame:
    """``(seed, item_id, times)``: the distinct shingles of each item and how often it has them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(batch.column("item_id"), batch.column("words"), strict=True):
                found, times = np.unique(
                    shingles(np.frombuffer(words.as_buffer(), np.uint64), MIN_MATCH), return_counts=True
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array([item.as_py()] * len(found), pa.int64()),
                     pa.array(times, pa.int64())],
                    names=["seed", "item_id", "times"],
                )

    return items.select("item_id", "words").mapInArrow(cut, "seed long, item_id long, times long")


def hits(docs: DataFrame, seeds_of_items: DataFrame) -> DataFrame:
    """``(doc_id, seeds, place, words)`` of documents that share a seed with some item.

    ``place`` and ``words`` are the positions (32 bits) and hashes (64 bits) of
    the words under shared seeds.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(filter_of(seeds_of_items.select("seed")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                w = Words(part.column("text").to_pylist())
                every = shingles(w.hash, MIN_MATCH)
                n = len(every)
                inside = w.doc[:n] == w.doc[len(w.doc) - n :]
                at = np.flatnonzero(inside & in_filter(shipped.value, every.view(np.int64)))
                if not len(at):
                    continue
                rows = []
                for d in np.unique(w.doc[at]):
                    own = at[w.doc[at] == d]
                    near = np.unique((own[:, None] + np.arange(MIN_MATCH)).ravel())
                    rows.append(
                        (
                            int(d), np.unique(every[own]).view(np.int64),
                            (near - w.first[d]).astype(np.int32).tobytes(), w.hash[near].tobytes(),
                        )
                    )
                row, found, place, words = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)),
                     pa.array(found, pa.list_(pa.int64())), pa.array(place, pa.binary()),
                     pa.array(words, pa.binary())],
                    names=["doc_id", "seeds", "place", "words"],
                )

    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    return rows.mapInArrow(scan, "doc_id long, seeds array<long>, place binary, words binary")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``(doc_id, item_id, n_words, covered, n_tiles, longest, coverage)`` of pairs above the threshold.

    Null and empty texts, items of fewer than :data:`MIN_MATCH` words and rows
    without an id match nothing.  If a ``doc_id`` or an ``item_id`` occurs more
    than once, the pair's best tiling is returned.
    """
    items = saved(benchmark_words(benchmark).where("item_id IS NOT NULL"), "items")
    known = saved(seeds(items), "seeds")
    found = saved(hits(docs, known), "hits")
    shared = (
        found.select("doc_id", F.explode("seeds").alias("seed"))
        .join(known, "seed")
        .groupBy("doc_id", "item_id")
        .agg(F.sum("times").alias("n_seeds"))
    )
    # seeds that the item has k times in all cover at most MIN_MATCH * k of its words
    pairs = (
        shared.join(items, "item_id")
        .where(F.col("n_seeds") * MIN_MATCH >= F.col("n_words") * coverage)
        .select("doc_id", "item_id", "n_words", F.col("words").alias("item"))
    )
    rows = pairs.join(found.select("doc_id", "place", "words"), "doc_id")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for place, words, item in zip(
                *(batch.column(c) for c in ("place", "words", "item")), strict=True
            ):
                tiles = greedy_tiles(
                    np.frombuffer(place.as_buffer(), np.int32),
                    np.frombuffer(words.as_buffer(), np.uint64),
                    np.frombuffer(item.as_buffer(), np.uint64),
                )
                sizes = [t[2] for t in tiles]
                out.append((sum(sizes), len(sizes), max(sizes, default=0)))
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "item_id", "n_words")),
                 *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "item_id", "n_words", "covered", "n_tiles", "longest"],
            )

    tiled = rows.mapInArrow(
        tile,
        "doc_id long, item_id long, n_words long, covered long, n_tiles long, longest long",
    ).withColumn("coverage", F.col("covered") / F.col("n_words"))
    best = F.max_by(
        F.struct("n_words", "covered", "n_tiles", "longest", "coverage"),
        F.struct("coverage", "covered", "longest"),
    )
    return (
        tiled.where(F.col("coverage") >= coverage)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.*")
    )
