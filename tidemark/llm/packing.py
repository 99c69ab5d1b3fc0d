"""Best-fit packing of token sequences by the sum of squares.

Documents are tokenised where they are read; what is shuffled is one small row
per piece.  Pieces of the full length fill a sequence alone.  Every other piece
goes, longest first, to the open sequence for which the sum over all gaps of
(number of open sequences with that gap) squared becomes smallest; a new one is
opened only for a piece that fits nowhere.  Tasks pack about :data:`PIECES_PER_TASK` pieces each on their own;
what that costs is at most a few part-filled sequences per task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, text_slices
from tidemark.llm.tokens import CACHED_WORDS, encoder

PIECES_PER_TASK = 400_000


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, spaced: bool = True,
    cached: int = CACHED_WORDS,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids)`` of each document's token pieces.

    A null or empty text is the end id alone.  Documents longer than
    ``capacity`` are cut into pieces of that length, the first one shorter if
    they do not divide.  ``ids`` is little-endian 32-bit binary.  ``cached`` is
    the number of words whose ids a worker keeps, for jobs short of memory.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, spaced, cached)
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                ids, bounds = own.encode(part.column("text"))
                size = np.diff(bounds) + 1
                whole = np.full(len(ids) + len(size), end_id, dtype="<u4")
                whole[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size - 1)] = ids
                count = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = size - (count - 1) * capacity
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[row], capacity)
                at = np.concatenate(([0], np.cumsum(length)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start.astype(np.int64)),
                        pa.array(length.astype(np.int64)),
                        pa.array(
                            [zlib.crc32(whole[at[i] : at[i + 1]]) for i in range(len(row))], pa.int64()
                        ),
                        pa.Array.from_buffers(
                            pa.binary(), len(row),
                            [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(whole)],
                        ),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    )


def assign(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of each length by the sum-of-squares rule, longest first.

    Ties go to the smallest gap.
    """
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    counts = np.zeros(capacity + 1, dtype=np.int64)
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        gap = capacity
        if s < capacity:
            # the change of the sum, halved and less a constant: N(gap - s) - N(gap)
            change = np.where(counts[s:] > 0, -counts[s:], 1 << 40)
            change[1:] += counts[1 : capacity - s + 1]
            change[0] -= 1  # a bin that becomes full leaves the sum
            best = int(np.argmin(change))
            if change[best] < 1 << 39:
                gap = best + s
        if gap == capacity:
            bins[i], made = made, made + 1
        else:
            counts[gap] -= 1
            bins[i] = open_bins[gap].pop()
            offsets[i] = capacity - gap
        if gap > s:
            counts[gap - s] += 1
            open_bins[gap - s].append(int(bins[i]))
    return bins, offsets


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of at most ``capacity``.

    Any other columns are kept.  An empty table gives an empty result.
    """
    cut = saved(cut, "pieces")
    spark = cut.sparkSession
    tasks = max(1, -(-cut.count() // PIECES_PER_TASK))
    schema = cut.drop("sequence_id", "offset").schema
    columns = schema.names

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        bins, offsets = assign(rows.column("length").to_numpy(), capacity)
        base = np.int64(TaskContext.get().partitionId()) << np.int64(32)
        done = rows.append_column("sequence_id", pa.array(bins + base))
        yield from done.append_column("offset", pa.array(offsets)).to_batches(max_chunksize=10_000)

    key = F.xxhash64("doc_id", "piece") if "piece" in columns else F.xxhash64("doc_id")
    dealt = cut.select(*columns).repartition(tasks, key)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return dealt.mapInArrow(place, f"{types}, sequence_id long, offset long")
