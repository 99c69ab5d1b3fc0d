"""Token-id files in Simple-8b word-aligned coding.

A 64-bit word holds a 4-bit selector and 60 bits of payload: as many of the
next ids as fit at one width.  Selector 15 announces an escape, an id of 60
bits or more that follows in a word of its own.  Ids are coded in blocks of
:data:`BLOCK`, and a file keeps the word offset of each block, so that encoding
and decoding are array operations over many blocks at once.

A file is little-endian: the header, ``doc_id`` and null mark of each document,
its first id's place in the file, the block offsets, the words.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import files_of, saved, scratch, text_slices, write_file
from tidemark.llm.tokens import encoder

BLOCK = 1024
#: ids per word and bits per id, by selector 0..14
COUNTS = np.array([120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
_LIMITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
_SMALL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)
IDS_PER_FILE = 1_000_000
_HEAD = struct.Struct("<8sQQQQI")
_MAGIC = b"IDS8B001"


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words, offsets)``: block ``k`` is ``words[offsets[k]:offsets[k + 1]]``.

    Greedy in each block: a word takes the selector with the most ids whose
    width suffices for all of them; the last word of a block may be part full.
    """
    ids = np.asarray(ids, dtype=np.uint64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64)
    blocks = -(-n // BLOCK)
    # a row per block; the zeros behind its end fit into any word
    width = np.zeros((blocks, BLOCK + int(COUNTS.max())), dtype=np.uint8)
    flat = np.zeros(blocks * BLOCK, dtype=np.uint8)
    small = int(ids.max()) < len(_SMALL)
    flat[:n] = _SMALL[ids.astype(np.intp)] if small else np.searchsorted(_LIMITS, ids, side="right")
    width[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    choice = np.full((blocks, BLOCK), ESCAPE, dtype=np.uint8)
    top = int(flat.max())
    seen = np.zeros((blocks, width.shape[1] + 1), dtype=np.int16)
    rows = columns = None
    # what fits a selector also fits those with fewer ids, so few places are left for many ids
    for selector in range(len(COUNTS) - 1, -1, -1):
        count, most = COUNTS[selector], WIDTHS[selector]
        if top <= most:
            choice[:] = selector
        elif rows is None:
            np.cumsum(width > most, axis=1, dtype=np.int16, out=seen[:, 1:])
            fits = seen[:, count : count + BLOCK] == seen[:, :BLOCK]
            choice[fits] = selector
            if 8 * np.count_nonzero(fits) < fits.size:
                rows, columns = np.nonzero(fits)
        else:
            fits = np.ones(len(rows), dtype=bool)
            for j in range(count):
                fits &= width[rows, columns + j] <= most
            rows, columns = rows[fits], columns[fits]
            choice[rows, columns] = selector
    choice = choice.ravel()
    stop = np.minimum((np.arange(blocks) + 1) * BLOCK, n)
    steps = np.append(COUNTS, 1)
    # follow the chain of words in all blocks side by side
    here = np.arange(0, n, BLOCK)
    starts = []
    while len(here):
        starts.append(here)
        after = here + steps[choice[here]]
        here = after[after < stop[here // BLOCK]]
    first = np.sort(np.concatenate(starts))
    kind = choice[first]
    slots = np.where(kind == ESCAPE, 2, 1)
    place = np.cumsum(slots) - slots
    words = np.zeros(int(slots.sum()), dtype=np.uint64)
    for selector in range(len(COUNTS)):
        mine = np.flatnonzero(kind == selector)
        if not len(mine):
            continue
        word = np.full(len(mine), selector << 60, dtype=np.uint64)
        for j in range(COUNTS[selector] if WIDTHS[selector] else 0):
            source = first[mine] + j
            inside = source < stop[first[mine] // BLOCK]
            value = np.where(inside, ids[np.minimum(source, n - 1)], np.uint64(0))
            word |= value << np.uint64(WIDTHS[selector] * j)
        words[place[mine]] = word
    escaped = np.flatnonzero(kind == ESCAPE)
    words[place[escaped]] = np.uint64(ESCAPE << 60)
    words[place[escaped] + 1] = ids[first[escaped]]
    per_block = np.bincount(first // BLOCK, weights=slots, minlength=-(-n // BLOCK))
    return words, np.concatenate(([0], np.cumsum(per_block))).astype(np.uint64)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of :func:`pack`; any run of blocks can be decoded by its offsets alone."""
    if n == 0:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    if (selector == ESCAPE).any():
        # a raw word may look like anything: an escape counts unless it is itself raw
        for i in np.flatnonzero(selector == ESCAPE):
            if not raw[i]:
                raw[i + 1] = True
    count = np.where(selector == ESCAPE, 0, COUNTS[np.minimum(selector, len(COUNTS) - 1)])
    count = np.where(raw, 1, count)
    block = np.searchsorted(offsets, np.arange(len(words)), side="right") - 1
    before = np.cumsum(count) - count
    base = before[offsets[:-1].astype(np.int64)]  # what earlier blocks count, padding included
    place = block * BLOCK + before - base[block]
    stop = np.minimum((block + 1) * BLOCK, n)
    ids = np.zeros(n, dtype=np.uint64)
    for s in range(1, len(COUNTS)):
        mine = np.flatnonzero((selector == s) & ~raw)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for j in range(COUNTS[s] if len(mine) else 0):
            to = place[mine] + j
            inside = to < stop[mine]
            ids[to[inside]] = (words[mine[inside]] >> np.uint64(WIDTHS[s] * j)) & mask
    ids[place[raw]] = words[raw]
    return ids


def to_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> list[bytes]:
    words, offsets = pack(ids)
    head = _HEAD.pack(_MAGIC, len(doc_ids), len(ids), len(offsets) - 1, len(words), BLOCK)
    return [
        head,
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        np.array([d is None for d in doc_ids], dtype="u1").tobytes(),
        np.concatenate(([0], np.cumsum(counts))).astype("<u8").tobytes(),
        offsets.astype("<u8").tobytes(),
        words.astype("<u8").tobytes(),
    ]


def from_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """``(doc_ids, bounds, ids)`` of one file."""
    magic, docs, n, blocks, size, block = _HEAD.unpack_from(content)
    if magic != _MAGIC or block != BLOCK:
        raise ValueError("not a token-id file")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(content, dtype=kind, count=count, offset=at)
        at += found.nbytes
        return found

    doc_id, null, bounds = take("<i8", docs), take("u1", docs), take("<u8", docs + 1)
    offsets, words = take("<u8", blocks + 1), take("<u8", size)
    names = [None if z else int(d) for d, z in zip(doc_id, null, strict=True)]
    return names, bounds.astype(np.int64), unpack(words, offsets, n)


_LISTED = "name string, part int, chunk int, n_docs long, n_ids long"


def write_ids(
    docs: DataFrame, tokenizer: str, end_id: int, spaced: bool = False, folder: str | None = None
) -> tuple[str, DataFrame]:
    """Encode ``docs (doc_id, text)`` and write id files in ascending ``doc_id`` order.

    Returns the folder and the list of its files in order.  Texts are range
    partitioned and sorted first, so each task writes a run of whole documents
    in files of about :data:`IDS_PER_FILE` ids.  A null text is empty, a null
    ``doc_id`` sorts first, equal ids follow each other in text order.
    """
    folder = folder or scratch(docs.sparkSession, "token-ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, spaced)
        task = TaskContext.get()
        names: list[int | None] = []
        counts: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = chunk = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, chunk
            name = f"ids-{task.partitionId():06d}-{chunk:05d}-{uuid.uuid4().hex}.s8b"
            write_file(
                f"{folder}/{name}", to_file(names, np.concatenate(counts), np.concatenate(parts))
            )
            row = [name, task.partitionId(), chunk, len(names), held]
            names.clear(), counts.clear(), parts.clear()
            held, chunk = 0, chunk + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0]]), *(pa.array([v], pa.int32()) for v in row[1:3]),
                 *(pa.array([v], pa.int64()) for v in row[3:])],
                names=["name", "part", "chunk", "n_docs", "n_ids"],
            )

        for batch in batches:
            for piece in text_slices(batch, "text", 1 << 22):
                ids, bounds = own.encode(piece.column("text"))
                whole = np.full(len(ids) + piece.num_rows, end_id, dtype=np.uint32)
                whole[np.arange(len(ids)) + np.repeat(np.arange(piece.num_rows), np.diff(bounds))] = ids
                names += piece.column("doc_id").to_pylist()
                counts.append(np.diff(bounds) + 1)
                parts.append(whole)
                held += len(whole)
                if held >= IDS_PER_FILE:
                    yield flush()
        if names:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keys = ["doc_id", F.crc32(F.col("text").cast("binary")), "text"]
    ordered = rows.repartitionByRange(*keys[:2]).sortWithinPartitions(*keys)
    return folder, saved(ordered.mapInArrow(write, _LISTED), "token-list")


def read_ids(spark, folder: str, listed: DataFrame) -> DataFrame:
    """Read id files back: one row per document with ``ids`` as little-endian 32-bit binary.

    ``start`` counts the ids of all documents before it, over all files.
    """
    from pyspark.sql.window import Window

    # one row for each file of millions of ids
    before = Window.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    placed = listed.select(
        "name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("ahead")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, ahead in zip(batch.column("content"), batch.column("ahead"), strict=True):
                names, bounds, ids = from_file(content.as_buffer())
                data = ids.astype("<u4")
                ends = np.concatenate(([0], (bounds[1:] * 4))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array(bounds[:-1] + ahead.as_py()),
                        pa.array(np.diff(bounds)),
                        pa.array(
                            [zlib.crc32(data[bounds[i] : bounds[i + 1]]) for i in range(len(names))],
                            pa.int64(),
                        ),
                        pa.Array.from_buffers(
                            pa.binary(), len(names), [None, pa.py_buffer(ends), pa.py_buffer(data)]
                        ),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return files_of(spark, folder, placed).select("content", "ahead").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )
