"""Shared helpers: scratch folders, checkpoints, word hashes and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves on one machine; on a
    cluster that is an error, because executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str = "step") -> DataFrame:
    """Write an intermediate result as Parquet to the shared folder and read it again.

    Cuts the lineage, survives the loss of executors, and later passes read
    only the columns they need.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_file(path: str, parts: list[bytes]) -> None:
    """Write one file of an archive from a task, to any store that Arrow reaches.

    Callers put the task attempt into the name and list finished files in a
    table that Spark commits, so files of lost or repeated attempts are unused.
    """
    from pyarrow import fs

    store, where = fs.FileSystem.from_uri(path)
    store.create_dir(where.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(where, compression=None) as out:
        for part in parts:
            out.write(part)


def files_of(spark: SparkSession, folder: str, listed: DataFrame) -> DataFrame:
    """``content`` of the files listed by ``name``, with the other columns of the list."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    )
    return found.join(listed, "name")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- words ----------------------------------------------------------------------------------

_BYTE_CODES = np.random.default_rng(20240229).integers(
    1, 2**63, 256, dtype=np.int64
).astype(np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n-1)`` modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_POWER: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """A view of the first ``n`` powers, kept between batches."""
    if len(_POWER.get(base, ())) < n:
        _POWER[base] = _powers(base, 1 << max(20, int(n).bit_length()))
    return _POWER[base][:n]


_UNBASE = pow(_BASE, -1, 1 << 64)


class Words:
    """Word hashes of a batch of texts, computed over one byte buffer.

    ``hash`` holds one 64-bit hash for each word (runs of bytes other than
    ASCII white space, A-Z lower-cased), ``doc`` the text it comes from and
    ``count`` the words of each text.  ``start`` and ``end`` are byte positions
    in the buffer, whose texts begin at ``base``.
    """

    def __init__(self, texts: list[str | None]) -> None:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.fromiter((len(b) + 1 for b in raw), dtype=np.int64, count=len(raw))
        data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        self.base = np.concatenate(([0], np.cumsum(sizes)))
        self.raw = data
        if not len(raw):
            data = data[:0]
        word = ~_SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        power = powers(_BASE, len(data) + 1)
        total = np.concatenate(
            ([np.uint64(0)], np.cumsum(_BYTE_CODES[_LOWER[data]] * power[:-1], dtype=np.uint64))
        )
        # dividing by base**start makes equal words equal wherever they stand
        back = powers(_UNBASE, len(data) + 1)
        self.hash = mix(
            (total[self.end] - total[self.start]) * back[self.start]
            + (self.end - self.start).astype(np.uint64)
        )
        self.doc = np.searchsorted(self.base, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=len(raw)) if len(raw) else np.zeros(0, int)
        self.first = np.concatenate(([0], np.cumsum(self.count)))


_STEPS = [np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64)) for i in range(64)]


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total += hashes[i : i + n] * _STEPS[i]
    return mix(total)


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; a short text is one shingle, an empty one none."""
    every = shingles(words.hash, width)
    for d in range(len(words.count)):
        lo, n = words.first[d], words.count[d]
        if n == 0:
            yield np.zeros(0, dtype=np.uint64)
        elif n < width:
            yield shingles(words.hash[lo : lo + n], int(n))
        else:
            yield np.unique(every[lo : lo + n - width + 1])


def tidy() -> None:
    """Give freed memory back to the system; workers are kept between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``limit`` bytes of text, one row at least."""
    long = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    sizes = np.cumsum(long.to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
    tidy()


# --- a filter of fixed size ----------------------------------------------------------------

_FILTER_BITS = 26


def _positions(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(ids.astype(np.int64).view(np.uint64))
    low = np.uint64((1 << _FILTER_BITS) - 1)
    return (h & low).astype(np.int64), ((h >> np.uint64(32)) & low).astype(np.int64)


def filter_of(ids: DataFrame) -> bytes:
    """A Bloom filter of fixed size (8 MB) over the first column, put together from 64 slices.

    It only saves work: values that it lets through by chance are dropped by the
    join that follows.
    """
    bits = 20

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = _positions(batch.column(0).to_numpy())
            at = np.unique(np.concatenate((p, q)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> bits).astype(np.int32)), pa.array(at)], names=["slice", "at"]
            )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column("at").to_numpy()
            for s in np.unique(at >> bits):
                mine = held.setdefault(int(s), np.zeros(1 << bits, dtype=bool))
                mine[at[(at >> bits) == s] & ((1 << bits) - 1)] = True
        for s, mine in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([np.packbits(mine).tobytes()])],
                names=["slice", "bits"],
            )

    found = np.zeros(1 << _FILTER_BITS, dtype=bool)
    slices = (
        ids.select(F.col(ids.columns[0]).cast("long")).mapInArrow(hashed, "slice int, at long")
        .repartition(16, "slice").mapInArrow(fill, "slice int, bits binary")
    )
    for row in slices.toLocalIterator():
        lo = row["slice"] << bits
        found[lo : lo + (1 << bits)] |= np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
    return np.packbits(found).tobytes()


def in_filter(bits: bytes, values: np.ndarray) -> np.ndarray:
    """Which values may be in the filter."""
    held = np.frombuffer(bits, np.uint8)
    hit = np.ones(len(values), dtype=bool)
    for at in _positions(values):
        hit &= (held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return hit


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` is in ``ids (doc_id)``; null ids stay.

    Rows outside the filter are surely kept and never shuffled; only those it
    lets through meet the ids in a join.
    """
    ids = saved(ids.select(F.col("doc_id").cast("long")).where("doc_id IS NOT NULL").distinct(), "dropped")
    shipped = docs.sparkSession.sparkContext.broadcast(filter_of(ids))
    at = docs.columns.index("doc_id")

    def side(maybe: bool):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(at)
                hit = in_filter(shipped.value, column.fill_null(0).to_numpy(zero_copy_only=False))
                hit &= column.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(hit == maybe))

        return docs.mapInArrow(pick, docs.schema)

    return side(False).union(side(True).join(ids, "doc_id", "left_anti").select(*docs.columns))


# --- connected components -------------------------------------------------------------------


def components(edges: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """``(id, component)`` for the ids in ``edges (a, b)``; the component is its smallest id.

    Each round gives every id the smallest label among itself and its
    neighbours and then jumps to the label of that label.  Labels only fall, so
    the loop ends with the first round that changes none.  ``min`` is combined
    before the shuffle, so a hub with very many links is no hot key.
    """
    both = saved(
        edges.select(F.col("a").alias("id"), F.col("b").alias("other"))
        .union(edges.select(F.col("b").alias("id"), F.col("a").alias("other")))
        .where("id <> other")
        .distinct()
    )
    labels = both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component"))
    if start is not None:
        labels = labels.join(
            start.select("id", F.col("component").alias("known")), "id", "left"
        ).select("id", F.least("component", F.coalesce("known", "component")).alias("component"))
    labels = saved(labels)
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("other"), "component"), "other")
            .groupBy("id")
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, "id", "left").select(
            "id", F.col("component").alias("old"),
            F.least("component", F.coalesce("near", "component")).alias("component"),
        )
        jump = step.select(F.col("id").alias("component"), F.col("component").alias("root"))
        step = saved(
            step.join(jump, "component", "left").select(
                "id", "old", F.least("component", F.coalesce("root", "component")).alias("component")
            )
        )
        labels = step.select("id", "component")
        if step.where("old <> component").isEmpty():
            return labels
