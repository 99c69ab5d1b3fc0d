"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A signature holds :data:`SYMBOLS` minimum hashes of a document's shingle set.
It is split into chunks of :data:`CHUNK` symbols; signatures at most
:data:`RADIUS` symbols apart have, by the pigeonhole principle, a chunk with at
most one differing symbol.  Every chunk is therefore indexed once for each
symbol it may get wrong, and all pairs within the radius meet under some key.
At a similarity of 0.8 a pair lies beyond the radius with a chance of about
2 in 100,000.

Documents with equal shingle sets form one class, and classes are what is
compared.  First each class is matched with the closest of a few classes drawn
from its keys, which joins large groups by a number of links in proportion to
their size; then every pair of classes that meet, are close enough and are
still in different components is checked, in crowds block by block.  All links
are confirmed on the full shingle sets.  So the components are those of all
links, while a group of thousands of near copies never becomes millions of
pairs.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Words,
    components,
    filter_of,
    in_filter,
    mix,
    saved,
    shingle_sets,
    text_slices,
)

CHUNK = 5
SYMBOLS = 80
RADIUS = 2 * (SYMBOLS // CHUNK) - 1
#: Draws of a class to be matched with before the rest is checked pair by pair.
DRAWS = 4
#: Members that are confirmed against one class in a single task.
MEMBERS_PER_TASK = 2000

#: Classes from which a cell counts as a crowd, and classes in a block of one.
CROWD = 8
BLOCK = 500

_FACTORS = np.random.default_rng(80).integers(1, 2**63, SYMBOLS, dtype=np.int64).astype(
    np.uint64
) * np.uint64(2) + np.uint64(1)
_CHUNK_CODES = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64))
_MULTIPLIERS = mix(np.arange(101, 101 + CHUNK, dtype=np.uint64)) | np.uint64(1)
#: Three bits of each symbol, 21 symbols to a word: equal symbols have equal bits.
_PER_WORD = 21
_WORDS = -(-SYMBOLS // _PER_WORD)
_LOW_BITS = sum(1 << (3 * i) for i in range(_PER_WORD))
_SKETCH = [f"s{i}" for i in range(_WORDS)]


def minhash(shingle_set: np.ndarray) -> np.ndarray:
    """The low 16 bits of :data:`SYMBOLS` minimum hashes of a non-empty set."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingle_set), 4096):
        part = shingle_set[at : at + 4096]
        np.minimum(least, (_FACTORS[:, None] * part[None, :]).min(axis=1), out=least)
    return mix(least).astype(np.uint16)


def sketch(signatures: np.ndarray) -> np.ndarray:
    """Three bits of every symbol, packed into :data:`_WORDS` signed integers per row."""
    bits = np.zeros((len(signatures), _WORDS * _PER_WORD), dtype=np.int64)
    bits[:, :SYMBOLS] = signatures & 7
    shifts = 3 * np.arange(_PER_WORD)
    return (bits.reshape(len(signatures), _WORDS, _PER_WORD) << shifts).sum(axis=2)


def keys(signatures: np.ndarray) -> np.ndarray:
    """One key per chunk and tolerated position: a hash of the chunk's other symbols."""
    n = len(signatures)
    chunks = signatures.astype(np.uint64).reshape(n, SYMBOLS // CHUNK, CHUNK) + np.uint64(1)
    terms = chunks * _MULTIPLIERS
    rest = terms.sum(axis=2, keepdims=True, dtype=np.uint64) - terms
    return mix(rest.reshape(n, SYMBOLS) ^ _CHUNK_CODES).astype(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, n_shingles, set_a, set_b, signature)`` from whole texts.

    ``set_a, set_b`` are a 128-bit digest of the shingle set.  A text without
    words has no shingles and a null signature.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                size, a, b, signs = [], [], [], []
                for found in shingle_sets(Words(part.column("text").to_pylist()), width):
                    size.append(len(found))
                    if not len(found):
                        a.append(None), b.append(None), signs.append(None)
                        continue
                    a.append(int(found.sum(dtype=np.uint64).view(np.int64)))
                    b.append(int(mix(found + np.uint64(77)).sum(dtype=np.uint64).view(np.int64)))
                    signs.append(minhash(found).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(a, pa.int64()),
                     pa.array(b, pa.int64()), pa.array(signs, pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        sign, "doc_id long, n_shingles long, set_a long, set_b long, signature binary"
    )


_CLASS = ["n_shingles", "set_a", "set_b"]


def classes(signed: DataFrame) -> DataFrame:
    """One row per distinct shingle set, named by its smallest ``doc_id``."""
    return (
        signed.where("signature IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(*_CLASS)
        .agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"))
    )


def index(rows: DataFrame) -> DataFrame:
    """``(key, id)`` for every key of every class."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                row = pa.array(np.repeat(np.arange(part.num_rows), SYMBOLS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys(_symbols(part)).ravel()), part.column("id").take(row)],
                    names=["key", "id"],
                )

    return rows.select("id", "signature").mapInArrow(explode, "key long, id long")


def marks(rows: DataFrame) -> DataFrame:
    """``(id, n, s0..)``: size and sketch of every class."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = sketch(_symbols(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_shingles"),
                 *(pa.array(bits[:, i]) for i in range(_WORDS))],
                names=["id", "n", *_SKETCH],
            )

    columns = "".join(f", {s} long" for s in _SKETCH)
    return rows.select("id", "n_shingles", "signature").mapInArrow(draw, f"id long, n long{columns}")


def _symbols(batch: pa.RecordBatch) -> np.ndarray:
    raw = b"".join(batch.column("signature").to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(batch.num_rows, SYMBOLS)


def _apart(a: str, b: str) -> Column:
    """A lower bound of the symbols in which two signatures differ, from their sketches."""
    parts = []
    for s in _SKETCH:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2))
        parts.append(F.bit_count(any_bit.bitwiseAND(F.lit(_LOW_BITS))))
    return functools.reduce(operator.add, parts)


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    """Sets of too different sizes cannot be similar enough."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def drawn_pairs(near: DataFrame, percent: int) -> DataFrame:
    """At most :data:`DRAWS` pairs per class: the closest of the classes drawn from its keys.

    The first draw takes from every key the most central class, the one that
    meets most others over all its keys: in a group of edited copies that is
    the original or the copy with the fewest edits.  The other draws take the
    smallest of some hash, so that the classes of a group draw the same few.
    """
    mark = F.struct("id", "n", *_SKETCH)
    central = near.groupBy("id").agg(F.sum("many").alias("meets"))
    near = near.join(central, "id")
    draws = [F.min(F.struct((-F.col("meets")).alias("h"), mark.alias("m")))] + [
        F.min(F.struct(F.xxhash64("id", F.lit(d)).alias("h"), mark.alias("m"))) for d in range(1, DRAWS)
    ]
    leaders = (
        near.groupBy("key")
        .agg(*[c.alias(f"d{d}") for d, c in enumerate(draws)])
        .select("key", F.posexplode(F.array(*[f"d{d}.m" for d in range(DRAWS)])).alias("draw", "b"))
    )
    met = near.select("key", mark.alias("a")).join(leaders, "key")
    met = met.where(
        (F.col("a.id") != F.col("b.id")) & (_apart("a", "b") <= RADIUS) & _sizes_fit("a", "b", percent)
    )
    return (
        met.groupBy(F.col("a.id").alias("a"), "draw")
        .agg(F.min(F.struct(_apart("a", "b").alias("far"), F.col("b.id").alias("b"))).alias("best"))
        .select("a", F.col("best.b").alias("b"))
        .distinct()
    )


def open_rows(near: DataFrame, labels: DataFrame) -> DataFrame:
    """``near`` with ``component`` and ``cell``, without keys that one component has for itself.

    Every key is headed by its largest component.  Classes that have the most
    keys under the same head share a cell, so that a crowd of copies too
    different to be linked is one cell.  A class in a cell of fewer than
    :data:`CROWD` is in a cell of its own.
    """
    size = labels.groupBy("component").agg(F.count("*").alias("size"))
    known = labels.join(size, "component").select("id", "component", "size")
    rows = near.join(known, "id", "left").select(
        *near.columns, F.coalesce("component", "id").alias("component"),
        F.coalesce("size", F.lit(1)).alias("size"),
    )
    rows = saved(rows, "near-labelled")
    heads = (
        rows.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
             F.max(F.struct("size", (-F.col("component")).alias("c"))).alias("head"))
        .where("lo < hi").select("key", "head")
    )
    rows = saved(rows.drop("size").join(heads, "key"), "near-mixed")
    cells = (
        rows.groupBy("id", "head").agg(F.count("*").alias("n"))
        .groupBy("id").agg(F.max_by("head", F.struct("n", "head")).alias("head"))
        .select("id", (-F.col("head.c")).alias("cell"))
    )
    cells = saved(cells, "cells")
    crowds = cells.groupBy("cell").agg(F.count("*").alias("crowd")).where(F.col("crowd") >= CROWD)
    crowded = saved(cells.join(crowds, "cell").select("id", "cell", "crowd"), "crowds")
    # cells of single classes get numbers that no crowd has
    return rows.drop("head").join(crowded, "id", "left").withColumn(
        "cell", F.coalesce(F.col("cell"), -1 - F.col("id"))
    )


def open_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs under a common key that may be similar, of different components and cells."""
    a, b = rows.alias("a"), rows.alias("b")
    met = a.join(
        b,
        (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id"))
        & (F.col("a.component") != F.col("b.component")) & (F.col("a.cell") != F.col("b.cell"))
        & _sizes_fit("a", "b", percent) & (_apart("a", "b") <= RADIUS),
    )
    return met.select(F.col("b.id").alias("a"), F.col("a.id").alias("b")).distinct()


def links_in_crowds(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links ``(a, b)`` between different components inside each crowd.

    A crowd is cut into blocks of about :data:`BLOCK` classes, and each pair of
    blocks is one task's work: the shingles of one block are indexed, those of
    the other are looked up.  Only links come out.
    """
    members = rows.where("crowd IS NOT NULL").select("id", "component", "cell", "crowd").distinct()
    blocks = F.ceil(F.col("crowd") / BLOCK).cast("int")
    members = members.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks")).cast("int")
    )
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "component", "cell", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    dealt = dealt.join(sets, "id")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, component = table.column("id").to_numpy(), table.column("component").to_numpy()
        found = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("found")]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block = table.column("block").to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        size = np.array([len(x) for x in found])
        shingle = np.concatenate([found[x] for x in left]) if len(left) else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(left)), size[left])
        order = np.argsort(shingle, kind="stable")
        shingle, owner = shingle[order], owner[order]
        out_a, out_b = [], []
        for r in right:
            lo = np.searchsorted(shingle, found[r], side="left")
            n = np.searchsorted(shingle, found[r], side="right") - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(left))
            good = (100 * both >= percent * (size[left] + size[r] - both)) & (both > 0)
            good &= component[left] != component[r]
            out_a.append(np.full(good.sum(), ids[r]))
            out_b.append(ids[left[good]])
        none = np.zeros(0, np.int64)
        return pa.table(
            {"a": np.concatenate([none, *out_a]), "b": np.concatenate([none, *out_b])}
        )

    return dealt.groupBy("cell", "i", "j").applyInArrow(compare, "a long, b long")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()


def sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``(id, found)``: the shingle sets of the documents that ``ids (id)`` names."""
    context = docs.sparkSession.sparkContext
    shipped = context.broadcast(filter_of(ids))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(shipped.value, batch.column("doc_id").to_numpy())))
            for part in text_slices(batch, "text"):
                found = [s.tobytes() for s in shingle_sets(Words(part.column("text").to_pylist()), width)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found, pa.binary())], names=["id", "found"]
                )

    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    sets = rows.mapInArrow(read, "id long, found binary").join(ids, "id", "left_semi")
    # repeated rows of a document would repeat its pairs
    return sets.dropDuplicates(["id"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets have ``100 * intersection >= percent * union``.

    The sets of all ``a`` stream past the set of their ``b``, which is held
    alone; a ``b`` with very many ``a`` is dealt out to several tasks.
    """
    parts = pairs.groupBy("b").agg(
        F.ceil(F.count("*") / MEMBERS_PER_TASK).cast("int").alias("parts")
    )
    members = (
        pairs.join(parts, "b")
        .withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
        .join(sets.select(F.col("id").alias("a"), "found"), "a")
        .select("b", "part", "a", "found")
    )
    heads = (
        parts.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .join(sets.select(F.col("id").alias("b"), "found"), "b")
        .select("b", "part", F.lit(None).cast("long").alias("a"), "found")
    )
    rows = heads.unionByName(members).repartition("b", "part").sortWithinPartitions(
        "b", "part", F.col("a").asc_nulls_first()
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, np.uint64)
        for batch in batches:
            out_a, out_b = [], []
            for b, a, found in zip(*(batch.column(c) for c in ("b", "a", "found")), strict=True):
                mine = np.frombuffer(found.as_buffer(), np.uint64)
                if not a.is_valid:
                    head = mine.copy()
                    continue
                if not len(mine) or not len(head):
                    continue
                at = np.minimum(np.searchsorted(head, mine), len(head) - 1)
                both = int((head[at] == mine).sum())
                if 100 * both >= percent * (len(head) + len(mine) - both):
                    out_a.append(a.as_py()), out_b.append(b.as_py())
            if out_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"]
                )

    return rows.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs (doc_id, text)``.

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased;
    a set holds the distinct shingles of ``width`` words, or the whole of a
    shorter text.  ``component_id`` is the smallest ``doc_id`` that links reach.
    A text without words is linked with nothing.  A null ``doc_id`` is linked
    with nothing either, has a null component and is kept.
    """
    signed = saved(signatures(docs, width), "signatures")
    groups = saved(classes(signed), "classes")
    rows = saved(index(groups), "index")
    shared = rows.groupBy("key").agg(F.count("*").alias("many")).where("many > 1")
    near = saved(rows.join(shared, "key").join(marks(groups), "id"), "near")
    pairs = saved(drawn_pairs(near, percent), "drawn")
    sets = saved(sets_of(docs, _ids(pairs), width), "sets")
    links = saved(confirmed(pairs, sets, percent), "links")
    labels = components(links)
    left = saved(open_rows(near, labels), "open")
    pairs = saved(open_pairs(left, percent), "pairs")
    crowded = left.where("crowd IS NOT NULL").select("id").distinct()
    sets = saved(sets_of(docs, _ids(pairs).union(crowded).distinct(), width), "sets")
    more = confirmed(pairs, sets, percent).union(links_in_crowds(left, sets, percent))
    more = saved(more, "links")
    if not more.isEmpty():
        labels = components(links.union(more), start=labels)
    named = groups.select("id", *_CLASS).join(labels, "id", "left").select(
        *_CLASS, F.coalesce("component", "id").alias("component")
    )
    out = signed.select("doc_id", *_CLASS).join(named, _CLASS, "left")
    return out.select(
        "doc_id", "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        (F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
    )
