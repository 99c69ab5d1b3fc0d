"""Quality scores from document statistics: random Fourier features, ridge, isotonic calibration.

Statistics are computed from whole texts in one pass.  Random cosines of their
standardised values approximate a Gaussian kernel, so that kernel ridge
regression becomes linear: every task adds up its part of the normal equations,
the parts are added in two levels, and one small system is solved.  A held-back
fifth of the training rows calibrates the scores by pooling adjacent violators
over a fixed grid.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, saved, shingles, text_slices

N_COSINES = 256
RIDGE = 1e-3
#: Cells of the grid on which raw scores between -1 and 2 are calibrated.
GRID = 3000
_ADDERS = 8

_KINDS = np.zeros(256, dtype=np.int64)  # the kinds of bytes that are counted
for _k, _bytes in enumerate(
    [
        b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n",
        b".", b",", b"!?", b"|", b"#$%&*^~=+<>{}[]\\_", b"@/:;-'\"()`", bytes(range(128, 256)),
    ],
    start=1,
):
    _KINDS[np.frombuffer(_bytes, np.uint8)] = _k
_N_KINDS = 13
N_STATISTICS = _N_KINDS + 11


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of :data:`N_STATISTICS` numbers per text; a null or empty text gives zeros."""
    n = len(texts)
    words = Words(texts)
    owner = np.repeat(np.arange(n), np.diff(words.base))
    kinds = np.bincount(owner * _N_KINDS + _KINDS[words.raw[: len(owner)]], minlength=n * _N_KINDS)
    kinds = kinds.reshape(n, _N_KINDS).astype(float)
    kinds[:, 5] -= 1  # the line feed that ends each text in the buffer
    size = np.maximum(kinds.sum(axis=1), 1)
    count = words.count
    safe = np.maximum(count, 1)
    length = (words.end - words.start).astype(float)
    by_doc = lambda values: np.bincount(words.doc, weights=values, minlength=n)
    mean = by_doc(length) / safe
    spread = np.sqrt(np.maximum(by_doc(length**2) / safe - mean**2, 0))

    def distinct(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values of each text, and how often the commonest one occurs."""
        order = np.lexsort((values, doc))
        v, d = values[order], doc[order]
        new = np.ones(len(v), dtype=bool)
        new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(new)
        most = np.zeros(n)
        np.maximum.at(most, d[at], np.diff(np.append(at, len(v))))
        return np.bincount(d[at], minlength=n), most

    kinds_of_words, commonest = distinct(words.hash, words.doc)
    triples = shingles(words.hash, 3)
    inside = words.doc[: len(triples)] == words.doc[len(words.doc) - len(triples) :]
    triples, doc3 = triples[inside], words.doc[: len(inside)][inside]
    kinds_of_triples, commonest3 = distinct(triples, doc3)
    n3 = np.maximum(np.bincount(doc3, minlength=n), 1)
    same = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    repeats = np.bincount(words.doc[1:][same], minlength=n)
    first = words.raw[words.start] if len(words.start) else np.zeros(0, np.uint8)
    last = words.raw[words.end - 1] if len(words.start) else np.zeros(0, np.uint8)
    closed = by_doc(np.isin(_KINDS[last], [8, 9, 10]).astype(float))
    capital = by_doc((_KINDS[first] == 2).astype(float))
    some = (count > 0).astype(float)
    return np.column_stack(
        [
            np.sqrt(kinds / size[:, None]) * some[:, None],
            np.log1p(size) * some, mean, spread, kinds_of_words / safe, commonest / safe,
            kinds_of_triples / n3, commonest3 / n3, repeats / safe, closed / safe, capital / safe,
            np.sqrt((kinds[:, 5] + 1) / safe) * some,
        ]
    )


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: the statistics of each whole text as binary doubles."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                x = statistics(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _binary(x)], names=["doc_id", "x"]
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(measure, "doc_id long, x binary")


def _binary(x: np.ndarray) -> pa.Array:
    x = np.ascontiguousarray(x, dtype=np.float64)
    step = x.shape[1] * 8
    ends = (np.arange(len(x) + 1) * step).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x)])


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, N_STATISTICS))
    return np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), -1)


def added(rows: DataFrame, part) -> np.ndarray | None:
    """Sum over all rows of ``part(batch)``, a vector of fixed length.

    Each task adds up its own rows; a few tasks add up those sums, and the
    driver the rest.  None for an empty table.
    """

    def level(batches: Iterator[pa.RecordBatch], of) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                more = of(batch)
                total = more if total is None else total + more
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() % _ADDERS], pa.int32()),
                 pa.array([np.asarray(total, dtype=np.float64).tobytes()], pa.binary())],
                names=["adder", "total"],
            )

    def gather(batch: pa.RecordBatch) -> np.ndarray:
        return sum(np.frombuffer(b) for b in batch.column("total").to_pylist())

    schema = "adder int, total binary"
    parts = rows.mapInArrow(lambda b: level(b, part), schema)
    sums = parts.repartition(_ADDERS, "adder").mapInArrow(lambda b: level(b, gather), schema).collect()
    return sum(np.frombuffer(r.total) for r in sums) if sums else None


@dataclass
class Model:
    """A fitted scorer; ``weights`` is None if no labelled row was found."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    grid: np.ndarray | None = None
    constant: float = 0.5

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        wave = np.sqrt(2 / N_COSINES) * np.cos(z @ self.directions + self.phases)
        return np.column_stack([wave, z / 10, np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        if self.grid is None:
            return np.clip(self.raw(x), 0, 1)
        at = np.clip((self.raw(x) + 1) / 3 * GRID - 0.5, 0, GRID - 1)
        return np.clip(np.interp(at, np.arange(GRID), self.grid), 0, 1)


def isotonic(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The non-decreasing values closest to ``total / weight``; empty cells are interpolated."""
    at = np.flatnonzero(weight > 0)
    blocks: list[list[float]] = []  # [sum, weight, first cell, last cell]
    for i in at:
        blocks.append([float(total[i]), float(weight[i]), i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][3] = last
    where = [p for b in blocks for p in (b[2], b[3])]
    value = [b[0] / b[1] for b in blocks for _ in range(2)]
    return np.interp(np.arange(len(weight)), where, value)


def fold(doc_id: Column) -> Column:
    """0 to 4, by the checksum of the id's text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def fit(found: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """Fit on ``found (doc_id, x)`` and ``labels (doc_id, label)``; fold 1 calibrates, 2 to 4 train.

    Rows of fold 0 are never looked at.  A null label is no label.
    """
    known = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").select(
        "doc_id", F.col("label").cast("double").alias("label")
    )
    rows = saved(
        found.where(fold(F.col("doc_id")) > 0)
        .join(known, "doc_id")
        .select(fold(F.col("doc_id")).cast("int").alias("fold"), "x", "label"),
        "labelled",
    )

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch.column("x"))
        y = batch.column("label").to_numpy()
        return np.concatenate(([len(x), y.sum()], x.sum(axis=0), (x**2).sum(axis=0)))

    rng = np.random.default_rng(seed)
    d = N_STATISTICS
    model = Model(
        np.zeros(d), np.ones(d), rng.standard_normal((d, N_COSINES)) / np.sqrt(d),
        rng.uniform(0, 2 * np.pi, N_COSINES),
    )
    sums = added(rows, moments)
    if sums is None:
        return model
    n, positive = sums[:2]
    model.constant = positive / n
    model.mean = sums[2 : 2 + d] / n
    model.scale = np.sqrt(np.maximum(sums[2 + d :] / n - model.mean**2, 1e-12)) + 1e-6
    if positive in (0, n):
        return model

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        use = batch.column("fold").to_numpy() != 1
        z = model.cosines(_matrix(batch.column("x"))[use])
        y = batch.column("label").to_numpy()[use]
        return np.concatenate(((z.T @ z).ravel(), z.T @ y, [len(y)]))

    total = added(rows, equations)
    k = model.directions.shape[1] + d + 1
    gram, right, used = total[: k * k].reshape(k, k), total[k * k : k * k + k], total[-1]
    if used == 0:
        return model
    penalty = np.full(k, RIDGE * used)
    penalty[-1] = 0
    weights = np.linalg.solve(gram + np.diag(penalty + 1e-9), right)

    def cells(batch: pa.RecordBatch) -> np.ndarray:
        use = batch.column("fold").to_numpy() == 1
        raw = model.cosines(_matrix(batch.column("x"))[use]) @ weights
        cell = np.clip(((raw + 1) / 3 * GRID).astype(int), 0, GRID - 1)
        y = batch.column("label").to_numpy()[use]
        return np.concatenate(
            (np.bincount(cell, minlength=GRID), np.bincount(cell, weights=y, minlength=GRID))
        )

    counted = added(rows, cells)
    model.weights = weights
    if counted[:GRID].sum() > 0:
        model.grid = isotonic(counted[:GRID], counted[GRID:])
    return model


def scores(found: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of each row of statistics."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = model.score(_matrix(batch.column("x")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(value, pa.float64())], names=["doc_id", "score"]
            )

    return found.mapInArrow(score, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, scored where they are read."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                score = model.score(statistics(part.column(at).to_pylist()))
                yield part.filter(pa.array(score >= least))

    return docs.mapInArrow(keep, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, score)`` for all documents, fitted on those with a ``label``.

    Without any label every score is 0.5; with one class it is that label.
    """
    found = saved(features(docs), "statistics")
    return scores(found, fit(found, labels))
