"""Periodic runs of words by difference-cover longest common extensions.

For each document the words become integer ids.  Longest common extension
queries ``LCE(i, j)`` (how many words agree from ``i`` and ``j`` on) are answered
without a full suffix array: only suffixes that start at positions of a
difference cover modulo ``v`` are sorted (prefix doubling over the sample, since
``i + v`` of a sampled ``i`` is sampled again), the LCPs of neighbouring sampled
suffixes go into a sparse table, and a query compares at most ``v - 1`` words
directly until both positions reach the cover, then asks the sparse table.

Runs are enumerated on a harmonic grid: for each period ``q`` only positions
``0, q, 2q, ...`` are probed, with one forward and one backward LCE each, which
is ``n/1 + n/2 + ... = O(n log n)`` queries.  A run of period ``q`` and length at
least ``4q`` covers some grid position ``i`` together with ``i + 2q``, so every
run is found, and the smallest period of a stretch is the least ``q`` found for it.

Spark reads documents and spreads them over tasks; each task runs the numpy
work on one document at a time (``mapInPandas``).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: a difference cover modulo 7 (every residue is a difference of two members).
COVER_MOD = 7
COVER = (1, 2, 4)
MIN_LENGTH, MIN_EXPONENT = 6, 4

_WORD = regex.compile(r"[^\x20\x09-\x0D]+")
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()

RESULT = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _shift_table(v: int, cover: tuple[int, ...]) -> np.ndarray:
    """``shift[a, b]``: least ``k < v`` with ``a + k`` and ``b + k`` both in the cover (mod ``v``)."""
    member = np.zeros(v, dtype=bool)
    member[list(cover)] = True
    shift = np.full((v, v), -1, dtype=np.int64)
    for a in range(v):
        for b in range(v):
            for k in range(v):
                if member[(a + k) % v] and member[(b + k) % v]:
                    shift[a, b] = k
                    break
    if (shift < 0).any():
        raise ValueError("not a difference cover")
    return shift


_SHIFT = _shift_table(COVER_MOD, COVER)


class CoverLCE:
    """Longest common extensions over one integer sequence."""

    def __init__(self, seq: np.ndarray, v: int = COVER_MOD, cover: tuple[int, ...] = COVER):
        n = len(seq)
        self.n, self.v = n, v
        self.shift = _SHIFT if (v, cover) == (COVER_MOD, COVER) else _shift_table(v, cover)
        # Distinct negative sentinels after the end stop every comparison there.
        pad = v * 2 + 2
        self.seq = np.concatenate([seq.astype(np.int64), -1 - np.arange(pad, dtype=np.int64)])
        member = np.zeros(v, dtype=bool)
        member[list(cover)] = True
        sample = np.nonzero(member[np.arange(n + v) % v])[0]
        self.slot = np.full(n + 2 * v + 2, -1, dtype=np.int64)
        self.slot[sample] = np.arange(len(sample))
        ranks = self._sort(sample)
        order = np.argsort(ranks, kind="stable")
        self.rank = ranks
        lcp = self._neighbour_lcp(sample, order)
        self._table(lcp)

    def _sort(self, sample: np.ndarray) -> np.ndarray:
        """Ranks of the sampled suffixes (ties only for equal suffixes, which cannot occur)."""
        v, seq = self.v, self.seq
        keys = np.stack([seq[sample + k] for k in range(v)][::-1])
        rank = self._dense(keys)
        self.levels = [rank]
        step = 1
        m = len(sample)
        while rank.max(initial=-1) < m - 1:
            reach = sample + step * v
            ahead = np.where(reach < len(self.slot), self.slot[np.minimum(reach, len(self.slot) - 1)], -1)
            nxt = np.where(ahead >= 0, rank[np.maximum(ahead, 0)], -1)
            rank = self._dense(np.stack([nxt, rank]))
            self.levels.append(rank)
            step *= 2
        return rank

    @staticmethod
    def _dense(keys: np.ndarray) -> np.ndarray:
        if keys.shape[1] == 0:
            return np.zeros(0, dtype=np.int64)
        order = np.lexsort(keys)
        ordered = keys[:, order]
        new = np.ones(keys.shape[1], dtype=bool)
        new[1:] = (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)
        dense = np.cumsum(new) - 1
        out = np.empty(keys.shape[1], dtype=np.int64)
        out[order] = dense
        return out

    def _sampled_lcp(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """LCP of sampled suffixes at positions ``a`` and ``b`` by descending the doubling levels."""
        v = self.v
        total = np.zeros(len(a), dtype=np.int64)
        a, b = a.copy(), b.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            span = v * (1 << level)
            sa, sb = self.slot[a], self.slot[b]
            ok = (sa >= 0) & (sb >= 0)
            ok[ok] = self.levels[level][sa[ok]] == self.levels[level][sb[ok]]
            total += np.where(ok, span, 0)
            a = np.where(ok, a + span, a)
            b = np.where(ok, b + span, b)
        return total + self._direct(a, b, v)

    def _direct(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Words that agree from ``a`` and ``b``, counting at most ``most``."""
        seq = self.seq
        count = np.zeros(len(a), dtype=np.int64)
        alive = np.ones(len(a), dtype=bool)
        limit = len(seq) - 1
        for k in range(most):
            same = seq[np.minimum(a + k, limit)] == seq[np.minimum(b + k, limit)]
            alive &= same & (a + k <= limit) & (b + k <= limit)
            count += alive
        return count

    def _neighbour_lcp(self, sample: np.ndarray, order: np.ndarray) -> np.ndarray:
        ordered = sample[order]
        if len(ordered) < 2:
            return np.zeros(0, dtype=np.int64)
        return self._sampled_lcp(ordered[:-1], ordered[1:])

    def _table(self, lcp: np.ndarray) -> None:
        self.sparse = [lcp]
        width = 1
        while 2 * width <= len(lcp):
            prev = self.sparse[-1]
            self.sparse.append(np.minimum(prev[:-width], prev[width:]))
            width *= 2

    def _rmq(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of ``lcp[lo:hi]`` for ``lo < hi``."""
        span = hi - lo
        level = np.floor(np.log2(np.maximum(span, 1))).astype(np.int64)
        out = np.empty(len(lo), dtype=np.int64)
        for lvl in np.unique(level):
            pick = level == lvl
            table = self.sparse[lvl]
            out[pick] = np.minimum(table[lo[pick]], table[hi[pick] - (1 << lvl)])
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from ``i`` and ``j`` on (positions within ``[0, n]``)."""
        i = np.asarray(i, dtype=np.int64)
        j = np.asarray(j, dtype=np.int64)
        k = self.shift[i % self.v, j % self.v]
        head = self._direct(i, j, self.v)
        out = head.copy()
        far = head >= k
        if far.any():
            a, b = i[far] + k[far], j[far] + k[far]
            ra, rb = self.rank[self.slot[a]], self.rank[self.slot[b]]
            same = ra == rb
            lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
            tail = np.zeros(len(a), dtype=np.int64)
            if (~same).any():
                tail[~same] = self._rmq(lo[~same], hi[~same])
            tail[same] = self.n - np.maximum(a[same], b[same])
            out[far] = k[far] + tail
        return out


#: Probes (grid position, period) answered in one vectorised batch; bounds memory per document.
PROBES_PER_BATCH = 1 << 21


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` with length >= max(6, 4 * period), by start then period."""
    n = len(ids)
    if n < MIN_LENGTH:
        return []
    forward = CoverLCE(ids)
    backward = CoverLCE(ids[::-1].copy())
    periods = np.arange(1, n // MIN_EXPONENT + 1, dtype=np.int64)
    counts = (n - 1) // periods  # grid positions 0, q, 2q, ... below n - q
    found_s, found_e, found_q = [], [], []
    first = 0
    while first < len(periods):
        last = first + 1
        total = counts[first]
        while last < len(periods) and total + counts[last] <= PROBES_PER_BATCH:
            total += counts[last]
            last += 1
        q = np.repeat(periods[first:last], counts[first:last])
        starts = np.repeat(np.cumsum(counts[first:last]) - counts[first:last], counts[first:last])
        grid = (np.arange(len(q), dtype=np.int64) - starts) * q
        # A run of period q holds a grid position whose q words repeat right after it, and from
        # there both extensions give the whole run: probe only where the first word repeats.
        hit = ids[grid] == ids[grid + q]
        grid, q = grid[hit], q[hit]
        right = forward.lce(grid, grid + q)
        hit = right >= q
        grid, q, right = grid[hit], q[hit], right[hit]
        left = np.zeros(len(grid), dtype=np.int64)
        inner = grid > 0
        left[inner] = backward.lce(n - grid[inner], n - grid[inner] - q[inner])
        start = grid - left
        end = grid + q + right
        keep = end - start >= np.maximum(MIN_LENGTH, MIN_EXPONENT * q)
        found_s.append(start[keep])
        found_e.append(end[keep])
        found_q.append(q[keep])
        first = last
    s, e, q = (np.concatenate(x) for x in (found_s, found_e, found_q))
    if len(s) == 0:
        return []
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    head = np.ones(len(s), dtype=bool)
    head[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[head], e[head], q[head]
    order = np.lexsort((q, s))
    return [(int(a), int(b - a), int(c)) for a, b, c in zip(s[order], e[order], q[order])]


def planted(words: list[str], doc_id) -> list[str]:
    """The contract's periodic rewrite of the word list for documents whose crc32 ends in 0."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(int(doc_id)).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def describe(doc_id, text: str | None) -> dict:
    """Runs and digests of one document (null text: no words)."""
    words = planted(_WORD.findall(text or ""), doc_id)
    codes = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int64, count=len(words))
    runs = find_runs(ids)
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, q in runs:
        dropped[s + q] += 1
        dropped[s + length] -= 1
    kept = np.cumsum(dropped[:-1]) == 0 if words else np.zeros(0, dtype=bool)
    collapsed = " ".join(w for w, k in zip(words, kept) if k)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return {
        "doc_id": doc_id, "n_words": len(words), "n_runs": len(runs),
        "start": top and top[0], "length": top and top[1], "period": top and top[2],
        "exponent_milli": top and (1000 * top[1]) // top[2],
        "runs_sha256": hashlib.sha256(listing.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(collapsed.encode("utf-8")).hexdigest(),
    }


def _batches(frames):
    for frame in frames:
        rows = [
            describe(None if pd.isna(d) else int(d), None if t is None or (isinstance(t, float)) else t)
            for d, t in zip(frame["doc_id"], frame["text"])
        ]
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])
        for column in ("start", "length", "period", "exponent_milli", "doc_id"):
            out[column] = out[column].astype("Int64")
        yield out


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document row: its runs of period ``q`` and length at least ``max(6, 4q)``.

    Null text has no words; a null ``doc_id`` gets no planted rewrite.  With no
    run, ``start``, ``length``, ``period`` and ``exponent_milli`` are null and
    ``runs_sha256`` is the digest of the empty string.  Repeated rows give
    repeated results.  Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(_batches, RESULT)


def brute_runs(ids: list) -> list[tuple[int, int, int]]:
    """Runs by checking every stretch and period (tests only)."""
    n = len(ids)
    found = {}
    for q in range(1, n // MIN_EXPONENT + 1):
        i = 0
        while i < n:
            j = i
            while j + q < n and ids[j] == ids[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(MIN_LENGTH, MIN_EXPONENT * q):
                key = (i, i + length)
                found[key] = min(found.get(key, q), q)
            i = j + 1 if j > i else i + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))
