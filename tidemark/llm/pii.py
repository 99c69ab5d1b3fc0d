"""Personal data by fixed patterns and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans.  They also label a bounded sample of windows,
drawn from all documents by hash, on which the tagger is trained in numpy.  It
then tags overlapping windows around every digit and at-sign of every text -
no kind can do without one of them - and the spans of all windows of a text are
reconciled at once: a best set of spans that do not overlap is chosen by total
confidence.  Spans that touch a base span are dropped, so base spans stay as
they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices

KINDS = ["email", "ip", "card", "phone"]
#: Labelled windows of each kind, and without any, on which the tagger is trained.
WINDOWS_PER_KIND = 160
WINDOW = 96
CONTEXT = 24
CONFIDENCE = 0.9
STEPS = 220

# --- base patterns --------------------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_ANCHOR = re.compile(r"[0-9@]+")


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return sum(values[0::2] + [v // 5 + 2 * v % 10 for v in values[1::2]]) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at-signs so that long words cost no more than others."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() < 64:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind, then start."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        out += [(0, *s) for s in _emails(text)]
    if _ANCHOR.search(text):
        out += [(1, *s) for s in _ips(text)]
        out += [(2, *s) for s in _cards(text)]
        out += [(3, *s) for s in _phones(text)]
    return out


def plausible(kind: int, found: str) -> bool:
    """What any span of a kind must hold, whoever found it."""
    digits = _NOT_DIGIT.sub("", found)
    if kind == 0:
        name, _, host = found.partition("@")
        return bool(name and host) and not any(c.isspace() for c in found)
    if kind == 1:
        parts = re.findall("[0-9]+", found)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and len(digits) < len(found)


# --- windows --------------------------------------------------------------------------------


def windows(text: str) -> list[tuple[int, int]]:
    """Overlapping ``(start, end)`` windows over all anchors with their context."""
    areas: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        lo, hi = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if areas and lo <= areas[-1][1]:
            areas[-1][1] = hi
        else:
            areas.append([lo, hi])
    out = []
    for lo, hi in areas:
        while hi - lo > WINDOW:
            out.append((lo, lo + WINDOW))
            lo += WINDOW // 2
        out.append((lo, hi))
    return out


def codes(pieces: list[str]) -> np.ndarray:
    """Character codes of windows: printable ASCII, white space, anything else; 0 pads."""
    out = np.zeros((len(pieces), WINDOW), dtype=np.int64)
    for row, piece in zip(out, pieces, strict=True):
        c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        row[: len(c)] = np.where((c > 32) & (c < 127), c - 30, np.where(c <= 32, 1, 2))
    return out


# --- the tagger -----------------------------------------------------------------------------

_SYMBOLS, _EMBED, _HIDDEN = 97, 10, 16
_TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def new_weights(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    h = _HIDDEN
    w = {"embed": rng.normal(0, 0.3, (_SYMBOLS, _EMBED))}
    for side in "fb":
        w[f"x{side}"] = rng.normal(0, 0.3, (_EMBED, 4 * h))
        w[f"h{side}"] = rng.normal(0, 0.2, (h, 4 * h))
        w[f"b{side}"] = np.concatenate((np.zeros(h), np.ones(h), np.zeros(2 * h)))
    w["out"] = rng.normal(0, 0.2, (2 * h, _TAGS))
    w["bias"] = np.zeros(_TAGS)
    w["move"] = np.zeros((_TAGS, _TAGS))
    w["first"] = np.zeros(_TAGS)
    return w


def _lstm(x: np.ndarray, w: dict, side: str) -> tuple[np.ndarray, list]:
    """Hidden states over time of ``x (time, rows, embed)``, and what the way back needs."""
    h = _HIDDEN
    pre = x @ w[f"x{side}"] + w[f"b{side}"]
    state = cell = np.zeros((x.shape[1], h))
    out, kept = np.empty((*x.shape[:2], h)), []
    for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
        z = pre[t] + state @ w[f"h{side}"]
        gate = _sigmoid(z[:, : 3 * h])
        i, f, o = gate[:, :h], gate[:, h : 2 * h], gate[:, 2 * h :]
        g = np.tanh(z[:, 3 * h :])
        before, cell = cell, f * cell + i * g
        c = np.tanh(cell)
        kept.append((t, state, before, i, f, o, g, c))
        state = out[t] = o * c
    return out, kept


def _lstm_back(dout: np.ndarray, x: np.ndarray, kept: list, w: dict, side: str, grad: dict) -> np.ndarray:
    dz_all = np.empty((*x.shape[:2], 4 * _HIDDEN))
    dh = dc = np.zeros((x.shape[1], _HIDDEN))
    for t, state, before, i, f, o, g, c in reversed(kept):
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - c * c)
        dz = np.concatenate(
            (dc * g * i * (1 - i), dc * before * f * (1 - f), dh * c * o * (1 - o), dc * i * (1 - g * g)),
            axis=1,
        )
        dz_all[t] = dz
        grad[f"h{side}"] += state.T @ dz
        dh, dc = dz @ w[f"h{side}"].T, dc * f
    grad[f"x{side}"] += np.tensordot(x, dz_all, ((0, 1), (0, 1)))
    grad[f"b{side}"] += dz_all.sum(axis=(0, 1))
    return dz_all @ w[f"x{side}"].T


def _forward(x: np.ndarray, w: dict) -> tuple:
    e = w["embed"][x.T]
    f, kept_f = _lstm(e, w, "f")
    b, kept_b = _lstm(e, w, "b")
    both = np.concatenate((f, b), axis=2)
    return both @ w["out"] + w["bias"], both, e, kept_f, kept_b


def _chain(score: np.ndarray, w: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward sums of the CRF and the log partition, ``score (time, rows, tags)``."""
    steps = len(score)
    a, b = np.empty_like(score), np.zeros_like(score)
    a[0] = score[0] + w["first"]
    for t in range(1, steps):
        a[t] = score[t] + _logsum(a[t - 1][:, :, None] + w["move"], 1)
    for t in range(steps - 2, -1, -1):
        b[t] = _logsum(w["move"] + (score[t + 1] + b[t + 1])[:, None, :], 2)
    return a, b, _logsum(a[-1], 1)


def train(x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 3) -> dict[str, np.ndarray]:
    """Fit to windows of codes ``x`` and tags ``y`` by Adam; deterministic for a seed."""
    w = new_weights(seed)
    if not len(x):
        return w
    rng = np.random.default_rng(seed + 1)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        rows = rng.choice(len(x), size=min(96, len(x)), replace=False)
        xs, ys = x[rows], y[rows].T
        score, both, e, kept_f, kept_b = _forward(xs, w)
        a, b, total = _chain(score, w)
        n = len(rows)
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        dscore = np.exp(a + b - total[None, :, None])
        grad["first"] = dscore[0].sum(axis=0)
        pair = a[:-1][:, :, :, None] + w["move"] + (score[1:] + b[1:])[:, :, None, :]
        grad["move"] = np.exp(pair - total[None, :, None, None]).sum(axis=(0, 1))
        at = np.arange(n)
        for t in range(len(ys)):
            dscore[t, at, ys[t]] -= 1
        np.subtract.at(grad["first"], ys[0], 1)
        np.subtract.at(grad["move"], (ys[:-1].ravel(), ys[1:].ravel()), 1)
        grad["out"] = np.tensordot(both, dscore, ((0, 1), (0, 1)))
        grad["bias"] = dscore.sum(axis=(0, 1))
        dboth = dscore @ w["out"].T
        de = _lstm_back(dboth[:, :, :_HIDDEN], e, kept_f, w, "f", grad)
        de += _lstm_back(dboth[:, :, _HIDDEN:], e, kept_b, w, "b", grad)
        np.add.at(grad["embed"], xs.T, de)
        rate = 0.02 * (1 - 0.8 * step / steps)
        for k in w:
            g = np.clip(grad[k] / n, -1, 1)
            m[k] = 0.9 * m[k] + 0.1 * g
            v2[k] = 0.99 * v2[k] + 0.01 * g * g
            w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-8)
    return w


def tagged(x: np.ndarray, w: dict) -> tuple[np.ndarray, np.ndarray]:
    """Best tag path of each window (Viterbi) and the posterior of each of its tags."""
    score = _forward(x, w)[0]
    a, b, total = _chain(score, w)
    steps, n, _ = score.shape
    best = score[0] + w["first"]
    back = np.zeros((steps, n, _TAGS), dtype=np.int8)
    for t in range(1, steps):
        ways = best[:, :, None] + w["move"]
        back[t] = ways.argmax(axis=1)
        best = score[t] + ways.max(axis=1)
    path = np.zeros((steps, n), dtype=np.int64)
    path[-1] = best.argmax(axis=1)
    at = np.arange(n)
    for t in range(steps - 1, 0, -1):
        path[t - 1] = back[t, at, path[t]]
    sure = np.exp(np.take_along_axis(a + b, path[:, :, None], 2)[:, :, 0] - total)
    return path.T, sure.T


def _path_spans(path: np.ndarray, sure: np.ndarray, size: int) -> Iterator[tuple[int, int, int, float]]:
    t = 0
    while t < size:
        tag = int(path[t])
        if tag == 0 or tag % 2 == 0:
            t += 1
            continue
        end = t + 1
        while end < size and path[end] == tag + 1:
            end += 1
        yield (tag - 1) // 2, t, end, float(sure[t:end].mean())
        t = end


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Of spans from all windows of a text, the set without overlap of most total confidence."""
    best: dict[tuple[int, int, int], float] = {}
    for kind, lo, hi, sure in spans:
        best[kind, lo, hi] = best.get((kind, lo, hi), 0) + sure * (hi - lo)
    order = sorted(best.items(), key=lambda s: (s[0][2], s[0][1], s[0][0]))
    ends = [s[0][2] for s in order]
    total, taken = [0.0], []
    for i, ((_, lo, _), value) in enumerate(order):
        j = int(np.searchsorted(ends[:i], lo, side="right"))
        take = total[j] + value > total[-1]
        taken.append((take, j))
        total.append(total[j] + value if take else total[-1])
    out, i = [], len(order)
    while i > 0:
        take, j = taken[i - 1]
        if take:
            out.append(order[i - 1][0])
            i = j
        else:
            i -= 1
    return out[::-1]


def find(texts: list[str | None], weights: dict | None) -> list[tuple[list, list]]:
    """``(base spans, all spans)`` of each text; null is empty."""
    base = [base_spans(t) if t else [] for t in texts]
    owner, at, pieces = [], [], []
    for d, t in enumerate(texts):
        for lo, hi in windows(t) if t else ():
            owner.append(d), at.append((lo, hi)), pieces.append(t[lo:hi])
    loose: list[list] = [[] for _ in texts]
    for i in range(0, len(pieces) if weights else 0, 256):
        paths, sures = tagged(codes(pieces[i : i + 256]), weights)
        for k, (path, sure) in enumerate(zip(paths, sures, strict=True)):
            d, (lo, hi) = owner[i + k], at[i + k]
            for kind, s, e, p in _path_spans(path, sure, hi - lo):
                # a span cut by the window's edge is whole in the next window
                if (s > 0 or lo == 0) and (e < hi - lo or hi == len(texts[d])) and p >= CONFIDENCE:
                    loose[d].append((kind, lo + s, lo + e, p))
    out = []
    for d, t in enumerate(texts):
        more = []
        for kind, lo, hi in reconcile(loose[d]):
            while lo < hi and t[lo].isspace():
                lo += 1
            free = all(hi <= s or e <= lo for _, s, e in base[d])
            if free and plausible(kind, t[lo:hi]):
                more.append((kind, lo, hi))
        out.append((base[d], sorted(base[d] + more)))
    return out


# --- Spark ----------------------------------------------------------------------------------


def _labelled(text: str) -> Iterator[tuple[int, str, bytes]]:
    """``(kind or 4, window, tags)`` of each window of a text, labelled by its base spans."""
    spans = base_spans(text)
    for lo, hi in windows(text):
        tags = np.zeros(WINDOW, dtype=np.int8)
        kind = len(KINDS)
        for k, s, e in spans:
            if s < hi and e > lo:
                kind = k
                tags[max(s - lo, 0) : e - lo] = 2 + 2 * k
                if s >= lo:
                    tags[s - lo] = 1 + 2 * k
        yield kind, text[lo:hi], tags.tobytes()


def fit(docs: DataFrame, per_kind: int = WINDOWS_PER_KIND, steps: int = STEPS) -> dict[str, np.ndarray]:
    """Train on ``per_kind`` windows of each kind, those with the smallest hashes in all documents."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[bytes, tuple[str, bytes]]] = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for kind, piece, tags in _labelled(text) if text else ():
                    key = hashlib.blake2b(piece.encode("utf-8", "surrogatepass"), digest_size=8)
                    own = held.setdefault(kind, {})
                    own[key.digest()] = (piece, tags)
                    if len(own) > 4 * per_kind:
                        held[kind] = dict(sorted(own.items())[:per_kind])
        rows = [(k, h, *x) for k, own in held.items() for h, x in sorted(own.items())[:per_kind]]
        if rows:
            kind, h, piece, tags = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(h, pa.binary()), pa.array(piece), pa.array(tags)],
                names=["kind", "h", "piece", "tags"],
            )

    from tidemark.llm.common import saved

    drawn = saved(
        docs.select(F.col("text").cast("string")).mapInArrow(
            draw, "kind int, h binary, piece string, tags binary"
        ),
        "windows",
    )
    rows = []
    for kind in range(len(KINDS) + 1):
        own = drawn.where(F.col("kind") == kind).dropDuplicates(["h"])
        rows += own.orderBy("h", "piece", "tags").limit(per_kind).collect()
    x = codes([r["piece"] for r in rows])
    y = np.array([np.frombuffer(r["tags"], np.int8) for r in rows], dtype=np.int64)
    return train(x, y, steps)


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{lo}:{hi}" for k, lo, hi in spans)


def spans(docs: DataFrame, weights: dict | None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of each row.

    Counts and digest are of the base spans, ``spans`` lists all.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = find(part.column("text").to_pylist(), weights)
                counts = [[sum(k == c for k, _, _ in b) for b, _ in found] for c in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array([hashlib.sha256(_listed(b).encode()).hexdigest() for b, _ in found]),
                     pa.array([_listed(every) for _, every in found])],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = "".join(f", n_{k} long" for k in KINDS)
    return rows.mapInArrow(scan, f"doc_id long{counts}, base_sha256 string, spans string")


def masked(docs: DataFrame, weights: dict | None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets.

    Overlapping spans are masked together, under the first one's kind.  All
    other columns are kept; a null text stays null.
    """

    def mask(text: str, found: list[tuple[int, int, int]]) -> str:
        out, done = [], 0
        for kind, lo, hi in sorted(found, key=lambda s: (s[1], -s[2])):
            if lo >= done:
                out += [text[done:lo], f"<{KINDS[kind]}>"]
            done = max(done, hi)
        return "".join([*out, text[done:]])

    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column(at).to_pylist()
                found = find(texts, weights)
                done = [
                    t if t is None or not every else mask(t, every)
                    for t, (_, every) in zip(texts, found, strict=True)
                ]
                yield part.set_column(at, part.schema.field(at), pa.array(done, part.schema.field(at).type))

    return docs.mapInArrow(scan, docs.schema)
