"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is read as a row sequence, and a repair is a derivation in a
small weighted hypergraph: an item ``(i, q)`` says that the first ``i`` rows
have been dealt with and the repaired output so far ends in grammar state
``q`` of ``(s?(ua)+)?``.  Deductions keep, rerole or delete row ``i`` (moving
to ``i + 1``) or insert an empty user or assistant turn (staying at ``i``).
Every deduction adds its cost and appends its initial to the audit string, so
``(cost, audit)`` ordered lexicographically is a superior and monotone weight:
the agenda pops items in that order and the first time the goal item pops, its
derivation is the cheapest repair with the ASCII-least audit.

Audits are never stored as strings.  Finalised derivations form a tree of back
pointers; two candidates are compared through the lowest common ancestor of
their parents (binary lifting), so memory is ``O(n log n)`` for ``n`` rows and a
comparison is ``O(log n)``.

Damage and faults are DataFrame columns; the agenda runs per conversation in
``applyInPandas`` over the few columns it needs.
"""

from __future__ import annotations

import hashlib
import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

# Fixed values of the contract: damage kinds by crc32 % 20 and edit prices.
DAMAGE_DROP, DAMAGE_EMPTY, DAMAGE_UNPUNCTUATE, DAMAGE_REPEAT, DAMAGE_USER = 0, 1, 2, 3, 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

_SPACE = r"\x20\x09-\x0D"
# Grammar (s?(ua)+)? as a machine: state -> {initial: next state}; 0 start, 1 after s, 2 after u, 3 after a.
_NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
_ACCEPT = (0, 3)
# The only role a rerole or an insert may give in each state.
_FORCED = {0: "user", 1: "user", 2: "assistant", 3: "user"}
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()

RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the contract's damage, with fault and a drop flag.

    Nulls in ``role`` and ``text`` become one space, also in the damage key
    ``conv_id:turn``.  Dropped rows stay as a flag so that their conversation is
    still reported.  ``fault`` is the first of ``b`` blank, ``d`` duplicate
    (same role and text earlier in the conversation's order), ``t`` truncated,
    else empty.  Order inside a conversation: turn with nulls first, then role
    and text, so rows that tie on turn have a defined place.
    """
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(F.encode(key, "UTF-8")) % 20).alias("damage"),
    )
    rows = rows.select(
        "conv_id", "turn", "damage",
        F.when(F.col("damage") == DAMAGE_USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == DAMAGE_EMPTY, F.lit(""))
        .when(F.col("damage") == DAMAGE_UNPUNCTUATE, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("damage") == DAMAGE_REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).withColumn("dropped", F.col("damage") == DAMAGE_DROP)
    kept = ~F.col("dropped")
    # Rows with equal role and text share a partition; only the first in conversation order is not a duplicate.
    same = Window.partitionBy("conv_id", "role", "text", "dropped").orderBy(F.col("turn").asc_nulls_first(), "copy")
    blank = ~F.col("text").rlike(f"[^{_SPACE}]")
    ends = F.col("text").rlike(f"[.!?][{_SPACE}]*$")
    return rows.withColumn(
        "fault",
        F.when(~kept, F.lit(""))
        .when(blank, F.lit("b"))
        .when(F.row_number().over(same) > 1, F.lit("d"))
        .when(~ends, F.lit("t"))
        .otherwise(F.lit("")),
    )


class _Tree:
    """Back-pointer tree of finalised derivations with binary lifting."""

    def __init__(self, size: int):
        self.levels = max(1, int(size).bit_length())
        self.up = [[0] for _ in range(self.levels)]
        self.depth = [0]
        self.char = [""]
        self.info: list[tuple] = [()]

    def add(self, parent: int, char: str, info: tuple) -> int:
        node = len(self.depth)
        self.depth.append(self.depth[parent] + 1)
        self.char.append(char)
        self.info.append(info)
        self.up[0].append(parent)
        for k in range(1, self.levels):
            self.up[k].append(self.up[k - 1][self.up[k - 1][node]])
        return node

    def lift(self, node: int, depth: int) -> int:
        gap = self.depth[node] - depth
        k = 0
        while gap:
            if gap & 1:
                node = self.up[k][node]
            gap >>= 1
            k += 1
        return node

    def lca(self, a: int, b: int) -> int:
        if self.depth[a] > self.depth[b]:
            a = self.lift(a, self.depth[b])
        elif self.depth[b] > self.depth[a]:
            b = self.lift(b, self.depth[a])
        if a == b:
            return a
        for k in range(self.levels - 1, -1, -1):
            if self.up[k][a] != self.up[k][b]:
                a, b = self.up[k][a], self.up[k][b]
        return self.up[0][a]

    def order(self, pa: int, ca: str, pb: int, cb: str) -> int:
        """Sign of ``audit(pa) + ca`` against ``audit(pb) + cb`` (``''``: nothing appended)."""
        if pa == pb:
            return (ca > cb) - (ca < cb)
        top = self.lca(pa, pb)
        if top == pa:
            step = self.char[self.lift(pb, self.depth[pa] + 1)]
            if ca != step:
                return (ca > step) - (ca < step)
            below = self.lift(pb, self.depth[pa] + 1)
            return 0 if below == pb and cb == "" else -1
        if top == pb:
            return -self.order(pb, cb, pa, ca)
        a = self.char[self.lift(pa, self.depth[top] + 1)]
        b = self.char[self.lift(pb, self.depth[top] + 1)]
        return (a > b) - (a < b)


class _Candidate:
    """A derivation waiting on the agenda: parent node plus one more deduction."""

    __slots__ = ("cost", "parent", "char", "item", "info", "tree")

    def __init__(self, cost, parent, char, item, info, tree):
        self.cost, self.parent, self.char, self.item, self.info, self.tree = cost, parent, char, item, info, tree

    def __lt__(self, other: _Candidate) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        return self.tree.order(self.parent, self.char, other.parent, other.char) < 0


def lightest_repair(initials: list[str], faults: list[str]) -> tuple[int, list[tuple[str, int, str]]]:
    """Cheapest repair of one conversation and its edits, ties to the ASCII-least audit.

    ``initials`` are the first characters of the roles, ``faults`` the first
    faults of the rows.  Returns the cost and the edits in order as
    ``(initial, row or -1, role given or '')``.
    """
    n = len(initials)
    tree = _Tree(4 * (n + 1) + 2)
    done: dict = {}
    goal = ("goal",)
    agenda = [_Candidate(0, 0, "", (0, 0), None, tree)]
    finished = None
    while agenda:
        top = heapq.heappop(agenda)
        if top.item in done:
            continue
        if top.item == goal:
            finished = top
            break
        node = 0 if top.info is None else tree.add(top.parent, top.char, top.info)
        done[top.item] = node
        cost = top.cost
        i, q = top.item

        def push(extra, char, item, info):
            if item not in done:
                heapq.heappush(agenda, _Candidate(cost + extra, node, char, item, info, tree))

        if i == n and q in _ACCEPT:
            push(0, "", goal, None)
        forced = _FORCED[q]
        push(INSERT, "I", (i, _NEXT[q][forced[0]]), ("I", -1, forced))
        if i < n:
            push(DELETE, "D", (i + 1, q), ("D", i, ""))
            if faults[i] not in ("b", "d"):
                extra = TRUNCATED if faults[i] == "t" else 0
                after = _NEXT[q].get(initials[i])
                if after is not None:
                    push(KEEP + extra, "K", (i + 1, after), ("K", i, ""))
                push(REROLE + extra, "R", (i + 1, _NEXT[q][forced[0]]), ("R", i, forced))
    edits = []
    node = finished.parent
    while node:
        edits.append(tree.info[node])
        node = tree.up[0][node]
    return finished.cost, edits[::-1]


def _gaps(turns: list) -> int:
    seen = [t for t in turns if t is not None]
    if not seen:
        return 0
    return int(max(seen) - min(seen) + 1 - len(set(seen)))


def _one(conv, turns: list, roles: list, texts: list, faults: list) -> dict:
    """Result row of one conversation from its kept rows, already in conversation order."""
    initials = [r[:1] for r in roles]
    pairs = {"su", "ua", "au"}
    illegal = sum(1 for x, y in zip(initials, initials[1:]) if x + y not in pairs)
    cost, edits = lightest_repair(initials, faults)
    lines = []
    for kind, row, role in edits:
        if kind == "I":
            lines.append(f"{role}:")
        elif kind != "D":
            lines.append(f"{role or roles[row]}:{texts[row]}")
    return {
        "conv_id": conv, "gaps": _gaps(turns),
        "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": illegal, "cost": cost, "audit": "".join(kind for kind, _, _ in edits),
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode("utf-8")).hexdigest() if lines else _EMPTY_SHA,
    }


def _column(frame: pd.DataFrame, name: str) -> list:
    values = frame[name]
    return [None if pd.isna(v) else v for v in values.astype(object)]


def _conversations(frames):
    """Walk conversations in order; one held back at each batch end may continue in the next."""
    names = ["conv_id", "turn", "role", "text", "fault", "dropped"]
    held = {n: [] for n in names}
    for frame in frames:
        cols = {n: _column(frame, n) for n in names}
        convs = cols["conv_id"]
        out = []
        start = 0
        for i in range(1, len(convs) + 1):
            if i < len(convs) and convs[i] == convs[start]:
                continue
            if held["conv_id"] and held["conv_id"][0] != convs[start]:
                out.append(_finish(held))
                held = {n: [] for n in names}
            for n in names:
                held[n].extend(cols[n][start:i])
            if i < len(convs):
                out.append(_finish(held))
                held = {n: [] for n in names}
            start = i
        if out:
            yield pd.DataFrame(out, columns=RESULT_NAMES)
    if held["conv_id"]:
        yield pd.DataFrame([_finish(held)], columns=RESULT_NAMES)


def _finish(rows: dict) -> dict:
    kept = [i for i, d in enumerate(rows["dropped"]) if not d]
    pick = lambda n: [rows[n][i] for i in kept]
    turns = [None if t is None else int(t) for t in pick("turn")]
    conv = rows["conv_id"][0]
    return _one(None if conv is None else int(conv), turns, pick("role"), pick("text"), pick("fault"))


RESULT_NAMES = [part.split()[0] for part in RESULT.split(", ")]


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per original ``conv_id`` (a null id is one conversation) with faults and the repair.

    A conversation whose rows all drop has zero counts, cost 0, an empty audit
    and the digest of the empty string.  Extra input columns are ignored.
    Spark puts each conversation in one partition and sorts it in conversation
    order; a task then walks its conversations one after the other.
    """
    rows = damaged(conversations).select("conv_id", "turn", "role", "text", "copy", "dropped", "fault")
    ordered = rows.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "copy"
    )
    return ordered.mapInPandas(_conversations, RESULT)


def brute_force(initials: list[str], faults: list[str]) -> tuple[int, str]:
    """Cheapest cost and least audit by enumerating every edit sequence (tests only, tiny inputs)."""
    import itertools

    n = len(initials)
    best = None
    for choice in itertools.product("KRD", repeat=n):
        for inserts in itertools.product(range(3), repeat=n + 1):
            q, cost, audit, ok = 0, 0, "", True
            for i in range(n + 1):
                for _ in range(inserts[i]):
                    q = _NEXT[q][_FORCED[q][0]]
                    cost += INSERT
                    audit += "I"
                if i == n:
                    break
                op = choice[i]
                if op == "D":
                    cost += DELETE
                elif faults[i] in ("b", "d"):
                    ok = False
                    break
                else:
                    cost += TRUNCATED if faults[i] == "t" else 0
                    if op == "K":
                        if initials[i] not in _NEXT[q]:
                            ok = False
                            break
                        q = _NEXT[q][initials[i]]
                    else:
                        cost += REROLE
                        q = _NEXT[q][_FORCED[q][0]]
                audit += op
            if ok and q in _ACCEPT and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best
