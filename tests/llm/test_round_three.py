"""Conversation repair, periodic runs and license scans."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark.llm import licenses, repair, runs

EMPTY = hashlib.sha256(b"").hexdigest()


# --- op11: conversation repair ---------------------------------------------------------------


def test_agenda_equals_enumeration_of_all_edit_sequences():
    rng = random.Random(11)
    for _ in range(300):
        n = rng.randint(0, 5)
        initials = [rng.choice("suax ") for _ in range(n)]
        faults = [rng.choice(["", "", "t", "b", "d"]) for _ in range(n)]
        cost, edits = repair.lightest_repair(initials, faults)
        assert (cost, "".join(e[0] for e in edits)) == repair.brute_force(initials, faults)


def test_long_conversation_stays_exact():
    initials = list("ua" * 400 + "uu" + "ua" * 400)
    cost, edits = repair.lightest_repair(initials, [""] * len(initials))
    assert cost == 3 and "".join(e[0] for e in edits).count("K") == len(initials) - 1


def _damage(conv, turn):
    key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    return zlib.crc32(key.encode()) % 20


def _expected(rows):
    """The contract worked by hand in plain Python for one conversation."""
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        d = _damage(conv, turn)
        if d == 0:
            continue
        if d == 1:
            text = ""
        if d == 2:
            text = "".join(c for c in text if c not in ".!?")
        if d == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if d == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in out:
        if not text.strip(" \t\n\x0b\x0c\r"):
            faults.append("b")
        elif (role, text) in seen:
            faults.append("d")
        elif text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
            faults.append("t")
        else:
            faults.append("")
        seen.add((role, text))
    initials = [r[1][:1] for r in out]
    cost, audit = repair.brute_force(initials, faults)
    return out, faults, cost, audit


def test_damage_faults_and_repair_on_a_table(spark):
    rows = []
    rng = random.Random(3)
    for conv in range(40):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", None])
            text = rng.choice(["Hello there.", "no stop", "   ", None, "Same!", "Same!"])
            rows.append((conv, turn, role, text))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in repair.repaired(df).collect()}
    assert len(got) == 40
    for conv in range(40):
        mine = [r for r in rows if r[0] == conv]
        out, faults, cost, audit = _expected(mine)
        row = got[conv]
        assert (row.cost, row.audit) == (cost, audit)
        assert (row.blank, row.duplicate, row.truncated) == (faults.count("b"), faults.count("d"), faults.count("t"))
        if not out:
            assert row.repaired_sha256 == EMPTY and row.audit == ""


def test_conversations_split_over_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for c in (1, 2, None) for t in range(7)]
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(1)
        got = {r.conv_id: r for r in repair.repaired(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got, key=str) == [1, 2, None]
    for conv in (1, 2, None):
        _, faults, cost, audit = _expected([r for r in rows if r[0] == conv])
        assert (got[conv].cost, got[conv].audit) == (cost, audit)


def test_nulls_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, 1), (None, 2, "user", "Hi.", 2), (7, None, "assistant", "", 3)],
        "conv_id long, turn long, role string, text string, cost int",
    )
    got = repair.repaired(df).collect()
    assert sorted((r.conv_id is None) for r in got) == [False, True]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repaired(empty).count() == 0


def test_gaps_ignore_null_turns():
    assert repair._gaps([None, None]) == 0
    assert repair._gaps([1, 4, 4, None]) == 2


# --- op12: periodic runs ---------------------------------------------------------------------


def test_runs_equal_brute_force():
    rng = random.Random(12)
    for _ in range(800):
        n = rng.randint(0, 80)
        ids = [rng.randint(0, rng.randint(1, 3)) for _ in range(n)]
        if n > 10 and rng.random() < 0.4:
            p, s = rng.randint(1, 6), rng.randint(0, n - 1)
            ids = ids[:s] + [ids[s + (i - s) % p] for i in range(s, n)]
        assert runs.find_runs(np.array(ids, dtype=np.int64)) == runs.brute_runs(ids)


def test_longest_common_extensions_by_the_cover():
    rng = np.random.default_rng(4)
    seq = rng.integers(0, 2, 300)
    lce = runs.CoverLCE(seq)
    i, j = rng.integers(0, 300, 500), rng.integers(0, 300, 500)
    got = lce.lce(i, j)
    for a, b, g in zip(i, j, got):
        if a != b:
            k = 0
            while a + k < 300 and b + k < 300 and seq[a + k] == seq[b + k]:
                k += 1
            assert g == k


def test_planted_rewrite_and_digests(spark):
    doc = next(d for d in range(1000) if zlib.crc32(str(d).encode()) % 10 == 0)
    text = " ".join(f"w{i}" for i in range(120))
    df = spark.createDataFrame(
        [(doc, text), (1, None), (None, "a a a a a a"), (2, ""), (2, "")], "doc_id long, text string"
    )
    got = {(r.doc_id, r.n_words): r for r in runs.periodic_runs(df).collect()}
    words = runs.planted(text.split(), doc)
    want = runs.find_runs(np.array([int(w[1:]) for w in words]))
    row = got[(doc, 120)]
    assert row.n_runs == len(want)
    listing = "".join(f"{s},{ln},{q}\n" for s, ln, q in want)
    assert row.runs_sha256 == hashlib.sha256(listing.encode()).hexdigest()
    assert got[(1, 0)].start is None and got[(1, 0)].runs_sha256 == EMPTY and got[(1, 0)].collapsed_sha256 == EMPTY
    none = got[(None, 6)]
    assert (none.n_runs, none.start, none.length, none.period, none.exponent_milli) == (1, 0, 6, 1, 6000)
    assert none.collapsed_sha256 == hashlib.sha256(b"a").hexdigest()
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_longest_run_ties_go_to_the_smaller_start():
    row = runs.describe(None, "a b a b a b a b x c d c d c d c d")
    assert (row["n_runs"], row["start"], row["length"], row["period"]) == (2, 0, 8, 2)


# --- op13: license scans ---------------------------------------------------------------------


def _oracle(rows):
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang"])
    con.register("documents", frame)
    return con.execute(licenses.oracle_sql()).fetchdf().convert_dtypes()


def test_scan_equals_brute_force_sql(spark):
    rng = random.Random(13)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in t.split()}) + ["zeta", "ünï", "42"]
    rows = []
    for d in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        if rng.random() < 0.5:
            _, t = rng.choice(licenses.TEMPLATES)
            part = t.split()
            part = [w for w in part if rng.random() < 0.9]
            at = rng.randint(0, len(words))
            words[at:at] = part
        text = " ".join(words).upper() if d % 7 == 0 else " ".join(words)
        rows.append((d, text, "en"))
    rows += [(None, None, None), (5, "All rights reserved. GNU General Public License; CC-BY!", None), (5, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = licenses.scan(df).toPandas().convert_dtypes()
    want = _oracle(rows)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda f: f[cols].astype(str).sort_values(cols).reset_index(drop=True)
    pd.testing.assert_frame_equal(key(got), key(want))


def test_base_places_and_labels(spark):
    df = spark.createDataFrame(
        [(1, "Code (c) 2020. All Rights Reserved; cc-by here, GNU General Public License.", 9)],
        "doc_id long, text string, score int",
    )
    (row,) = licenses.scan(df).collect()
    assert (row.n_base, row.first_word, row.last_word) == (3, 3, 10)
    assert row.base_labels == "cc-by,gpl,reserved"
    assert set(row.labels.split(",")) >= {"cc-by", "gpl", "reserved"}


def test_reordered_template_far_in_a_long_text_is_found(spark):
    notice = "licensed under the apache license version 2 0".split()
    text = " ".join(["filler"] * 5000 + notice[::-1] + ["filler"] * 5000)
    (row,) = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert "apache-2.0" in row.labels.split(",") and row.score == 1.0


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = licenses.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
