"""Near duplicates, decontamination and sharding against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neardup, sharding, tiling
from tidemark.llm.common import Words, components, filter_of, in_filter, without

SCHEMA = "doc_id long, text string, component long, n long"


def brute_components(texts: dict[int, str | None], width: int, percent: int = 80) -> dict[int, int]:
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(texts, 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= percent * either:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in texts}


def edited_copies(count: int, seed: int) -> dict[int, str | None]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts: dict[int, str | None] = {}
    base = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(count):
        words = base.copy() if i % 3 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts[i * 7 + 3] = " ".join(words)
    texts |= {1: None, 2: "", 4: " \t\n", 5: "short one", 6: "SHORT  one", 8: "Éa", 9: "éa", 10000: texts[3]}
    return texts


@pytest.mark.parametrize("width", [4, 5])
def test_components_equal_brute_force(spark, width):
    texts = edited_copies(150, width)
    rows = [(d, t, 5, 6) for d, t in texts.items()]
    docs = spark.createDataFrame(rows + [rows[0]], SCHEMA)
    out = neardup.near_duplicates(docs, width).collect()
    expected = brute_components(texts, width)
    assert len(out) == len(rows) + 1
    assert {r.doc_id: r.component_id for r in out} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    assert {r.n_shingles for r in out if r.doc_id in (1, 2, 4)} == {0}


def test_crowds_are_compared_in_blocks(spark, monkeypatch):
    """Copies too different from each other form crowds, here cut into blocks of 20."""
    monkeypatch.setattr(neardup, "BLOCK", 20)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    texts = {}
    for i in range(120):
        words = base.copy()
        for at in rng.sample(range(100), rng.choice([2, 5, 8])):
            words[at] = f"e{i}_{at}" if rng.random() < 0.7 else f"x{at}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame([(d, t, 1, 1) for d, t in texts.items()], SCHEMA)
    out = neardup.near_duplicates(docs, 4).collect()
    assert {r.doc_id: r.component_id for r in out} == brute_components(texts, 4)


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = neardup.near_duplicates(spark.createDataFrame([(None, "a b c d e f", 1, 1)], SCHEMA)).first()
    assert lone.component_id is None and lone.kept


def test_every_pair_within_the_radius_shares_a_key():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 1 << 16, (1, neardup.SYMBOLS)).astype(np.uint16)
    for _ in range(300):
        two = one.copy()
        at = rng.choice(neardup.SYMBOLS, neardup.RADIUS, replace=False)
        two[0, at] ^= rng.integers(1, 1 << 16, neardup.RADIUS).astype(np.uint16)
        assert (neardup.keys(one) == neardup.keys(two)).any()


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (102, 101)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 101: 101, 102: 101}


def test_filter_and_without(spark):
    ids = spark.createDataFrame([(i,) for i in range(0, 1000, 3)], "doc_id long")
    bits = filter_of(ids)
    assert in_filter(bits, np.arange(0, 1000, 3)).all() and in_filter(bits, np.arange(5000, 6000)).sum() < 5
    docs = spark.createDataFrame([(i, "t", 1, 1) for i in [*range(10), None, 3]], SCHEMA)
    assert sorted(r.doc_id or -1 for r in without(docs, ids).collect()) == [-1, 1, 2, 4, 5, 7, 8]


def brute_tiles(doc: list, item: list, least: int) -> int:
    """Item words that greedy string tiling covers, by trying all pairs of places."""
    used_d, used_i, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                k = 0
                while (
                    p + k < len(doc) and q + k < len(item) and doc[p + k] == item[q + k]
                    and p + k not in used_d and q + k not in used_i
                ):
                    k += 1
                if k > best[0]:
                    best = (k, p, q)
        k, p, q = best
        if k < least:
            return total
        used_d |= set(range(p, p + k))
        used_i |= set(range(q, q + k))
        total += k


def test_tiles_equal_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.choice("abcdef") for _ in range(rng.randint(0, 25))]
        doc = [rng.choice("abcdef") for _ in range(rng.randint(0, 40))]
        if len(item) > 12:
            doc[5:5] = item[8:] + item[:8]
        w = Words([" ".join(doc), " ".join(item)])
        d, i = w.hash[: len(doc)], w.hash[len(doc) :]
        tiles = tiling.greedy_tiles(np.arange(len(d)), d, i, 3)
        assert sum(t[2] for t in tiles) == brute_tiles(doc, item, 3)


def test_contaminated_documents(spark):
    item = [f"q{i}" for i in range(30)]
    other = [f"r{i}" for i in range(20)]
    noise = [f"n{i}" for i in range(50)]
    rows = [
        (1, " ".join(noise + item + noise)),  # verbatim
        (2, " ".join(item[15:] + noise + item[:15])),  # reordered
        (3, " ".join(noise + item[:9])),  # a part only
        (4, " ".join(noise)), (5, None), (6, ""), (None, " ".join(item)),
        (7, " ".join(item + other).upper()), (7, " ".join(item[:20])),
    ]
    docs = spark.createDataFrame([(d, t, 0, 0) for d, t in rows], SCHEMA)
    bench = spark.createDataFrame(
        [(10, " ".join(item), "x"), (11, " ".join(other), "x"), (12, None, "x"), (13, "too short", "x"), (None, " ".join(noise), "x")],
        "item_id long, text string, doc_id string",
    )
    out = {(r.doc_id, r.item_id): r for r in tiling.contaminated(docs, bench).collect()}
    assert set(out) == {(1, 10), (2, 10), (7, 10), (7, 11)}
    assert out[2, 10].n_tiles == 2 and out[2, 10].coverage == 1.0
    assert tiling.contaminated(docs.limit(0), bench).count() == 0
    assert tiling.contaminated(docs, bench.limit(0)).count() == 0


def test_shards_are_even_and_keep_copies(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        text = None if i % 97 == 0 else f"copy {i % 40}" if i % 3 == 0 else f"text {rng.random()}"
        rows.append((i, text, 1, 1))
    rows += [(5, "same id", 1, 1), (5, "same id", 1, 1), (None, "x", 1, 1), (None, "x", 1, 1)]
    out = sharding.shard_documents(spark.createDataFrame(rows, SCHEMA), shards=7).collect()
    assert len(out) == len(rows)
    shards: dict = {}
    for r in out:
        shards.setdefault(r.shard, []).append(r.slot)
    sizes = [len(s) for s in shards.values()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    groups: dict = {}
    for r in out:
        groups.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) <= 1


def test_a_crowd_larger_than_a_shard_is_split(spark):
    rows = [(i, "hot" if i % 2 else f"t{i}", 1, 1) for i in range(400)]
    out = sharding.shard_documents(spark.createDataFrame(rows, SCHEMA), shards=8)
    assert {r["count"] for r in out.groupBy("shard").count().collect()} == {50}
    assert sharding.shard_documents(spark.createDataFrame([], SCHEMA), shards=4).count() == 0


def test_links_of_any_graph(spark):
    """Two cliques end up in one shard each."""
    docs = spark.createDataFrame([(str(i), i) for i in range(200)], "node string, v long")
    links = [(str(a), str(b)) for base in (0, 10) for a, b in itertools.combinations(range(base, base + 6), 2)]
    out = sharding.even_shards(docs, spark.createDataFrame(links, "a string, b string"), 4, rounds=8)
    where = {r.v: r.shard for r in out.collect()}
    assert len({where[i] for i in range(6)}) == 1 and len({where[i] for i in range(10, 16)}) == 1
    assert {r["count"] for r in out.groupBy("shard").agg(F.count("*").alias("count")).collect()} == {50}
