"""Main text, archives, personal data, neighbours, quality."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hnsw, pii, quality, warc, wrapper

PAGES = "page_id long, url string, html string, text string"


def page(source: str) -> str:
    return wrapper.Page(source).text()


def test_article_without_its_surroundings():
    source = """<!DOCTYPE html><html class="has-sidebar"><head><title>t</title><script>var a="</p>";</script></head><body>
    <header>site</header><div id="cookie-notice">We use</div><nav><ul><li>menu</ul></nav>
    <div class="layout"><aside>side</aside><article><header><h1>Head&amp;line</h1></header>
    <p>One <b>two</b>&nbsp;&copy;<br>three<p>four <!-- gone --> five<form><p>mail?</p></form>
    <div class="ad-slot">buy</div><ul><li>a<li>b</ul><section id="comments"><p>reader</p></section>
    <p hidden>no</p><p>a&lt;b</p></article><article class="comment"><p>a much longer reader comment than the article itself, on and on</p></article>
    </div><footer>&copy; x</footer></body>"""
    assert page(source) == "Head&line\nOne two © three\nfour five\na\nb\na<b"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>open <b>only", "open only"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<p>x</p><script>1</script", "x"), ("<" * 50, "<" * 50), ("<main><p>m</p></main><p>out</p>", "m"),
    ],
)
def test_odd_pages(source, text):
    assert page(source) == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ('<div class="content has-sidebar"><article><p>whole story</p></article></div>', "whole story"),
        ('<div class="sidebar"><article><p>whole story</p></article><p>x</p></div>', "whole story"),
        ('<form id="aspnetForm"><p>all of the page</p></form>', "all of the page"),
        ('<article><div class="post-header"><h1>Title</h1></div><p>text</p></article>', "Title\ntext"),
        ('<p>a long enough piece of prose</p><div class="notice-of-intent">we mean it</div>', "a long enough piece of prose\nwe mean it"),
        ('<p>short</p><div class="legal"><p>the law says most of this page</p></div>', "short\nthe law says most of this page"),
        ('<div class="banner"><h1>T</h1></div><p>text of the page</p><div class="sidebar">x</div>', "T\ntext of the page"),
        ('<p>text</p><div class="comments"><p>far more words than the text has</p></div>', "text"),
        ('<p>one <span class="share">tweet</span> two</p><div class="adSlot">buy</div>', "one two"),
    ],
)
def test_names_mark_leaf_like_areas_only(source, text):
    assert page(source) == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article><p>part one</p></article><p>x</p><article><p>the second part</p></article>", "part one\nthe second part"),
        ("<main><h1>Title</h1><p>lead</p><article><p>the long rest of it</p></article></main><p>x</p>", "Title\nlead\nthe long rest of it"),
        ("<main><p>lead</p></main><article>a<article class='comment'>reader</article></article><p>x</p>", "lead\na"),
    ],
)
def test_all_articles_are_read(source, text):
    assert page(source) == text


def brute_matching(one, two, a=0, b=0) -> int:
    kids = [[[c for c in range(1, len(t[0])) if t[0][c] == e] for e in range(len(t[0]))] for t in (one, two)]

    def w(x, y):
        if one[1][x] != two[1][y]:
            return 0
        xs, ys = kids[0][x], kids[1][y]
        m = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, p in enumerate(xs):
            for j, q in enumerate(ys):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + w(p, q))
        return 1 + m[-1][-1]

    return w(a, b)


def test_tree_matching_is_a_valid_matching():
    rng = random.Random(2)

    def tree():
        n = rng.randint(1, 14)
        parent = [-1] + [rng.randint(max(0, i - 4), i - 1) for i in range(1, n)]
        return np.array(parent), np.array([0] + [rng.randint(1, 2) for _ in range(1, n)], np.uint32), np.zeros(n, np.int64)

    for _ in range(100):
        one, two = tree(), tree()
        pairs = wrapper.match_trees(one, two)
        assert len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs) <= brute_matching(one, two)
        assert all(one[1][a] == two[1][b] for a, b in pairs)
        assert all((one[0][a], two[0][b]) in [*pairs, (-1, -1)] for a, b in pairs)


def test_equal_trees_match_whole():
    tree = wrapper.Page("<ul>" + "<li>x" * 50 + "</ul><p>a</p><p>b</p>").tree()
    assert len(wrapper.match_trees(tree, tree)) == len(tree[0])


def test_long_lists_are_aligned_whole():
    def table(rows):
        return wrapper.Page("<table>" + "".join(f"<tr><td>row {i}</td><td>x</td></tr>" for i in rows) + "</table>").tree()

    one, two = table(range(2500)), table(range(-1, 2599))
    pairs = wrapper.match_trees(one, two)
    assert len(pairs) == len(one[0]) and all(one[2][a] == two[2][b] for a, b in pairs)


def test_halving_keeps_the_largest_sum(monkeypatch):
    rng = np.random.default_rng(3)
    for cells in (4, 40):
        monkeypatch.setattr(wrapper, "_MOST_CELLS", cells)
        for _ in range(50):
            table = rng.integers(0, 4, (rng.integers(1, 12), rng.integers(1, 12)))
            pairs = sorted(wrapper.align_lists(lambda i, js, t=table: t[i][js], np.arange(len(table)), np.arange(table.shape[1])))
            best = np.zeros((table.shape[0] + 1, table.shape[1] + 1), int)
            for i, j in np.ndindex(*table.shape):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + table[i, j])
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
            assert sum(table[p] for p in pairs) == best[-1, -1]


def test_template_of_a_host_is_left_out(spark):
    def html(i):
        return f"<body><div><p>Welcome to our site</p></div><div><p>story number {i} tells something long enough</p><p>end {i}</p></div></body>"

    rows = [(i, f"http://h.example/{i}", html(i), "t") for i in range(12)]
    rows += [(50, "http://lone.example/", html(50), "t"), (None, None, None, None), (3, "http://h.example/3", html(3), "t")]
    out = wrapper.main_texts(spark.createDataFrame(rows, PAGES)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.n_chars == len(r.text)
        if r.page_id is None:
            assert r.text == ""
        elif r.page_id == 50:  # one page has no template
            assert r.text.startswith("Welcome")
        else:
            assert r.text == f"story number {r.page_id} tells something long enough\nend {r.page_id}"
    assert wrapper.main_texts(spark.createDataFrame([], PAGES)).count() == 0


def test_copies_are_not_taken_for_template(spark):
    rows = [(i, "http://h.example/", "<p>the same article</p><p>on all pages</p>", None) for i in range(9)]
    assert {r.text for r in wrapper.main_texts(spark.createDataFrame(rows, PAGES)).collect()} == {"the same article\non all pages"}


def test_template_is_left_out_of_short_pages_too(spark):
    notice = "<div><p>Welcome to the site of the society, which has been on line for a very long time</p></div>"
    rows = [(i, f"http://h.example/{i}", f"{notice}<div><p>story {i}{' and more of it' * (i % 2) * 20}</p></div>", None) for i in range(12)]
    out = wrapper.main_texts(spark.createDataFrame(rows, PAGES)).collect()
    assert all(r.text == f"story {r.page_id}{' and more of it' * (r.page_id % 2) * 20}" for r in out)


def test_near_copies_are_not_taken_for_template(spark):
    same = "".join(f"<p>paragraph {k} of the article</p>" for k in range(8))
    rows = [(i, f"http://h.example/{i}", f"<div>{same}</div><p>{i} views</p>", None) for i in range(9)]
    for r in wrapper.main_texts(spark.createDataFrame(rows, PAGES)).collect():
        assert r.text == "\n".join([*(f"paragraph {k} of the article" for k in range(8)), f"{r.page_id} views"])


def test_template_of_other_layouts_optional_blocks_and_small_hosts(spark):
    def story(i):
        return f"<p>story {i}</p><p>what {i} says</p>"

    def html(i):
        if i % 3 == 0:  # the second layout
            return f"<table><tr><td><h3>Second welcome</h3></td><td><blockquote>{story(i)}</blockquote></td></tr></table>"
        more = "<section><h4>Our <b>offer</b></h4><p>of the week</p></section>" if i % 4 == 1 else ""
        return f"<div><h2>Welcome</h2></div>{more}<div>{story(i)}</div>"

    rows = [(i, f"http://h.example/{i}", html(i), None) for i in range(40)]
    rows += [(i, "http://two.example/", f"<div><h2>Welcome</h2></div><div>{story(i)}</div>", None) for i in (50, 51)]
    for r in wrapper.main_texts(spark.createDataFrame(rows, PAGES)).collect():
        assert r.text == f"story {r.page_id}\nwhat {r.page_id} says"


def test_archives_round_trip(spark):
    same = "<p>same é</p>"
    rows = [(i, f"http://x/{i}", same if i % 3 == 1 else f"<p>{i}</p>\r\n\r\nWARC/1.0", "t") for i in range(30)]
    rows += [(40, None, None, None), (41, "u\r\nv", "", None), (7, "http://x/7", same, "t")]
    folder, listed = warc.write_archives(spark.createDataFrame(rows, PAGES))
    out = warc.read_archives(spark, folder, listed).collect()
    assert len(out) == len(rows)
    first: dict = {}
    for p, _, h, _ in sorted(rows, key=lambda r: r[0]):
        first.setdefault(h or "", p)
    for r in out:
        h = next(x[2] for x in rows if x[0] == r.page_id) or ""
        assert r.payload_bytes == len(h.encode()) and r.payload_digest == warc.digest(h.encode())
        revisit = first[h] != r.page_id
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == (first[h] if revisit else None)
        assert r.html == (None if revisit else h)
    folder, listed = warc.write_archives(spark.createDataFrame(rows, PAGES), min_bytes=10_000)
    assert warc.read_archives(spark, folder, listed).where("record_type = 'revisit'").count() == 0
    folder, listed = warc.write_archives(spark.createDataFrame([], PAGES))
    assert listed.count() == 0


def test_archives_resolve_repeated_ids_per_payload(spark):
    rows = [(3, "a", "AAA", None), (4, "c", "CCC", None), (7, "a", "AAA", None), (7, "b", "BBB", None),
            (9, "a", "AAA", None), (9, "c", "CCC", None), (3, "a", "AAA", None), (None, "a", "AAA", None)]
    folder, listed = warc.write_archives(spark.createDataFrame(rows, PAGES))
    out = sorted(
        ((r.page_id, r.html, r.record_type, r.refers_to, r.payload_digest) for r in warc.read_archives(spark, folder, listed).collect()),
        key=str,
    )
    d = {h: warc.digest(h.encode()) for h in ("AAA", "BBB", "CCC")}
    assert out == sorted(
        [(3, "AAA", "response", None, d["AAA"]), (3, "AAA", "response", None, d["AAA"]), (4, "CCC", "response", None, d["CCC"]),
         (7, None, "revisit", 3, d["AAA"]), (7, "BBB", "response", None, d["BBB"]), (9, None, "revisit", 3, d["AAA"]),
         (9, None, "revisit", 4, d["CCC"]), (None, "AAA", "response", None, d["AAA"])],
        key=str,
    )


PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute_spans(text: str) -> list:
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = [
                lambda: True, lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                lambda d=digits: 16 <= len(d) <= 19 and pii.luhn(d), lambda d=digits: 8 <= len(d) <= 15,
            ][kind]
            if good():
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    parts = ["a", "B1", "@", ".", "-", " ", "+", "(", ")", "7", "49", "255.1.0.9", "256.1.1.1", "4111111111111111",
             "4111 1111 1111 1111", "x@y.zz", "a.b@c-d.e.f", "+49 (170) 123-4567", "é", "1.2.3.4.5.6.7.8", "\n", "%"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("9" * 100_000 + "@" + "a" * 100_000) == []


def labelled_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8)))
    out = []
    for _ in range(n):
        item = rng.choice(
            [f"{word()}.{rng.randint(1, 99)}@{word()}.{word()}.org", ".".join(str(rng.randint(1, 250)) for _ in range(4)),
             f"+{rng.randint(1, 9)} ({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}",
             f"{rng.randint(1900, 2030)}"]
        )
        out.append(" ".join([word() for _ in range(8)] + [item] + [word() for _ in range(8)]))
    return out


def test_tagger_learns_its_labels():
    rows = [w for t in labelled_texts(240, 1) for w in pii._labelled(t)]
    x = pii.codes([r[1] for r in rows])
    y = np.array([np.frombuffer(r[2], np.int8) for r in rows], dtype=np.int64)
    weights = pii.train(x[:180], y[:180], steps=160)
    path, sure = pii.tagged(x[180:], weights)
    inside = y[180:] > 0
    assert (path[inside] == y[180:][inside]).mean() > 0.9
    assert (path[~inside] == 0).mean() > 0.98 and (sure <= 1 + 1e-6).all()


def test_windows_cover_all_anchors_and_overlap():
    text = "x" * 300 + "1" * 500 + "y" * 100 + "@" + "z" * 10
    found = pii.windows(text)
    assert all(any(lo <= i < hi for lo, hi in found) for i, c in enumerate(text) if c in "1@")
    assert all(hi - lo <= pii.WINDOW for lo, hi in found)
    assert pii.reconcile([(0, 0, 5, 0.9), (1, 3, 9, 0.95), (0, 0, 5, 0.9), (2, 20, 30, 0.9)]) == [(0, 0, 5), (2, 20, 30)]


def test_spans_and_masks(spark):
    texts = ["mail a.b@c.org or +49 (170) 123-4567", None, "", "nothing here", *labelled_texts(40, 2)]
    docs = spark.createDataFrame([(i, t, "k", 3) for i, t in enumerate(texts)], "doc_id long, text string, kind string, n_ip long")
    weights = pii.fit(docs, per_kind=20, steps=20)
    rows = {r.doc_id: r for r in pii.spans(docs, weights).collect()}
    for i, t in enumerate(texts):
        listed = ",".join(f"{pii.KINDS[k]}:{lo}:{hi}" for k, lo, hi in brute_spans(t or ""))
        assert rows[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(rows[i].spans.split(","))
    masked = pii.masked(docs, None).orderBy("doc_id").collect()
    assert masked[0].text == "mail <email> or <phone>" and masked[1].text is None and masked[3].text == "nothing here"
    assert masked[0].kind == "k" and pii.spans(docs.limit(0), None).count() == 0
    assert pii.fit(docs.limit(0), steps=1)["out"].shape


def test_neighbours_with_copies_and_unusable_rows(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(400, 8))
    v[50:200] = v[50]  # one vector holds a large part of all rows
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)]
    rows += [(1000, None, 1), (1100, [0.0] * 8, 1), (1200, [float("nan")] * 8, 1), (1300, [1.0, None] * 4, 1),
             (1400, [1.0] * 3, 1), (None, [1.0] * 8, 1), (0, v[0].tolist(), 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    out = hnsw.neighbours(table, F.col("vec_id") % 100 == 0, k=10).collect()
    hit = 0
    for q in range(0, 400, 100):
        far = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        order = [int(i) for i in np.lexsort((np.arange(400), far)) if i != q][:10]
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(abs(r.score - far[r.vec_id]) < 1e-12 for r in mine)
        hit += len(set(order) & {r.vec_id for r in mine})
    assert hit >= 39 and {r.query_id for r in out} == {0, 100, 200, 300}
    assert hnsw.neighbours(table.limit(0), F.lit(True)).count() == 0


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 300)
    monkeypatch.setattr(hnsw, "QUERIES_PER_BLOCK", 7)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(1000, 16))
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    out = hnsw.neighbours(table, F.col("vec_id") % 50 == 0, k=5).collect()
    hit = 0
    for q in range(0, 1000, 50):
        far = ((v - v[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hit += len(set(np.argsort(far)[:5]) & {r.vec_id for r in out if r.query_id == q})
    assert hit / 100 >= 0.95


def test_graphs_are_not_repeated_for_the_queries_they_meet(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 100)
    monkeypatch.setattr(hnsw, "QUERIES_PER_BLOCK", 16)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(900, 8)).astype(np.float32)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, v array<float>")
    index = hnsw.build_index(rows, 9).cache()
    assert index.rdd.getNumPartitions() == 9 and index.count() == 9
    found = hnsw.search(index, rows, 9, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan  # a join would send the graph along with every block of queries
    got = found.collect()
    assert len(got) <= 900 * 5 * 4  # five of each group, and there are no more groups than shuffle partitions
    far = np.sqrt(((v[:, None].astype(float) - v[None]) ** 2).sum(axis=2))
    hits = 0
    for i in range(900):
        mine = sorted((r.score, r.found) for r in got if r.query == i)[:5]
        assert all(abs(s - far[i, f]) < 1e-12 for s, f in mine)
        hits += len({f for _, f in mine} & set(np.argsort(far[i], kind="stable")[:5].tolist()))
    assert hits / 4500 >= 0.99
    index.unpersist()


@pytest.mark.parametrize("n", [1, 3, 40, 700])
def test_walks_side_by_side_find_what_single_walks_find(n):
    rng = np.random.default_rng(n)
    vectors = rng.standard_normal((n, 12)) + 1e4
    graph = hnsw.build(vectors)
    wanted = rng.standard_normal((30, 12)) + 1e4
    many = graph.search_many(wanted, 11)
    assert many.shape == (30, hnsw.EF_SEARCH)
    hits = 0
    for q, found in zip(wanted, many, strict=True):
        found = found[found >= 0]
        assert len(set(found.tolist())) == len(found)
        hits += len(set(found[:11].tolist()) & set(graph.search(q, 11)[:11].tolist()))
    assert hits >= 0.99 * 30 * min(n, 11)


def quality_texts(n: int) -> list[tuple[int, str | None, int]]:
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8)))
    out = []
    for i in range(n):
        good = rng.random() < 0.7
        text = " ".join(word() for _ in range(rng.randint(5, 80)))
        out.append((i, text + "." if good else text.upper().replace(" ", "!! "), int(good)))
    return out


def test_quality_scores_on_held_out_rows(spark):
    rows = quality_texts(500)
    extra = [(900, None), (901, ""), (None, "abc"), (902, "x" * 300_000)]
    docs = spark.createDataFrame([(d, t, 0.5) for d, t, _ in rows] + [(d, t, 0.5) for d, t in extra], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows] + [(900, None)], "doc_id long, label int")
    out = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert len(out) == len(rows) + len(extra) and all(0 <= s <= 1 for s in out.values())
    folds = {r.doc_id: r.f for r in docs.select("doc_id", quality.fold(F.col("doc_id")).alias("f")).collect()}
    held = [(out[d], y) for d, _, y in rows if folds[d] == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.95


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(1, 20)], "doc_id long, label int")
    assert {r.score for r in quality.classify(docs, one).collect()} <= {0.5, 1.0}
    assert quality.classify(docs.limit(0), one).count() == 0


def test_isotonic_is_the_closest_monotone_fit():
    weight, total = np.array([1, 0, 2, 1, 1.0]), np.array([1, 0, 0, 1, 0.0])
    fit = quality.isotonic(weight, total)
    assert (np.diff(fit) >= -1e-12).all()
    assert fit[0] == pytest.approx(1 / 3) and fit[4] == pytest.approx(0.5)


def test_statistics_of_slices_agree():
    texts = ["one two two", None, "", "LOUD!! words |", "a\nb\nc"]
    assert np.allclose(quality.statistics(texts), np.vstack([quality.statistics([t]) for t in texts]))


@pytest.mark.parametrize(("offset", "scale"), [(0.0, 1.0), (1e4, 1.0), (1e6, 1.0), (0.0, 1e-25), (0.0, 1e20), (1e6, 1e-3)])
def test_graph_recall_off_the_origin_and_at_extreme_scales(offset, scale):
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((1500, 32)) * scale + offset
    graph = hnsw.build(vectors)
    hits = 0
    for i in range(0, 1500, 30):
        q = vectors[i]
        truth = np.argsort(np.sqrt(((vectors - q) ** 2).sum(axis=1)), kind="stable")[:11]
        found = graph.search(q, 11)
        found = found[np.argsort(np.sqrt(((vectors[found] - q) ** 2).sum(axis=1)), kind="stable")][:11]
        hits += len(set(truth.tolist()) & set(found.tolist()))
    assert hits / (50 * 11) >= 0.9
