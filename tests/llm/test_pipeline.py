"""The stages one by one against plain versions of their rules."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_dedup import brute_components
from test_extract import brute_spans, quality_texts
from tidemark.llm import pii, quality


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    item = " ".join(f"q{i}" for i in range(25))
    rows = [(d, t, "en", "s", len(t)) for d, t, _ in quality_texts(300)]
    long = " ".join(f"w{i}" for i in range(60))
    rows += [
        (1000, long, "en", "s", len(long)), (1001, long + " more", "en", "s", len(long) + 5),
        (1002, "before " + item + " after", "en", "s", 9), (1003, "write to a.b@c.org now, please do", "en", "s", 33),
        (None, "no id", "en", "s", 5), (1004, None, None, None, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, y, 0) for d, _, y in quality_texts(300)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        before = {r.doc_id: r for r in docs.collect()}
        kept = {r.doc_id: r for r in after.collect()}
        assert set(kept) <= set(before)
        if name == "quality":
            found = quality.features(docs)
            labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
            score = {r.doc_id: r.score for r in quality.scores(found, quality.fit(found, labels)).collect()}
            assert set(kept) == {d for d in before if score[d] >= 0.3}
            loud = {d for d, t, y in quality_texts(300) if not y}
            assert len(loud & set(kept)) < 0.1 * len(loud)
        elif name == "neardup":
            expected = brute_components({d: r.text for d, r in before.items() if d is not None}, 5)
            assert {d for d in kept if d is not None} == {d for d, c in expected.items() if d == c}
        elif name == "decontamination":
            assert set(before) - set(kept) == {1002} & set(before)
        else:
            assert set(kept) == set(before)
            for d, r in kept.items():
                if r.text is not None:
                    assert brute_spans(r.text) == [] and r.n_chars == len(r.text)
                assert (r.text is None) == (before[d].text is None)
            assert "<email>" in kept[1003].text
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == set(kept)
    for seq in {r.sequence_id for r in packed}:
        own = sorted((r for r in packed if r.sequence_id == seq), key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]


def test_masks_leave_nothing_that_the_patterns_find():
    text = "x 4111111111111111 y 10.0.0.1 z +49 170 1234567 u a@b.cd"
    (base, every), = pii.find([text], None)
    assert base == every == brute_spans(text)
    assert re.search(pii._ANCHOR, text)


def test_repeated_ids_lose_no_text(spark, folder):
    rows = [(1, "t t t t t t"), (2, "u u u u u u"), (2, "t t t t t t"), (3, "u u u u u u"), (5, "x x x x x x"), (5, "x x x x x x"), (None, "t t t t t t"), (None, "y y y y y y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.neardup_stage(spark, docs, folder).collect())
    assert kept == Counter([(1, "t t t t t t"), (2, "u u u u u u"), (5, "x x x x x x"), (None, "y y y y y y")])
    items = spark.createDataFrame([(1, "u u u u u u")], "item_id long, text string")
    items.write.mode("overwrite").parquet(f"{folder}/repeat/benchmark.parquet")
    clean = Counter((r.doc_id, r.text) for r in corpus_pipeline.decontamination_stage(spark, docs, f"{folder}/repeat").collect())
    assert clean == Counter(r for r in rows if r[1] != "u u u u u u")
    clash = docs.withColumn("_row", F.lit("mine")).withColumn("_id", F.lit(7))
    kept = corpus_pipeline.neardup_stage(spark, clash, folder)
    assert kept.columns == clash.columns
    assert Counter((r.doc_id, r.text, r._row, r._id) for r in kept.collect()) == Counter(
        (d, t, "mine", 7) for d, t in [(1, "t t t t t t"), (2, "u u u u u u"), (5, "x x x x x x"), (None, "y y y y y y")]
    )
