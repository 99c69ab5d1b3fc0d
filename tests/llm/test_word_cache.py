"""The packing stage bounds the words that a worker keeps; ids stay those of the tokenizer."""

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import packing, tokens


def test_few_cached_words_give_the_same_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = tokens.Encoder(path, True, cached=40)
    for k in range(6):
        texts = [" ".join(f"word{(i * i + k) % 70}x, and" for i in range(60)), None, f"a{k} b\nc.", "  odd  text "]
        ids, bounds = own.encode(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            plain = own.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert ids[bounds[i] : bounds[i + 1]].tolist() == plain
        assert len(own.place) <= 40


def test_packing_stage_bounds_the_cache(spark, monkeypatch):
    seen = []

    def pieces(docs, path, **given):
        seen.append(given)
        return docs.withColumn("ids", F.lit(None))

    monkeypatch.setattr(packing, "pieces", pieces)
    monkeypatch.setattr(packing, "pack", lambda cut, capacity: cut)
    corpus_pipeline.packing_stage(spark, spark.range(1), "")
    assert seen[0]["cached"] < tokens.CACHED_WORDS
