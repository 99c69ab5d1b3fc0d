"""Benchmark items that repeat themselves."""

from tidemark.llm import tiling


def test_copy_of_an_item_of_one_phrase_is_found(spark):
    text = " ".join(["one two three four five"] * 12)
    docs = spark.createDataFrame([(1, f"before {text} after"), (2, "one two three four five")], "doc_id long, text string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    (row,) = tiling.contaminated(docs, items).collect()
    assert (row.doc_id, row.item_id, row.covered) == (1, 7, 60)
