"""Token ids, their files, and packing."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, simple8b
from tidemark.llm.tokens import Encoder

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [
    "a  b\n\nc \t'll don't <|endoftext|> x", " lead", "trail ", "\n", "a\nb\n c", "Ünï ΣΑΣ x1 22", "", None,
    "a\x00b \x01", "a　b", "x. y, z.", "word " * 3000, "one two",
]
SCHEMA = "doc_id long, text string, length long"


@pytest.mark.parametrize(("path", "spaced"), [(WORD, False), (BYTE, True)])
def test_encoder_equals_the_tokenizer(path, spaced):
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    own = Encoder(path, spaced)
    for _ in range(2):
        ids, bounds = own.encode(pa.array(ODD))
        for i, text in enumerate(ODD):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids
    own.place = dict.fromkeys(map(str, range(10)), 0)
    own._thin()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 70), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=2500))
def test_pack_round_trip(values):
    ids = np.array(values, dtype=np.uint64)
    words, offsets = simple8b.pack(ids)
    assert (simple8b.unpack(words, offsets, len(ids)) == ids).all()


def test_escapes_that_look_like_selectors():
    ids = np.full(3000, 15 << 60, dtype=np.uint64)
    words, offsets = simple8b.pack(ids)
    assert (simple8b.unpack(words, offsets, len(ids)) == ids).all()


def test_files_in_document_order(spark):
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(3, "repeated id", 7), (None, "no id", None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    folder, listed = simple8b.write_ids(docs, WORD, end_id=2)
    found = simple8b.read_ids(spark, folder, listed).orderBy("start").collect()
    plain = Tokenizer.from_file(WORD)
    plain.encode_special_tokens = True
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda d: -1 if d is None else d)
    start = 0
    texts = {(r[0], r[1]) for r in rows}
    for r in found:
        options = [plain.encode(t or "", add_special_tokens=False).ids + [2] for d, t in texts if d == r.doc_id]
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids in options and r.start == start and r.n_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4"))
        start += r.n_tokens


def test_files_of_an_empty_table(spark):
    folder, listed = simple8b.write_ids(spark.createDataFrame([], SCHEMA), WORD, end_id=2)
    assert listed.count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_assign_fills_without_overlap(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    bins, offsets = packing.assign(lengths, 64)
    for b in set(bins.tolist()):
        mine = np.flatnonzero(bins == b)
        mine = mine[np.argsort(offsets[mine])]
        assert offsets[mine].tolist() == [0, *np.cumsum(lengths[mine])[:-1].tolist()]
        assert lengths[mine].sum() <= 64


def test_assign_takes_the_smallest_sum_of_squares():
    """Against the rule written out: try every gap and add up the squares."""
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 33, 300)
    counts: dict[int, int] = {}
    made = 0
    for s in sorted(lengths.tolist(), reverse=True):
        best = None
        for gap in sorted(g for g, n in counts.items() if n and g >= s):
            after = dict(counts)
            after[gap] -= 1
            if gap > s:
                after[gap - s] = after.get(gap - s, 0) + 1
            cost = sum(n * n for n in after.values())
            if best is None or cost < best[0]:
                best = (cost, after)
        if best is None:
            made += 1
            counts[32 - s] = counts.get(32 - s, 0) + (s < 32)
        else:
            counts = best[1]
    assert packing.assign(lengths, 32)[0].max() + 1 == made


def test_pieces_and_sequences(spark):
    rows = [(i, t, 7) for i, t in enumerate([*ODD, "again", "again"])] + [(None, "no id", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = packing.pack(packing.pieces(docs, BYTE, end_id=0, capacity=256), 256).collect()
    plain = Tokenizer.from_file(BYTE)
    plain.encode_special_tokens = True
    texts = {r[0]: r[1] for r in rows}
    by_doc: dict = {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
    for d, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        ids = [*plain.encode(texts[d] or "", add_special_tokens=False).ids, 0]
        assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == ids
        assert all(r.length == 256 for r in own[1:]) and own[0].length <= 256
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
    assert set(by_doc) == set(texts)
    total = sum(r.length for r in out)
    assert len({r.sequence_id for r in out}) <= -(-total // 256) + 1
    assert packing.pack(packing.pieces(docs.limit(0), BYTE, 0, 256), 256).count() == 0
