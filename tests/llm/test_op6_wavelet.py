"""Wavelet-matrix token files: brute force over ids, and an exact round trip."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents, put
from test_op7_bpe import TEXTS
from tokenizers import Tokenizer
from tollgate.llm import op6_wavelet as W
from tollgate.llm.common import table
from tollgate.llm.op7_bpe import vocabulary_path


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path(W.VOCABULARY))
    t.no_truncation()
    t.no_padding()
    return t


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=300), st.integers(0, 75), st.integers(0, 300), st.integers(0, 300))
def test_rank_select_access(ids, token, low, high):
    low, high = min(low, high), max(low, high)
    w = W.WaveletMatrix.build(np.array(ids, np.uint16))
    _, _, w = W.parse_file(W.file_bytes([1], [len(ids)], np.array(ids, np.uint16)))
    assert w.decode().tolist() == ids
    assert [w.access(i) for i in range(len(ids))] == ids
    where = [i for i, x in enumerate(ids) if x == token]
    assert w.occurrences(token).tolist() == where
    assert [w.select(token, k) for k in range(len(where))] == where
    assert w.count(token, low, high) == ids[low:high].count(token)
    assert w.rank(token, high) == ids[:high].count(token)


def test_long_sequence_crosses_samples():
    ids = np.random.default_rng(0).integers(0, 50257, 20_000).astype(np.uint16)
    w = W.WaveletMatrix.build(ids)
    assert (w.decode() == ids).all()
    assert all(w.access(i) == ids[i] for i in range(0, 20_000, 997))
    assert w.count(int(ids[5]), 3, 15_000) == int((ids[3:15_000] == ids[5]).sum())
    with pytest.raises(IndexError):
        w.select(int(ids[5]), 20_000)


def brute(rows, library):
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_pieces_equal_whole_texts(library):
    e = W.encoder(W.VOCABULARY)
    texts = [t or "" for t in TEXTS] + ["a  b   c\n\n d\t\te \r\n", "  lead", "trail  ", "x\xa0\xa0y 　 z", "'s''s ''ll '", "<|endoftext|><|endoftext|> x"]
    for t in texts:
        assert np.frombuffer(e.encode(t), "<u2").tolist() == library.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab 's\n\t1.\xa0 \x1c", max_size=60)))
def test_any_text(text):
    if not hasattr(test_any_text, "t"):
        test_any_text.t = Tokenizer.from_file(vocabulary_path(W.VOCABULARY))
    assert np.frombuffer(W.encoder(W.VOCABULARY).encode(text), "<u2").tolist() == test_any_text.t.encode(text, add_special_tokens=False).ids


def test_query_small_shards(spark, tmp_path, library):
    rows = [(i * 7 % 31, t) for i, t in enumerate(TEXTS)] + [(None, "null id")]
    docs = table(spark, put(documents(spark, rows), tmp_path, "documents"), "documents")
    folder, files = W.write_shards(spark, docs, shard_tokens=300)
    assert files.count() > 4
    got = sorted(map(tuple, W.read_shards(spark, folder, files).collect()), key=lambda r: r[1])
    assert got == brute(rows, library)


def test_driver_documents(spark, library):
    got = sorted(map(tuple, W.op6_wavelet_tokens(spark, "/root/testdata/sf0.001").collect()), key=lambda r: r[1])
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got == brute(rows, library)


def test_repeated_ids_and_empty_table(spark, tmp_path):
    rows = [(5, "a"), (5, "a"), (5, "b"), (1, None)]
    got = sorted(map(tuple, W.op6_wavelet_tokens(spark, put(documents(spark, rows), tmp_path, "documents")).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [1, 5, 5, 5] and [r[1] for r in got] == [0, 1, 3, 5]
    assert W.op6_wavelet_tokens(spark, put(documents(spark, []), tmp_path / "e", "documents")).count() == 0
