"""BPE by prefixes against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents, put
from tokenizers import Tokenizer
from tollgate.llm import op7_bpe as B


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(B.vocabulary_path(B.VOCABULARY))
    t.no_truncation()
    t.no_padding()
    return t


TEXTS = ["", None, "Hello, World!", "it's we'll I'd they've 'twas ''s", "aaaaaaaaaaaaaaaaaaaaaaa aaaa", "x" * 5000,
         "É é ñ ß İstanbul ΟΔΟΣ Σ ﬁ ǅ", "1234 5½ ² Ⅷ ٣", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> <|end", "日本語 テスト 한국어 🎉🎉 👩‍👩‍👧",
         "a\x1cb\x1fc\x85d\xa0e f　g\x0bh", "\x00\x01\x7f\xad", " \t\n ", "</w> w>/ </w", "don'T CAN'T 'S", "_a_b__ -- ... ?!",
         "​﻿ zero", "e" + "́" * 40, " ".join(f"word{i}ing" for i in range(4000))]


def test_fixed_texts(library):
    c = B.codec(B.VOCABULARY)
    for t in TEXTS:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert c.encode(t or "") == want, t
        assert c.decode(want) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abcdeinorst' 's1.", max_size=80)))
def test_any_text(text):
    t = Tokenizer.from_file(B.vocabulary_path(B.VOCABULARY)) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = t
    assert B.codec(B.VOCABULARY).encode(text) == t.encode(text, add_special_tokens=False).ids


def test_random_words(library):
    rng, c = random.Random(5), B.codec(B.VOCABULARY)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 24))) for _ in range(4000)]
    assert c.bpe.encode_words(words) == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_query(spark, tmp_path, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "null id")]
    got = B.op7_bpe_codec(spark, put(documents(spark, rows), tmp_path, "documents")).collect()
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_driver_documents(spark, library):
    got = {r.doc_id: r for r in B.op7_bpe_codec(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bounded_tables(monkeypatch, library):
    monkeypatch.setattr(B, "KEEP_WORDS", 10)
    monkeypatch.setattr(B, "KEEP_PAIRS", 10)
    c = B.TextCodec(B.vocabulary_path(B.VOCABULARY))
    for t in TEXTS:
        assert c.encode(t or "") == library.encode(t or "", add_special_tokens=False).ids


def test_empty_table_and_ids(spark):
    assert B.encoded(documents(spark, [])).count() == 0
    row = B.encoded(documents(spark, [(1, "Hello there")]), with_ids=True).first()
    assert B.codec(B.VOCABULARY).decode(row.ids) == row.decoded
    with pytest.raises(ValueError):
        B.TextCodec(B.vocabulary_path("byte_bpe_50k.json"))


def test_plain_words_skip_the_pattern(library):
    """Letters, also before punctuation, are cut at white space; only other pieces meet the pattern."""
    class Seen:
        def __init__(self, pattern):
            self.pattern, self.texts = pattern, []

        def findall(self, text):
            self.texts.append(text)
            return self.pattern.findall(text)

    c = B.TextCodec(B.vocabulary_path(B.VOCABULARY))
    c.pattern = Seen(c.pattern)
    text = "Hello, wörld!! (so) it's 12 a\x85b'\nend.'s ''' x²"
    assert c.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert c.pattern.texts == ["(so)", "it's", "12", "end.'s", "'''", "x²"]
