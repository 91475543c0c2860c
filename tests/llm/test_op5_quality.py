"""Quality rules against a brute-force version."""

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents, put
from tollgate.llm import op5_quality as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def covered(n):
        grams = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
        return {j for i in range(len(words) - n + 1) if grams[tuple(words[i:i + n])] > 1 for j in range(i, i + n)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup, dup_bytes = set(), 0, 0
    for x in lines:
        dup, dup_bytes = dup + (x in seen), dup_bytes + (x in seen) * len(x.encode())
        seen.add(x)
    chars, rep, sym = sum(map(len, words)), len(covered(5)), len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * rep > 20 * len(words)
    kept = not failed and sym <= 0.30 * len(words) and dup_bytes <= 0.20 * max(1, sum(len(x.encode()) for x in lines))
    for n, most in ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10)):
        kept = kept and sum(len(words[j]) for j in covered(n)) <= most * max(1, chars)
    return len(words), chars, sym, dup, rep, failed, kept


TEXTS = ["", None, "one", "a b c d e a b c d e", "x y z w v " * 30, "line one\nline one\n \nline two\nline one",
         " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(200)) + " w3 w4 w5 w6 w7 w8 tail",
         "é ü ñ # * $ % & | < > " * 3, "\x0bodd\x0cspace not\x85split\x1cnor", "same line here again and again\n" * 40,
         " ".join(f"q{i * i % 89}" for i in range(5000))]


def test_measures_match_brute_force(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS * 2)] + [(0, TEXTS[4]), (None, "null id")]
    got = Q.op5_quality_rules(spark, put(documents(spark, rows), tmp_path, "documents"))
    got = sorted((tuple(r)[:1] + (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                  for r in got.collect()), key=repr)
    assert got == sorted(((d, *brute(t)) for d, t in rows), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "cc", "ü", "\n", "#"]), max_size=60).map(" ".join), max_size=4))
def test_property(texts):
    m = Q.measure([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert tuple(m[f][i] for f in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")) == brute(t)


def test_pieces_give_the_same_words():
    text = (" ".join(f"w{i}" for i in range(300)) + "x" * 500).encode()
    whole, parts = Q._number([text]), Q._number([text], piece=50)
    assert whole.words == parts.words and (whole.ids == parts.ids).all()


def test_keep_drops_rejected_rows_and_keeps_columns(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    kept = Q.keep(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, t in enumerate(TEXTS) if brute(t)[-1]]
    assert Q.keep(documents(spark, [])).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_clean_documents_stay(spark, sf):
    rows = Q.op5_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1"), "doc_id")
    n, kept = rows.count(), rows.where("kept").count()
    assert kept >= 0.9 * n
