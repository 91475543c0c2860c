"""Substring dedup: spans and texts against brute force over all windows."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_helpers import documents, put
from tollgate.llm import op13_repeats as R


def brute(rows, window):
    """(doc_id, words, removed, kept words) of every row, from all windows of all rows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ids = [R.NO_ID if d is None else d for d, _ in rows]
    first: dict = {}
    for d, w in zip(ids, words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for (doc_id, _), d, w in zip(rows, ids, words):
        go = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                go.update(range(i, i + window))
        out.append((doc_id, len(w), len(go), " ".join(x for i, x in enumerate(w) if i not in go)))
    return sorted(out, key=repr)


def got(spark, rows, window, tile=R.TILE):
    df = R.without_repeats(spark, documents(spark, rows), window, tile)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=repr)


def words(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(4000)}é" for _ in range(n)]


def test_passages_cut_anywhere(spark):
    """Whole copies, parts of a passage, two passages side by side, near copies, repeats inside a document."""
    a, b, c = words(1, 130), words(2, 90), words(3, 60)
    edited = a[:70] + ["changed"] + a[71:]
    rows = [(5, " ".join(words(4, 20) + a + words(5, 20))), (9, "\n".join(a)), (7, " ".join(a[30:95] + words(6, 9))), (8, " ".join(a[:49])),
            (11, " ".join(edited)), (12, " ".join(b + a[40:] + b)), (10, "  ".join(b)), (13, " ".join(c + c)), (14, "\t".join(c + c[:30])),
            (2, " ".join(c[5:57])), (20, " ".join(words(9, 400))), (21, None), (22, ""), (None, " ".join(a)), (None, " ".join(words(30, 80))),
            (3, " ".join(words(30, 80))), (9, "\n".join(a)), (40, "x" * 200_000), (41, "x " * 70_000), (42, "y x " * 40)]
    want = brute(rows, 50)
    assert got(spark, rows, 50) == want
    assert sum(x[2] for x in want) > 500


@pytest.mark.parametrize("window, tile, letters", [(6, 2, 3), (5, 12, 2), (2, 1, 6), (9, 4, 4)])
def test_short_windows_over_few_words(spark, window, tile, letters):
    """Very common phrases with many contexts; equal rolling-hash minima all over."""
    r = random.Random(window)
    rows = [(r.randrange(40), " ".join(r.choice("abcdefgh"[:letters]) for _ in range(r.randrange(0, 60)))) for _ in range(60)]
    assert got(spark, rows, window, tile) == brute(rows, window)


def test_many_small_shards_and_parts(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_WINDOWS", 40)
    monkeypatch.setattr(R, "PART_ROWS", 2)
    shared = words(50, 70)
    rows = [(i, " ".join(words(100 + i, 15) + shared + words(200 + i % 5, 60))) for i in range(30)]
    assert got(spark, rows, 50) == brute(rows, 50)


def test_word_hashes_and_rolling():
    text = " a  bb\tccc\n\x0b\x0cdd\réé a ".encode()
    h = R.word_hashes(text)
    assert len(h) == 6 and h[0] == h[5] and len(set(h.tolist())) == 5
    assert len(R.word_hashes(b"")) == len(R.word_hashes(b" \n ")) == 0
    w = np.arange(1, 200, dtype=np.uint64)
    for k in (1, 2, 3, 25, 50):
        got_ = R.rolling(w, k)
        want = [sum(int(x) * pow(int(R._BASE), k - 1 - j, 2**64) for j, x in enumerate(w[i:i + k].tolist())) % 2**64 for i in range(len(w) - k + 1)]
        assert got_.tolist() == want
    assert len(R.rolling(w[:3], 4)) == 0


def test_query_and_empty_table(spark, tmp_path):
    a = words(7, 120)
    rows = [(3, " ".join(a)), (1, " ".join(a[20:100])), (2, None)]
    put(documents(spark, rows), tmp_path, "documents")
    got_ = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in R.op13_substring_dedup(spark, str(tmp_path)).collect()}
    assert got_ == {d: (n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute(rows, 50)}
    put(documents(spark, []), tmp_path, "documents")
    df = R.op13_substring_dedup(spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and df.count() == 0
