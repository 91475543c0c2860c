"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import put
from tollgate.llm import op12_phrases as P

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top=P.TOP):
    counts: dict = {}
    for lang, text in rows:
        f = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        c = {p: a for p, a in f.items() if len(p) >= 2 and a >= min_count}
        scored = []
        for p, a in c.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in c.items()):
                continue
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string").selectExpr(
        "*", "1 AS f", "'x' AS phrase", "2 AS k", "3 AS n")


def got(df):
    return sorted(tuple(r) for r in df.collect())


def prose(seed, n, words="the cat sat on a mat Ünder new York city zoo"):
    r = random.Random(seed)
    return "".join(r.choice(words.split()) + r.choice([" ", " ", "  ", "\t", ", ", ".\n"]) for _ in range(n))


@pytest.mark.parametrize("min_count, shard_words, bits, summed", [(5, 2_000_000, 28, 256), (3, 40, 6, 4), (9, 500, 10, 2)])
def test_against_plain_counts(spark, monkeypatch, min_count, shard_words, bits, summed):
    """One shard or many; with room for every phrase in a bucket of its own or with few buckets."""
    monkeypatch.setattr(P, "MOST_BUCKETS", bits)
    monkeypatch.setattr(P, "PART_BITS", 5)
    monkeypatch.setattr(P, "SUMMED_SHARDS", summed)
    rows = [("en" if i % 3 else "de", prose(i, 150)) for i in range(30)]
    rows += [("en", "new york city zoo " * 12), ("en", "New York City. " * 40), (None, "a b c " * 20), ("und", "a b c d a b"), ("fr", None), ("fr", ""),
             ("de", " \t\n ,.;"), ("en", "z" * 100_000), ("en", "q r s t u v " * 3_000), ("en", "\x00 \x1c x y " * 10)]
    rows += rows[:3]
    df = P.collocations(spark, frame(spark, rows), min_count, shard_words=shard_words)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, min_count)
    assert got(df) == want and {x[0] for x in want} >= {"en", "de", "und"}


def test_top_and_ties(spark):
    rows = [("en", "b a. d c. f e. " * 7)]
    df = P.collocations(spark, frame(spark, rows), 5, top=2)
    assert [x[2] for x in got(df)] == ["b a", "d c"] and got(df) == brute(rows, 5, 2)


def test_large_counts_are_exact(spark, monkeypatch):
    """Products beyond 64 bits: counts of the order of a hundred billion."""
    f, n = 300_000_000_007, 9_000_000_000_000_011
    found = spark.createDataFrame([("en", "x", 1, f + 1), ("en", "y", 1, f + 2), ("en", "x y", 2, f)], "lang string, phrase string, k int, f long")
    total = spark.createDataFrame([("en", n)], "lang string, n long")
    monkeypatch.setattr(P, "counted_phrases", lambda *_: (found, total))
    row = P.collocations(spark, None).first()
    assert row.score == 1000 * f * n // ((f + 1) * (f + 2))


def test_index_intervals_and_round_trip():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 5, 3000).astype(np.int32)
    ids[0] = 0
    words = pa.table({"lang": pa.array([b"", *[b"en"] * 4], pa.large_binary()), "word": pa.array([b"", b"a", b"b", b"c", b"d"], pa.large_binary())})
    index = P.FMIndex.from_bytes(P.FMIndex(P.FMIndex.transform(ids), words).to_bytes())
    assert index.words.equals(words)
    n = np.bincount(index.bwt, minlength=5)
    lo, size = (np.cumsum(n) - n)[1:], n[1:]
    phrases = [(i,) for i in range(1, 5)]
    for k in range(2, 6):
        which, before, lo, size = index.extended(lo, size)
        order = np.argsort(lo)
        phrases = [(int(before[i]), *phrases[which[i]]) for i in order]
        lo, size = lo[order], size[order]
        assert list(zip(*(x.tolist() for x in index.ids(lo, k)))) == phrases
        plain = Counter(tuple(ids[i:i + k].tolist()) for i in range(len(ids) - k + 1) if ids[i:i + k].all())
        assert dict(zip(phrases, size.tolist())) == plain


def test_bucket_sums_saturate(spark):
    rows = [P._packed(np.array([1, 5]), np.array([3, 2]), 0, 1), P._packed(np.array([0, 5]), np.array([1, 100]), 0, 2)]
    out = list(P._summed(3, 50)(iter(P._rows(rows).to_batches())))
    assert len(out) == 1 and out[0].num_rows == 1
    again = P._rows([P._sparse(np.array([1, 3, 0, 0, 0, 50, 0, 0], np.uint32), 0, 1)]).to_batches()[0]
    assert out[0].equals(again)


def test_empty_table(spark, tmp_path):
    put(frame(spark, []), tmp_path, "documents")
    df = P.op12_phrase_collocations(spark, str(tmp_path))
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and df.count() == 0


def test_phrases_move_packed(spark, monkeypatch):
    """Words and phrases pass between shards and sums as one row for each part of the keys, not one a phrase."""
    monkeypatch.setattr(P, "PART_WORDS", 2_500)
    rows_of, write = {}, P.written

    def counting(spark, df, name):
        out = write(spark, df, name)
        rows_of[name] = out.count()
        return out

    monkeypatch.setattr(P, "written", counting)
    rows = [("en" if i % 4 else "de", prose(i, 300)) for i in range(40)]
    assert got(P.collocations(spark, frame(spark, rows), 3, shard_words=700)) == brute(rows, 3)
    shards, parts = rows_of["phrase-shards"], 16
    assert 10 <= shards <= 40 and rows_of["phrase-counts-2"] > 100
    moved = [rows_of[f"phrase-answers-{k}"] for k in range(1, 6)]
    assert all(x <= (shards + 1) * parts for x in moved), moved
    assert not {f"phrase-{x}-{k}" for x in ("nodes", "state") for k in range(1, 6)} & set(rows_of)


def test_narrowed_rows_extend_as_the_whole_index():
    """Rounds from the third on read the rows of frequent phrases alone, and find the same phrases and counts."""
    rng = np.random.default_rng(6)
    ids = np.minimum(rng.geometric(0.2, 20_000), 60).astype(np.int32) - 1
    ids[0] = 0
    index = P.FMIndex(P.FMIndex.transform(ids), pa.table({c: pa.array([b"w"] * 60, pa.large_binary()) for c in ("lang", "word")}))
    n = np.bincount(index.bwt, minlength=60)
    whole = rows = index
    lo, size = (np.cumsum(n) - n)[1:], n[1:]
    own, names = lo, [(i,) for i in range(1, 60)]
    for k in range(2, P.MAX_WORDS + 1):
        which, before, new, n = whole.extended(lo, size)
        narrow = rows.extended(own, size)
        assert all((a == b).all() for a, b in zip((which, before, n), (narrow[0], narrow[1], narrow[3])))
        names = [(int(b), *names[w]) for w, b in zip(which, before)]
        plain = Counter(tuple(ids[i:i + k].tolist()) for i in range(len(ids) - k + 1) if ids[i:i + k].all())
        known = set(names)
        assert dict(zip(names, n.tolist())) == {p: c for p, c in plain.items() if p in known}
        assert {p for p, c in plain.items() if c >= 20} <= known
        keep = n >= 20
        lo, size, names = new[keep], n[keep], [p for p, on in zip(names, keep) if on]
        rows = rows.narrowed(narrow[2][keep], size)
        own = np.cumsum(size) - size
        assert len(rows.shorter) == size.sum() < len(ids)


def test_tokens_are_numbered_by_language():
    texts = [b"New  York,\tnew\x00york..", b"", b" a\r\nb ", b"\x1c NEW"]
    data, begins = P.tokens(texts)
    cut = [bytes(x) for x in np.split(data, begins[1:])]
    pieces = [re.findall(rb"[^\x20\x09]+", piece) for t in texts for piece in re.split(rb"[.,;:!?\x0A-\x0D]", t.lower())]
    assert cut == [w for piece in pieces for w in [*piece, b"\n"]]
    ids, words = P._numbered([(data, begins), P.tokens([b"york b c"])], 7)
    assert words.to_pylist() == [b"new", b"york", b"new\x00york", b"a", b"b", b"\x1c", b"c"]
    assert ids.tolist() == [7, 8, 0, 9, 0, 0, 0, 0, 10, 0, 0, 11, 0, 12, 7, 0, 8, 11, 13, 0]


@pytest.mark.parametrize("numbers", [[3, 0, 3, 1, 0], [], [5], [2**40, 7, 2**62, 7, 0], [2**62] * 3])
def test_order_is_stable(numbers):
    assert P._order(np.array(numbers, np.int64)).tolist() == sorted(range(len(numbers)), key=lambda i: (numbers[i], i))


def test_shards_are_dealt_over_all_salts(spark):
    """Names of shards end in twenty zeros; with two salts, all shards had the same."""
    shards = spark.range(400).selectExpr("id << 20 AS shard")
    for salts in (2, 8):
        n = [r["count"] for r in shards.groupBy(P._salt(salts).alias("salt")).count().collect()]
        assert len(n) == salts and min(n) > 400 / salts / 2
